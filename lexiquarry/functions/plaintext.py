"""Wikitext to plain text: one chain of regular expressions, all in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ANY_CASE, FLAGS, strip, sub

# The markup forms, in the order in which they go.
COMMENT = r"(?s)<!--.*?-->"
REF = r"(?s)<ref[^>]*>.*?</ref>|<ref[^/]*/?>"
CATEGORY = r"\[\[Category:[^\]]*\]\]"
MEDIA = r"\[\[(?:File|Image):[^\]]*\]\]"
INNER_TEMPLATE = r"\{\{[^{}]*\}\}"
LINK = r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]"
WEB_LINK = r"\[https?://[^\s\]]+(?: ([^\]]*))?\]"
TAG = r"<[^>]+>"
QUOTES = r"'{2,5}"
HEADING = r"(?m)^=+\s*(.*?)\s*=+$"
#: Templates nest so deep and no deeper.
TEMPLATE_PASSES = 3


def without_templates(text: Column) -> Column:
    for _ in range(TEMPLATE_PASSES):
        text = sub(text, INNER_TEMPLATE)
    return text


def plaintext(wikitext: Column) -> Column:
    """Markup off, link labels kept, blank runs collapsed, ends stripped."""
    text = sub(sub(wikitext, COMMENT), REF)
    text = without_templates(sub(sub(text, CATEGORY, flags=ANY_CASE), MEDIA, flags=ANY_CASE))
    text = sub(sub(text, LINK, "$1"), WEB_LINK, "$1")
    text = sub(sub(sub(text, TAG), QUOTES), HEADING, "$1")
    return strip(sub(sub(text, r"\n{3,}", "\n\n"), " {2,}", " "))


def word_count(text: Column) -> Column:
    """Words between white space; null counts 0."""
    words = F.filter(F.split(text, FLAGS + r"\s+"), lambda w: w != "")
    return F.when(text.isNull(), F.lit(0)).otherwise(F.size(words)).cast("long")
