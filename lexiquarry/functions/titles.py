"""Titles as keys and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ANY_CASE, strip, sub

# Administrative suffixes, of which a key drops one.
_SUFFIX = r"\s+(?:county|parish|borough|census\s+area|municipality|district|department|prefecture|province|commune)$"


def spaced(title: Column) -> Column:
    return F.translate(title, "_", " ")


def underscored(title: Column) -> Column:
    return F.translate(title, " ", "_")


def title_key(title: Column) -> Column:
    """Lower case, one administrative suffix off the part before the first comma, white space collapsed."""
    parts = F.transform(F.split(spaced(title), ",", 2), lambda p: strip(p))
    head = sub(F.get(parts, F.lit(0)), _SUFFIX, "", ANY_CASE)
    joined = F.concat_ws(", ", head, F.get(parts, F.lit(1)))
    return F.lower(strip(sub(joined, r"\s+", " ")))


def language(wiki: Column) -> Column:
    """The language code of a wiki's name."""
    return sub(wiki, r"wiki$")


def article_url(title: Column, lang: str = "en") -> Column:
    """The article's address; ``_ / : ,`` and unreserved characters stay as they are."""
    path = F.url_encode(underscored(title))
    for code, plain in (("*", "%2A"), ("%7E", "~"), ("%2F", "/"), ("%3A", ":"), ("%2C", ",")):
        path = F.replace(path, F.lit(code), F.lit(plain))
    return F.concat(F.lit(f"https://{lang}.wikipedia.org/wiki/"), path)
