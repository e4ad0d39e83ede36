"""Name origins from a section or from the lead."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .plaintext import plaintext
from .text import ANY_CASE, FLAGS, group, has, present, strip, sub

# Headings, cue phrases, and lengths.
HEADINGS = (
    r"(?:etymology|name(?:\s+origin)?|origin(?:\s+of\s+(?:the\s+)?name)?|naming|history\s+and\s+name|name\s+and\s+history"
    r"|name\s+and\s+etymology|derivation(?:\s+of\s+(?:the\s+)?name)?)"
)
CUES = (
    r"(?:named?\s+(?:after|for|from)|derives?\s+from|the\s+name\s+(?:comes?\s+from|derives?\s+from|means?|is\s+derived|originates?)"
    r"|its\s+name\s+(?:comes?\s+from|means?)|named\s+in\s+honor)"
)
SECTION_CHARACTERS, LEAD_CHARACTERS, LEAST_CHARACTERS = 2000, 1500, 20

#: A section of level 2 or 3, up to the next heading of its level or above; those of level 3 are in one of level 2, too.
_SECTION = r"(?sm)^(?=(==(?!=)[^\n]*?(?<!=)==(?!=)[ \t]*$(?:(?!^={1,2}(?!=)).)*+|===(?!=)[^\n]*?(?<!=)===(?!=)[ \t]*$(?:(?!^={1,3}(?!=)).)*+))"
#: What the heading of such a section holds, whatever markup is about it.
_HINT = r"\A[^\n]*(?:etymology|nam|origin|derivation)"


def from_section(wikitext: Column) -> Column:
    """Text, on one line, of the first section under such a heading that has any; headings may hold links, tags, quotes and templates."""
    sections = F.filter(F.regexp_extract_all(wikitext, F.lit(FLAGS + _SECTION), F.lit(1)), lambda s: has(s, _HINT, ANY_CASE))
    title = lambda section: plaintext(group(section, r"\A=+([^\n]*?)=+[ \t]*(?:\n|\z)"))
    named = F.filter(sections, lambda s: has(title(s), rf"\A{HEADINGS}\z", ANY_CASE))

    def text_of(section: Column) -> Column:
        body = sub(section, r"(?m)^=+.*$")
        lines = F.filter(F.split(plaintext(body), "\n"), lambda line: has(line, r"\S") & ~has(line, r"^\s*="))
        return F.substring(strip(F.array_join(lines, " ")), 1, SECTION_CHARACTERS)

    return F.get(F.filter(F.transform(named, text_of), lambda t: t != ""), F.lit(0))


def from_lead(text: Column) -> Column:
    """The sentence of the lead that holds the first cue, if it is long enough."""
    sentence = strip(group(F.substring(text, 1, LEAD_CHARACTERS), rf"(?s)(?:^|\.)([^.]*?{CUES}[^.]*\.?)", 1, ANY_CASE))
    return F.when(F.length(sentence) > LEAST_CHARACTERS, present(sentence))


def etymology(wikitext: Column, text: Column) -> Column:
    return F.coalesce(from_section(wikitext), from_lead(text))


