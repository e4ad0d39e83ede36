"""Column helpers for text rules that follow Unicode-aware regular expressions.

Patterns run with ``(?Ud)``: classes are Unicode's and only a line feed ends a line.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

FLAGS = "(?Ud)"
ANY_CASE = "(?iuUd)"
#: What ``\s`` means in these patterns: white space as Unicode has it.
SPACES = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def sub(text: Column, pattern: str, to: str = "", flags: str = FLAGS) -> Column:
    return F.regexp_replace(text, flags + pattern, to)


def group(text: Column, pattern: str, n: int = 1, flags: str = FLAGS) -> Column:
    """A group of the first match; empty where nothing matches."""
    return F.regexp_extract(text, flags + pattern, n)


def has(text: Column, pattern: str, flags: str = FLAGS) -> Column:
    return text.rlike(flags + pattern)


def strip(text: Column, also: str = "") -> Column:
    """White space off both ends, or, given ``also``, those characters instead."""
    return F.btrim(text, F.lit(also or SPACES))


def present(text: Column) -> Column:
    """Null in place of an empty text, which is computed once."""
    return F.get(F.filter(F.array(text), lambda t: t != ""), F.lit(0))


def two_digits(number: Column) -> Column:
    return F.lpad(number, 2, "0")


def any_of(words: list[str] | tuple[str, ...]) -> str:
    """A non-capturing alternation of literal words, longest first."""
    return "(?:" + "|".join(w.replace("-", r"\-") for w in sorted(words, key=len, reverse=True)) + ")"
