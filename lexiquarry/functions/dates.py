"""Dates as text: full, partial, circa and BC dates do not fit a date type, so they stay strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ANY_CASE, group, has, let, strip, sub, two_digits

# Month names, in order.
MONTHS = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
MONTH = "(?:" + "|".join(MONTHS) + ")"
_SHORT = "".join(m[:3] for m in MONTHS).lower()

# The forms of dates. First what ``normalise`` takes off before it reads a date: pattern, replacement, any case.
_CLEANING = (
    ("&ndash;", "-", False),
    ("&nbsp;", " ", False),
    (r"&\w+;", "", False),
    (r"(?s)\}\}.*", "", False),
    (r"\s*[,(]?\s*aged\s+(?:about\s+)?\d+[^)]*\)?\s*,?\s*$", "", True),
    (r"\s*\(age\s+\d+[^)]*\)\s*$", "", True),
    (r"(\d+)(?:st|nd|rd|th)\b", "$1", True),
    (r"^(?:On|Possibly|Died|Birth date|Either)\s+", "", True),
)
_CIRCA = r"^[Cc]\.\s*"
_ERA = r"\s*B\.?C\.?E?\.?\s*$"
_ISO, _DAY_FIRST = r"^(\d{4})-(\d{1,2})-(\d{1,2})$", r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})$"
_YEAR, _YEARS = r"^\d{3,4}$", r"^\d{3,4}[-/]\d{2,4}$"
#: Pattern, and the groups of day, month and year; the forms read a prefix, but for month and year.
_WORDED = (
    (rf"^(\d{{1,2}})\s+(?:of\s+)?({MONTH}),?\s*(\d{{1,4}})", 1, 2, 3),
    (rf"^({MONTH})\s+(\d{{1,2}}),\s*(\d{{1,4}})", 2, 1, 3),
    (rf"^({MONTH})\s+(\d{{1,2}})\s+(\d{{4}})", 2, 1, 3),
    (rf"^({MONTH})\s+(\d{{1,4}})$", 0, 1, 2),
)
_DECADE = r"^(?:early|late|mid)?\s*(\d{3,4})s$"
_CENTURY = r"^(\d{1,2})(?:st|nd|rd|th)?[- ]?century$"
#: What no rule below alters, and the two ways of writing a date of which none but that form's own is true.
_KEPT = r"\A(?:c\. )?(?:[0-9]{3,4}|[0-9]{4}-[0-9]{2}-[0-9]{2})\z"
_PLAIN = rf"\A(?:[0-9]{{1,2}} {MONTH} [0-9]{{3,4}}|{MONTH} [0-9]{{1,2}}, [0-9]{{3,4}})\z"
_MONTH_DAY, _DAY_MONTH = rf"^({MONTH}),?\s+(\d{{1,2}})$", rf"^(\d{{1,2}})\s+({MONTH})$"


def month_number(name: Column) -> Column:
    """Two digits of a month's full name."""
    at = F.instr(F.lit(_SHORT), F.substring(F.lower(name), 1, 3))
    return two_digits(((at + 2) / 3).cast("int").cast("string"))


def _date(year: Column, *rest: Column) -> Column:
    return F.concat_ws("-", year, *rest)


def _numeric(s: Column) -> list[tuple[Column, Column]]:
    """Conditions and values of the forms without words, in their order."""
    day, month = group(s, _DAY_FIRST).cast("int"), group(s, _DAY_FIRST, 2).cast("int")
    return [
        (has(s, _ISO), _date(group(s, _ISO), two_digits(group(s, _ISO, 2)), two_digits(group(s, _ISO, 3)))),
        (has(s, _YEAR), s),
        (has(s, _YEARS), group(s, r"^(\d{3,4})")),
        (has(s, _DAY_FIRST) & month.between(1, 12) & day.between(1, 31), _date(group(s, _DAY_FIRST, 3), two_digits(group(s, _DAY_FIRST, 2)), two_digits(group(s, _DAY_FIRST)))),
    ]


def _worded(s: Column) -> list[tuple[Column, Column]]:
    """The forms with a month's name, in their order."""
    out = []
    for pattern, day, month, year in _WORDED:
        part = lambda n, p=pattern: group(s, p, n, ANY_CASE)
        days = [two_digits(part(day))] if day else []
        out.append((has(s, pattern, ANY_CASE), _date(part(year), month_number(part(month)), *days)))
    return out


def _first(cases: list[tuple[Column, Column]], otherwise: Column) -> Column:
    chain = F
    for condition, value in cases:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def _plain(s: Column) -> Column:
    """The date of a text in a form of ``_PLAIN``, by its words."""

    def read(words: Column) -> Column:
        one, two, year = (F.get(words, F.lit(n)) for n in range(3))
        day_first = F.length(one) < 3
        month, day = F.when(day_first, two).otherwise(one), F.when(day_first, one).otherwise(F.translate(two, ",", ""))
        return _date(year, month_number(month), two_digits(day))

    return let(F.split(s, " "), read)


def normalise(raw: Column) -> Column:
    """``YYYY-MM-DD``, ``YYYY-MM``, ``YYYY``, with ``c. `` before or `` BC`` after; text without a form stays; null without a digit."""
    text = strip(raw)
    for pattern, to, any_case in _CLEANING:
        text = sub(text, pattern, to, ANY_CASE) if any_case else sub(text, pattern, to)
        if pattern.startswith("(?s)"):
            text = F.when(raw.contains("}}"), strip(text)).otherwise(text)

    def dated(held: Column) -> Column:
        circa = F.when(has(held, _CIRCA), F.lit("c. ")).otherwise(F.lit(""))
        bare = sub(sub(held, _CIRCA), r"\s+or\s+.*$")
        bare = sub(bare, r"(?s)^(\d{3,4}),\s+.*", "$1")
        bare = strip(sub(strip(sub(bare, r"\s+", " ")), r",+\z"))
        return let(F.struct(circa.alias("circa"), bare.alias("s")), read)

    def read(x: Column) -> Column:
        s, circa = x["s"], x["circa"]
        era = has(s, _ERA, ANY_CASE)
        return _first([(c, F.concat(circa, v)) for c, v in _numeric(s)], F.when(era, before_christ(circa, strip(sub(s, _ERA, "", ANY_CASE)))).otherwise(after(circa, s)))

    def before_christ(circa: Column, rest: Column) -> Column:
        return let(rest, lambda s: _first([(has(s, r"^\d{1,4}$"), F.concat(circa, s, F.lit(" BC"))), *((c, F.concat(circa, v, F.lit(" BC"))) for c, v in _worded(s)), (s != "", F.concat(circa, s, F.lit(" BC")))], F.lit(None).cast("string")))

    def after(circa: Column, s: Column) -> Column:
        return _first([(c, F.concat(circa, v)) for c, v in _worded(s)], F.when(has(s, r"\d"), s))

    return F.when(has(raw, _KEPT), raw).when(has(raw, _PLAIN), _plain(raw)).when(raw != "", let(text, dated))


def normalise_with_note(raw: Column) -> Column:
    """A struct of ``date`` and ``note``; the note tells where the date stands for a decade, a century or no year."""

    none = F.lit(None).cast("string")
    pair = lambda date, n=none: F.struct(date.alias("date"), n.alias("note"))

    def read(x: Column) -> Column:
        s, bare = x["s"], x["bare"]
        note = F.concat(F.lit("~"), s)
        no_year = F.concat(note, F.lit(" (no year)"))
        year = F.lpad(((group(bare, _CENTURY, 1, ANY_CASE).cast("int") - 1) * 100 + 1).cast("string"), 4, "0")
        return (
            F.when(has(bare, _DECADE, ANY_CASE), pair(F.concat(group(bare, _DECADE, 1, ANY_CASE).cast("int").cast("string"), F.lit("-01-01")), note))
            .when(has(bare, _CENTURY, ANY_CASE), pair(F.concat(year, F.lit("-01-01")), note))
            .when(has(s, _MONTH_DAY, ANY_CASE), pair(_date(F.lit("9999"), month_number(group(s, _MONTH_DAY, 1, ANY_CASE)), two_digits(group(s, _MONTH_DAY, 2, ANY_CASE))), no_year))
            .when(has(s, _DAY_MONTH, ANY_CASE), pair(_date(F.lit("9999"), month_number(group(s, _DAY_MONTH, 2, ANY_CASE)), two_digits(group(s, _DAY_MONTH, 1, ANY_CASE))), no_year))
            .otherwise(pair(normalise(s)))
        )

    s = strip(raw)
    both = F.struct(s.alias("s"), strip(sub(s, r"^[Cc]\.?\s*")).alias("bare"))
    return F.when(has(raw, _KEPT), pair(raw)).when(raw != "", let(both, read)).otherwise(pair(none))


def sort_key(date: Column) -> Column:
    """A struct of year, month, day; what is missing counts 0. BC dates have none."""
    part = lambda parts, n: F.coalesce(F.get(parts, F.lit(n)).try_cast("int"), F.lit(0))
    return let(F.split(sub(date, r"^c\. "), "-"), lambda p: F.struct(part(p, 0).alias("y"), part(p, 1).alias("m"), part(p, 2).alias("d")))


def _pick(dates: Column, last: bool) -> Column:
    """The least or greatest of an array of dates; of equal ones, the first."""
    keyed = F.transform(dates, lambda d, i: F.struct(sort_key(d).alias("k"), (-i if last else i).alias("i"), d.alias("date")))
    return (F.array_max if last else F.array_min)(keyed)["date"]


def earliest(dates: Column) -> Column:
    return _pick(dates, False)


def latest(dates: Column) -> Column:
    return _pick(dates, True)
