"""Fields of infobox templates: found, split and cleaned in the JVM, however deep templates nest.

Templates that nest to ``DEPTH`` levels are matched by one regular expression, with possessive repeats, so long
infoboxes neither back up nor overflow the stack. What nests deeper is cut into pieces, which are runs of such templates,
links and texts, bars, and runs of the braces left over, and one pass over them counts how many braces are open. That takes
time in proportion to the text, and a step for a run of braces, not for each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import MONTH, month_number
from .plaintext import COMMENT, LINK, MEDIA, QUOTES, TAG, without_templates
from .text import ANY_CASE, FLAGS, any_of, group, has, let, present, strip, sub, two_digits

#: Levels that the regular expression knows; deeper ones are counted.
DEPTH = 4
# Templates that hold a date.
DATE_TEMPLATES = (
    "birth date", "death date", "birth date and age", "death date and age", "birth-date", "death-date", "birth-date and age",
    "death-date and age", "b-da", "d-da", "start date", "end date", "start date and age", "end date and age",
)


@dataclass(frozen=True)
class Infobox:
    """Which templates to read and which parameters make which field, the first that is filled."""

    names: tuple[str, ...]
    aliases: dict[str, tuple[str, ...]]
    dates: frozenset[str] = field(default_factory=frozenset)
    numbers: frozenset[str] = field(default_factory=frozenset)


def _nested(depth: int) -> str:
    inner = "" if depth == 0 else f"|{_nested(depth - 1)}"
    return rf"\{{\{{(?:[^{{}}]++{inner}|\{{(?!\{{)|\}}(?!\}}))*+\}}\}}"


_TEMPLATE = _nested(DEPTH - 1)
_PIECE = rf"(?:[^|{{}}\[\]]++|{_TEMPLATE}|\[\[[^\[\]]*+\]\]|[{{}}\[\]])"
_PARAMETER = rf"(?s)\|({_PIECE}*+)"
#: All of a text in pieces; braces of templates that nest too deep, or are not closed, stand apart, those that open with the
#: text (and bars) between them, which lie within the first.
_OPENED = rf"\{{\{{[^{{}}\[\]]*+(?:(?:(?=(?:\{{\{{[^{{}}]*+){{{DEPTH + 1}}})|(?!{_TEMPLATE}))\{{\{{[^{{}}\[\]]*+)*+"
_PIECES = rf"(?s)\||(?:[^|{{}}\[\]]++|{_TEMPLATE}|\[\[[^\[\]]*+\]\]|\{{(?!\{{)|\}}(?!\}})|[\[\]])++|{_OPENED}|\}}\}}(?:\}}\}})*+"
_SHALLOW_BODY = rf"(?s)\A(?:\|(?:[^{{}}]++|{_TEMPLATE}|\{{(?!\{{)|\}}(?!\}}))*+)?\}}\}}"


def _pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(FLAGS + _PIECES), F.lit(0))


def _scan(pieces: Column) -> Column:
    """``close``: which piece (from 1) closes the template that is open at the start, if one does, by the ``nth`` braces of it; ``bars``: those that part its parameters."""
    none = F.lit(None).cast("int")
    state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("open"), none.alias("close"), none.alias("nth"), F.array().cast("array<int>").alias("bars"))

    def step(s: Column, piece: Column) -> Column:
        at, open_ = s["at"] + 1, s["open"]
        to = lambda open_, close=none, nth=none, bars=s["bars"]: F.struct(at.alias("at"), open_.alias("open"), close.alias("close"), nth.alias("nth"), bars.alias("bars"))
        opens, closes = piece.startswith("{{") & ~piece.contains("}"), piece.startswith("}}")
        braces = ((F.length(piece) - F.length(F.translate(piece, "{", ""))) / 2).cast("int")
        ends = (F.length(piece) / 2).cast("int")
        return (
            F.when(s["close"].isNotNull(), s)
            .when(piece == "|", F.when(open_ == 0, to(open_, bars=F.concat(s["bars"], F.array(at)))).otherwise(to(open_)))
            .when(closes, F.when(open_ < ends, to(F.lit(0), at, open_ + 1)).otherwise(to(open_ - ends)))
            .when(opens, to(open_ + braces))
            .otherwise(to(open_))
        )

    return F.aggregate(pieces, state, step)


def _closed(rest: Column) -> Column:
    """``rest``, which follows a template's name, up to the braces that close it; null if none do."""
    cut = lambda pieces: let(_scan(pieces), lambda s: F.concat(F.array_join(F.slice(pieces, F.lit(1), s["close"] - 1), ""), F.repeat(F.lit("}}"), s["nth"])))
    return F.coalesce(present(group(rest, _SHALLOW_BODY, 0)), let(_pieces(rest), cut))


def _opening(names: tuple[str, ...]) -> str:
    return rf"(?s)\{{\{{\s*{any_of(names)}\s*(?=\||\}}\}})"


def infobox(wikitext: Column, names: tuple[str, ...]) -> Column:
    """What stands between the name and the closing braces of the first template so named that is closed; null without one.

    Comments go first, as they may hold bars and braces.
    """
    opening = _opening(names)
    after = lambda text: group(text, opening + r"(.*)\z", 1, ANY_CASE)

    def search(rest: Column) -> Column:
        """Of the first opening, or of the next ones as long as the one before is not closed."""
        state = F.struct(rest.alias("rest"), F.lit(None).cast("string").alias("body"))
        step = lambda s, _: F.when(s["body"].isNotNull() | (s["rest"] == ""), s).otherwise(F.struct(after(s["rest"]).alias("rest"), _closed(s["rest"]).alias("body")))
        tries = F.sequence(F.lit(0), F.regexp_count(rest, F.lit(ANY_CASE + opening)))
        return F.aggregate(tries, state, step, lambda s: s["body"])

    return let(after(sub(wikitext, COMMENT)), lambda rest: F.when(rest != "", F.coalesce(present(group(rest, _SHALLOW_BODY, 0)), search(rest))))


def parameters(body: Column) -> Column:
    """An array of ``name`` (null: by position) and ``value``, both stripped."""
    part = lambda pieces, s: F.transform(s["bars"], lambda bar, n: F.array_join(F.slice(pieces, bar + 1, F.coalesce(F.get(s["bars"], n + 1), F.size(pieces) + 1) - bar - 1), ""))
    deep = lambda inside: let(_pieces(inside), lambda pieces: let(_scan(pieces), lambda s: part(pieces, s)))
    shallow = lambda inside: F.regexp_extract_all(inside, F.lit(FLAGS + _PARAMETER), F.lit(1))
    parts = lambda inside: F.when(inside.contains("{{") & sub(inside, _TEMPLATE).contains("{{"), deep(inside)).otherwise(shallow(inside))

    def read(p: Column) -> Column:
        """By the first ``=`` that no bracket or brace stands before."""
        before = lambda name: F.when((name != p) & ~name.contains("{") & ~name.contains("["), name)
        name_value = lambda name: F.struct(strip(name).alias("name"), strip(F.when(name.isNull(), p).otherwise(F.substring(p, F.length(name) + 2, F.length(p)))).alias("value"))
        return let(let(F.substring_index(p, "=", 1), before), name_value)

    return F.transform(let(sub(body, r"\}\}\z"), parts), read)


def _iso(text: Column) -> Column:
    """``D Month Y`` or ``Month D, Y`` at the start of a text; else null."""
    dmy, mdy = rf"^(\d{{1,2}})\s+({MONTH})\s+(\d{{3,4}})", rf"^({MONTH})\s+(\d{{1,2}}),?\s+(\d{{3,4}})"
    at = lambda p, n: group(text, p, n, ANY_CASE)
    return F.when(has(text, dmy, ANY_CASE), F.concat_ws("-", at(dmy, 3), month_number(at(dmy, 2)), two_digits(at(dmy, 1)))).when(
        has(text, mdy, ANY_CASE), F.concat_ws("-", at(mdy, 3), month_number(at(mdy, 1)), two_digits(at(mdy, 2)))
    )


def template_date(value: Column) -> Column:
    """The date of the first date template, at any depth, in a value that holds one; else null."""
    rests = F.regexp_extract_all(value, F.lit(ANY_CASE + _opening(DATE_TEMPLATES) + r"(?=(.*)\z)"), F.lit(1))
    bodies = F.filter(F.transform(rests, _closed), lambda b: b.isNotNull())

    def dated(body: Column) -> Column:
        by_place = F.filter(parameters(body), lambda p: p["name"].isNull() | has(p["name"], r"^\d+\z"))
        return let(F.transform(by_place, lambda p: p["value"]), of_values)

    def of_values(values: Column) -> Column:
        numbers = F.filter(values, lambda v: has(v, r"^\d{1,4}\z"))
        year, month, day = (F.get(numbers, F.lit(n)) for n in range(3))
        fits = (F.size(numbers) >= 3) & month.cast("int").between(1, 12) & day.cast("int").between(1, 31)
        written = F.concat_ws("-", year, F.lpad(month.cast("int").cast("string"), 2, "0"), F.lpad(day.cast("int").cast("string"), 2, "0"))
        return F.coalesce(F.when(fits, written), _iso(F.get(values, F.lit(0))))

    return F.get(F.filter(F.transform(bodies, dated), lambda d: d.isNotNull()), F.lit(0))


# What cleaning takes off a value after templates, in order: pattern, replacement, any case.
_CLEANING = (
    (LINK, "$1", False),
    (MEDIA, "", True),
    (r"(?s)<ref[^>]*>.*?</ref>", "", False),
    (r"<ref[^/]*/?>", "", False),
    (TAG, "", False),
    ("&nbsp;", " ", False),
    ("&ndash;", "–", False),
    ("&mdash;", "—", False),
    (r"&\w+;", "", False),
    (QUOTES, "", False),
    (r"\}\}", "", False),
    (r"\{\{", "", False),
    (r"\d+px\b", "", False),
    (r"\s*\n\s*\*?\s*", "; ", False),
    (r"\s+", " ", False),
)


#: What each of these patterns, and templates, need a part of: a value without any stays as it is.
_MARKUP = r"[\[{}<&]|''|px|[^\S ]|  "


def clean(value: Column, date: bool = False, number: bool = False) -> Column:
    """A value without markup; null if nothing is left."""
    bare = without_templates(value)
    for pattern, to, any_case in _CLEANING:
        bare = sub(bare, pattern, to, ANY_CASE if any_case else FLAGS)
    text = present(strip(strip(strip(F.when(has(value, _MARKUP), bare).otherwise(value)), ",;")))
    if number:
        text = F.translate(text, ",", "")
    return F.coalesce(F.when(value.contains("{{"), template_date(value)), text) if date else text


def fields(wikitext: Column, spec: Infobox, wanted: tuple[str, ...] | None = None) -> Column:
    """A struct of the wanted fields, null where the article has none.

    Fields of one kind are cleaned by one expression, so that the plan doesn't grow with the fields and their names.
    """
    wanted = wanted or tuple(spec.aliases)
    kind = {f: (f in spec.dates, f in spec.numbers) for f in wanted}
    kinds = {k: [f for f in wanted if kind[f] == k] for k in dict.fromkeys(kind.values())}

    def value_of(params: Column, name: str) -> Column:
        return F.try_element_at(F.filter(params, lambda p: p["name"] == name), F.lit(-1))["value"]  # the last of a name holds

    def read(params: Column) -> Column:
        values = lambda f: F.array(*[value_of(params, a) for a in spec.aliases.get(f, (f,))])
        first = lambda k: lambda values: F.aggregate(values, F.lit(None).cast("string"), lambda got, v: F.coalesce(got, clean(v, *k)))
        found = [F.transform(F.array(*map(values, fs)), first(k)) for k, fs in kinds.items()]
        at = {f: (n, F.lit(m)) for n, fs in enumerate(kinds.values()) for m, f in enumerate(fs)}
        by_kind = F.struct(*[x.alias(f"k{n}") for n, x in enumerate(found)])
        return let(by_kind, lambda x: F.struct(*[F.get(x[f"k{at[f][0]}"], at[f][1]).alias(f) for f in wanted]))

    return let(F.coalesce(parameters(infobox(wikitext, spec.names)), F.array().cast("array<struct<name:string,value:string>>")), read)
