"""Text rules, case by case."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexiquarry.functions import biography as bio
from lexiquarry.functions import dates, etymology, infobox, model_reply, modes, plaintext, text, titles


def apply(spark, values, column):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, v string")
    return [r.x for r in rows.select("n", column(F.col("v")).alias("x")).orderBy("n").collect()]


DATES = {
    "1840-11-14": "1840-11-14", "October 26, 1965": "1965-10-26", "3 November,  2002": "2002-11-03", "August 25, 2001 (aged 22)": "2001-08-25",
    "c. 1450": "c. 1450", "14&nbsp;November&nbsp;1840": "1840-11-14", "1840/42": "1840", "31-08-1983": "1983-08-31", "9 of May, 1971": "1971-05-09",
    "Possibly 17 July 1947 (aged 34) or 31 July 1952": "1947-07-17", "375 BCE": "375 BC", "March 20, 43 BC": "43-03-20 BC", "1908-6-24": "1908-06-24",
    "Either 1946, 1947 or 1949": "1946", "1040}} ()}} (aged around 75)": "1040", "}}": None, "": None, "unknown": None, None: None, "February 341 BC": "341-02 BC",
    "November 1840": "1840-11", "1st May 1900": "1900-05-01", "99 May 1900": "1900-05-99", "31-13-1983": "31-13-1983", "about 12 things": "about 12 things", "BC": None, "c. 14 May 1900": "c. 1900-05-14",
}


def test_dates(spark):
    assert apply(spark, DATES, dates.normalise) == list(DATES.values())


def test_dates_with_notes(spark):
    cases = {
        "early 1960s": ("1960-01-01", "~early 1960s"), "900s": ("900-01-01", "~900s"), "7 century": ("0601-01-01", "~7 century"), "c. 7th century": ("0601-01-01", "~c. 7th century"),
        "November, 12": ("9999-11-12", "~November, 12 (no year)"), "19 November": ("9999-11-19", "~19 November (no year)"), "14 May 1900": ("1900-05-14", None), None: (None, None), "": (None, None),
    }
    assert [(x.date, x.note) for x in apply(spark, cases, dates.normalise_with_note)] == list(cases.values())


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.dates(), min_size=5, max_size=40))
def test_written_dates_read_back(spark, days):
    months = dates.MONTHS
    forms = [f(d) for d in days for f in (lambda d: f"{d.day} {months[d.month - 1]} {d.year:04d}", lambda d: f"{months[d.month - 1].upper()} {d.day}, {d.year:04d} (age 3)", lambda d: f"{d.day:02d}.{d.month}.{d.year:04d}")]
    want = [f"{d.year:04d}-{d.month:02d}-{d.day:02d}" for d in days for _ in range(3)]
    assert apply(spark, forms, dates.normalise) == want


def test_earliest_and_latest_keep_the_first_of_equals(spark):
    x = F.array(F.lit("1900"), F.lit("c. 1900"), F.lit("1950-02-01"), F.lit("1950-02-01"))
    r = spark.range(1).select(dates.earliest(x).alias("a"), dates.latest(x).alias("b"), dates.earliest(F.array().cast("array<string>")).alias("c")).first()
    assert (r.a, r.b, r.c) == ("1900", "1950-02-01", None)


def test_plaintext(spark):
    cases = {
        "a<!-- x\ny -->b": "ab", "x<ref name='a'>t</ref>y<ref name=b/>z": "xyz", "[[Category:C]][[file:F.png|thumb]]t": "t", "{{a|{{b|{{c}}}}}}t": "t", "{{a|{{b|{{c|{{d}}}}}}}}t": "{{a|}}t",
        "[[A|b]] [[C]]": "b C", "[https://x.org lab el] [http://y.org]": "lab el", "<b>x</b> '''y''' ''z''": "x y z", "== H ==\ntext": "H\ntext", "a\n\n\n\nb   c ": "a\n\nb c", "": "", None: None,
    }
    assert apply(spark, cases, plaintext.plaintext) == list(cases.values())
    assert apply(spark, ["a b c\n d", "", "  ", None], plaintext.word_count) == [4, 0, 0, 0]


BOX = """x {{cite|a={{b}}}} {{ Infobox Person
| name = N
| birth_date = {{birth date and age|df=y|1950|3|7}}
| died = 3 March 1999
| nationality =
| citizenship = [[France|French]]<ref>r</ref> &amp; '''German'''
| occupation = Painter
* Writer
|occupation= {{hlist|x}} Poet
|empty=
}} rest"""


def test_infobox(spark):
    got = apply(spark, [BOX, "no box", "{{infobox person x|born=1}}", "{{outer|{{infobox person|born=1 May 1900}}}}", None, "{{infobox person|born=unclosed", "{{Infobox person}}"], lambda v: infobox.fields(v, modes.BIO, modes.FIELDS["bio"]))
    assert tuple(got[0]) == ("1950-03-07", "3 March 1999", "French German", "Poet")
    assert all(set(got[n]) == {None} for n in (1, 2, 4, 5, 6)) and got[3].birth_date == "1 May 1900"


def test_infobox_numbers_and_lists(spark):
    geo = "{{Infobox settlement|population_total=1,234,567|area_km2={{convert|1|km}}|area= 12px 3|region=A<br>B\n* C,}}"
    r = apply(spark, [geo], lambda v: infobox.fields(v, modes.GEO))[0]
    assert (r.population, r.area_km2, r.subdivision_name) == ("1234567", "3", "AB; C")
    assert apply(spark, ["{{Infobox city<!-- a | }} -->|population=7<!-- | -->|pop=}}"], lambda v: infobox.fields(v, modes.GEO))[0].population == "7"


def test_long_infobox_does_not_overflow(spark):
    text = "{{Infobox person\n" + "".join(f"| p{n} = {{{{x|[[a|b]]}}}} {'w ' * 20}\n" for n in range(3000)) + "| nationality = Danish\n}}"
    assert apply(spark, [text], lambda v: infobox.fields(v, modes.BIO, ("nationality",)))[0].nationality == "Danish"


def nested(depth, inner="x|y=1"):
    return "{{a|" * depth + inner + "}}" * depth


@pytest.mark.parametrize("depth", [0, 1, 3, 4, 5, 6, 20, 200, 3000])
def test_templates_nest_to_any_depth(spark, depth):
    deep = nested(depth)
    born = "{{nowrap|" * depth + "{{birth date|1900|2|3|note={{small|[[a|b]]}}}}" + "}}" * depth
    box = f"{{{{unclosed|a=1 {deep} {{{{Infobox person|name={{{{open| {{{{ infobox Person\n|pre={deep} z\n|birth_date={born}\n|post=[[c|d]] {deep}|nationality = Danish\n|occupation=Poet}}}} after"
    outer = f"{{{{wrap|x={deep}|" + "{{infobox person|nationality=Thai|a=" + deep + "}}}}"
    got = apply(spark, [box, outer, "{{infobox person|nationality=Lao|a=" + "{{a|" * depth + "}}"], lambda v: infobox.fields(v, modes.BIO, ("birth_date", "nationality", "occupation")))
    assert tuple(got[0]) == ("1900-02-03", "Danish", "Poet") and got[1].nationality == "Thai"
    assert got[2].nationality == ("Lao" if depth <= 0 else None)  # not closed from one level on


def test_parameters_of_deep_bodies_are_those_of_shallow_ones(spark):
    inner = "|a=1|{{x|[[p|q]]|{{y|z}}}}| b = {c} {{{d}}} [e|f=|=g|"
    shallow, deep = (apply(spark, [inner + end + "}}"], infobox.parameters)[0] for end in ("", "h" + nested(9)))
    assert [tuple(p) for p in shallow[:-1]] == [tuple(p) for p in deep[:-1]] and deep[-1].value == "h" + nested(9)


@pytest.mark.parametrize("mode", sorted(modes.MODES))
def test_every_mode_reads_its_first_alias(spark, mode):
    spec = modes.MODES[mode]
    box = "{{" + spec.names[-1] + "".join(f"|{a[0]}=v{n}" for n, a in enumerate(spec.aliases.values())) + "}}"
    got = apply(spark, [box], lambda v: infobox.fields(v, spec))[0].asDict()
    first = {}
    for n, a in enumerate(spec.aliases.values()):
        first[a[0]] = f"v{n}"
    assert got == {f: first[a[0]] for f, a in spec.aliases.items()}


LIVES = {
    "A (14 November 1840 – 5 December 1926) was a French painter who x.": ("1840-11-14", "1926-12-05", "French", "painter"),
    "B (born May 3, 1950) is an American-born British theoretical physicist and author.": ("1950-05-03", None, "American, British", "theoretical physicist, author"),
    "C (born c. 1450 – 1500; aged 50) was a South African and New Zealand poet.": ("c. 1450", "1500", "South African, New Zealand", "poet"),
    "D (1608 or 1609 in X – 3 May 1660) was the singer-songwriter of Y.": ("1608", "1660-05-03", None, "singer-songwriter"),
    "E of German descent.": (None, None, "German", None),
    "F (c. 1500) was an austro-hungarian king.": ("c. 1500", None, "Hungarian, Austro-hungarian", "king"),
    "": (None, None, None, None),
}


def told(spark, texts, wanted=bio.FIELDS):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(texts)], "n int, v string")
    return [tuple(r)[2:] for r in bio.told(rows, F.col("v"), wanted).orderBy("n").collect()]


def test_biographies(spark):
    assert told(spark, LIVES) == list(LIVES.values())
    for n, field in enumerate(bio.FIELDS):
        assert told(spark, LIVES, (field,)) == [(x[n],) for x in LIVES.values()]


def test_only_the_first_paragraph_counts(spark):
    assert told(spark, ["G is here.\n\nH (1900 – 1950) was a French poet.", None]) == [(None,) * 4] * 2


def test_etymology(spark):
    cases = {
        "lead\n== History ==\nno\n== Etymology ==\nThe '''name''' [[x|is]] old.\n\nMore.\n=== Sub ===\nDeep.\n== Next ==\nno": "The name is old. More. Deep.",
        "=== Origin of the name ===\nText\n=== Other ===\nno": "Text", "== Name ==\n\n== Naming ==\nsecond": "second", "== Names ==\nx": None, "none": None,
        "== [[Etymology]] ==\nlinked": "linked", "== <span id='a'>''Name''</span> [[of it|origin]] ==\ntagged": "tagged", "== {{anchor|x}} Naming ==\ntemplate": "template",
        "== History ==\nno\n=== [[Name]] ===\nyes\n== Name ==\nlate": "yes", "== My name ==\nx": None, "==== Name ====\nx": None, "== Name\nx": None, "== Name == \nlast line": "last line",
    }
    assert apply(spark, cases, etymology.from_section) == list(cases.values())
    assert len(apply(spark, ["== Name ==\n" + "x" * 5000], etymology.from_section)[0]) == 2000
    leads = {"One. It was named after King X of Y. Three.": "It was named after King X of Y.", "Its name means small river": "Its name means small river", "Named for X.": None, "x" * 1500 + " named after someone of note": None, "no cue": None}
    assert apply(spark, leads, etymology.from_lead) == list(leads.values())


def test_titles(spark):
    keys = {"Kent_County,  Delaware": "kent, delaware", "Foo parish": "foo", "A Census Area district, B": "a census area, b", "Plain": "plain", "x, y, z": "x, y, z"}
    assert apply(spark, keys, titles.title_key) == list(keys.values())
    from urllib.parse import quote

    nasty = ["São Paulo", "A/B: C, D*E~F", "100% (x) & y?", "it's \"q\" + z"]
    assert apply(spark, nasty, titles.article_url) == ["https://en.wikipedia.org/wiki/" + quote(t.replace(" ", "_"), safe="_/:,") for t in nasty]
    assert apply(spark, ["enwiki", "simplewiki"], titles.language) == ["en", "simple"]


def test_model_replies(spark):
    replies = {'{"a": " x "}': "x", '```json\n{"a": "x",}\n```': "x", '{"a": 3}': None, '{"a": null}': None, '{"a": "  "}': None, "not json": None, None: None, '{"b": "x"}': None}
    assert apply(spark, replies, lambda v: model_reply.text_field(v, "a")) == list(replies.values())
    asked = apply(spark, ["t" * 4000], lambda v: model_reply.prompt(v, F.array(F.lit("a"), F.lit("b")), "de"))[0]
    assert "Keys: a, b.\n" in asked and "code de)" in asked and asked.endswith("t" * 3000) and not asked.endswith("t" * 3001)


def test_modes():
    assert modes.mode_of("rivers") == "geo" and modes.mode_of("poets") == "bio" and modes.mode_of("poets", "math") == "math"
    assert modes.mode_of("rivers", "etymology") == "etymology" and len(modes.STEM_MODES) == 32
    assert len(set(bio.NATIONALITIES)) == 193 and len(set(bio.OCCUPATIONS)) == 179


def test_a_run_of_braces_is_one_piece(spark):
    """The steps that count braces don't grow with how deep templates nest."""
    from lexiquarry.functions import infobox

    deep = spark.range(1).select(F.concat(F.repeat(F.lit("{{t|k="), 300), F.lit("x"), F.repeat(F.lit("}}"), 300), F.lit("|b=1}}")).alias("rest"))
    got = deep.select(F.size(infobox._pieces(F.col("rest"))).alias("n"), infobox._closed(F.col("rest")).alias("body"), "rest").first()
    assert got.n < 10 and got.body == got.rest


def test_each_rule_stands_in_the_plan_once():
    """Lambdas are computed as often as they are written, so what a rule names twice must be computed before."""
    v = F.col("v")
    uses = lambda column, what: str(column).replace("\\\\", "\\").count(what)
    assert uses(infobox.fields(v, modes.BIO), infobox.QUOTES) == 2  # values that are dates, and others
    assert uses(infobox.parameters(v), r"\}\}\z") == 1
    assert uses(bio.life_dates(v), dates._CENTURY) == 0 and uses(bio.life_dates(v), dates._ISO) == 2 * uses(dates.normalise(v), dates._ISO)
    assert uses(bio.nationality(F.col("p"), F.col("t")), "papua") == 4 and uses(bio.occupation(F.col("t")), "zoologist") == 2


def test_white_space_is_that_of_the_patterns(spark):
    from lexiquarry.functions.text import sub

    every = [f"{chr(c)}a{chr(c)}" for c in range(1, 0x3100)]
    assert apply(spark, every, text.strip) == apply(spark, every, lambda v: sub(v, r"^\s+|\s+\z"))


def test_plain_dates_are_as_others(spark):
    cases = {
        "4 May 920": "920-05-04", "May 14, 1900": "1900-05-14", "May 14, 12345": "1234-05-14", "4 may 1920": "1920-05-04", "1900-2-03": "1900-02-03", "c. 1900-02-03": "c. 1900-02-03", "C. 1850": "c. 1850", "1900\n": "1900",
    }
    assert apply(spark, cases, dates.normalise) == list(cases.values())
    assert [(x.date, x.note) for x in apply(spark, ["c. 1850", "1900-02-03", "190"], dates.normalise_with_note)] == [("c. 1850", None), ("1900-02-03", None), ("190", None)]


def test_an_alias_is_read_where_those_before_are_blank(spark):
    box = "{{infobox person|nationality=<!-- -->|citizenship='' ''|country=[[x|Thai]]|occupation=a|known_for=b|nationality= , }}"
    assert tuple(apply(spark, [box], lambda v: infobox.fields(v, modes.BIO, ("nationality", "birth_date", "occupation")))[0]) == ("Thai", None, "a")


def test_a_reply_is_parsed_once(spark):
    assert str(model_reply.text_field(F.col("v"), "a")).count("try_parse_json") == 2  # as it is, or else without trailing commas
