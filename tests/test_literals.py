"""What patterns can't match without, against the patterns themselves; and the cache's snapshots."""

import random
import re
import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiquarry.functions.literals import beginnings, joined, required, trie
from lexiquarry.operators import categories as cat
from lexiquarry.sources import files


@pytest.mark.parametrize(
    ("pattern", "want"),
    [
        ("painters", {"painters"}),
        (r"(?:^|_)Painters?_of", {"painter"}),
        ("(?:cats|dogs)_of", {"cats", "dogs"}),
        ("a(?:lpha|ble)_x", {"lpha", "ble"}),
        ("(?:cats|do|g+)", None),
        ("x*abc{2}d", None),
        ("(?!never)(?<=not)only", {"only"}),
        (r"\bring(?:ing)?\b", {"ring"}),
        ("(?:ring){1,3}", {"ring"}),
        ("(?:ring){0,3}", None),
        ("[abc]defg[hij]", {"defg"}),
        ("[a[bc]def]", None),
        ("(?x) de f", None),
        (r"\Qabc\E", None),
        (r"\p{Lu}abcd", None),
        ("gräßlich_bar", {"lich_bar"}),
        ("(unclosed", None),
        ("(?>abc)def++", {"abc"}),
        ("", None),
    ],
)
def test_required_literals(pattern, want):
    assert required(pattern) == (want and frozenset(want))


def random_pattern(rng, depth=2):
    word = lambda: "".join(rng.choice("abcs_") for _ in range(rng.randint(1, 5)))
    made = ""
    for _ in range(rng.randint(1, 3)):
        kind = rng.randrange(7)
        inner = random_pattern(rng, depth - 1) if depth else word()
        made += [word(), f"(?:{inner}|{word()})", f"(?:{inner})?", f"(?:{inner})+", "[ab]", f"{word()}.", f"(?!{word()}){inner}"][kind]
    return made


def test_names_that_match_hold_what_is_required(spark):
    rng = random.Random(1)
    patterns = list({random_pattern(rng) for _ in range(60)})
    names = ["".join(rng.choice("abcsABCS_ſ") for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    for p in patterns:
        if need := required(p):
            for n in names:
                if re.search(p, n, re.I):
                    assert re.search(trie(need), n.lower()), (p, n)
    rare = [p for p in patterns if required(p)]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    for some in (patterns[:20], rare, rare[:2], [*rare, r"(a)\1b\1"]):
        got = {r.name for r in cat.find_categories(df, some).collect()}
        assert got == {n for n in names if any(re.search(p, n, re.I) for p in some)}


def test_aliases_of_letters_and_words_in_words():
    found = lambda words, text: bool(re.search(trie(frozenset(words)), text.lower()))
    assert found({"king"}, "KING") and found({"king"}, "King") and found({"sing"}, "ſing") and found({"ring"}, "rıng")
    assert found({"ring", "ringing", "rind"}, "xrindx") and not found({"ring", "ringing", "rind"}, "rin rg") and found({"ringing", "ring"}, "ring")


def test_groups_are_tagged_as_each_alone(spark):
    df = spark.createDataFrame([(n,) for n in ("French_painters", "Rivers_of_X", "Kings", "x")], "name string")
    groups = (("a", ("painters", "^rivers")), ("b", (r"\bking",)), ("c", ("x",)), ("d", ()))
    assert {tuple(r) for r in cat.tag_groups(df, groups).collect()} == {("a", "French_painters"), ("a", "Rivers_of_X"), ("b", "Kings"), ("c", "Rivers_of_X"), ("c", "x")}
    assert {tuple(r) for r in cat.tag_groups(df, groups[:2]).collect()} == {("a", "French_painters"), ("a", "Rivers_of_X"), ("b", "Kings")}
    assert cat.tag_groups(df, groups[3:]).count() == 0


TABLES = ("page", "link", "edge", "member")


def saved(spark, n):
    return {t: spark.range(n).select("id", F.lit(t).alias("t")) for t in TABLES}


@pytest.mark.parametrize("dies_at", [0, 1, 2, 3, 4, 7])
def test_a_save_that_dies_leaves_the_old_cache(spark, tmp_path, monkeypatch, dies_at):
    source = tmp_path / "s"
    source.write_text("x")
    cache = files.Cache(spark, tmp_path, "xwiki")
    cache.save_all(saved(spark, 3), [source])
    steps = []

    def step(real):
        def run(*args, **kwargs):
            steps.append(1)
            if len(steps) == dies_at + 1:
                raise KeyboardInterrupt
            return real(*args, **kwargs)

        return run

    with monkeypatch.context() as m:
        m.setattr(Path, "replace", step(Path.replace))
        m.setattr(Path, "write_text", step(Path.write_text))
        with pytest.raises(KeyboardInterrupt):
            cache.save_all(saved(spark, 5), [source])
    held = cache.load_all(TABLES, [source])
    assert held and {df.count() for df in held.values()} in ({3}, {5})
    cache.save_all(saved(spark, 7), [source])
    assert {df.count() for df in cache.load_all(TABLES, [source]).values()} == {7}


def test_old_versions_go_and_tables_of_other_saves_stay(spark, tmp_path):
    cache = files.Cache(spark, tmp_path, "xwiki")
    cache.save(spark.range(2), "index", [])
    for n in (3, 4, 5):
        cache.save_all(saved(spark, n), [])
    assert len(list((cache.folder / "data").iterdir())) == 2
    assert cache.load("index", []).count() == 2 and cache.load_all(("page", "index"), []) is None
    shutil.rmtree(next((cache.folder / "data").glob("*/index")))
    assert cache.load("index", []) is None and cache.load("page", []).count() == 5
    assert cache.clear() == 5


def test_what_patterns_begin_with_is_tried_once():
    many = [f"(?:^|_){a}{b}s?_of" for a in "cdfk" for b in ("ring", "gear", "rod")]
    assert joined(many).count("(?:^|_)") == 1 and beginnings(many) == 1
    assert joined(["ab|cd", "a[bx]+?c", "a[bx]+?d", r"(?<n>ab)", r"(?i)ab", "[a[b]]"]) == r"(?:(?:a(?:[bx]+?(?:c|d)|b)|cd))|(?:(?<n>ab))|(?:(?i)ab)|(?:[a[b]])"
    assert beginnings([]) == 0 and joined(["ab", "abc", "abd"]) == "(?:ab)"


def test_joined_patterns_match_what_each_matches(spark):
    rng = random.Random(2)
    odd = ["^ab|c$", "", "(a|b)c", "(a|b)s", r"\bab", r"a{2}b", r"a{1,2}+c", "(?<=a)b", "(?<!a)bc", "(?>a|ab)c", "(?i)AbC", "[^_]$", r"\x61bs", r"a\_b", "ſ_", "(?:)", "a||bcs"]
    patterns = list({random_pattern(rng) for _ in range(40)}) + odd
    names = spark.createDataFrame([("".join(rng.choice("abcsABCS_ſ") for _ in range(rng.randint(0, 12))),) for _ in range(800)], "name string")
    sets = [rng.sample(patterns, rng.randint(2, 9)) for _ in range(25)]
    one = lambda p: F.col("name").rlike(cat.ANY_CASE + p)
    got = names.select(*[F.col("name").rlike(cat.ANY_CASE + joined(s)).alias(f"g{n}") for n, s in enumerate(sets)], *[F.greatest(*map(one, s)).alias(f"w{n}") for n, s in enumerate(sets)])
    for row in got.collect():
        assert row[: len(sets)] == row[len(sets) :]
