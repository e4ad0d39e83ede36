"""Search, traversal and whole runs on small dumps."""

import bz2
import gzip
import json
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiquarry.operators import categories as cat
from lexiquarry.operators import reports
from lexiquarry.plans import extract, publish, run
from lexiquarry.sources import archives, remote
from lexiquarry.streaming.watch import watch_categories


def edges(spark, sub, members):
    return spark.createDataFrame(sub, "parent string, child string"), spark.createDataFrame(members, "category string, page_id long")


GRAPHS = {
    "simple": ([("Root", "A"), ("Root", "B"), ("A", "C")], [("Root", 1), ("A", 2), ("C", 3)], "Root", None, {1, 2, 3}),
    "cycle": ([("A", "B"), ("B", "A")], [("A", 1), ("B", 2)], "A", None, {1, 2}),
    "depth 0": ([("Root", "A"), ("A", "B")], [("Root", 1), ("A", 2), ("B", 3)], "Root", 0, {1}),
    "depth 1": ([("Root", "L1"), ("L1", "L2"), ("L2", "L3")], [("Root", 1), ("L1", 2), ("L2", 3), ("L3", 4)], "Root", 1, {1, 2}),
    "unknown": ([("x", "y")], [("x", 1)], "Missing", None, set()),
}


@pytest.mark.parametrize("case", GRAPHS)
def test_traversal(spark, case):
    sub, members, root, depth, want = GRAPHS[case]
    sub, members = edges(spark, sub, members)
    assert {r.page_id for r in cat.reached_articles(members, cat.traverse(sub, root, depth)).collect()} == want


def test_depth_stats(spark):
    sub, members = edges(spark, [("Root", "A"), ("Root", "B"), ("A", "C")], [("Root", 1), ("A", 2), ("A", 3), ("B", 4), ("C", 5), ("C", 6), ("A", 1)])
    got = cat.depth_stats(cat.traverse(sub, "Root"), members).orderBy("depth").collect()
    assert [tuple(r)[1:] for r in got] == [(1, 1, 1, 1), (2, 3, 3, 4), (1, 2, 4, 6)]
    none = cat.depth_stats(cat.traverse(sub, "Missing"), members).collect()
    assert [tuple(r) for r in none] == [(0, 1, 0, 1, 0)]


def test_patterns(spark):
    names = spark.createDataFrame([("French_Painters",), ("painters_of_Ë",), ("Poets",), ("aa",)], "name string")
    find = lambda p: {r.name for r in cat.find_categories(names, p).collect()}
    assert find(["(?:^|_)painters?(?:$|_)"]) == {"French_Painters", "painters_of_Ë"} and find([]) == set()
    assert find(["ë$", r"^(.)\1$"]) == {"painters_of_Ë", "aa"}
    assert {r.name for r in cat.find_by_table(names, spark.createDataFrame([("^poets$",), ("ë",)], "regex string")).collect()} == {"Poets", "painters_of_Ë"}


def test_groups_tag_once(spark):
    names = spark.createDataFrame([("a1",), ("b1",), ("a1",), ("ab",)], "name string")
    got = cat.tag_groups(names, (("a", ("^a", "a")), ("b", ("b",)), ("none", ()))).collect()
    assert sorted(map(tuple, got)) == [("a", "a1"), ("a", "ab"), ("b", "ab"), ("b", "b1")]


def test_page_filter(spark):
    pages = spark.createDataFrame([(1, 0, "a", 0, 10), (2, 0, "b", 1, 10), (3, 14, "c", 0, 10), (4, 0, "d", None, 9), (5, 0, "e", None, 10), (6, 0, "f", 0, 10)], "page_id long, namespace long, title string, is_redirect long, length long")
    wanted = spark.createDataFrame([(i,) for i in range(1, 6)], "page_id long")
    assert {r.page_id for r in cat.filter_pages(pages, wanted, 10).collect()} == {1, 5}


CONTENT = "title string, wikitext string, plaintext string"


def test_tiers_and_model(spark):
    content = spark.createDataFrame([("A b", "{{Infobox person|nationality=Danish|died=c. 1450}}", "A (born 3 May 1400) was a French poet."), ("C", "", "C lived."), ("D", "{{Infobox person|nationality=[[X|Y]]}}", None)], CONTENT)
    targets = spark.createDataFrame([(1, "A_b", 10), (2, "C", 20), (3, "D", 30), (4, "Gone", 40)], "page_id long, title string, length long")
    asked = []

    def model(rows, prompt):
        asked.append(rows.where(prompt.isNotNull()).count())
        return rows.withColumn("reply", F.when(prompt.contains("C lived"), F.lit('{"nationality": " Swiss ", "occupation": 3, "birth_date": "7 century"}')))

    got = {r.page_id: r for r in extract.records(targets, content, "bio", model=model).collect()}
    assert got[1].asDict() == {"page_id": 1, "title": "A b", "birth_date": "1400-05-03", "death_date": "c. 1450", "nationality": "Danish", "occupation": "poet", "birth_date_note": None, "death_date_note": None, "article_bytes": 10, "word_count": 9}
    assert (got[2].nationality, got[2].occupation, got[2].birth_date, got[2].birth_date_note) == ("Swiss", None, "0601-01-01", "~7 century")
    assert asked == [1] and got[3].nationality == "Y" and (got[4].nationality, got[4].word_count) == (None, 0)
    assert extract.records(targets, content, "bio", how="inner").count() == 3
    assert extract.records(targets, content, "etymology").columns == ["page_id", "title", "etymology", "article_bytes", "word_count"]
    assert extract.records(targets, content, "geo", ("population", "nationality")).where("page_id = 1").first().nationality == "French"


def test_reports(spark):
    rows = spark.createDataFrame([("x", None), (None, None), ("y", "z")], "a string, b string")
    assert sorted(map(tuple, reports.fill_rates(rows, ("a", "b")).collect())) == [("a", 2, 3, 2 / 3), ("b", 1, 3, 1 / 3)]
    assert {tuple(r) for r in reports.tier_mix(rows, ["a"], ["b"]).collect()} == {("infobox", 1), ("none", 1), ("infobox+text", 1)}
    assert tuple(reports.dry_run(spark.range(17)).first()) == (17, 5, 1, 0.001)


@pytest.fixture
def wiki(tmp_path):
    """Dumps and an archive of a wiki with two painters, a river and a stub."""

    def dump(table, rows):
        with gzip.open(tmp_path / f"xwiki-latest-{table}.sql.gz", "wt") as f:
            f.write(f"INSERT INTO `{table}` VALUES {','.join(rows)};\n")

    page = lambda i, ns, title, length, redirect=0: f"({i},{ns},'{title}',{redirect},0,0.1,'2024',NULL,1,{length},'wikitext',NULL)"
    dump("page", [page(1, 0, "Ann_Art", 9000), page(2, 0, "Bob_Brush", 8000), page(3, 0, "Long_River", 7000), page(4, 0, "Stub", 10), page(5, 0, "Old_Name", 9000, 1), page(10, 14, "Painters", 0), page(11, 14, "French_painters", 0), page(12, 14, "Rivers_of_X", 0)])
    dump("linktarget", ["(100,14,'Painters')", "(101,14,'French_painters')", "(102,14,'Rivers_of_X')", "(103,0,'Painters')"])
    link = lambda i, kind, to: f"({i},'k','2024','p','{kind}',1,{to})"
    dump("categorylinks", [link(1, "page", 100), link(2, "page", 101), link(11, "subcat", 100), link(3, "page", 102), link(4, "page", 100), link(5, "page", 100), link(1, "file", 102), link(3, "page", 103)])
    texts = {1: ("Ann Art", "{{Infobox artist|birth_date={{birth date|1900|1|2}}}} Ann Art (born 1900) was a French painter."), 2: ("Bob Brush", "Bob (3 May 1850 – 1900) was a painter."), 3: ("Long River", "{{Infobox settlement|population=1,000}} A river. It was named after a very long snake.")}
    xml = [f"<page><title>{t}</title><ns>0</ns><id>{i}</id><revision><text>{w.replace('&', '&amp;')}</text></revision></page>" for i, (t, w) in texts.items()]
    first, second = bz2.compress(("<mediawiki>" + xml[0]).encode()), bz2.compress("".join(xml[1:]).encode())
    (tmp_path / archives.archive_name("xwiki", "multistream")).write_bytes(first + second)
    (tmp_path / archives.archive_name("xwiki", "multistream-index")).write_bytes(bz2.compress(f"0:1:Ann Art\n{len(first)}:2:Bob Brush\n{len(first)}:3:Long River".encode()))
    return tmp_path


def read_csv(path):
    return "".join(p.read_text() for p in sorted(Path(path).glob("part-*")))


def test_regex_run(spark, wiki):
    config = run.parse_args(["--patterns", "(?:^|_)painters", "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--output-format", "csv", "--no-llm"])
    (made,) = run.run(spark, config).collect()
    text = read_csv(made.path)
    assert text.count("\n1,Ann Art,1900-01-02,,French,painter") + text.startswith("page_id,title,birth_date,death_date") == 2
    assert "2,Bob Brush,1850-05-03,1900,,painter" in text and "Stub" not in text and "Old" not in text
    assert (wiki / "cache" / "xwiki" / "articles.json").exists()
    dry = run.parse_args(["--patterns", "painters", "--wiki", "xwiki", "--data-dir", str(wiki), "--dry-run", "--min-page-length", "5"])
    assert run.run(spark, dry).first().articles == 3


def test_bfs_run(spark, wiki):
    base = ["Painters", "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--output-format", "tsv", "--no-llm", "--no-cache"]
    assert run.parse_args(base).search == "bfs"
    assert "Bob Brush" in read_csv(run.run(spark, run.parse_args(base)).first().path)
    assert "Bob Brush" not in read_csv(run.run(spark, run.parse_args([*base, "--max-depth", "0"])).first().path)


def test_group_run(spark, wiki):
    folder = wiki / "patterns"
    folder.mkdir()
    (folder / "visual_artists.txt").write_text("painters\n")
    (folder / "rivers.txt").write_text("^rivers_of\n")
    config = run.parse_args(["--all", str(folder), "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--no-llm"])
    assert {r.name for r in run.run(spark, config).collect()} == {"rivers", "visual_artists"}
    assert len(list((wiki / "r" / "rivers").glob("*.xlsx"))) == 1


def counted(log, reply):
    """A transport that notes every call in a file that all workers append to."""

    def call(url, asked):
        with open(log, "a") as f:
            f.write(json.dumps(asked) + "\n")
        return reply(asked)

    return call


def pages_of(asked):
    texts = {"Ann Art": "Ann Art (born 1900) was a French painter.", "Bob Brush": "Bob lived.", "Long River": "A river of note."}
    titles = [t for t in asked["titles"].split("|") if t in texts]
    if asked["prop"] == "extracts":
        return {"query": {"pages": [{"title": t, "extract": texts[t]} for t in titles]}}
    return {"query": {"pages": [{"title": t, "revisions": [{"slots": {"main": {"content": texts[t]}}}]} for t in titles]}}


def said(log):
    return [json.loads(line) for line in log.read_text().splitlines()]


def test_titles_and_prompts_are_asked_once(spark, wiki):
    folder = wiki / "patterns"
    folder.mkdir()
    for stem, pattern in (("visual_artists", "painters"), ("historians", "french"), ("scientists", "painters|rivers"), ("rivers", "^rivers_of")):
        (folder / f"{stem}.txt").write_text(pattern)
    base = ["--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--use-api", "--api-rate-limit", "0"]
    for n, (args, prompts) in enumerate(((["--all", str(folder)], 4), (["--patterns", ".", "--output-format", "csv"], 3), (["--patterns", "."], 3))):
        api, model = wiki / f"api{n}", wiki / f"model{n}"
        ask = counted(model, lambda asked: {"response": '{"birth_date": "1801", "population": "5"}'})
        made = run.run(spark, run.parse_args([*args, *base]), lambda rows, prompt, ask=ask: remote.ask_model(rows, prompt, "u", "m", ask), counted(api, pages_of))
        for prop in ("revisions", "extracts"):
            assert sorted(t for x in said(api) if x["prop"] == prop for t in x["titles"].split("|")) == ["Ann Art", "Bob Brush", "Long River"]
        asked = [x["prompt"] for x in said(model)]
        assert len(asked) == len(set(asked)) == prompts  # in groups the river is one of a person's and one of a place's
        if n == 1:
            text = read_csv(made.first().path)
            assert "2,Bob Brush,1801," in text and "1,Ann Art,1900," in text
    assert sorted(p.name for p in (wiki / "r").iterdir()) == ["historians", "regex_results", "rivers", "scientists", "visual_artists"]


def test_reports_of_a_run(spark, wiki):
    told = {}
    config = run.parse_args(["Painters", "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--output-format", "csv", "--no-llm", "--min-page-length", "0"])
    run.run(spark, config, report=lambda name, rows: told.update({name: [tuple(r) for r in rows.collect()]}))
    assert told["not in the index"] == [(1,)] and told["depths"][0] == (0, 1, 3, 1, 3) and ("birth_date", 2, 3, 2 / 3) in told["fields"]


def test_downloads_alone_end_the_run(spark, wiki, monkeypatch):
    monkeypatch.setattr(remote, "download", lambda url, to: to)
    monkeypatch.setattr(run, "parsed_dumps", None)
    config = run.parse_args(["--download-articles", "--wiki", "xwiki", "--data-dir", str(wiki)])
    assert [r.name for r in run.run(spark, config).collect()] == [archives.archive_name("xwiki", v) for v in ("multistream", "multistream-index")]
    assert run.run(spark, replace(config, multistream=False)).count() == 1


def test_commands(spark, wiki, capsys, monkeypatch):
    monkeypatch.setattr(spark, "stop", lambda: None)
    run.main(["--patterns", "painters", "--wiki", "xwiki", "--data-dir", str(wiki), "--dry-run"])
    assert "done:" in capsys.readouterr().out
    (wiki / "de" / "regions").mkdir(parents=True)
    (wiki / "de" / "regions" / "a.json").write_text(json.dumps({"features": [{"properties": {"GID_2": "G1", "NAME_2": "Long River", "NAME_1": "X"}}]}))
    (wiki / "p.txt").write_text("rivers")
    args = ["--country", "de", "--map-data-dir", str(wiki), "--patterns-file", f"{wiki}/p.txt", "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--no-llm"]
    publish.main(args)
    assert "Long River" in read_csv(wiki / "de" / "wikipedia" / "unmatched") and json.loads(read_csv(wiki / "de" / "wikipedia" / "entries")) == {}
    assert publish.publish(spark, *publish.parse([*args, "--dry-run"])).first().articles == 1
    with pytest.raises(SystemExit):
        publish.parse(["--country", "zz", "--map-data-dir", str(wiki)])


def test_workbooks_of_a_run_are_written_one_a_partition(spark, wiki, monkeypatch):
    config = run.parse_args(["--patterns", ".", "--wiki", "xwiki", "--data-dir", str(wiki), "--results-dir", f"{wiki}/r", "--no-llm", "--min-page-length", "0"])
    names = {}
    for split in ("true", "false"):
        monkeypatch.setattr(run, "records", lambda *a, **k: spark.range(1000).select((F.col("id") * 7 % 1000).alias("page_id")))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", split)
        try:
            run.run(spark, replace(config, results_dir=wiki / split))
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        names[split] = sorted(p.name for p in (wiki / split / config.name).glob("*.xlsx"))
    assert len(names["true"]) == 1 and len(names["false"]) == 4 and [n.split("-")[1] for n in names["false"]] == ["00000", "00001", "00002", "00003"]


def test_arguments(tmp_path, monkeypatch):
    monkeypatch.chdir(tmp_path)
    with pytest.raises(SystemExit):
        run.parse_args([])
    (tmp_path / "patterns" / "geo").mkdir(parents=True)
    (tmp_path / "patterns" / "a.txt").write_text("x\ny")
    (tmp_path / "patterns" / "geo" / "b.txt").write_text("z")
    assert run.parse_args([]).patterns == ("x", "y") and run.parse_args(["--extraction-mode", "geo"]).groups == (("b", ("z",)),)
    assert run.parse_args(["--patterns", "p"]).groups == () and run.parse_args(["--all", "--ollama-model", "m"]).model_name == "m"
    assert run.parse_args(["X", "--wiki", "simplewiki"]).min_length == 0 and run.parse_args(["X", "--wiki", "simplewiki", "--min-page-length", "7"]).min_length == 7
    both = run.parse_args(["X", "--patterns", "p"])
    assert both.search == "regex" and both.lang == "en" and run.parse_args(["A b"]).name == "A_b" and run.parse_args(["--patterns", "p"]).name == "regex_results"


def test_stream_of_dumps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.sql").write_text("INSERT INTO `page` VALUES (1,14,'Painters',0,0,0,0,0,0,5,'x',NULL),(2,0,'Painter',0,0,0,0,0,0,5,'x',NULL);\n")
    stream = watch_categories(spark, str(tmp_path / "in"), ("painter",)).writeStream.format("memory").queryName("found").option("checkpointLocation", str(tmp_path / "c")).start()
    try:
        stream.processAllAvailable()
        assert [tuple(r) for r in spark.table("found").collect()] == [(1, "Painters")]
    finally:
        stream.stop()
