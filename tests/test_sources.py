"""Dumps, archives, remote sources, the cache and the sinks, on generated files."""

import bz2
import gzip
import io
import json
import re
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiquarry.sources import archives, dumps, files, remote, sinks


def test_dump_rows(spark, tmp_path):
    lines = [
        "-- comment", "CREATE TABLE `page` (x);", "INSERT INTO `page` VALUES (1,'it\\'s','a,b',NULL),(2,'(x)','\\\\','NULL');",
        "INSERT INTO `other` VALUES (9,'no');", "INSERT INTO `page` VALUES (3, 'a\\nb' ,'',0.5),(4,'open",
    ]
    with gzip.open(tmp_path / "d.sql.gz", "wt") as f:
        f.write("\n".join(lines))
    got = [r.fields for r in dumps.read_dump(spark, str(tmp_path / "d.sql.gz"), "page").collect()]
    assert got == [["1", "it's", "a,b", None], ["2", "(x)", "\\", "NULL"], ["3", "anb", "", "0.5"]]


def test_lines_of_a_gzip_dump_are_split_in_many_tasks(spark, tmp_path):
    with gzip.open(tmp_path / "d.sql.gz", "wt") as f:
        f.write("".join(f"INSERT INTO `t` VALUES ({n},'a'),({n},'b');\nINSERT INTO `other` VALUES (0,'c');\n" for n in range(200)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = dumps.read_dump(spark, str(tmp_path / "d.sql.gz"), "t").select("fields", F.spark_partition_id().alias("task")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(tuple(r.fields) for r in got) == sorted((str(n), x) for n in range(200) for x in "ab") and len({r.task for r in got}) == 4


def test_many_tuples_on_a_line(spark):
    line = "INSERT INTO `t` VALUES " + ",".join(f"({n},'x\\'({n}')" for n in range(60_000)) + ";"
    got = dumps.inserts(spark.createDataFrame([(line,)], "value string"), "t")
    assert got.count() == 60_000 and got.where(F.get("fields", F.lit(1)) == F.concat(F.lit("x'("), F.get("fields", F.lit(0)))).count() == 60_000


def page(number, title, text, ns=0):
    return f"<page><title>{title}</title><ns>{ns}</ns><id>{number}</id><revision><id>9</id><text bytes='1'>{text}</text></revision></page>"


@pytest.fixture
def archive(tmp_path):
    """A multistream archive of 6 blocks and its index."""
    blocks = [[page(10 * b + k, f"T {b}:{k}", f"wiki &amp; {b}{k} " + "x" * (200_000 if b == 3 else 10)) for k in range(3)] for b in range(6)]
    blocks[1].append(page(99, "Category:C", "no", 14))
    blocks[2].append(page(98, "Empty", ""))
    out, index = io.BytesIO(), []
    for b, own in enumerate(blocks):
        head = "<mediawiki xmlns='http://x/export-0.11/'><siteinfo><a>b</a></siteinfo>" if b == 0 else ""
        offset = out.tell()
        out.write(bz2.compress((head + "\n".join(own) + ("</mediawiki>" if b == 5 else "")).encode()))
        index += [f"{offset}:{i}:{t}" for i, t in re.findall(r"<title>(.*?)</title><ns>\d+</ns><id>(\d+)</id>", "".join(own)) for i, t in [(t, i)]]
    index.insert(3, "broken:line")
    path = tmp_path / archives.archive_name("xwiki", "multistream")
    path.write_bytes(out.getvalue())
    (tmp_path / archives.archive_name("xwiki", "multistream-index")).write_bytes(bz2.compress("\n".join(index).encode()))
    return tmp_path


def test_multistream(spark, archive):
    path, index = archives.find_multistream(archive, "xwiki")
    index = archives.read_index(spark, str(index))
    assert index.where("page_id = 11").first().title == "T 1:1"
    wanted = spark.createDataFrame([(i,) for i in (0, 11, 32, 52, 99, 98, 777)], "page_id long")
    got = {r.page_id: (r.title, r.wikitext) for r in archives.read_multistream(wanted, index, str(path)).collect()}
    assert {i: t for i, (t, _) in got.items()} == {0: "T 0:0", 11: "T 1:1", 32: "T 3:2", 52: "T 5:2"}
    assert got[11][1] == "wiki & 11 " + "x" * 10 and len(got[32][1]) == 200_010
    assert archives.missing_from(wanted, index).count() == 1
    assert archives.read_multistream(wanted, index, f"file://{path}", limit=2).count() <= 2
    assert archives.content(archives.read_multistream(wanted, index, str(path))).where("page_id = 0").first().plaintext.startswith("wiki & 00")


def test_small_reads_and_bad_blocks(spark, archive, monkeypatch):
    monkeypatch.setattr(archives, "READ_BYTES", 64)
    path, index = archives.find_multistream(archive, "xwiki")
    every = archives.read_index(spark, str(index)).select("page_id")
    assert archives.read_multistream(every, archives.read_index(spark, str(index)), str(path)).count() == 18
    assert archives.pages_in(b"<page><title>x</page>") == {} and archives.pages_in(b"") == {}


def test_xml_scan(spark, archive, tmp_path):
    text = "<mediawiki xmlns='http://x/'>" + page(1, "A", "  lead spaces") + page(2, "B", "") + page(3, "C:x", "c", 14) + page(4, "D", "d") + "</mediawiki>"
    (tmp_path / archives.archive_name("ywiki", "xml")).write_text(text)
    path = archives.find_archive(tmp_path, "ywiki")
    assert {(r.page_id, r.wikitext) for r in archives.read_xml(spark, str(path)).collect()} == {(1, "  lead spaces"), (4, "d")}
    assert archives.read_xml(spark, str(path), spark.createDataFrame([(4,)], "page_id long"), 5).first().title == "D"
    assert archives.find_archive(tmp_path, "ywiki").suffix == ".xml"
    with pytest.raises(FileNotFoundError):
        archives.find_archive(tmp_path, "zwiki")
    with pytest.raises(FileNotFoundError):
        archives.find_multistream(tmp_path, "zwiki")


def test_batches(spark):
    blocks = spark.createDataFrame([(x,) for x in (0, 10, 15, 100, 105, 1000, 1001)], "offset long")
    got = {r.offset: (r.stripe, r.batch) for r in archives.batches_of(blocks, 10, 1000).collect()}
    assert got == {0: (0, 0), 10: (0, 0), 15: (0, 0), 100: (0, 1), 105: (0, 1), 1000: (1, 0), 1001: (1, 0)}


def replies(url, asked):
    titles = asked["titles"].split("|")
    if asked["prop"] == "extracts":
        return {"query": {"pages": [{"title": t, "extract": f"text {t}"} if t != "t1" else {"title": t} for t in titles]}}
    half = titles[len(titles) // 2 :] if "go" in asked else titles[: len(titles) // 2]
    pages = [{"title": t, "revisions": [{"slots": {"main": {"content": f"wiki {t}"}}}]} if t != "t2" else {"title": t, "missing": True} for t in half]
    return {"query": {"pages": pages}} | ({} if "go" in asked else {"continue": {"go": "on"}})


def test_api_batches_and_continuations(spark):
    titles = spark.createDataFrame([(f"t{n}",) for n in range(7)] + [("t0",)], "title string").coalesce(1)
    got = {r.title: r.wikitext for r in remote.fetch_articles(titles, "u", replies, batch=3, pause=0).collect()}
    assert got == {f"t{n}": f"wiki t{n}" for n in range(7) if n != 2}
    assert {r.title for r in remote.fetch_articles(titles, "u", replies, "plaintext", 3, 0).collect()} == {f"t{n}" for n in range(7) if n != 1}


def fails_once(url, body, seen=[]):  # noqa: B006
    if body["prompt"] in seen or body["prompt"] == "fine":
        return {"response": json.dumps({"a": body["prompt"]})}
    seen.append(body["prompt"])
    raise OSError


def test_model_is_asked_again(spark):
    rows = spark.createDataFrame([(1, "fine"), (2, "once")], "n int, p string").coalesce(1)
    got = remote.ask_model(rows, F.col("p"), "u", "m", fails_once, backoff=0).orderBy("n").collect()
    assert [json.loads(r.reply)["a"] for r in got] == ["fine", "once"]
    assert remote.ask_model(rows, F.col("p"), "u", "m", lambda u, b: {}, 2, 0).where("reply IS NULL").count() == 2


class Server:
    """Answers HEAD and GET; breaks off the first GET half-way."""

    def __init__(self, body, ranges=True):
        self.body, self.ranges, self.calls, self.broken = body, ranges, [], False

    def __call__(self, request, timeout):
        self.calls.append((request.get_method(), request.get_header("Range")))
        outer, at = self, 0
        status = 200
        if request.get_header("Range") and self.ranges:
            at, status = int(request.get_header("Range")[6:-1]), 206

        class Reply(io.BytesIO):
            headers = {"Content-Length": str(len(outer.body))}

            def read(self, n=-1):
                if not outer.broken and self.tell() >= 5:
                    outer.broken = True
                    raise OSError
                return super().read(5)

        reply = Reply(self.body[at:])
        reply.status = status
        return reply


@pytest.mark.parametrize("ranges", [True, False])
def test_download_resumes(tmp_path, ranges):
    server, waits = Server(b"0123456789abcdef", ranges), []
    to = remote.download("http://x/f", tmp_path / "d" / "f", server, sleep=waits.append)
    assert to.read_bytes() == server.body and waits == [60.0] and server.calls[-1] == ("GET", "bytes=5-")
    remote.download("http://x/f", to, server, sleep=waits.append)
    assert server.calls[-1][0] == "HEAD"


def test_download_gives_up(tmp_path):
    def opener(request, timeout):
        if request.get_method() == "HEAD":
            return Server(b"x")(request, timeout)
        raise OSError

    waits = []
    with pytest.raises(OSError):
        remote.download("http://x/f", tmp_path / "f", opener, sleep=waits.append)
    assert waits == [60, 120, 240, 480]


def test_cache(spark, tmp_path):
    source, gone = tmp_path / "s", tmp_path / "gone"
    source.write_text("x")
    cache = files.Cache(spark, tmp_path, "xwiki")
    assert cache.load("t", [source]) is None
    cache.save(spark.range(3), "t", [source])
    assert cache.load("t", [source]).count() == 3 and cache.load("t", [source, gone]) is None
    import os

    os.utime(source, (1, 1))
    assert cache.load("t", [source]) is None
    source.unlink()
    assert cache.load("t", [source]).count() == 3
    (cache.folder / "t.json").write_text("{broken")
    assert cache.load("t", [source]) is None
    assert files.Cache(spark, tmp_path, "other").clear() == 0 and cache.clear() == 1 and cache.clear() == 0


def test_patterns_and_newest(tmp_path):
    (tmp_path / "b.txt").write_text("x\n\n  y \n")
    (tmp_path / "a.txt").write_text("z")
    assert files.read_patterns(tmp_path) == (("a", ("z",)), ("b", ("x", "y"))) and files.read_patterns(tmp_path / "b.txt") == (("b", ("x", "y")),)
    with pytest.raises(FileNotFoundError):
        files.newest(tmp_path)


def test_delimited(spark, tmp_path):
    df = spark.createDataFrame([(1, None, 'a"b'), (2, "x,y", "l1\nl2")], "a int, b string, c string")
    sinks.write_delimited(df.coalesce(1), f"{tmp_path}/o", one_file=True)
    (part,) = Path(f"{tmp_path}/o").glob("part-*")
    assert part.read_text() == 'a,b,c\n1,,"a""b"\n2,"x,y","l1\nl2"\n'
    back = files.read_results(spark, f"{tmp_path}/o").orderBy("row_at").collect()
    assert [(r.a, r.b, r.c) for r in back] == [("1", "", 'a"b'), ("2", "x,y", "l1\nl2")]
    sinks.write_delimited(df.limit(0), f"{tmp_path}/e", "\t")
    assert all(not p.read_bytes() for p in Path(f"{tmp_path}/e").glob("part-*"))


def test_workbooks(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([(n, f"t<&{n}" + "w" * n, None) for n in range(70)], "n long, t string, z string").coalesce(1)
    (made,) = sinks.write_workbooks(df, f"{tmp_path}/x", "My sheet").collect()
    with zipfile.ZipFile(made.path) as z:
        sheet = z.read("xl/worksheets/sheet1.xml").decode()
        assert 'name="My sheet"' in z.read("xl/workbook.xml").decode()
    assert made.rows == 70 and sheet.count("<row ") == 71 and 'width="50"' in sheet and "t&lt;&amp;1w" in sheet and '<c r="A3"><v>1</v></c>' in sheet
    monkeypatch.setattr(sinks, "SHEET_ROWS", 30)
    assert sorted(r.rows for r in sinks.write_workbooks(df, f"{tmp_path}/y").collect()) == [10, 30, 30]
    assert sinks.write_workbooks(df.limit(0), f"{tmp_path}/z").count() == 0


def test_regions_and_keyed_json(spark, tmp_path):
    (tmp_path / "regions").mkdir()
    feature = lambda g, a, b: {"properties": {"GID_2": g, "NAME_2": a, "NAME_1": b, "x": 1}, "geometry": None}
    (tmp_path / "regions" / "b.json").write_text(json.dumps({"features": [feature("B1", "Kent County", "Delaware"), feature("B2", "", "X"), feature("B3", "New", "Land")]}))
    (tmp_path / "regions" / "a.json").write_text(json.dumps({"features": [feature("A1", "Kent", "Delaware")]}))
    from lexiquarry.plans.run import publish_regions

    results = spark.createDataFrame([("5", "Kent County, Delaware", "1,2", "note", 0), ("6", "Kent, Delaware", "", "", 1), ("7", "New, Land", "", "", 2), ("8", "Nowhere", "3", "", 3)], "page_id string, title string, population string, date_note string, row_at long")
    publish_regions(spark, results, str(tmp_path), f"{tmp_path}/out")
    (part,) = Path(f"{tmp_path}/out/entries").glob("part-*")
    assert json.loads(part.read_text()) == {
        "A1": {"title": "Kent County, Delaware", "population": "1,2", "wikipedia_url": "https://en.wikipedia.org/wiki/Kent_County,_Delaware"},
        "B3": {"title": "New, Land", "wikipedia_url": "https://en.wikipedia.org/wiki/New,_Land"},
    }
    entries = spark.createDataFrame([('a"\n\\b', 1, ("x", None)), ("c", 2, (None, None))], "gid string, row_at long, entry struct<title: string, other: string>")
    sinks.write_keyed_json(entries, f"{tmp_path}/odd")
    (part,) = Path(f"{tmp_path}/odd").glob("part-*")
    assert json.loads(part.read_text()) == {'a"\n\\b': {"title": "x"}, "c": {}} and '\n    "title": "x"\n  },\n' in part.read_text()
    text = lambda name: "".join(p.read_text() for p in Path(f"{tmp_path}/out/{name}").glob("part-*"))
    assert "Nowhere" in text("unmatched") and '"Kent County, Delaware","Kent, Delaware"' in text("collisions") and "A1,B1,b.json" in text("key_collisions")


def test_filters_reach_the_archive(spark, archive, monkeypatch):
    """Of a filter on page_id only the blocks that hold such pages are unpacked, and only their stretches are planned."""
    from lexiquarry.sources import multistream

    path, index = archives.find_multistream(archive, "xwiki")
    kept = archives.keep_index(archives.read_index(spark, str(index)), str(archive / "kept"))
    multistream.register(spark)
    offsets = {r.page_id: r.offset for r in spark.read.parquet(kept).collect()}
    whole = spark.read.format("multistream").option("index", kept).option("split", 300).load(str(path))
    assert {r.page_id for r in whole.collect()} == {10 * b + k for b in range(6) for k in range(3)}
    assert whole.rdd.getNumPartitions() == len({o // 300 for o in offsets.values()}) > 1
    for test, want in (
        ("page_id = 11", {11}), ("page_id IN (0, 52, 777)", {0, 52}), ("page_id > 40 AND page_id <= 51", {41, 42, 50, 51}), ("page_id >= 50 AND page_id < 52", {50, 51}),
        ("page_id = 11 AND title = 'T 1:1'", {11}), ("page_id = 11 AND title = 'x'", set()), ("page_id = 1000", set()), ("page_id % 10 = 1 AND page_id < 30", {1, 11, 21}), ("page_id IS NULL", set()),
    ):
        assert {r.page_id for r in whole.where(test).collect()} == want, test
    one = whole.where("page_id IN (0, 52)")
    assert one.rdd.getNumPartitions() == len({offsets[i] // 300 for i in (0, 52)})
    reader = multistream.MultistreamSource({"path": str(path), "index": kept, "split": "300"}).reader(None)
    opened = []
    monkeypatch.setattr(multistream, "stream", lambda f, at, *rest, real=multistream.stream: opened.append(at) or real(f, at, *rest))
    assert list(reader.pushFilters([multistream.EqualTo(("page_id",), 11), multistream.EqualTo(("title",), "x")])) == [multistream.EqualTo(("title",), "x")]
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert [r["page_id"] for r in rows] == [11] and opened == [offsets[11]]
