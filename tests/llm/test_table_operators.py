"""top-k, mixing, URL filters, WARC, chat formatting and HTML text, against brute force and round trips."""

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiquarry.llm import chat, html_text, mixing, topk, url_filter, warc
from lexiquarry.llm._shared import materialise, shared_dir


def brute_topk(rows, k):
    usable = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, q in usable:
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in usable if j != i)[:k]
            out += [(i, n, j, -s) for n, (s, j) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_topk_equals_brute_force(spark, scale):
    rng = random.Random(0)
    rows = [(k, [rng.uniform(-scale, scale) for _ in range(6)]) for k in range(300)]
    rows += [(k, rows[3][1]) for k in range(300, 420)]  # one common vector: ties
    rows += [(450, None), (500, []), (501, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (502, [float("nan")] * 6), (550, [float("inf")] * 6), (600, [scale, -scale])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("x"))
    got = topk.top_k(df, df.where("vec_id % 50 = 0"), block_rows=64, query_rows=4)
    assert sorted(map(tuple, got.collect())) == brute_topk(rows, 5)


def test_lists_close_early_and_keep_all(spark):
    rng = np.random.default_rng(5)
    x = np.floor(256 * np.r_[rng.normal(0, 0.1, (3000, 8)), rng.normal(0, 2, (40, 8))])
    q, ids = x[::50], np.arange(len(x))
    lists = topk.Lists(ids, x)
    scores = (q @ x.T).astype(np.int64)
    scores[np.arange(len(q)), np.arange(0, len(x), 50)] = -(2**60)
    want = [(i, j, scores[i, j]) for i in range(len(q)) for j in sorted(range(len(x)), key=lambda j, i=i: (-scores[i, j], j))[:5]]
    assert list(zip(*map(np.ndarray.tolist, lists.search(ids[::50], q, 5)), strict=True)) == want
    floor = np.array([scores[i, j] for i, j, _ in want[4::5]])  # the true k-th score, met but not passed
    assert list(zip(*map(np.ndarray.tolist, lists.search(ids[::50], q, 5, floor)), strict=True)) == want
    assert len(lists.search(ids[::50], q, 5, floor * 0 + 2**40)[0]) == 0


def test_large_components_are_exact_and_take_seconds():
    import time

    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(0, 1, (16384, 64)))
    x[5000:9000] = x[4999]  # ties
    x[77, 3], x[4999, 9] = 2.0**60, -(2.0**55)
    q, ids = x[: 64 * 200 : 200].copy(), np.arange(len(x))
    q[5, 0] = 3e17
    began = time.process_time()
    got = topk.WideLists(ids, x).search(ids[: 64 * 200 : 200], q, 5)
    assert time.process_time() - began < 30
    whole = x.astype(object)
    want = []
    for i in range(0, 64, 7):
        scores = [sum(int(a) * int(b) for a, b in zip(q[i], row)) for row in whole]
        order = sorted((j for j in range(len(x)) if j != 200 * i), key=lambda j: (-scores[j], j))[:5]
        want += [(i, j, scores[j]) for j in order]
    assert [r for r in zip(*map(np.ndarray.tolist, got), strict=True) if r[0] % 7 == 0] == want


@pytest.mark.parametrize("scale", [1e9, 1e15, 1e200, 1e307])
def test_topk_of_large_components(spark, scale):
    rng = random.Random(4)
    rows = [(k, [rng.uniform(-1, 1) * scale ** rng.choice([0, 0.5, 1]) for _ in range(5)]) for k in range(150)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0"), block_rows=40).collect()))
    clipped = [(i, [max(-1e300, min(1e300, math.floor(256 * x) if abs(x) < 1e303 else math.copysign(1e300, x))) / 256 for x in v]) for i, v in rows]
    assert [r[:3] for r in got] == [r[:3] for r in brute_topk(clipped, 5)]
    assert all(r[3] == min(max(w[3], -(2**63)), 2**63 - 1) for r, w in zip(got, brute_topk(clipped, 5)))


def test_topk_of_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 2.0]), (50, [0.5, 0.5]), (3, [0.0, -1.0])], schema)
    assert sorted(map(tuple, topk.top_k(few, few.where("vec_id % 50 = 0")).collect())) == brute_topk([(0, [1.0, 2.0]), (50, [0.5, 0.5]), (3, [0.0, -1.0])], 5)
    none = few.limit(0)
    assert topk.top_k(none, none).count() == 0


DOCS = "doc_id long, text string, source string, size string"


def test_mixing_meets_its_targets(spark):
    rng = random.Random(4)
    names = ["a", "b", "c", "d", "é", None]
    rows = [(k, " ".join(["w"] * rng.randint(0, 40)), "a" if k % 3 == 0 else rng.choice(names), "clash") for k in range(600)]
    rows += [(700, None, "b", ""), (None, "x y", "c", ""), (5, rows[5][1], rows[5][2], "")]
    got = mixing.allocate(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    size = {}
    for r in got:
        size[r.source] = size.get(r.source, 0) + r.size
    order = sorted((n for n in size if n is not None)) + [None]
    weight = {n: (5, 2, 1)[k % 3] for k, n in enumerate(order)}
    left, full = 1.5 * sum(size.values()), set()
    while True:  # the contract's own words: the excess is reshared until none is above
        level = (left - sum(2 * size[n] for n in full)) / sum(weight[n] for n in order if n not in full)
        over = {n for n in order if n not in full and level * weight[n] > 2 * size[n]}
        if not over:
            break
        full |= over
    target = {n: 2 * size[n] if n in full else level * weight[n] for n in order}
    for n in order:
        own = [r for r in got if r.source == n]
        assert own[0].source_size == size[n] and own[0].target == pytest.approx(target[n])
        assert abs(sum(r.taken for r in own) - own[0].target) <= mixing.PACKET and all(0 <= r.taken <= 2 * r.size for r in own)
    assert sum(r.taken for r in got) == math.floor(1.5 * sum(size.values()))
    again = mixing.allocate(spark.createDataFrame(rows[::-1], DOCS).repartition(7)).collect()
    key = lambda r: (str(r.doc_id), r.size, r.taken, str(r.virtual_finish))
    assert sorted(map(key, got)) == sorted(map(key, again))
    mixed = mixing.mix(spark.createDataFrame(rows, DOCS))
    assert mixed.columns == ["doc_id", "text", "source", "size", "taken", "virtual_finish"] and mixed.where("taken = 0").count() == 0
    mixed = mixed.collect()
    assert [r.virtual_finish for r in mixed] == sorted(r.virtual_finish for r in mixed)
    assert sorted((str(r.doc_id), r.taken) for r in mixed) == sorted((str(r.doc_id), r.taken) for r in got if r.taken)


def test_mixing_equals_fair_queueing_packet_by_packet(spark, monkeypatch):
    rng = random.Random(7)
    monkeypatch.setattr(mixing, "PACKET", 16)
    rows = [(k // 2 if k < 20 else k, " ".join(["w"] * rng.randint(0, 90)), rng.choice("aaab") if k % 5 else "c", "") for k in range(150)]
    rows += [rows[30]] * 3  # equal rows
    got = mixing.allocate(spark.createDataFrame(rows, DOCS)).collect()
    target = {r.source: r.target for r in got}
    queue = []
    for name in "abc":
        own = sorted((r for r in rows if r[2] == name), key=lambda r: (hashlib.md5(f"mix{r[0]}".encode()).hexdigest(), r[0], len(r[1].split())))
        at = 0
        for _ in range(2):
            for k, r in enumerate(own):
                n = len(r[1].split())
                for a in range(0, n, 16):
                    queue.append(((at + a + min(16, n - a)) / target[name], name, at + a, min(16, n - a), k, r[0], n))
                at += n
    left, taken = math.floor(1.5 * sum(len(r[1].split()) for r in rows)), {}
    for _, name, _, words, k, doc, n in sorted(queue):
        taken[name, k, doc, n] = taken.get((name, k, doc, n), 0) + min(words, left)
        left -= min(words, left)
    assert sorted((r.source, r.doc_id, r.size, r.taken) for r in got if r.taken) == sorted((name, doc, n, t) for (name, _, doc, n), t in taken.items() if t)
    mixed = mixing.mix(spark.createDataFrame(rows, DOCS)).collect()
    assert sum(r.taken for r in mixed) == sum(r.taken for r in got) and len(mixed) == sum(r.taken > 0 for r in got)


def test_mixing_of_nothing(spark):
    assert mixing.allocate(spark.createDataFrame([], DOCS)).count() == 0
    assert [r.taken for r in mixing.allocate(spark.createDataFrame([(1, "", "a", ""), (2, None, None, "")], DOCS)).collect()] == [0, 0]


def test_url_filter_equals_brute_force(spark):
    log = [("domain", "Bad.org", "add", "2024-01-05"), ("domain", "bad.org", "remove", "2024-01-10"), ("domain", "bad.org", "add", "2024-01-20"), ("prefix", "ok.net/a/b", "add", "2024-01-01"), ("domain", "x.y", "add", "2024-01-03"), ("domain", "x.y", "remove", "2024-01-03")]
    urls = ["http://bad.org/", "https://u:p@WWW.bad.org:80/x?y", "http://notbad.org/", "http://ok.net/a/b/c#f", "http://ok.net/a/bc", "http://OK.net/a/b?q", "http://x.y", "mailto:a@bad.org", "", None, "http://bad.org./z", "http://[bad.org]/"]
    captures = [(k, u, f"2024-01-{d:02d}") for k, u in enumerate(urls) for d in (1, 5, 9, 10, 19, 20, 31)]
    df = spark.createDataFrame([(*c, "old") for c in captures] + [(0, urls[0], None, "old")] * 2, "id int, url string, day string, blocked string").withColumn("fetched_at", F.to_timestamp("day"))
    got = url_filter.judge(df, url_filter.list_entries(spark, log))

    def want(u, day):
        if not u or "://" not in u or day is None:
            return False
        host, _, path = u.split("://")[1].partition("/")
        host = host.split("@")[-1].split(":")[0].rstrip(".").lower()
        path = f"{host}/{path}".split("?")[0].split("#")[0].rstrip("/") + "/"
        bad = (host == "bad.org" or host.endswith(".bad.org")) and ("2024-01-05" <= day < "2024-01-10" or day >= "2024-01-20")
        return bad or path.startswith("ok.net/a/b/")

    rows = got.collect()
    assert len(rows) == len(captures) + 2 and all(r.blocked == want(r.url, r.day) for r in rows)
    assert url_filter.judge(df.limit(0), url_filter.list_entries(spark)).count() == 0


def test_hosts(spark):
    urls = {"http://[2001:db8::1]:80/x": "[2001:db8::1]", "HTTPS://U:p@Www.A.org.:8080?q": "www.a.org", "ftp://a.b#c": "a.b", "//a.b/c": "", "a.b/c": "", "http://": "", "http://é.org/": "é.org"}
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(url_filter.host_of(F.col("url")).alias("h")).collect()
    assert [r.h for r in rows] == list(urls.values())


def test_url_filter_of_a_long_list(spark):
    rng = random.Random(8)
    day = lambda n: f"2024-{n // 28 + 1:02d}-{n % 28 + 1:02d}"
    log = {}
    for n in range(100_000):
        kind, value = ("domain", f"d{n}.net") if n % 2 else ("prefix", f"w.h{n % 5000}.org/p{n}")
        first = rng.randrange(300)
        log[kind, value] = [("add", first), ("remove", first + rng.randint(1, 30))] if n % 3 else [("add", first)]
    entries = spark.createDataFrame([(k, v, a, day(d)) for (k, v), own in log.items() for a, d in own], "kind string, value string, action string, day string")
    entries = entries.withColumn("at", F.to_timestamp("day"))
    captures = []
    for k in range(1500):
        n = rng.randrange(100_000)
        captures.append((k, f"http://a.b.d{n}.net/x" if n % 2 else f"https://w.h{n % 5000}.org/p{n}/{k}", rng.randrange(330)))
    df = spark.createDataFrame([(k, u, day(d)) for k, u, d in captures], "id int, url string, __url string").withColumn("fetched_at", F.to_timestamp("__url"))
    got = {r.id: r.blocked for r in url_filter.judge(df, entries).collect()}

    def active(kind, value, d):
        own = log.get((kind, value), [])
        return bool(own) and own[0][1] <= d and (len(own) == 1 or d < own[1][1])

    for k, u, d in captures:
        host, _, path = u.split("://")[1].partition("/")
        want = active("domain", ".".join(host.split(".")[-2:]), d) or active("prefix", f"{host}/{path.split('/')[0]}", d)
        assert got[k] == want, u
    assert 100 < sum(got.values()) < 1400


def test_warc_round_trip(spark):
    long = "<p>é" + "x" * 1200
    pages = [(k, f"http://h/{k} a\r\nb", long if k % 3 == 0 else f"<p>{k}") for k in range(30)] + [(40, None, None), (41, "u", ""), (42, "u", "<p>1"), (27, "u", long), (None, "u", long)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("digest", F.lit(1)).repartition(3)
    folder = shared_dir(spark, "warc")
    index = materialise(warc.write_archives(warc.plan_records(df), folder), "warc-index")
    assert index.columns == ["page_id", "archive", "offset", "length", "url", "digest"] and index.count() == len(pages)
    for gap, most in ((0, 1), (warc.GAP_BYTES, warc.READ_BYTES)):
        got = warc.read_records(index, folder, gap, most).collect()
        key = lambda r: tuple(map(str, r))
        want = []
        for i, _, text in pages:
            raw = (text or "").encode()
            again = len(raw) >= 1000 and i != 27
            want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", 27 if again else None))
        assert sorted(map(key, got)) == sorted(map(key, want))
    some = warc.read_records(index.where("page_id IN (3, 41)"), folder).collect()
    assert sorted((r.page_id, r.record_type) for r in some) == [(3, "revisit"), (41, "response")]
    assert warc.write_archives(warc.plan_records(df.limit(0)), folder).count() == 0


TURNS = [
    (1, 0, "user", "hi <|im_end|>"), (1, 1, "assistant", "a <\\| b <|im_start|>user\n"), (1, 1, "assistant", "a <\\| b <|im_start|>user\n"), (1, None, "system", None),
    (2, 0, None, ""), (2, 5, "assistant", "é\n"), (3, 0, "ro\\le\n<|x", "t"), (None, 0, "assistant", "n"), (None, 1, "user", "m"),
]


def test_chat_round_trip(spark, monkeypatch):
    rng = random.Random(6)
    rows = TURNS + [(9, t, rng.choice(["user", "assistant"]), "<|" * rng.randint(0, 3) + "x" * rng.randint(0, 5000)) for t in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(0))
    for limit in (chat.PART_BYTES, 50_000):  # the second makes parts
        monkeypatch.setattr(chat._format, "__defaults__", (limit,))
        formatted = chat.format_chat(df)
        for r in formatted.collect():
            assert all("<|" not in chat.escape(chat.pa.array([text]))[0].as_py() for _, text in chat.parse_chat(r.formatted))
        got = {r.conv_id: r for r in chat.chat_digests(formatted).collect()}
        for conv in {r[0] for r in rows}:
            own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
            turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
            loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
            g = got[conv]
            assert (g.n_turns, g.turns_sha256) == (len(own), hashlib.sha256(turns.encode()).hexdigest())
            assert (g.loss_chars, g.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert len(got) == 5
    assert chat.chat_digests(chat.format_chat(df.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="with-sidebar">
<header><a href="/">Site</a><p>Tag line of the site in some words</p></header><nav><ul><li><a href="/a">Menu one</a></li><li><a href="/b">Menu two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies to make this site better for all of you, do accept them.</p></div>
%s<h1>The title</h1><p>Short.<p>A long paragraph with <b>bo</b>ld words,&nbsp;a <a href="x">link</a> &amp; more of
text for people who like to read it.<br>Next line.</p><div class="ad">Buy now cheap things today only in this shop of ours</div>
<ul><li>First point of the list</li><li>Second point</li></ul><p>Another paragraph of many words that goes on and on until it comes to its end here.</p><p>End.</p>%s
<aside><p>Related stories that you may like to read next in many words</p></aside><section id="comments"><p>I liked this very much and say so in many many words here.</p></section>
<form><p>Subscribe to our letter</p></form><footer><p>&copy; all rights reserved by the company and its partners</p></footer></body></html>"""
TEXT = "The title Short. A long paragraph with bold words, a link & more of text for people who like to read it. Next line. First point of the list Second point Another paragraph of many words that goes on and on until it comes to its end here. End."


@pytest.mark.parametrize("around", [("<article>", "</article>"), ("<main>", "</main>"), ('<div id="content">', "</div>"), ("", "")])
def test_main_text(spark, around):
    assert html_text.main_text(PAGE % around, html_text.weights({})) == TEXT


def test_main_text_of_odd_pages():
    w = html_text.weights({})
    text = lambda page: html_text.main_text(page, w)
    assert (text(None), text(""), text("<p></p>"), text("plain &lt; text")) == ("", "", "", "plain < text")
    assert text("<p>one<p>two <b>bo") == "one two bo" and text("<article><p>cut off here <a hre") == "cut off here"
    assert text("<article><script>if (a < b) { '</p>' }</script><p>kept text</p><!-- <p>no</p> --></article>") == "kept text"
    assert len(text("<p>" + "word " * 200_000)) == 5 * 200_000 - 1
    assert text("<div>" * 20_000 + "<p>deep text</p>" + "</div>" * 20_000) == "deep text"
    every = " ".join(f"words of depth {k}" for k in range(20_000))
    assert text("".join(f"<div><p>words of depth {k}</p>" for k in range(20_000))) == every


def test_deep_and_unclosed_elements_keep_the_article_and_its_furniture():
    text = lambda page: html_text.main_text(page, html_text.weights({}))
    prose = "some words of the story that go on for a good while so that this is long"
    inside = f"<nav>go home</nav><div>{prose}</div>"
    rows = "".join(f"<tr><td>cell {k}<td>more" for k in range(400))
    wanted = " ".join(f"cell {k} more" for k in range(400))
    got = text(f"<body><div><article><p>{prose}</p><table>{rows}<tr><td>{inside}</table><p>{prose} end</p></article></div><div>next page</div>")
    assert got == f"{prose} {wanted} {prose} {prose} end"
    terms = "".join(f"<dt>term {k}<dd>sense" for k in range(600))
    assert text(f"<article><dl>{terms}</dl><div>{prose}</div><p>{prose}</p></article>").endswith(f"sense {prose} {prose}")
    deep = 700
    assert text(f"<article><p>{prose}</p>{'<div>' * deep}{inside}{'</div>' * deep}<p>{prose} end</p></article><p>other</p>") == f"{prose} {prose} {prose} end"
    found, tree = html_text.blocks(f"<table>{rows}</table>")
    assert len(found) == 800 and all(tree.parents[tree.parents[tree.parents[b.place]]] == 0 for b in found)


WHOLE = ["overflow-hidden", "md:hidden", "has-sidebar", "content-with-sidebar", "no-ads", "public-notice", "sidebar", "noticeBoard"]


@pytest.mark.parametrize("mark", [f'class="box {c}"' for c in WHOLE] + ['title="the hidden life"', 'data-hidden="false"', 'data-role="menu"', 'data-id="nav"', "id='hidden-gems'", 'alt="x" role="complementary"'])
@pytest.mark.parametrize("tag", ["article", "div"])
def test_a_wrapper_by_its_name_keeps_the_page(mark, tag):
    prose = "some words of the story that go on for a good while so that this is long"
    page = f'<body><div {mark}><{tag}><p>{prose}</p><p>{prose}</p><div class="ad-slot">buy now</div><div class="site-footer">all rights</div><p>{prose}</p></{tag}></div><div>go home</div>'
    assert html_text.main_text(page, html_text.weights({})) == f"{prose} {prose} {prose}"


def test_furniture_by_name_goes():
    w = html_text.weights({})
    prose = "some words of the story that go on for a good while so that this is long"
    for mark in ("class=ad", 'class="x nav-bar"', "id='comments'", 'role="navigation"', "hidden", 'style="color:red; display: none"', 'aria-hidden="true"', 'class="siteHeader"', 'class="hidden"', 'class="post-comments"'):
        assert html_text.main_text(f"<article><p>{prose}</p><div {mark}>some other text</div><p>{prose}</p></article>", w) == f"{prose} {prose}", mark
    for mark in ('class="public-notice"', 'title="the nav"', 'class="md:hidden"', 'class="entry-header"'):
        assert "some other text" in html_text.main_text(f"<article><p>{prose}</p><div {mark}>some other text</div><p>{prose}</p></article>", w), mark
    talk = f'<div class="comments"><article><p>{prose}</p></article><p>{prose}</p><p>{prose}</p></div>'
    assert html_text.main_text(f"<div><p>{prose} first</p>{talk}</div>", w) == f"{prose} first"
    assert html_text.main_text(f"<div>{talk}</div>", w).count(prose) >= 1


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE % ("<article>", "</article>"), "x"), (2, None, None, "x"), (1, "u", "<p>again", "x"), (None, "u", "<p>b", "x")], "page_id long, url string, html string, text string")
    got = html_text.extract(pages, html_text.train(pages)).collect()
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got) == sorted([("1", TEXT, len(TEXT)), ("2", "", 0), ("1", "again", 5), ("None", "b", 1)])
    assert html_text.extract(pages.limit(0), html_text.weights({})).count() == 0


PROSE = "some words of the story that go on for a good while so that this is long"


@pytest.mark.parametrize("learned", [False, True])
def test_edges_of_an_article_stay_and_its_surroundings_go(learned):
    counts = html_text.Counter()
    if learned:  # by pages whose articles keep to paragraphs
        for _ in range(300):
            counts.update(html_text.count_features(PAGE % ("<article>", "</article>")))
            counts.update(html_text.count_features(f"<nav><a>Home</a></nav><div>{TEXT} {TEXT}</div><article><h1>Head</h1><p>{TEXT}</p></article><footer>All rights</footer>"))
    w = html_text.weights(counts)
    text = lambda page: html_text.main_text(page, w)
    prose = "The river rises in the hills above the town, turns east and reaches the sea after a day's walk through meadows."
    around = "<nav><a href=/>Home</a> <a href=/x>About</a></nav>%s<footer>All rights reserved</footer>"
    assert text(around % f"<article><h1><a href=x>Linked head</a></h1><p>{prose}</p></article>") == f"Linked head {prose}"
    assert text(around % f"<article><div><h1><a href=x>Linked head</a></h1></div><div class=body><p>{prose}</p><p>{prose}</p></div></article>") == f"Linked head {prose} {prose}"
    assert text(around % f"<article><p>{prose}</p><p><a href=x>read more of it here</a></p></article>") == f"{prose} read more of it here"
    assert text(around % f"<article><p>{prose}</p><p class=\"reply\">He gave a reply.</p></article>") == f"{prose} He gave a reply."
    assert text(around % f"<article><p>{prose}</p><aside class=pull-quote>Well said.</aside><p>{prose}</p></article>") == f"{prose} Well said. {prose}"
    assert text(around % f"<article><p>{prose}</p><aside><blockquote>Well said.</blockquote></aside><p>{prose}</p></article>") == f"{prose} Well said. {prose}"
    assert text(around % f"<article><p>{prose}</p><aside>See also</aside><p>{prose}</p></article>") == f"{prose} {prose}"
    bare = "<div><div><a href=/>Home</a> <a href=/x>About</a></div><div>%s</div><div>All rights reserved</div></div>"
    assert text(bare % f"<div>{prose}</div><div>{prose}</div>") == f"{prose} {prose}"
    assert text(bare % f"{prose}<br>{prose}") == f"{prose} {prose}"


def test_what_looks_like_markup_in_a_script_stays_in_it():
    text = lambda page: html_text.main_text(page, html_text.weights({}))
    for script in ('var s="<!--";', "if(a<b){ // don't", "x='<p class=\"'", "</p>", "a<!b", 'document.write("<div>")', "<script "):
        page = f"<body><article><p>Hello first</p><script>{script}</script><p class='x'>it's here &gt; there</p><style>a<b{{}}</style><p>{PROSE}</p></article><footer>out</footer></body>"
        assert text(page) == f"Hello first it's here > there {PROSE}", script
    assert text(f"<article><p>{PROSE}</p><script>var a = 1;</script ><p>after</p><SCRIPT>x</sCript\n><p>end</p></article>") == f"{PROSE} after end"


def test_words_of_names_alone_delete_no_article_text():
    text = lambda page: html_text.main_text(page, html_text.weights({}))
    for part in ('<section id="discussion"><h2>Discussion</h2><p>%s</p></section>', '<h2 id="discussion">%s</h2>', '<h2 id="search">%s</h2>', '<p class="share-price">%s</p>', '<p class="related-work">%s</p>', "<p><math><mi>x</mi> %s</math></p>", "<object>%s</object>", "<video>%s</video>", "<map><p>%s</p></map>", "<dl><dt>%s<dd>sense</dl>"):
        inside = part % PROSE
        want = " ".join(x for x in (PROSE, "Discussion" if "<h2>" in part else "", "x" if "<mi>" in part else "", PROSE, "sense" if "<dl>" in part else "", "the end") if x)
        for mark in ("article", "div"):
            assert text(f"<body><{mark}><p>{PROSE}</p>{inside}<p>the end</p></{mark}><nav><a>go</a></nav></body>") == want, (part, mark)
    for part in ('<p class="ad">%s</p>', '<div class="related"><p>%s</p></div>', '<section id="comments"><p>%s</p></section>', '<form><p>%s</p></form>', "<aside>%s</aside>", '<ul><li class="comment">%s</li></ul>'):
        assert text(f"<body><article><p>{PROSE}</p>{part % PROSE}<p>the end</p></article></body>") == f"{PROSE} the end", part


def test_the_stretch_equals_brute_force():
    rng = random.Random(3)
    for _ in range(400):
        n = rng.randint(0, 12)
        scores, costs = [rng.randint(-4, 4) for _ in range(n)], [rng.randint(0, 2) for _ in range(n)]
        start, stop = html_text.best_stretch(scores, costs)
        total = lambda a, z: sum(scores[a:z]) - sum(costs[a + 1 : z])
        best = max([0, *(total(a, z) for a in range(n) for z in range(a + 1, n + 1))])
        assert (total(start, stop) if stop else 0) == best


def test_weights_are_learned_and_decide():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    say = lambda n: " ".join(word() for _ in range(n))

    def page():
        inside = [say(4), *(say(rng.randint(2, 60)) for _ in range(4))]
        body = f"<h1>{inside[0]}</h1>" + "".join(f"<p>{x}</p>" for x in inside[1:])
        links = "".join(f'<li><a href="/">{word()}</a></li>' for _ in range(6))
        return f'<body><nav><ul>{links}</ul></nav><div class="zzbox"><p>{say(30)}</p></div><article>{body}</article><footer>{say(rng.randint(3, 40))}</footer></body>', " ".join(inside)

    counts = sum((html_text.count_features(page()[0]) for _ in range(200)), start=html_text.Counter())
    learned = html_text.weights(counts)
    assert learned["c:zzbox"] < -1 and "c:zzbox" not in html_text.weights({})
    plain = [(re.sub(r"<(/?)(?:nav|article|footer)", r"<\1div", p), t) for p, t in (page() for _ in range(100))]
    right = lambda w: sum(html_text.main_text(p, w) == t for p, t in plain)
    assert right(learned) >= 95 and right({k: -v for k, v in learned.items()}) == 0 and right(dict.fromkeys(learned, 0.0)) == 0
