"""The store of answers: what is asked once, at which rate, and what a killed task or run leaves to the next."""

import json
import os
import subprocess
import sys
import time
from http.client import IncompleteRead
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiquarry.plans.extract import fill_by_model
from lexiquarry.sources import remote
from lexiquarry.sources.answers import Answers, Pace

ROOT = Path(__file__).resolve().parent.parent


def noted(log, reply):
    def call(url, asked):
        with open(log, "a") as f:
            f.write(json.dumps([time.time(), asked.get("prompt") or asked["titles"]]) + "\n")
        return reply(asked)

    return call


def told(log):
    return [json.loads(line) for line in Path(log).read_text().splitlines()]


def prompts(spark, n, repeats=2):
    return spark.range(n * repeats).select((F.col("id") % n).alias("n"), F.concat(F.lit("p"), F.col("id") % n).alias("p"))


def test_a_store_answers_reruns_and_failures_are_asked_again(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")

    def reply(asked):
        if asked["prompt"] == "p3" and len(told(log)) < 30:
            raise OSError
        return {"response": asked["prompt"].upper()}

    rows = prompts(spark, 8)
    ask = lambda model="m": {(r.n, r.reply) for r in remote.ask_model(rows, F.when(F.col("n") != 5, F.col("p")), "u", model, noted(log, reply), 2, 0, store=store).collect()}
    want = {(n, f"P{n}" if n not in (3, 5) else None) for n in range(8)}
    assert ask() == want and sorted(p for _, p in told(log)) == sorted(["p0", "p1", "p2", "p3", "p3", "p4", "p6", "p7"])
    assert ask() == want and len(told(log)) == 10  # the failed one only, twice
    assert ask("other") == want and len(told(log)) == 18  # another model's replies are others
    log.write_text(log.read_text() * 3)
    assert ask() == (want - {(3, None)}) | {(3, "P3")}
    assert not Path(store, "coming").exists() or not any(Path(store, "coming").iterdir())
    Answers(spark, store).clear()
    assert Answers(spark, store).known().count() == 0


@pytest.mark.parametrize("bad", [json.JSONDecodeError("x", "y", 0), IncompleteRead(b"x"), RuntimeError("x"), [1, 2], {"response": None}, {"response": {"a": 1}}, "text", None], ids=repr)
def test_one_bad_reply_costs_one_record(spark, bad):
    def transport(url, asked):
        if "Nobody" in asked["prompt"]:
            if isinstance(bad, Exception):
                raise bad
            return bad
        return {"response": '{"nationality": "Thai"}'}

    rows = spark.createDataFrame([(1, "Nobody knows.", None, "poet"), (2, "Known well.", None, "poet"), (3, "Full.", "Lao", "poet")], "page_id int, plaintext string, nationality string, occupation string")
    got = fill_by_model(rows, ("nationality", "occupation"), lambda r, p: remote.ask_model(r, p, "u", "m", transport, 2, 0))
    assert sorted(map(tuple, got.collect())) == [(1, "Nobody knows.", None, "poet"), (2, "Known well.", "Thai", "poet"), (3, "Full.", "Lao", "poet")]


_KILLED = """
import json, os, sys
from pyspark.sql import SparkSession, functions as F
from lexiquarry.sources import remote
log, where = sys.argv[1:]
def transport(url, asked):
    what = asked.get("prompt") or asked["titles"]
    with open(log, "a") as f:
        f.write(what + "\\n")
    if "p7" in what.split("|") and not os.path.exists(log + ".killed"):
        open(log + ".killed", "w").close()
        os._exit(1)
    if "prompt" in asked:
        return {"response": what}
    return {"query": {"pages": [{"title": t, "extract": t} for t in what.split("|")]}}
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", "file://" + where).config("spark.sql.shuffle.partitions", "2").getOrCreate()
rows = spark.range(40).select(F.concat(F.lit("p"), "id").alias("p"))
if sys.argv[1].endswith("model"):
    assert remote.ask_model(rows, F.col("p"), "u", "m", transport, 1, 0).where("reply = p").count() == 40
else:
    assert remote.fetch_articles(rows.withColumnRenamed("p", "title"), "u", transport, "plaintext", 4, 0).where("title = plaintext").count() == 40
"""


@pytest.mark.parametrize("kind", ["model", "api"])
def test_a_killed_task_asks_nothing_twice(tmp_path, kind):
    (tmp_path / "job.py").write_text(_KILLED)
    env = os.environ | {"PYTHONPATH": f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"}
    done = subprocess.run([sys.executable, str(tmp_path / "job.py"), str(tmp_path / kind), str(tmp_path / "shared")], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert (tmp_path / f"{kind}.killed").exists()
    calls = (tmp_path / kind).read_text().splitlines()
    twice = {c for c in calls if calls.count(c) > 1}
    assert len(twice) == 1 and len(calls) == len(set(calls)) + 1  # the one that the task died of
    assert {t for c in calls for t in c.split("|")} == {f"p{n}" for n in range(40)}


def test_a_run_that_died_leaves_its_answers(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    titles = spark.range(30).select(F.concat(F.lit("t"), "id").alias("title"))

    def reply(asked):
        if "t9" in asked["titles"].split("|") and not (tmp_path / "died").exists():
            (tmp_path / "died").touch()
            raise OSError("down")
        return {"query": {"pages": [{"title": t, "extract": t} for t in asked["titles"].split("|") if t != "t4"]}}

    fetch = lambda: remote.fetch_articles(titles, "u", noted(log, reply), "plaintext", 2, 0, tasks=1, store=store)
    with pytest.raises(Exception, match="down"):
        fetch().collect()
    before = [t for _, c in told(log)[:-1] for t in c.split("|")]
    assert {r.title for r in fetch().collect()} == {f"t{n}" for n in range(30) if n != 4}
    after = [t for _, c in told(log)[len(before) // 2 + 1 :] for t in c.split("|")]
    assert sorted(before + after) == sorted(f"t{n}" for n in range(30))  # the page without text too
    assert fetch().count() == 29 and len(told(log)) == 16


def test_quick_answers_share_files(spark, tmp_path):
    """A task's answers go to one file, not to one each; each is on disk before the next is asked for."""
    store, on_disk = tmp_path / "store", tmp_path / "log"

    def transport(url, asked):
        files = list((store / "coming").rglob("*.json"))
        with open(on_disk, "a") as f:
            f.write(f"{len(files)} {sum(p.read_text().count(chr(10)) for p in files)}\n")
        return {"response": asked["prompt"]}

    rows = spark.range(300).select(F.concat(F.lit("p"), "id").alias("p"))
    assert remote.ask_model(rows, F.col("p"), "u", "m", transport, 1, 0, tasks=1, store=str(store)).where("reply = p").count() == 300
    seen = [tuple(map(int, line.split())) for line in on_disk.read_text().splitlines()]
    assert [lines for _, lines in seen] == list(range(300)) and max(files for files, _ in seen) < 100


def test_half_a_line_of_a_killed_task_is_asked_again(spark, tmp_path):
    place = tmp_path / "store" / "coming" / "x"
    place.mkdir(parents=True)
    (place / "00000-1-0000000.json").write_text('{"key": "a", "answer": "A", "at": 1.0}\n{"key": "b", "answer": "B", "at": 1')
    store = Answers(spark, str(tmp_path / "store"))
    assert [tuple(r) for r in store.known().collect()] == [("a", "A")]
    asked = spark.createDataFrame([("a", "qa"), ("b", "qb")], "key string, question string")
    got = store.ask(asked, lambda qs, wait: [(f"new {q}", True) for q in qs], 1)
    assert {tuple(r) for r in got.collect()} == {("a", "A"), ("b", "new qb")}


@pytest.mark.parametrize("partitions", [4, 16, 200])
def test_requests_keep_the_rate_at_any_number_of_partitions(spark, tmp_path, partitions):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        titles = spark.range(160).select(F.concat(F.lit("t"), "id").alias("title"))
        reply = lambda asked: {"query": {"pages": [{"title": t, "extract": t} for t in asked["titles"].split("|")]}}
        assert remote.fetch_articles(titles, "u", noted(tmp_path / "log", reply), "plaintext", 1, 0.05).count() == 160
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    at = sorted(t for t, _ in told(tmp_path / "log"))
    assert len(at) == 160 and 18 <= 100 / (at[140] - at[40]) <= 22  # 20 a second, once all tasks are up
    assert all(b - a > 0.85 for a, b in zip(at, at[20:]))  # and never more


def test_slots_of_tasks_do_not_meet():
    now, seen = [0.0], []
    for n in range(4):
        now[0] = 0.0
        wait = Pace(0.1, 4, n, lambda: now[0], lambda s: now.__setitem__(0, now[0] + s))
        for call in range(5):
            wait()
            seen.append(round(now[0], 3))
            now[0] += 0.01 if (n, call) != (2, 1) else 1.0  # one request takes long
    assert sorted(seen)[:8] == [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7]
    late = seen[10:15]
    assert all(b - a >= 0.39 for a, b in zip(late[2:], late[3:]))
