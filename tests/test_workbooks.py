"""Workbooks appear as whole sets: after lost tasks, after failed writes, and over earlier sets."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lexiquarry.sources import sinks

ROOT = Path(__file__).resolve().parent.parent


def files_in(folder):
    return sorted(p.relative_to(folder) for p in Path(folder).rglob("*") if p.is_file())


def table(spark, n, parts=3):
    return spark.range(n).select("id", F.concat(F.lit("g"), F.col("id") % 2).alias("g"), F.when(F.col("id") % 3 != 0, F.concat(F.lit("<&\n"), "id")).alias("t")).repartition(parts, "id")


def test_cells_come_back(spark, tmp_path):
    made = sinks.write_workbooks(table(spark, 50).sortWithinPartitions("g"), str(tmp_path / "x"), by="g").collect()
    assert sum(r.rows for r in made) == 50 and {r.name for r in made} == {"g0", "g1"}
    got = sinks.read_workbooks(spark, str(tmp_path / "x"))
    assert {tuple(r.cells) for r in got.where("row = 1").collect()} == {("id", "t")}
    want = {(f"g{i % 2}", str(i), f"<&\n{i}" if i % 3 else None) for i in range(50)}
    assert {(r.name, r.cells[0], r.cells[1] if len(r.cells) > 1 else None) for r in got.where("row > 1").collect()} == want
    assert sinks.read_workbooks(spark, str(tmp_path / "x")).count() == 50 + len(made)


def test_a_second_set_takes_the_place_of_the_first(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "mine.xlsx").write_text("not ours")
    first = {Path(r.path).name for r in sinks.write_workbooks(table(spark, 30), str(tmp_path / "x")).collect()}
    second = {Path(r.path).name for r in sinks.write_workbooks(table(spark, 20, 2), str(tmp_path / "x")).collect()}
    assert len(first) == 3 and len(second) == 2 and not first & second
    assert {p.name for p in (tmp_path / "x").iterdir()} == second | {"mine.xlsx", "_workbooks.json"}
    assert set(json.loads((tmp_path / "x" / "_workbooks.json").read_text())) == second


def test_a_write_that_fails_leaves_what_was_there(spark, tmp_path):
    sinks.write_workbooks(table(spark, 30), str(tmp_path / "x"))
    before = files_in(tmp_path / "x")
    bad = table(spark, 300).withColumn("z", F.when(F.col("id") == 299, F.raise_error(F.lit("no"))).otherwise("z"))
    with pytest.raises(Exception, match="no"):
        sinks.write_workbooks(bad, str(tmp_path / "x"))
    assert files_in(tmp_path / "x") == before


_LOST = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from lexiquarry.sources import sinks
where = sys.argv[1]
def dies(source):
    for k, batch in enumerate(source):
        yield batch
    if not os.path.exists(where + "/died"):
        open(where + "/died", "w").close()
        os._exit(1)
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
df = spark.range(2000).repartition(3, "id").mapInArrow(dies, "id long")
made = sinks.write_workbooks(df, where + "/x").collect()
assert sum(r.rows for r in made) == 2000
assert sinks.read_workbooks(spark, where + "/x").where("row > 1").select(F.get("cells", F.lit(0))).distinct().count() == 2000
"""


def test_a_lost_attempt_leaves_no_files(tmp_path):
    (tmp_path / "job.py").write_text(_LOST)
    env = os.environ | {"PYTHONPATH": f"{ROOT}{os.pathsep}{os.environ.get('PYTHONPATH', '')}"}
    done = subprocess.run([sys.executable, str(tmp_path / "job.py"), str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    assert (tmp_path / "died").exists() and len(list((tmp_path / "x").glob("*.xlsx"))) == 3 and len(files_in(tmp_path / "x")) == 4
