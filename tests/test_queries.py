"""Every query against its SQL on the smallest tables, where they are at hand."""

import os
from pathlib import Path

import duckdb
import pytest

from lexiquarry import queries

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, str(DATA))
    columns = sorted(got.columns)
    want = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    rows = sorted(repr([r[c] for c in columns]) for r in got.collect())
    assert rows == sorted(repr([r[names.index(c)] for c in columns]) for r in want.fetchall())


def test_sample_is_the_same_on_every_run(spark):
    one, two = (sorted(map(tuple, queries.page_sample(spark, str(DATA)).collect())) for _ in range(2))
    assert one == two and len(one) > 0


def test_entry_has_rows_without_the_optional_parts():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and len(queries.QUERIES) <= len(entry.queries())


def test_dealt_rows_make_as_many_tasks_for_each_core(spark):
    cores = spark.sparkContext.defaultParallelism
    tasks = lambda rows: queries.dealt_out(spark, spark.range(1), rows).rdd.getNumPartitions()
    assert [tasks(n) for n in (0, 5, queries.DEALT_ROWS * cores, queries.DEALT_ROWS * cores + 1)] == [cores, cores, cores, 2 * cores]
