"""Temporal URL filter lists: dated entries become validity intervals, an as-of join judges captures.

``entries`` is a log: ``kind, value, action, at`` (``kind`` is ``domain`` or ``prefix``; ``action``
is ``add`` or ``remove``). Of a value, each ``add`` holds from its time to the next event on that
value. A capture offers every value that could list it: its host and the host's parent domains, and
its host with each leading run of whole path segments. Those keys meet the intervals in an equi-join
with the as-of condition, so neither side is compared row by row. Spark broadcasts the list only
below its own size threshold; beyond it the join shuffles, and a hot host splits by AQE.

Defined cases: a null or hostless url, or a null time, is never blocked; entries with a null field
are ignored; when events of one value share a time, a ``remove`` comes last; rows repeat as they
are; letters of the host and of listed values are compared in lower case, paths as they are; user,
port, query, fragment and a trailing dot of the host do not count; hosts in brackets (IPv6) count as they are; columns
of any name stay, but ``blocked`` and ``listed_by``, which are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import fresh, table

#: The query's list: value, kind, action, date.
ENTRIES = (
    ("domain", "spam-farm.example.org", "add", "2024-02-01"),
    ("domain", "spam-farm.example.org", "remove", "2024-06-01"),
    ("domain", "spam-farm.example.org", "add", "2024-09-01"),
    ("domain", "cheap-pills.example.com", "add", "2024-01-15"),
    ("domain", "tionsh.example.net", "add", "2024-03-10"),
    ("domain", "tionsh.example.net", "remove", "2024-04-20"),
    ("domain", "thther.example.org", "add", "2024-07-01"),
    ("domain", "thther.example.org", "remove", "2024-07-01"),
    ("prefix", "tionsh.example.net/es", "add", "2024-05-05"),
    ("prefix", "blog.ththan.example.net/en", "add", "2024-08-01"),
    ("prefix", "blog.ththan.example.net/en", "remove", "2024-11-01"),
)


def intervals(entries: DataFrame) -> DataFrame:
    """``kind, value, valid_from, valid_to`` (null: still holds) of the event log."""
    known = entries.dropna(subset=["kind", "value", "action", "at"]).select("kind", F.lower("value").alias("value"), "action", "at")
    known = known.where(F.col("action").isin("add", "remove")).distinct()
    order = W.partitionBy("kind", "value").orderBy("at", F.col("action"))
    known = known.withColumn("valid_to", F.lead("at").over(order))
    held = (F.col("action") == "add") & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("at")))
    return known.where(held).select("kind", "value", F.col("at").alias("valid_from"), "valid_to")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)
    return F.lower(F.regexp_replace(host, r"\.$", ""))


def _keys(url: Column) -> Column:
    host = host_of(url)
    labels = F.split(host, r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[^:]*://[^/?#]*([^?#]*)", 1)
    parts = F.filter(F.split(path, "/"), lambda p: p != "")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.concat(F.array(host), F.slice(parts, 1, n)), "/"))
    kind = lambda name, values: F.transform(values, lambda v: F.struct(F.lit(name).alias("kind"), v.alias("value")))
    return F.when(host != "", F.concat(kind("domain", domains), kind("prefix", prefixes)))


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", at: str = "fetched_at") -> DataFrame:
    """``captures`` with ``blocked`` and ``listed_by``, the entries active at fetch time (``kind:value``, sorted)."""
    captures = captures.drop("blocked", "listed_by")
    seen = captures.select(F.col(url).alias("__url"), F.col(at).alias("__at")).where("__url IS NOT NULL AND __at IS NOT NULL").distinct()
    keys = seen.select("__url", "__at", F.explode(_keys(F.col("__url"))).alias("__key")).select("__url", "__at", "__key.kind", "__key.value")
    active = (F.col("valid_from") <= F.col("__at")) & (F.col("valid_to").isNull() | (F.col("__at") < F.col("valid_to")))
    hits = keys.join(intervals(entries), ["kind", "value"]).where(active)
    hits = hits.groupBy("__url", "__at").agg(F.array_join(F.sort_array(F.collect_set(F.concat_ws(":", "kind", "value"))), " ").alias("listed_by"))
    own_url, own_at = fresh(captures, "__url"), fresh(captures, "__at")
    hits = hits.withColumnsRenamed({"__url": own_url, "__at": own_at})
    out = captures.join(hits, (F.col(url) == F.col(own_url)) & (F.col(at) == F.col(own_at)), "left").drop(own_url, own_at)
    return out.withColumn("blocked", F.col("listed_by").isNotNull()).withColumn("listed_by", F.coalesce("listed_by", F.lit("")))


def list_entries(spark: SparkSession, entries: tuple[tuple[str, str, str, str], ...] = ENTRIES) -> DataFrame:
    rows = ", ".join(f"('{k}', '{v}', '{a}', TIMESTAMP '{at} 00:00:00')" for k, v, a, at in entries)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(kind, value, action, at)")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, judged at a fetch time. The table has none, so the query spreads the pages over 2024."""
    day = F.coalesce(F.pmod(F.col("page_id") * 7919, F.lit(366)), F.lit(0)).cast("int")
    at = F.date_add(F.lit("2024-01-01").cast("date"), day).cast("timestamp")
    pages = table(spark, sf_dir, "pages").select("page_id", "url", at.alias("fetched_at"))
    out = judge(pages, list_entries(spark))
    return out.select("page_id", "url", F.date_format("fetched_at", "yyyy-MM-dd").alias("fetched_on"), "blocked", "listed_by")


OP10_SQL = r"""
WITH log(kind, value, action, since) AS (VALUES %s),
spans AS (SELECT *, lead(since) OVER (PARTITION BY kind, value ORDER BY since, action) AS till FROM log),
held AS (SELECT kind, value, since, coalesce(till, '9999-01-01') AS till FROM spans WHERE action = 'add'),
caps AS (
  SELECT page_id, url, strftime(DATE '2024-01-01' + (page_id * 7919 %% 366)::INT, '%%Y-%%m-%%d') AS day,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[^:]*://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hits AS (
  SELECT c.page_id, c.url, string_agg(DISTINCT kind || ':' || value, ' ' ORDER BY kind || ':' || value) AS listed_by
  FROM caps c JOIN held h ON c.day >= h.since AND c.day < h.till AND c.host <> '' AND
    CASE WHEN kind = 'domain' THEN ends_with('.' || host, '.' || value)
         ELSE starts_with(rtrim(host || path, '/') || '/', value || '/') END
  GROUP BY ALL)
SELECT c.page_id, c.url, day AS fetched_on, h.page_id IS NOT NULL AS blocked, coalesce(listed_by, '') AS listed_by
FROM caps c LEFT JOIN hits h ON c.page_id = h.page_id AND c.url = h.url
""" % ", ".join(f"('{k}', '{v}', '{a}', '{at}')" for k, v, a, at in ENTRIES)
