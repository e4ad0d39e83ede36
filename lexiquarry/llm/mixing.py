"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions alone.

Each source is a queue of its documents in shuffled order, ``max_repeats`` rounds of it. As packets do in
a network, documents go in packets of at most ``PACKET`` words, so that a long one can't hold up the
mixture. A packet's virtual finish time is the words that its source has served by its end over the
source's target. All packets of all queues are range-sorted by virtual finish time, and the mixture is
what of that order lies within the total budget; the packet on the cut is taken in part. A source's
words are thus its target to within about a packet.

Running totals never gather a source, or the mixture, in one task. Within a source, documents fall into
ranges of their shuffle key, which are summed first, and only one range of one source is ordered at a
time. Over the mixture, the ranges of the global sort are summed first. What orders sources themselves
(their names, and the levels that fill them) sees one row for each source.

Defined cases: null text has size 0; null is a source of its own, after all others; an empty table
gives no rows; rows that share a doc_id are separate documents; documents of size 0 take 0; a
source of size 0 has target 0. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import fresh, materialise, table, word_count

WEIGHTS = (5, 2, 1)
BUDGET_SHARE = 1.5
MAX_REPEATS = 2
#: Words of a document that are queued at a time.
PACKET = 256
#: Rows of a source that one range of its shuffle key holds, about, at most.
RANGE_ROWS = 1 << 16


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_share: float = BUDGET_SHARE, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    A target is ``level * weight``, or ``max_repeats`` times the source's size where that is less;
    the level is the one at which all targets add up to the budget (sources sorted by the level
    that fills them). The windows without a partition see one row for each source only.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    by_fill = W.orderBy("fill", F.col("source").asc_nulls_last())
    per = per.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * max_repeats).cast("double"))
    per = per.withColumn("fill", F.col("cap") / F.col("weight"))
    per = per.withColumn("budget", F.sum("source_size").over(W.partitionBy(F.lit(0))) * F.lit(budget_share))
    full = F.coalesce(F.sum("cap").over(by_fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    open_weight = F.sum("weight").over(by_fill.rowsBetween(0, W.unboundedFollowing))
    per = per.withColumn("level", (F.col("budget") - full) / open_weight)
    # the first source, by the level that fills it, that the rest of the budget does not fill
    stops = F.when(F.col("level") <= F.col("fill"), F.struct(F.row_number().over(by_fill), "level"))
    per = per.withColumn("level", F.min(stops).over(W.partitionBy(F.lit(0)))["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def _allocate(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget_share: float = BUDGET_SHARE, max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """As ``allocate``, with ``_same, _again``: a digest of each row, equal for rows of equal doc_id, source and text."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("_key"), *_digest())
    sized = materialise(sized.withColumn("_row", F.monotonically_increasing_id()), "sizes")  # so that texts are read once and rows keep their numbers
    digits = max(2, math.ceil(math.log(max(1, sized.count()) / RANGE_ROWS, 16)))
    sized = sized.withColumn("_bin", F.substring("_key", 1, digits))
    targets = source_targets(sized, weights, budget_share, max_repeats)
    bins = sized.groupBy("source", "_bin").agg(F.sum("size").alias("_sum"))
    earlier = W.partitionBy("source").orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)
    bins = bins.withColumn("_earlier", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    bins = bins.select(F.col("source").alias("_s"), F.col("_bin").alias("_b"), "_earlier")
    inside = W.partitionBy("source", "_bin").orderBy("_key", "doc_id", "size", "_row").rowsBetween(W.unboundedPreceding, 0)
    queued = sized.withColumn("_inside", F.sum("size").over(inside))
    queued = queued.join(bins, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bin") == F.col("_b")))
    targets = targets.withColumnRenamed("source", "_t")
    queued = queued.join(targets, F.col("source").eqNullSafe(F.col("_t")))
    queued = queued.withColumn("_before", F.col("_earlier") + F.col("_inside") - F.col("size"))
    queued = materialise(queued.select("doc_id", "source", "size", "source_size", "target", "_row", "_before", "_same", "_again"), "queues")
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    taken = _truncate(_packets(queued, max_repeats), F.lit(math.floor(total * budget_share)).cast("long"))
    taken = taken.groupBy("_row").agg(F.sum("part").alias("taken"), F.max("finish").alias("virtual_finish"))
    out = queued.join(taken, "_row", "left")
    return out.select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "virtual_finish", "_same", "_again")


def _digest() -> list[Column]:
    return [F.xxhash64("doc_id", "source", "text").alias("_same"), F.xxhash64(F.lit(1), "doc_id", "source", "text").alias("_again")]


def _packets(queued: DataFrame, max_repeats: int) -> DataFrame:
    """``_row, source, start, words, finish`` of every packet of every round; ``start`` counts the words of the source before it."""
    rounds = queued.where("size > 0").withColumn("_round", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1))))
    each = rounds.withColumn("_at", F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(PACKET).cast("long"))))
    each = each.withColumn("start", F.col("_before") + F.col("source_size") * F.col("_round") + F.col("_at"))
    each = each.withColumn("words", F.least(F.lit(PACKET).cast("long"), F.col("size") - F.col("_at")))
    return each.select("_row", "source", "start", "words", ((F.col("start") + F.col("words")) / F.col("target")).alias("finish"))


def _truncate(packets: DataFrame, budget: Column) -> DataFrame:
    """``_row, part, finish`` of the packets within the budget, in the global order of finish times; ``part`` is the words taken of each."""
    order = [F.col("finish"), F.col("source").asc_nulls_last(), F.col("start")]
    ranges = materialise(packets.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "packets")
    sums = ranges.groupBy("_range").agg(F.sum("words").alias("_sum"))  # a row for each partition of the sort
    sums = sums.withColumn("_earlier", F.coalesce(F.sum("_sum").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    inside = W.partitionBy("_range").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    # ranges that end before the cut are whole; no more than one holds the cut, those after it go
    ranges = ranges.join(F.broadcast(sums), "_range").where(F.col("_earlier") < budget)
    whole = ranges.where(F.col("_earlier") + F.col("_sum") <= budget).select("_row", F.col("words").alias("part"), "finish")
    cut = ranges.where(F.col("_earlier") + F.col("_sum") > budget).withColumn("_total", F.col("_earlier") + F.sum("words").over(inside))
    part = F.least(F.col("words"), budget - F.col("_total") + F.col("words"))
    return whole.unionByName(cut.select("_row", part.alias("part"), "finish").where("part > 0"))


def allocate(docs: DataFrame, **kw) -> DataFrame:
    """Per document: ``doc_id, source, size, source_size, target, taken, virtual_finish``.

    ``docs`` needs ``doc_id, text, source``. ``virtual_finish`` is that of the last packet taken, null where
    nothing is. ``kw``: ``weights, budget_share, max_repeats, seed``.
    """
    return _allocate(docs, **kw).drop("_same", "_again")


def mix(docs: DataFrame, **kw) -> DataFrame:
    """The documents of the mixture, range-sorted by virtual finish time, with ``size, taken, virtual_finish`` added.

    A document of which twice its words are taken appears once, with ``taken`` telling so. Of equal rows
    as many appear as something is taken of.
    """
    docs = docs.drop("size", "taken", "virtual_finish")
    of0, of1, of, same, again, nth = (fresh(docs, f"__{n}") for n in ("of0", "of1", "of", "same", "again", "nth"))
    got = _allocate(docs, **kw).where("taken > 0").withColumn(nth, F.row_number().over(W.partitionBy("_same", "_again").orderBy("virtual_finish", "taken")))
    got = got.select(F.col("_same").alias(same), F.col("_again").alias(again), nth, "size", "taken", "virtual_finish")
    numbered = docs.select("*", *[c.alias(n) for c, n in zip(_digest(), (of0, of1), strict=True)])
    numbered = numbered.withColumn(of, F.row_number().over(W.partitionBy(of0, of1).orderBy(F.lit(0))))
    # the number is compared by range, not as a key, so that the join keeps the window's partitioning
    on = (F.col(of0) == F.col(same)) & (F.col(of1) == F.col(again)) & F.col(of).between(F.col(nth), F.col(nth))
    mixed = numbered.join(got, on).select(*[F.col(f"`{c}`") for c in docs.columns], "size", "taken", "virtual_finish")
    return mixed.orderBy("virtual_finish", "doc_id")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = allocate(table(spark, sf_dir, "documents"))
    return got.orderBy(F.col("virtual_finish").asc_nulls_last(), "doc_id")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
named AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM per),
capped AS (
  SELECT *, (2 * source_size)::DOUBLE AS cap, (2 * source_size)::DOUBLE / weight AS fill,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS budget FROM named),
levels AS (
  SELECT *, row_number() OVER (ORDER BY fill, source ASC NULLS LAST) AS pos, (budget - coalesce(sum(cap) OVER (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fill, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
  FROM capped),
targets AS (
  SELECT source, source_size, least(cap, arg_min(lv, pos) FILTER (WHERE lv <= fill) OVER () * weight) AS target FROM levels),
queued AS (
  SELECT q.*, t.source_size, t.target, row_number() OVER () AS r,
         sum(size) OVER (PARTITION BY q.source ORDER BY k, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS before
  FROM sized q JOIN targets t ON q.source IS NOT DISTINCT FROM t.source),
packets AS (
  SELECT r, source, target, before + source_size * turn + 256 * j AS start, least(256, size - 256 * j) AS words
  FROM queued, range(2) AS a(turn), LATERAL (SELECT unnest(range((size + 255) // 256)) AS j)),
ordered AS (
  SELECT *, (start + words)::DOUBLE / target AS finish,
         sum(words) OVER (ORDER BY (start + words)::DOUBLE / target, source NULLS LAST, start ROWS UNBOUNDED PRECEDING) AS total
  FROM packets),
budget AS (SELECT floor(coalesce(sum(size), 0)::DOUBLE * 1.5::DOUBLE)::BIGINT AS words FROM sized),
cut AS (
  SELECT r, sum(least(o.words, b.words - total + o.words))::BIGINT AS taken, max(finish) AS virtual_finish
  FROM ordered o, budget b WHERE b.words - total + o.words > 0 GROUP BY r)
SELECT q.doc_id, q.source, q.size, q.source_size, q.target, coalesce(c.taken, 0)::BIGINT AS taken, c.virtual_finish
FROM queued q LEFT JOIN cut c ON q.r = c.r
"""
