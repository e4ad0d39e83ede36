"""Exact top-k by inner product: the threshold algorithm over sorted per-dimension lists, in blocks.

Vectors become integers, ``floor(256 * x)`` of each component. Candidates are dealt into blocks of
about ``BLOCK_ROWS``; a block's task sorts its candidates by each dimension once and then lets all queries pass,
``QUERY_ROWS`` at a time. Sorted access goes down all lists from both ends, a deeper stretch each round;
rows it meets are scored in full (random access, one matrix product for all open queries). No row not met
yet can score more than the sum over dimensions of the query's component times the list's value at
the depth reached; a query closes when that bound is below its k-th score. Each block gives k rows a
query at most, of which the best k remain.

What a query's k-th score must reach is known before: a first pass searches one block of candidates for
all queries, and its k-th score (of any k candidates, so no more than the true one) closes queries in the other
blocks as soon as their bound is below it.

Defined cases: vectors that are null, empty, or hold null or non-finite components take no part;
shorter vectors count as filled up with zeros; rows that share the query's vec_id are its own and no
candidates; repeated candidate rows are candidates each; a query row that repeats exactly is asked
once; scores beyond 64 bits saturate, components beyond 1e300 too; extra columns are ignored. Where products pass what
floats hold exactly, scores are floats with a known error first, and whole numbers for what lies within it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import materialise, table

K = 5
BLOCK_ROWS = 16384
QUERY_ROWS = 2048
FIRST_DEPTH = 4
#: Greater components count as this.
MOST = 1e300

HITS = "query_id long, query_key long, vec_id long, score long, beyond string"
ROWS = "b int, kind int, part int, vec_id long, query_key long, floor long, embedding array<double>"
_HITS = pa.schema([("query_id", pa.int64()), ("query_key", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("beyond", pa.string())])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Integer components as float64, rows filled up with zeros."""
    lists = column.combine_chunks()
    size = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(size), int(size.max(initial=0))))
    at = np.repeat(np.arange(len(size)), size)
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(256.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)), -MOST, MOST)
    out[at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


class Lists:
    """The candidates of a block, sorted by each dimension; ``ids`` ascend, so ties go to the first."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        n = len(ids)
        order = np.argsort(x, axis=0, kind="stable")
        self.ids, self.x, self.values = ids, x, np.take_along_axis(x, order, axis=0)
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
        self.met = np.minimum(rank, n - 1 - rank).min(axis=1, initial=n)  # the depth at which some list first shows the row
        self.order = np.argsort(self.met, kind="stable")

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, position and score of each query's k best, less those under its ``floor``."""
        n = len(self.ids)
        low = np.iinfo(np.int64).min
        least = np.full(len(q), low) if floor is None else np.where(floor == low, low, floor * n - n + 1)  # the least key of such a score
        best = np.full((len(q), k), low)
        active, done, depth = np.arange(len(q)), 0, FIRST_DEPTH
        while len(active) and done < n:
            upto = int(np.searchsorted(self.met[self.order], depth))
            rows = np.sort(self.order[done:upto])
            done = upto
            if len(rows):
                for a in range(0, len(active), 256):
                    part = active[a : a + 256]
                    keys = np.rint(q[part] @ self.x[rows].T).astype(np.int64) * n - rows  # one number for score and tie
                    keys[query_ids[part][:, None] == self.ids[rows][None, :]] = low
                    both = np.concatenate([best[part], keys], axis=1)
                    best[part] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
            if done < n:
                top, bottom = self.values[n - 1 - depth], self.values[depth]
                bound = np.maximum(q[active], 0) @ top + np.minimum(q[active], 0) @ bottom
                kth = np.maximum(best[active].min(axis=1), least[active])
                active = active[(kth == low) | (bound >= -(-kth // n))]
            depth *= 2
        best = np.sort(best, axis=1)[:, ::-1]
        at, place = np.nonzero((best != low) & (best >= least[:, None]))
        keys = best[at, place]
        score = -(-keys // n)
        return at, score * n - keys, score


def beyond(score: int) -> str:
    """Nothing for scores that fit 64 bits; else a text by which those that don't are in order, the greater one later."""
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    if low <= score <= high:
        return ""
    text = f"{len(str(abs(score))):05d}{abs(score)}"
    return text if score > 0 else text.translate(str.maketrans("0123456789", "9876543210"))


class WideLists(Lists):
    """The same lists for components whose products pass 64 bits.

    Scores are floats here, off by no more than a bound that is known; what lies within that of a query's k-th score stays
    open, and is scored by whole numbers in the end, each distinct vector once.
    """

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        self.distinct = np.unique(self.x, axis=0, return_inverse=True)[1].ravel()
        self.depths = self.met[self.order]
        found = [self._one(int(i), one, k) for i, one in zip(query_ids, q, strict=True)]
        at = np.repeat(np.arange(len(q)), [len(rows) for rows, _ in found])
        return at, np.array([v for rows, _ in found for v in rows], np.int64), np.array([v for _, scores in found for v in scores], object)

    def _one(self, query_id: int, q: np.ndarray, k: int) -> tuple[list[int], list[int]]:
        """Positions and scores of one query's k best."""
        n, dims = self.x.shape
        scale = float(np.abs(q).max(initial=0)) or 1.0
        unit = q / scale  # keeps sums of any components finite
        off = 4 * dims * 2.0**-52
        kept_rows, kept, slack = np.zeros(0, np.int64), np.zeros(0), np.zeros(0)
        done, depth = 0, FIRST_DEPTH
        while done < n:
            upto = int(np.searchsorted(self.depths, depth))
            rows = self.order[done:upto]
            done = upto
            rows = rows[self.ids[rows] != query_id]
            x = self.x[rows]
            kept_rows, kept = np.concatenate([kept_rows, rows]), np.concatenate([kept, x @ unit])
            slack = np.concatenate([slack, off * (np.abs(x) @ np.abs(unit))])
            if len(kept) > k:  # at least k score this much
                kth = np.partition(kept - slack, len(kept) - k)[-k]
                on = kept + slack >= kth
                kept_rows, kept, slack = kept_rows[on], kept[on], slack[on]
            if done < n and len(kept) >= k:
                kth = np.partition(kept - slack, len(kept) - k)[-k]
                top, bottom = self.values[n - 1 - depth], self.values[depth]
                bound = np.maximum(unit, 0) @ top + np.minimum(unit, 0) @ bottom
                if bound + off * (np.abs(unit) @ np.maximum(np.abs(top), np.abs(bottom))) < kth:
                    break
            depth *= 2
        own = [int(v) for v in q]
        score: dict[int, int] = {}
        for row in kept_rows.tolist():
            if (same := int(self.distinct[row])) not in score:
                score[same] = sum(a * int(b) for a, b in zip(own, self.x[row], strict=True))
        best = sorted(kept_rows.tolist(), key=lambda row: (-score[int(self.distinct[row])], row))[:k]
        return best, [score[int(self.distinct[row])] for row in best]


def _search(k: int, query_rows: int):
    """Rows of ``ROWS``, sorted by block, candidates before queries by id, in; hits out."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, x, lists = -1, np.zeros(0, np.int64), np.zeros((0, 0)), None
        kept: list[pa.Table] = []

        def candidates() -> None:
            nonlocal ids, x, lists
            rows = pa.concat_tables(kept)
            ids, x, lists = rows["vec_id"].to_numpy(), _matrix(rows["embedding"]), None

        def answer(wanted: pa.Table) -> pa.RecordBatch:
            nonlocal x, lists
            query_ids, q = wanted["vec_id"].to_numpy(), _matrix(wanted["embedding"])
            floor = wanted["floor"].to_numpy()
            dims = max(x.shape[1], q.shape[1])
            if x.shape[1] < dims:
                x, lists = np.pad(x, ((0, 0), (0, dims - x.shape[1]))), None
            q = np.pad(q, ((0, 0), (0, dims - q.shape[1])))
            most = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * dims
            if most < 2**52 and most * (len(ids) + 1) < 2**61:
                lists = lists or Lists(ids, x)
                # every score here is above a floor under these bounds, and none reaches one over them
                low = np.iinfo(np.int64).min
                at, hits, scores = lists.search(query_ids, q, k, np.where(floor == low, low, np.clip(floor, -int(most) - 1, int(most) + 1)))
            else:
                at, hits, scores = WideLists(ids, x).search(query_ids, q, k)
            more = [beyond(v) for v in scores] if scores.dtype == object else [""] * len(scores)
            scores = np.clip(scores, np.iinfo(np.int64).min, np.iinfo(np.int64).max).astype(np.int64)
            return pa.record_batch([pa.array(query_ids[at]), pa.array(wanted["query_key"].to_numpy()[at]), pa.array(ids[hits]), pa.array(scores), pa.array(more, pa.string())], schema=_HITS)

        def runs(batch: pa.RecordBatch) -> Iterator[pa.Table]:
            b, kind = batch["b"].to_numpy(), batch["kind"].to_numpy()
            cuts = np.flatnonzero((np.diff(b) != 0) | (np.diff(kind) != 0)) + 1
            for a, z in zip([0, *cuts], [*cuts, len(b)], strict=True):
                yield pa.Table.from_batches([batch.slice(a, z - a)])

        for batch in source:
            for rows in runs(batch) if batch.num_rows else ():
                own, kind = rows["b"][0].as_py(), rows["kind"][0].as_py()
                if kind == 0:
                    if own != block:
                        block, kept, x = own, [], np.zeros((0, 0))
                    kept.append(rows)
                elif own == block:  # else the block has no candidates
                    if kept:
                        candidates()
                        kept = []
                    for at in range(0, rows.num_rows, query_rows):
                        yield answer(rows.slice(at, query_rows))

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``; both tables hold ``vec_id, embedding``."""
    usable = lambda e: F.size(e).between(1, 1 << 30) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))

    def ready(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
        return df.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(usable(F.col("embedding")))

    vectors, queries = ready(vectors), ready(queries)
    queries = queries.withColumn("query_key", F.xxhash64("embedding")).dropDuplicates(["vec_id", "query_key"])
    n = -(-max(1, vectors.count()) // block_rows)
    block = F.pmod(F.xxhash64("vec_id", F.xxhash64("embedding")), F.lit(n)).cast("int")
    rows = vectors.select(block.alias("b"), F.lit(0).alias("kind"), F.lit(0).alias("part"), "vec_id", F.lit(0).cast("long").alias("query_key"), F.lit(0).cast("long").alias("floor"), "embedding")
    parts = -(-max(1, queries.count()) // (8 * query_rows))
    asked = queries.select("query_key", "vec_id", "embedding", F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"))
    search = lambda df, *by: df.repartition(*by).sortWithinPartitions(*by[1:], "kind", "vec_id").mapInArrow(_search(k, query_rows), HITS)
    columns = ["b", "kind", "part", "vec_id", "query_key", "floor", "embedding"]
    # the first pass: block 0, dealt again for each part of the queries, which are many more than one task should see
    low = F.lit(-(1 << 63)).cast("long")
    first = asked.select(F.lit(0).alias("b"), F.lit(1).alias("kind"), "part", "vec_id", "query_key", low.alias("floor"), "embedding")
    shown = rows.where("b = 0").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = search(shown.select(columns).unionByName(first).withColumn("b", F.col("part")), parts, "b")
    order = W.partitionBy("query_id", "query_key").orderBy(F.col("score").desc(), F.col("beyond").desc(), "vec_id")
    found = materialise(found, "first-block")
    kth = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), "query_key", F.col("score").alias("floor"))
    if n > 1:
        known = asked.join(kth, ["vec_id", "query_key"], "left").withColumn("b", F.explode(F.sequence(F.lit(1), F.lit(n - 1))))
        known = known.select("b", F.lit(1).alias("kind"), "part", "vec_id", "query_key", F.coalesce("floor", low).alias("floor"), "embedding")
        found = found.unionByName(search(rows.where("b > 0").unionByName(known), n - 1, "b"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


OP2_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
