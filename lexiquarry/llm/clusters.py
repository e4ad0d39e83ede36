"""Centroid clustering of integer vectors with Elkan's bounds.

Vectors become integers, ``floor(64 * x)`` of each component, and centroids stay integers, so all squared distances
are exact. Each row carries its cluster, an upper bound of the distance to its own centroid and a lower bound of that to
every centroid, from round to round, in a table of the shared folder. A round moves the bounds by how far the centroids
moved, then leaves out every distance that the bounds or the distances between centroids show to be greater. Bounds are rounded
away from the truth at each step and a distance is left out only if it is strictly greater, so ties are always
computed, and go to the smaller number.

A task sums its rows by cluster as it assigns them, in two halves of 32 bits that can't overflow, and adds those
sums to the table it writes as rows of their own, k for each task. Only sums of them, k times the number of components,
come to the driver, which holds k centroids. No group of rows meets in one task.

Defined cases: vectors that are null, of another number of components, or that hold null or non-finite components are
left out; components past 2**61 count as that, and a distance or inertia past 64 bits is given as the greatest long, while
clusters are chosen by the whole number; repeated rows are vectors each; vectors without an id can be first centroids
only if too few have one; of fewer vectors than centroids each is one; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import materialise, table

K = 16
DIMS = 64
SCALE = 64
ROUNDS = 3
MOST = 1 << 61
#: Sums of absolute components up to this give distances within 64 bits, by DIMS components.
EXACT = 1 << 28

#: kind 0: a vector; kind 1: a task's sums of a cluster, ``vec_id`` its rows, ``x`` the upper halves and then the lower ones.
STATE = "kind int, vec_id long, x array<long>, cluster int, upper float, lower array<float>"
_STATE = pa.schema([("kind", pa.int32()), ("vec_id", pa.int64()), ("x", pa.list_(pa.int64())), ("cluster", pa.int32()), ("upper", pa.float32()), ("lower", pa.list_(pa.float32()))])

Batches = Iterator[pa.RecordBatch]


def above(x: np.ndarray) -> np.ndarray:
    """Floats of 32 bits that are at least ``x``, whatever the last step rounded off."""
    x = np.nextafter(x, np.inf)
    short = x.astype(np.float32)
    return np.where(short < x, np.nextafter(short, np.float32(np.inf)), short)


def below(x: np.ndarray) -> np.ndarray:
    """Floats of 32 bits, zero or more, that are at most ``x``, or zero."""
    x = np.maximum(np.nextafter(x, -np.inf), 0.0)
    short = x.astype(np.float32)
    return np.where(short > x, np.nextafter(short, np.float32(-np.inf)), short)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of rows and a centroid, or of rows in pairs."""
    d = x - c
    return (d * d).sum(axis=1)


def root(d: np.ndarray) -> np.ndarray:
    return np.sqrt(np.nextafter(d.astype(np.float64), np.inf))


def root_below(d: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(np.nextafter(d.astype(np.float64), -np.inf), 0.0))


class Round:
    """The centroids of a round, the distances between them, and how far they came since the round before."""

    def __init__(self, centres: list[list[int]], before: list[list[int]] | None):
        whole = np.array(centres, object)
        self.centres, self.k = centres, len(centres)
        self.moved = np.array([float(root(squared(np.array([a], object), np.array(b, object)))[0]) for a, b in zip(centres, before or centres, strict=True)])
        self.between = np.array([root_below(squared(whole, one)) for one in whole])
        apart = self.between + np.where(np.eye(self.k, dtype=bool), np.inf, 0.0)
        self.half = apart.min(axis=1) / 2

    def assign(self, x: np.ndarray, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Nearest centroid and bounds of each row, and how many distances that took; -1 in ``own``: not assigned yet."""
        centres = np.array(self.centres, object)
        if int(np.abs(x).max(initial=0)) + max((abs(v) for c in self.centres for v in c), default=0) <= EXACT:
            centres = centres.astype(np.int64)
        else:
            x = x.astype(object)
        fresh = own < 0
        own = np.where(fresh, 0, own)
        upper = np.where(fresh, np.float32(np.inf), above(upper.astype(np.float64) + self.moved[own]))
        lower = below(lower.astype(np.float64) - self.moved)
        exact = np.zeros(len(x), x.dtype)
        tight = np.zeros(len(x), bool)
        took = 0
        rows = np.flatnonzero(~(upper < self.half[own]))

        def maybe(at: np.ndarray, j: int) -> np.ndarray:
            o = own[at]
            return at[(o != j) & ~(lower[at, j] > upper[at]) & ~(self.between[o, j] / 2 > upper[at])]

        for j in range(self.k):
            at = maybe(rows, j)
            loose = at[~tight[at]]
            if len(loose):  # the bound of the row's own centroid gives way to the distance
                o = own[loose]
                exact[loose] = d = squared(x[loose], centres[o])
                upper[loose], lower[loose, o], tight[loose] = above(root(d)), below(root_below(d)), True
                took += len(loose)
                at = maybe(at, j)
            d = squared(x[at], centres[j])
            took += len(at)
            lower[at, j] = below(root_below(d))
            nearer = (d < exact[at]) | ((d == exact[at]) & (j < own[at]))
            at, d = at[nearer], d[nearer]
            own[at], exact[at], upper[at] = j, d, above(root(d))
        if self.k == 1:
            upper = above(root(squared(x, centres[own])))
        return own, upper, lower, took

    def distances(self, x: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Exact squared distance of each row and its centroid, the greatest long at most."""
        centres = np.array(self.centres, object)
        d = squared(x.astype(object), centres[own]) if int(np.abs(x).max(initial=0)) + max(abs(v) for c in self.centres for v in c) > EXACT else squared(x, centres.astype(np.int64)[own])
        return np.minimum(d, np.iinfo(np.int64).max).astype(np.int64)


def _columns(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = batch.num_rows
    flat = lambda name, width: batch[name].flatten().to_numpy(zero_copy_only=False).reshape(n, width)
    return flat("x", DIMS), batch["cluster"].to_numpy(), batch["upper"].to_numpy(), flat("lower", k)


def _lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * values.shape[1], values.ravel())


def _round(step: Round):
    """State in; state out, with each task's sums after its rows."""

    def run(source: Batches) -> Batches:
        sums, count = np.zeros((step.k, 2 * DIMS), np.int64), np.zeros(step.k, np.int64)
        for batch in source:
            if not batch.num_rows:
                continue
            x, own, upper, lower = _columns(batch, step.k)
            own, upper, lower, _ = step.assign(x, own, upper, lower)
            halves = np.concatenate([x >> 32, x & 0xFFFFFFFF], axis=1)
            for j in np.unique(own):
                mine = own == j
                sums[j] += halves[mine].sum(axis=0)
                count[j] += int(mine.sum())
            yield pa.record_batch([pa.array(np.zeros(len(own), np.int32)), batch["vec_id"], batch["x"], pa.array(own.astype(np.int32)), pa.array(upper), _lists(lower)], schema=_STATE)
        held = np.flatnonzero(count)
        if len(held):
            none = np.zeros(len(held), np.float32)
            yield pa.record_batch([pa.array(np.ones(len(held), np.int32)), pa.array(count[held]), _lists(sums[held]), pa.array(held.astype(np.int32)), pa.array(none), _lists(none[:, None])], schema=_STATE)

    return run


def _last(step: Round):
    def run(source: Batches) -> Batches:
        for batch in source:
            if batch.num_rows:
                x, own, upper, lower = _columns(batch, step.k)
                own = step.assign(x, own, upper, lower)[0]
                yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(own.astype(np.int32)), pa.array(step.distances(x, own))], ["vec_id", "cluster", "distance"])

    return run


def integers(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """``vec_id, x`` of the usable vectors."""
    e = F.col("embedding")
    good = F.col("embedding").isNotNull() & (F.size(e) == dims) & ~F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    whole = lambda v: F.greatest(F.least(F.floor(F.lit(float(scale)) * v), F.lit(MOST)), F.lit(-MOST))
    return vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).where(good).select("vec_id", F.transform(e, whole).alias("x"))


def first_centres(rows: DataFrame, k: int) -> list[list[int]]:
    """The ``k`` vectors of least hash, by hash."""
    named = rows.withColumn("h", F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256))
    return [list(r["x"]) for r in named.orderBy(F.col("h").asc_nulls_last(), "vec_id", "x").limit(k).collect()]


def _centres(state: DataFrame, before: list[list[int]]) -> list[list[int]]:
    """The floor of each cluster's mean; an empty cluster's centroid stays."""
    sums = state.where("kind = 1")
    total = F.sum(F.col("v").cast("decimal(38,0)"))
    got = sums.select("cluster", "vec_id", F.posexplode("x").alias("at", "v")).groupBy("cluster", "at").agg(total.alias("v"), F.sum("vec_id").alias("n")).collect()
    cells = {(r["cluster"], r["at"]): (int(r["v"]), r["n"]) for r in got}
    out = []
    for j, old in enumerate(before):
        each = [(cells.get((j, i)), cells.get((j, i + DIMS))) for i in range(DIMS)]
        out.append([((high[0] << 32) + low[0]) // high[1] for high, low in each] if each[0][0] else old)
    return out


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every usable vector."""
    rows = integers(vectors)
    centres = first_centres(rows, k)
    none = F.array(*[F.lit(0.0).cast("float")] * max(1, len(centres)))
    state = rows.select(F.lit(0).alias("kind"), "vec_id", "x", F.lit(-1).alias("cluster"), F.lit(0.0).cast("float").alias("upper"), none.alias("lower"))
    if not centres:
        spark = vectors.sparkSession
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    before = None
    for at in range(rounds):
        state = materialise(state.where("kind = 0").mapInArrow(_round(Round(centres, before)), STATE), f"clusters-{at}")
        before, centres = centres, _centres(state, centres)
    done = materialise(state.where("kind = 0").mapInArrow(_last(Round(centres, before)), "vec_id long, cluster int, distance long"), "clusters")
    return done.select("*", *_digests(done, centres))


def _digests(done: DataFrame, centres: list[list[int]]) -> list[Column]:
    """What each row tells of its cluster; there are no more than k of them."""
    most = np.iinfo(np.int64).max
    sums = {r["cluster"]: int(r["s"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    one = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1)
    inertia = [F.lit(min(sums.get(j, 0), most)).cast("long") for j in range(len(centres))]
    sha = [F.lit(hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for c in centres]
    return [one(inertia).alias("cluster_inertia"), F.lit(min(sum(sums.values()), most)).cast("long").alias("inertia"), one(sha).alias("centroid_sha256")]


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster(table(spark, sf_dir, "embeddings"))


def _sql() -> str:
    """Each round as a table of its own, all distances computed."""
    parts = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda c: floor(64 * c::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS j, x AS c FROM (SELECT x, sha256('1:' || vec_id) AS h FROM v ORDER BY h LIMIT 16))""",
    ]
    for r in range(ROUNDS + 1):
        parts.append(f"""a{r} AS MATERIALIZED (SELECT rid, min(16 * list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT + j) AS best
  FROM v, c{r} GROUP BY rid)""")
        if r < ROUNDS:
            parts.append(f"""s{r} AS (SELECT j, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT x, (best % 16)::BIGINT AS j, unnest(range(1, 65)) AS i FROM v JOIN a{r} USING (rid)) GROUP BY j, i),
c{r + 1} AS MATERIALIZED (SELECT j, coalesce(m.c, o.c) AS c FROM c{r} o LEFT JOIN (SELECT j, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM s{r} GROUP BY j) m USING (j))""")
    return f"""
WITH {", ".join(parts)},
done AS (SELECT vec_id, (best % 16)::INT AS cluster, (best // 16)::BIGINT AS distance FROM a{ROUNDS} JOIN v USING (rid))
SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256
FROM done JOIN c{ROUNDS} ON j = cluster
"""


OP12_SQL = _sql()
