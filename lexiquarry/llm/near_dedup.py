"""MinHash near-dedup as a multi-index Hamming join.

Two documents are linked if their sets of distinct ``shingle``-word shingles overlap by ``percent`` or
more of their union. A signature keeps ``SYMBOLS`` minimum hashes, 32 bits each; the distance of two
signatures is the number of symbols that differ, about ``SYMBOLS * (1 - similarity)``.

1. Documents of equal sets fold into one representative by a 128-bit digest of the set.
2. Signatures are split into ``CHUNKS`` chunks. By the pigeonhole principle a pair within the distance has
   a chunk with at most ``DISTANCE // CHUNKS`` = 1 symbol wrong. All ways in which one symbol of a chunk
   may be wrong are enumerated as keys with that symbol left out, so every such pair shares a key:
   none under the distance is missed. (At 80 % similarity a pair lies beyond it once in a million.)
3. In a key's bucket every member meets one leader, a pair for each member. Pairs whose signatures lie
   within the distance are confirmed on full sets, exactly, and confirmed links join components.
4. What a bucket still holds of several components is split by the rarest shingles of its members' sets:
   of two linked sets, the rarest few (all but as many as must be shared, and one) have one in common. So
   no link is lost, and what a template gives to all its pages makes no pairs.
5. Parts whose largest component is the same go together, a document once. Each member outside that component
   meets all others, so a group of copies that its leaders have joined costs nothing more among itself. Again
   signatures within the distance are confirmed on full sets. What goes together is dealt out in cells of bounded
   size; tasks give links, never pairs.
6. Components over the confirmed links give the classes.

At 80 % similarity and 64 symbols the expected distance is 12.8 with deviation 3.2; 29 is five
deviations above. Other similarities take the distance that is five deviations above their own. Signatures are
compared by the low byte of each symbol, which can make a distance less but never more.

Defined cases: null or wordless texts have an empty set and are linked with nothing; with fewer words
than a shingle the whole sequence is the one shingle; rows that share a doc_id are one document; rows
without doc_id take no part and are kept; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import fresh, materialise, table
from ._words import Words, each_slice, grams, mix
from .graph import components

SHINGLE = 5
PERCENT = 80
SYMBOLS = 64
#: A cell of a part holds so many shingles of members outside its largest component, about, and lets so many members pass.
CELL_SHINGLES, CELL_MEMBERS = 1 << 20, 1 << 14
#: Ids that are broadcast at most.
SMALL = 1_000_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)
_SALT = mix(_rng.integers(0, 1 << 63, 2 * SYMBOLS, dtype=np.uint64))

Batches = Iterator[pa.RecordBatch]


def distance_for(percent: int) -> int:
    """Symbols that may differ: five deviations above what pairs of that similarity expect."""
    p = 1 - percent / 100
    return min(SYMBOLS - 1, math.ceil(SYMBOLS * p + 5 * math.sqrt(SYMBOLS * p * (1 - p))))


def chunk_bounds(distance: int) -> np.ndarray:
    """Bounds of so many chunks that some chunk of a pair within the distance has one symbol wrong at most."""
    chunks = distance // 2 + 1
    return np.linspace(0, SYMBOLS, chunks + 1).round().astype(int)


def shingle_sets(w: Words, shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    g = grams(w.hash, shingle)
    out = []
    for a, b in zip(w.rows[:-1], w.rows[1:], strict=True):
        out.append(np.unique(g[a : b - shingle + 1]) if b - a >= shingle else grams(w.hash[a:b], b - a) if b > a else g[:0])
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """``SYMBOLS`` 32-bit symbols of each set; none may be empty."""
    every = np.concatenate(sets)
    start = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), SYMBOLS), np.uint64)
    for k in range(SYMBOLS):
        out[:, k] = np.minimum.reduceat(every * _A[k] + _B[k], start)
    return (mix(out) >> np.uint64(32)).astype(np.uint32)


def _sketches(shingle: int):
    def run(source: Batches) -> Batches:
        for batch in source:
            ids = batch["doc_id"]
            for first, w in each_slice(batch["text"]):
                sets = shingle_sets(w, shingle)
                n = np.array([len(s) for s in sets], np.int64)
                full = np.flatnonzero(n)
                signed: list[bytes | None] = [None] * len(sets)
                low: list[bytes | None] = [None] * len(sets)
                d = np.zeros((2, len(sets)), np.uint64)
                if len(full):
                    every, start = np.concatenate(sets), np.concatenate([[0], np.cumsum(n[full])[:-1]])
                    d[0, full] = np.add.reduceat(mix(every ^ _SALT[0]), start)
                    d[1, full] = np.add.reduceat(mix(every + _SALT[1]), start)
                    for r, row in zip(full, signatures([sets[r] for r in full]), strict=True):
                        signed[r], low[r] = row.tobytes(), row.astype(np.uint8).tobytes()
                yield pa.RecordBatch.from_arrays([ids.slice(first, len(sets)), pa.array(n), pa.array(d[0].view(np.int64)), pa.array(d[1].view(np.int64)), pa.array(signed, pa.binary()), pa.array(low, pa.binary())], ["doc_id", "n_shingles", "d1", "d2", "signature", "low"])

    return run


def sketch(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, n_shingles, d1, d2, signature, low``: set size, set digest, symbols and their low bytes (null for empty sets)."""
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return docs.mapInArrow(_sketches(shingle), "doc_id long, n_shingles long, d1 long, d2 long, signature binary, low binary")


def chunk_keys(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each symbol, a key of its chunk with that symbol left out; a column for each symbol."""
    each = mix(symbols.astype(np.uint64) ^ _SALT[:SYMBOLS])
    sums = np.add.reduceat(each, bounds[:-1], axis=1)
    return mix(np.repeat(sums, np.diff(bounds), axis=1) - each + _SALT[SYMBOLS:])


def _keys(reps: DataFrame, bounds: np.ndarray) -> DataFrame:
    """``rep, key`` of every key of every signature."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for at in range(0, batch.num_rows, 4000):
                part = batch.slice(at, 4000)
                symbols = np.frombuffer(b"".join(part["signature"].to_pylist()), np.uint32).reshape(-1, SYMBOLS)
                keys = chunk_keys(symbols, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part["rep"].to_numpy(zero_copy_only=False), SYMBOLS)), pa.array(keys.ravel().view(np.int64))], ["rep", "key"])

    return reps.select("rep", "signature").mapInArrow(run, "rep long, key long")


def within(a: np.ndarray, b: np.ndarray, distance: int) -> np.ndarray:
    """Which rows of two arrays of symbols differ in ``distance`` places at most."""
    return (a != b).sum(axis=1) <= distance


def _close(pairs: DataFrame, signatures: DataFrame, distance: int, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` (distinct) those whose signatures are within the distance, and whose sizes allow a link."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                one, two = (np.frombuffer(b"".join(part[c].to_pylist()), np.uint8).reshape(-1, SYMBOLS) for c in ("_a", "_b"))
                yield part.select(["a", "b"]).filter(pa.array(within(one, two, distance)))

    side = lambda c: signatures.select(F.col("rep").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("low").alias(f"_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    return both.select("a", "b", "_a", "_b").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, ids: DataFrame, shingle: int) -> DataFrame:
    """``rep, shingles`` of the documents of the ids (``rep``): each set's hashes, sorted."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for first, w in each_slice(batch["text"]):
                own = shingle_sets(w, shingle)
                for at in range(0, len(own), 500):
                    some = [s.tobytes() for s in own[at : at + 500]]
                    yield pa.RecordBatch.from_arrays([batch["rep"].slice(first + at, len(some)), pa.array(some, pa.binary())], ["rep", "shingles"])

    ids = materialise(ids.select("rep").distinct(), "ids")
    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string"))
    many = ids.count()
    texts = texts.join(F.broadcast(ids) if many <= SMALL else ids, "rep", "left_semi")
    sets = materialise(texts.mapInArrow(run, "rep long, shingles binary"), "sets")
    return sets if sets.count() == many else materialise(sets.dropDuplicates(["rep"]), "sets")  # rows share a doc_id


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets overlap by ``percent`` or more of their union."""
    if min(len(a), len(b)) * 100 < max(len(a), len(b)) * percent:
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    shared = int(np.count_nonzero(both[1:] == both[:-1]))
    return 100 * shared >= percent * (len(both) - shared)


def _confirmed(pairs: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` (distinct) those whose full sets are linked."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent) for x, y in zip(part["_a"], part["_b"], strict=True)]
                yield part.select(["a", "b"]).filter(pa.array(found, pa.bool_()))

    pairs = materialise(pairs, "pairs")
    sets = _sets(docs, pairs.select(F.col("a").alias("rep")).unionAll(pairs.select(F.col("b").alias("rep"))), shingle)
    # a leader of many is ``b``: its pairs come with the members' sets, so Spark sees their size and splits them
    side = lambda c: sets.select(F.col("rep").alias(c), F.col("shingles").alias(f"_{c}"))
    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "_a", "_b")
    return materialise(joined.mapInArrow(run, "a long, b long"), "links")


def _open(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Rows (``key, rep``) of keys that hold several components, with ``c`` (their own) and ``most`` (the key's largest)."""
    rows = rows.join(roots.withColumnRenamed("node", "rep"), "rep", "left").withColumn("c", F.coalesce("root", "rep")).drop("root")
    per = rows.groupBy("key", "c").agg(F.count("*").alias("m"))
    per = per.groupBy("key").agg(F.count("*").alias("components"), F.max(F.struct("m", "c")).alias("top")).where("components > 1")
    return rows.join(per.select("key", F.col("top.c").alias("most")), "key")


def _rarest(sets: DataFrame, percent: int) -> DataFrame:
    """``key, rep, n, at``: of each set its rarest shingles with their rank, as many as leave no two linked sets without one in common."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                own = [np.frombuffer(x.as_buffer(), np.int64) for x in part["shingles"]]
                n = np.fromiter(map(len, own), np.int64, len(own))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([*own, np.zeros(0, np.int64)])), pa.array(np.repeat(part["rep"].to_numpy(zero_copy_only=False), n)), pa.array(np.repeat(n, n))], ["key", "rep", "n"])

    every = sets.mapInArrow(run, "key long, rep long, n long")
    # a shingle of one set alone makes no pair; it only takes a place before the others
    known = every.join(every.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "key")
    own = W.partitionBy("rep")
    alone = F.col("n") - F.count("*").over(own)
    rank = F.row_number().over(own.orderBy("df", "key"))
    return known.withColumn("at", alone + rank).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).select("key", "rep", "n", "at")


class _Cell:
    """Members held in memory, with the members of each shingle."""

    def __init__(self, rows: pa.Table):
        own = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"].combine_chunks()]
        self.rep, self.c, self.at = (rows[k].to_numpy() for k in ("rep", "c", "at"))
        self.low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, SYMBOLS)
        self.n = np.array([len(x) for x in own])
        every, row = np.concatenate(own), np.repeat(np.arange(len(own)), self.n)
        order = np.argsort(every, kind="stable")
        self.shingle, self.start = np.unique(every[order], return_index=True)
        self.start, self.row = np.append(self.start, len(every)), row[order]

    def shared(self, shingles: np.ndarray) -> np.ndarray:
        """Of each member, how many of the (sorted, distinct) shingles it has."""
        at = np.minimum(np.searchsorted(self.shingle, shingles), len(self.shingle) - 1)
        at = at[self.shingle[at] == shingles]
        first, size = self.start[at], self.start[at + 1] - self.start[at]
        places = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
        return np.bincount(self.row[places], minlength=len(self.n))


def _across(distance: int, percent: int):
    """Rows sorted by ``most, block, salt, role`` in (role 0 is held, 1 passes); links between components out."""

    def links(cell: _Cell, rows: pa.Table, root: dict[int, int]) -> Iterator[tuple[int, int]]:
        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                x = up
            return x

        low = np.frombuffer(b"".join(rows["low"].to_pylist()), np.uint8).reshape(-1, SYMBOLS)
        rep, c, at = (rows[k].to_numpy() for k in ("rep", "c", "at"))
        for k, shingles in enumerate(rows["shingles"].combine_chunks()):
            own = np.frombuffer(shingles.as_buffer(), np.uint64)
            n = len(own)
            # the least overlap of a link, and the most of two that share nothing before either's first shared rare shingle
            least = -(-percent * (n + cell.n) // (100 + percent))
            most = np.minimum(n - at[k], cell.n - cell.at) + 1
            near = np.flatnonzero((cell.c != c[k]) & (most >= least))
            near = near[within(cell.low[near], low[k], distance)]
            if len(near) and (len(near) > 50 or any(find(int(x)) != find(int(c[k])) for x in cell.c[near])):
                both = cell.shared(own)[near]
                for i in near[100 * both >= percent * (n + cell.n[near] - both)]:
                    x, y = find(int(cell.c[i])), find(int(c[k]))
                    if x != y:
                        root[max(x, y)] = min(x, y)
                        yield int(rep[k]), int(cell.rep[i])

    def run(source: Batches) -> Batches:
        now, held, cell, root = None, [], None, {}
        for whole in source:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                key = list(zip(*(batch[k].to_pylist() for k in ("most", "block", "salt", "role")), strict=True))
                cuts = [0, *(k for k in range(1, len(key)) if key[k] != key[k - 1]), len(key)]
                found: list[tuple[int, int]] = []
                for a, z in zip(cuts[:-1], cuts[1:], strict=True):
                    rows = pa.Table.from_batches([batch.slice(a, z - a)])
                    if key[a][:3] != now:
                        now, held, cell, root = key[a][:3], [], None, {}
                    if key[a][3] == 0:
                        held.append(rows)
                    elif held:
                        cell = cell or _Cell(pa.concat_tables(held))
                        found += links(cell, rows, root)
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return run


def _split(docs: DataFrame, ids: DataFrame, reps: DataFrame, roots: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``a, b``: links across the components of ``roots`` between any of the ids."""
    sets = _sets(docs, ids, shingle)
    parts = _open(materialise(_rarest(sets, percent), "rarest"), roots)
    rows = parts.groupBy("most", "rep").agg(F.min("c").alias("c"), F.min("at").alias("at"), F.max("n").alias("n"))
    rows = materialise(rows.withColumn("outside", F.col("c") != F.col("most")), "parts")
    size = rows.groupBy("most").agg(F.ceil(F.sum(F.when(F.col("outside"), F.col("n"))) / CELL_SHINGLES).cast("int").alias("blocks"), F.ceil(F.count("*") / CELL_MEMBERS).cast("int").alias("salts"))
    rows = rows.join(size, "most")
    every = lambda name: F.explode(F.sequence(F.lit(0), F.col(name) - 1))
    one = lambda name: F.pmod(F.xxhash64("rep", F.lit(name)), F.col(name)).cast("int")
    held = rows.where("outside").withColumn("role", F.lit(0)).withColumn("block", one("blocks")).withColumn("salt", every("salts"))
    passing = rows.withColumn("role", F.lit(1)).withColumn("block", every("blocks")).withColumn("salt", one("salts"))
    members = sets.join(reps.select("rep", "low"), "rep")
    dealt = held.unionByName(passing).select("rep", "most", "block", "salt", "role", "c", "at").join(members, "rep")
    dealt = dealt.repartition("most", "block", "salt").sortWithinPartitions("most", "block", "salt", "role")
    return materialise(dealt.mapInArrow(_across(distance_for(percent), percent), "a long, b long"), "links")


def find_components(docs: DataFrame, reps: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``node, root`` of the representatives (``rep, n_shingles, signature, low``) that are linked with a lesser one."""
    distance = distance_for(percent)
    keys = _keys(reps, chunk_bounds(distance))
    shared = keys.groupBy("key").agg(F.min("rep").alias("lead"), F.max("rep").alias("last")).where("lead < last")
    buckets = materialise(keys.join(shared.select("key", "lead"), "key").where("rep <> lead"), "buckets")
    pairs = _close(buckets.select(F.col("rep").alias("a"), F.col("lead").alias("b")).distinct(), reps, distance, percent)
    links = _confirmed(pairs, docs, shingle, percent)
    roots = components(links)
    # leaders have met all of their buckets, so they stay out of what follows
    more = _split(docs, _open(buckets.select("key", "rep"), roots), reps, roots, shingle, percent)
    return roots if more.isEmpty() else components(links.unionAll(more))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    sketches = materialise(sketch(docs, shingle), "sketches")
    known = sketches.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = known.groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"), F.first("signature").alias("signature"), F.first("low").alias("low"))
    classes = materialise(classes, "classes")
    roots = find_components(docs, classes.select("rep", "n_shingles", "signature", "low"), shingle, percent)
    # what differs from the document itself: copies of a representative, and linked representatives
    moved = classes.join(roots.withColumnRenamed("node", "rep"), "rep", "left").where("rep < last OR root IS NOT NULL")
    moved = moved.select("d1", "d2", "n_shingles", F.least("rep", "root").alias("component"))
    out = sketches.join(moved, ["d1", "d2", "n_shingles"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("component")), F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each class, that of least doc_id, and all columns."""
    other = fresh(docs, "__id")
    dropped = near_duplicates(docs, shingle, percent).where("NOT kept").select(F.col("doc_id").alias(other))
    return docs.join(dropped, F.col("doc_id").cast("long") == F.col(other), "left_anti")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


OP5_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                                 ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a),
classes AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM classes c LEFT JOIN n ON c.doc_id = n.doc_id
"""
