"""Ranked lexical search: every document against a set of items, by sort-based accumulation.

Items are dealt into blocks whose terms are of bounded size; a block's vocabulary is broadcast as flat arrays, each
term with the items that hold it. A first pass over the documents counts how many of them hold each term, and all
terms; a second one scores. Its tasks work on slices of whole documents: words that the vocabulary holds give
(document, term, occurrences), each is joined to the term's items, and the (item, document, impact) arrays are
concatenated, ordered by a radix sort of packed keys and summed by ``numpy.add.reduceat``. A task keeps the k best of
each item, and its k-th score keeps out all that is less. What tasks keep is range-partitioned by item, where the k best remain.

All scores are 64-bit integers. A word is found by its hash and then compared byte by byte, so the result is exact.

Defined cases: null and empty texts have no terms; rows that share an item_id are one item with the terms of all; items
without terms, or whose terms no document holds, give no rows; documents that repeat are documents each; a document
without an id counts and ranks behind others of its score; extra columns are ignored. An item is held whole, so its
own terms must fit into memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import materialise, table
from ._words import Words, each_slice

K = 10
#: Bytes of terms, with 24 for each, that a block of items holds on average.
BLOCK_BYTES = 16 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
#: Terms up to so many bytes are compared eight bytes at a time.
_SHORT = 64
_LAST = np.iinfo(np.int64).max

TERMS = "item_id long, hash long, term binary"
HITS = "item_id long, doc_id long, score long"

Batches = Iterator[pa.RecordBatch]


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned keys, by 16 bits at a time from the lowest."""
    order = np.arange(len(keys))
    for shift in range(0, int(keys.max(initial=0)).bit_length(), 16):
        digit = (keys[order] >> np.uint64(shift)).astype(np.uint16)
        order = order[np.argsort(digit, kind="stable")]  # of 16-bit keys a radix sort
    return order


def _eights(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Eight bytes from each start as a number, those past ``size`` as zeros; ``data`` goes on for eight bytes more."""
    got = np.lib.stride_tricks.sliding_window_view(data, 8)[start].view("<u8").ravel()
    keep = np.clip(size, 0, 8).astype(np.uint64) * np.uint64(8)
    return np.where(keep == 64, got, got & ((np.uint64(1) << (keep & np.uint64(63))) - np.uint64(1)))


class Vocabulary:
    """The terms of a block of items, and the items of each term."""

    def __init__(self, item_ids: np.ndarray, hashes: np.ndarray, terms: list[bytes]):
        """Of parallel arrays, a row for each term of each item."""
        order = sorted(range(len(terms)), key=lambda i: (hashes[i], terms[i]))
        held = [terms[i] for i in order]
        new = np.array([i == 0 or a != held[i - 1] for i, a in enumerate(held)], bool)
        at = np.flatnonzero(new)
        self.hash = np.array([hashes[i] for i in order], np.uint64)[at]
        self.size = np.array([len(held[i]) for i in at], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(held[i] for i in at) + bytes(8), np.uint8)
        self.items, places = np.unique(item_ids[order], return_inverse=True)
        self.places = places.astype(np.int64)  # of the items of each term, term by term
        self.bounds = np.append(at, len(held))
        self.run = int(np.unique(self.hash, return_counts=True)[1].max(initial=0))  # terms of one hash

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """Words of the slice that are terms, and which."""
        data = np.append(_LOWER[w.data], np.zeros(8, np.uint8))
        first = np.searchsorted(self.hash, w.hash)
        words, terms = [], []
        for more in range(self.run):
            term = np.minimum(first + more, len(self.hash) - 1)
            at = np.flatnonzero((first + more < len(self.hash)) & (self.hash[term] == w.hash) & (self.size[term] == w.end - w.start))
            term = term[at]
            start, size = w.start[at], self.size[term]
            same = np.ones(len(at), bool)
            for k in range(0, min(_SHORT, int(size.max(initial=0))), 8):
                on = np.flatnonzero(size > k)
                same[on] &= _eights(data, start[on] + k, size[on] - k) == _eights(self.data, self.start[term[on]] + k, size[on] - k)
            for i in np.flatnonzero(same & (size > _SHORT)):
                s = self.start[term[i]]
                same[i] = np.array_equal(data[start[i] : start[i] + size[i]], self.data[s : s + size[i]])
            words.append(at[same])
            terms.append(term[same])
        return np.concatenate(words), np.concatenate(terms)

    def postings(self, w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, term and occurrences, of each term in each row of the slice."""
        words, terms = self.find(w)
        rows = np.searchsorted(w.rows, words, "right") - 1
        key, count = np.unique(rows * len(self.hash) + terms, return_counts=True)
        return key // len(self.hash), key % len(self.hash), count


class Counts(NamedTuple):
    documents: int
    terms: int
    weights: np.ndarray  # of the vocabulary's terms


def impacts(counts: Counts, term: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What each term of a document of ``n`` terms adds to a score."""
    large = 90 * int(n.max(initial=0)) * counts.documents > _LAST
    m = 10 + ((90 * n.astype(object) * counts.documents) // counts.terms).astype(np.int64) if large else 10 + (90 * n * counts.documents) // counts.terms
    return counts.weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def accumulate(v: Vocabulary, row: np.ndarray, term: np.ndarray, impact: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Item, row and score of each pair that shares a term with an impact."""
    row, term, impact = (x[impact > 0] for x in (row, term, impact))
    size = v.bounds[term + 1] - v.bounds[term]
    if not size.sum():
        return (np.zeros(0, np.int64),) * 3
    each = np.repeat(np.arange(len(term)), size)
    place = v.places[v.bounds[term][each] + np.arange(len(each)) - np.repeat(np.cumsum(size) - size, size)]
    keys = (place * n_rows + row[each]).astype(np.uint64)
    order = radix_order(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    got = keys[first].astype(np.int64)
    return got // n_rows, got % n_rows, np.add.reduceat(impact[each][order], first)


class Best:
    """The k best of each item so far; a full item's k-th score keeps lesser ones out."""

    def __init__(self, items: int, k: int):
        self.k, self.kth = k, np.full(items, -1)
        none = np.zeros(0, np.int64)
        self.item, self.doc, self.score, self.null = none, none, none, none

    def add(self, item: np.ndarray, doc: np.ndarray, score: np.ndarray, null: np.ndarray) -> None:
        on = score >= self.kth[item]
        if not on.any():
            return
        item, doc, score, null = (np.concatenate([a, b[on]]) for a, b in ((self.item, item), (self.doc, doc), (self.score, score), (self.null, null)))
        order = np.lexsort([doc, null, -score, item])
        item = item[order]
        first = np.searchsorted(item, item)
        keep = np.arange(len(item)) - first < self.k
        order = order[keep]
        self.item, self.doc, self.score, self.null = item[keep], doc[order], score[order], null[order]
        full = np.flatnonzero(np.bincount(self.item, minlength=len(self.kth)) == self.k)
        self.kth[full] = self.score[np.searchsorted(self.item, full, "right") - 1]


def _terms(source: Batches) -> Batches:
    for batch in source:
        for first, w in each_slice(batch["text"], marks=True):
            data = _LOWER[w.data].tobytes()
            rows = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
            terms = [data[a:b] for a, b in zip(w.start, w.end, strict=True)]
            yield pa.RecordBatch.from_arrays([batch["item_id"].take(pa.array(first + rows)), pa.array(w.hash.view(np.int64)), pa.array(terms, pa.binary())], ["item_id", "hash", "term"])


def _count(held):
    """``term, df`` of a task's documents; term -1: how many have terms; -2: all their terms."""

    def run(source: Batches) -> Batches:
        v: Vocabulary = held.value
        df, docs, total = np.zeros(len(v.hash), np.int64), 0, 0
        for batch in source:
            for _, w in each_slice(batch["text"], marks=True):
                df += np.bincount(v.postings(w)[1], minlength=len(df))
                size = np.diff(w.rows)
                docs, total = docs + int((size > 0).sum()), total + int(size.sum())
        at = np.flatnonzero(df)
        if docs:
            yield pa.RecordBatch.from_pydict({"term": pa.array(np.append(at, [-1, -2])), "df": pa.array(np.append(df[at], [docs, total]))})

    return run


def _score(held, counts, k: int):
    def run(source: Batches) -> Batches:
        v: Vocabulary = held.value
        best = Best(len(v.items), k)
        for batch in source:
            ids = batch["doc_id"]
            null, doc = ids.is_null().to_numpy(zero_copy_only=False).astype(np.int64), ids.fill_null(_LAST).to_numpy()
            for first, w in each_slice(batch["text"], marks=True):
                row, term, tf = v.postings(w)
                impact = impacts(counts.value, term, tf, np.diff(w.rows)[row])
                item, row, score = accumulate(v, row, term, impact, len(w.rows) - 1)
                best.add(item, doc[first + row], score, null[first + row])
        yield pa.RecordBatch.from_arrays([pa.array(v.items[best.item]), pa.array(best.doc, mask=best.null == 1), pa.array(best.score)], ["item_id", "doc_id", "score"])

    return run


def _vocabulary(terms: DataFrame) -> Vocabulary:
    got = terms.toArrow()
    return Vocabulary(got["item_id"].to_numpy(), got["hash"].to_numpy().view(np.uint64), got["term"].to_pylist())


def _counts(docs: DataFrame, held, size: int) -> Counts:
    sums = docs.select("text").mapInArrow(_count(held), "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    df = {r["term"]: r["df"] for r in sums.collect()}
    n = df.get(-1, 0)
    return Counts(n, df.get(-2, 0), np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * df.get(t, 0) + 1))) for t in range(size)], np.int64))


def rank(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    items = items.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("long"), "text")
    terms = materialise(items.mapInArrow(_terms, TERMS).distinct(), "item-terms")
    size = terms.agg(F.sum(F.octet_length("term") + 24)).first()[0] or 0
    blocks = -(-size // block_bytes)
    found = spark.createDataFrame([], HITS)
    for b in range(blocks):
        v = _vocabulary(terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b))
        if not len(v.hash):
            continue
        held = spark.sparkContext.broadcast(v)
        counts = spark.sparkContext.broadcast(_counts(docs, held, len(v.hash)))
        found = found.unionByName(docs.mapInArrow(_score(held, counts, k), HITS))
    order = W.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    # stored first, as range bounds are sampled
    return materialise(found, "item-hits").repartitionByRange("item_id").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def op13_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT rid, doc_id, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
tf AS (SELECT rid, term, count(*)::BIGINT AS tf FROM (SELECT rid, unnest(terms) AS term FROM d) WHERE term IN (SELECT term FROM q) GROUP BY rid, term),
weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, corpus GROUP BY term, docs),
impact AS (SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // total)))) AS impact
  FROM tf JOIN sizes USING (rid) JOIN weights USING (term), corpus),
scored AS (SELECT item_id, rid, doc_id, sum(impact)::BIGINT AS score FROM q JOIN impact USING (term) GROUP BY item_id, rid, doc_id HAVING sum(impact) > 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scored)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
