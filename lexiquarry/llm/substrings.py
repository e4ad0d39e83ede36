"""Substring dedup by content-defined chunks.

A gear rolling hash runs over the bytes of a text; where its mask bits are zero a chunk ends. The hash
looks back ``GEAR_BYTES`` bytes only and no chunk is made longer or shorter than it says, so inside a repeated
passage the ends are the same wherever the passage stands, from its first ``GEAR_BYTES`` bytes on.
Single chunks of a few words meet by chance, so what is compared is a unit: two neighbouring long chunks
with all bytes between them, or a chunk that holds ``MIN_WORDS`` words by itself.

1. Each document gives its distinct unit digests; per digest, the documents are counted and the least
   doc_id is found (sums and minima combine before the shuffle, so a common unit is no hot key).
2. Digests of two documents or more meet the documents' digests again; a document learns which of its
   units an earlier document (a lesser doc_id) holds. A bit array, 32 bits for each of those digests but
   32 MB at most, keeps others out of that join; what it lets through by chance the join drops. Up to some 10
   million shared digests it lets 3 % through, at 130 million 40 %; far beyond, the join sees all digests again.
3. In each text, runs of such units, or of units that the text itself held before, are cut if they
   hold ``MIN_WORDS`` whole words or more; units that overlap are one run. Every byte that goes, short
   chunks too, has thus stood between the same long chunks before. Only whole words go; what they leave is joined by a space.

The first document with a passage keeps it. Defined cases: null texts stay null, empty ones empty;
repeated rows of one doc_id count as one document and are cut alike; a null doc_id comes after all
others; an empty table gives no rows; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import BitArray, bit_array, fresh, materialise, table
from ._words import _SPACE, SLICE_BYTES, _P, _P_INV, _power, mix, slices, utf8

GEAR_BYTES = 8
#: A chunk ends where these bits of the hash are zero: one byte in 16. Each depends on 5 to 8 bytes.
MASK = np.uint32(0b1111 << 4)
#: Shorter chunks are common words more often than passages: no unit starts or ends with them.
LEAST_BYTES = 12
#: Whole words of a run that is cut. Chunk ends lie inside a passage, which costs it 9 words of 51 on average.
MIN_WORDS = 24

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_LAST = (1 << 63) - 1
#: Bits of the array that keeps digests of one document out of the join, at most: 32 MB.
FILTER_BITS = 28
ROWS = "doc_id long, digest long"

Batches = Iterator[pa.RecordBatch]


def gear(data: np.ndarray) -> np.ndarray:
    """At every byte, the gear hash of it and the ``GEAR_BYTES - 1`` bytes before."""
    h = _GEAR[data]
    step = 1
    while step < GEAR_BYTES:
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h, step = more, 2 * step
    return h


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each chunk of a slice, and one past the last. Row bounds are chunk bounds."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(n + 1, bool)
    cut[1:] = (gear(data) & MASK) == 0
    cut[offsets] = True
    bounds = np.flatnonzero(cut)
    return bounds[:-1], bounds[1:]


def _digests(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(_P, n), out=sums[1:])
    return mix((sums[end] - sums[start]) * _power(_P_INV, n)[start] + (end - start).astype(np.uint64))


def chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks of a slice: first byte, one past the last, digest."""
    start, end = _bounds(data, offsets)
    return start, end, _digests(data, start, end)


def units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of a slice, by first byte: first byte, one past the last, digest. None goes across rows."""
    start, end = _bounds(data, offsets)
    long = end - start >= LEAST_BYTES
    start, end = start[long], end[long]
    row = np.searchsorted(offsets, start, "right")
    pair = np.flatnonzero(row[:-1] == row[1:])
    # words that begin in a chunk; the few bytes that can hold enough come first
    alone = np.flatnonzero(end - start >= 2 * MIN_WORDS - 1)
    if len(alone):
        solid = ~_SPACE[data]
        begins = solid.copy()
        begins[1:] &= ~solid[:-1]
        edge = offsets[offsets < len(data)]
        begins[edge] = solid[edge]
        count = np.cumsum(begins, dtype=np.int32)
        alone = alone[count[end[alone] - 1] - count[start[alone]] + begins[start[alone]] >= MIN_WORDS]
    first, last = np.concatenate([start[pair], start[alone]]), np.concatenate([end[pair + 1], end[alone]])
    if len(alone):
        order = np.argsort(first, kind="stable")
        first, last = first[order], last[order]
    return first, last, _digests(data, first, last)


def _slices(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    data, offsets = utf8(column)
    for a, b in slices(offsets, SLICE_BYTES):
        yield a, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def _digest_rows(source: Batches, held: BitArray | None = None) -> Batches:
    """Distinct ``doc_id, digest``; with ``held``, of digests whose bit is set."""
    for batch in source:
        ids = batch["doc_id"].to_numpy(zero_copy_only=False)
        for first, data, offsets in _slices(batch["text"]):
            start, _, digest = units(data, offsets)
            rows = np.searchsorted(start, offsets)
            if held is not None:
                on = held.has(digest)
                rows, digest = np.concatenate([[0], np.cumsum(on)])[rows], digest[on]
            own = [np.unique(digest[a:b]) for a, b in zip(rows[:-1], rows[1:], strict=True)]
            size = np.fromiter(map(len, own), np.int64, len(own))
            yield pa.RecordBatch.from_pydict({"doc_id": np.repeat(ids[first : first + len(own)], size), "digest": np.concatenate([*own, np.zeros(0, np.uint64)]).view(np.int64)})


def repeated_units(docs: DataFrame) -> DataFrame:
    """``doc_id, digests``: of each document, the units that a document of lesser doc_id holds."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), "text")
    rows = docs.mapInArrow(_digest_rows, ROWS)
    shared = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    shared = materialise(shared.select("digest", "first"), "shared-units")
    held = bit_array(shared, "digest", FILTER_BITS, 32)
    again = docs.mapInArrow(lambda source: _digest_rows(source, held), ROWS)
    later = again.join(shared, "digest").where("doc_id > first")
    return later.groupBy("doc_id").agg(F.collect_set("digest").alias("digests"))


def cut_spans(text: bytes, known: np.ndarray, min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Byte spans to cut: ``known`` holds the sorted digests of units that earlier documents hold."""
    data = np.frombuffer(text, np.uint8)
    start, end, digest = units(data, np.array([0, len(data)]))
    if not len(start):
        return []
    _, first = np.unique(digest, return_index=True)
    again = np.ones(len(digest), bool)
    again[first] = False
    if len(known):
        again |= known[np.minimum(np.searchsorted(known, digest), len(known) - 1)] == digest
    start, end = start[again], end[again]
    if not len(start):
        return []
    # units that overlap are one run
    reach = np.maximum.accumulate(end)
    fresh = np.flatnonzero(np.concatenate([[True], start[1:] >= reach[:-1]]))
    space = _SPACE[data]
    spans = []
    for a, b in zip(start[fresh], reach[np.append(fresh[1:], len(start)) - 1], strict=True):
        # shrink to whole words
        if a and not space[a - 1]:
            gap = np.flatnonzero(space[a:b])
            a = a + gap[0] if len(gap) else b
        if b < len(data) and not space[b]:
            gap = np.flatnonzero(space[a:b])
            b = a + gap[-1] if len(gap) else a
        solid = ~space[a:b]
        if len(solid) and int(np.count_nonzero(solid[1:] & ~solid[:-1])) + int(solid[0]) >= min_words:
            spans.append((int(a), int(b)))
    return spans


def without(text: bytes, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, a space in place of each that stood between words."""
    kept, at = [], 0
    for a, b in [*spans, (len(text), len(text))]:
        kept.append(text[at:a].decode())
        at = b
    out = kept[0]
    for piece in kept[1:]:
        joint = " " if out and piece and not out[-1].isspace() and not piece[0].isspace() else ""
        out += joint + piece
    return out


def _cut(source: Batches, text_at: int, digests_at: int) -> Batches:
    """Batches with the cut text in place and, for the digests, the spans and the count of bytes."""
    none = np.zeros(0, np.uint64)
    for whole in source:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            texts, spans, cut = [], [], []
            lists = batch.column(digests_at)
            for k, text in enumerate(batch.column(text_at)):
                raw = (text.as_py() or "").encode()
                known = np.sort(lists[k].values.to_numpy(zero_copy_only=False).view(np.uint64)) if lists[k].is_valid else none
                found = cut_spans(raw, known)
                texts.append(without(raw, found) if found else text.as_py())
                spans.append([x for span in found for x in span])
                cut.append(sum(b - a for a, b in found))
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, batch.column(text_at).type)
            columns[digests_at : digests_at + 1] = [pa.array(spans, pa.list_(pa.int64())), pa.array(cut, pa.int64())]
            names = [*batch.schema.names[:digests_at], "cut_spans", "cut_bytes", *batch.schema.names[digests_at + 1 :]]
            yield pa.RecordBatch.from_arrays(columns, names)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut from ``text``, and ``cut_spans`` (bounds in the old UTF-8 bytes) and ``cut_bytes``."""
    docs = docs.drop("cut_spans", "cut_bytes")
    other = fresh(docs, "__id")
    known = repeated_units(docs).select(F.col("doc_id").alias(other), F.col("digests").alias(fresh(docs, "__digests")))
    joined = docs.join(known, F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)) == F.col(other), "left").drop(other)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    text_at, digests_at = docs.columns.index("text"), len(docs.columns)
    return joined.mapInArrow(lambda source: _cut(source, text_at, digests_at), ", ".join([*fields, "cut_spans array<long>", "cut_bytes long"]))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
