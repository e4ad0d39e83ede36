"""Benchmark decontamination: rare n-gram seeds join training passages to test items, Smith-Waterman alignment scores them.

1. The items' ``N``-word sequences form a table. One pass over the documents stores where they hold any of them,
   and counts of each the documents that do (counts combine before the shuffle).
2. Seeds are the rare sequences of an item, held by ``RARE`` documents at most, and of every ``WINDOW``
   consecutive sequences the rarest that any document holds. So every unbroken run of ``N + WINDOW - 1``
   copied words has a seed, however common the passage is, and every shorter one of ``N`` words on that is rare.
3. What is stored is joined to the seeds. Hits are grouped by document, item, band of diagonals (place in the text
   less place in the item) and stretch of the item, so a phrase that both repeat makes few of them.
4. Documents with hits are read once more, and the words about each group of hits on near diagonals are aligned
   with the item's by Smith-Waterman (match 2, mismatch and gap -1) in a band: ``SLACK`` diagonals on either
   side (fewer for short items), from ``MARGIN`` words before the first seed to as many after the last.
   A score is the share of the item's own best score, ``2 * words``; from ``THRESHOLD`` on, or from
   ``PASSAGE`` on in points of the alignment, so that a part of a long item counts too, the document
   leaks the item.
5. Items of fewer than ``N`` words leak where all their words stand in a row.

Two passes, however large the benchmark is. What is broadcast has a bound: an array of ``2**FILTER_BITS``
bits at most, which keeps other sequences out of the joins (what it lets through the joins drop), and tables
whose size was measured. Words are runs of letters and digits in lower case (A-Z), so changed punctuation
does not hide a copy.

Defined cases: null or empty texts and items match nothing; an item of one word leaks
to each document that holds the word; repeated items are reported each; repeated documents are judged
each; an empty benchmark flags nothing; very long items take time in proportion to their length; extra columns
stay in ``drop_leaks`` and are ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._shared import bit_array, fresh, materialise, small, table
from ._words import Words, each_slice, grams

N = 4
WINDOW = 3
#: Documents that hold a rare sequence at most.
RARE = 64
THRESHOLD = 0.45
#: Points of an alignment that are a leak whatever the item's length: 13 copied words.
PASSAGE = 2 * 13
#: Diagonals on either side of a seed's, and words before the first and after the last seed, that an alignment may take in.
SLACK = MARGIN = 64
#: Bits of the array of sequences at most: 8 MB.
FILTER_BITS = 26

LEAKS = "doc_id long, item_id long, score double, first_word int, last_word int"
_PLACES = "uid long, doc_id long, row_key long, item long, base int, first int, last int, low int, high int, words binary"
_SCORED = "uid long, doc_id long, row_key long, item long, points int, score double, first_word int, last_word int"

Batches = Iterator[pa.RecordBatch]


def _own_grams(w: Words, n: int = N) -> tuple[np.ndarray, np.ndarray]:
    """The slice's sequences and the row of each; those across rows are cut out by a row of -1."""
    g = grams(w.hash, n)
    row = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
    inside = row[: len(g)] == row[n - 1 :] if len(g) else np.zeros(0, bool)
    return g, np.where(inside, row[: len(g)], -1)


def read_items(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, n, words``: a number for each row with words, their count and hashes."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for first, w in each_slice(batch["text"], marks=True):
                own = [w.hash[a:b] for a, b in zip(w.rows[:-1], w.rows[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch["item_id"].slice(first, len(own)), pa.array([len(x) for x in own], pa.int32()), pa.array([x.tobytes() for x in own], pa.binary())], ["item_id", "n", "words"])

    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "item_id long, n int, words binary").where("n > 0")
    # numbers are drawn once, as the table is written
    return materialise(items.select(F.monotonically_increasing_id().alias("item"), "item_id", "n", "words"), "items")


def item_grams(items: DataFrame) -> DataFrame:
    """``gram, item, n, place`` of every sequence of every item; a short item is one sequence."""

    def run(source: Batches) -> Batches:
        for batch in source:
            for item, n, words in zip(batch["item"].to_pylist(), batch["n"].to_pylist(), batch["words"], strict=True):
                g = grams(np.frombuffer(words.as_buffer(), np.uint64), min(n, N))
                yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(np.full(len(g), item)), pa.array(np.full(len(g), n, np.int32)), pa.array(np.arange(len(g), dtype=np.int32))], ["gram", "item", "n", "place"])

    return items.mapInArrow(run, "gram long, item long, n int, place int")


def _lengths(items: DataFrame) -> list[int]:
    """The lengths of sequences that the items hold: ``N`` at most."""
    return sorted(r[0] for r in items.select(F.least("n", F.lit(N))).distinct().collect())


def held_sequences(docs: DataFrame, sequences: DataFrame, lengths: list[int]) -> DataFrame:
    """``row_key, gram, at, new``: where documents hold the sequences (and a few others); ``new`` is 1 at a row's first of each."""
    held = bit_array(sequences, "gram", FILTER_BITS)

    def run(source: Batches) -> Batches:
        for batch in source:
            keys = batch["row_key"].to_numpy(zero_copy_only=False)
            for first, w in each_slice(batch["text"], marks=True):
                for n in lengths:
                    g, row = _own_grams(w, n)
                    at = np.flatnonzero(held.has(g) & (row >= 0))
                    g, row = g[at], row[at]
                    new = np.zeros(len(at), np.int32)
                    new[np.unique(np.stack([g, row.astype(np.uint64)], axis=1), axis=0, return_index=True)[1]] = 1
                    yield pa.RecordBatch.from_arrays([pa.array(keys[first + row]), pa.array(g.view(np.int64)), pa.array((at - w.rows[row]).astype(np.int32)), pa.array(new)], ["row_key", "gram", "at", "new"])

    return materialise(docs.select("row_key", "text").mapInArrow(run, "row_key long, gram long, at int, new int"), "held-sequences")


def document_frequencies(found: DataFrame, sequences: DataFrame) -> DataFrame:
    """``gram, df``: the documents (rows) that hold each of the sequences, where any does."""
    return found.groupBy("gram").agg(F.sum("new").alias("df")).join(sequences, "gram", "left_semi")


def choose_seeds(sequences: DataFrame, frequencies: DataFrame) -> DataFrame:
    """``gram, item, n, place``: the rare sequences and the rarest of every window; those in no document are no seeds."""
    known = sequences.join(frequencies, "gram", "left")
    ahead = W.partitionBy("item").orderBy("place").rangeBetween(0, WINDOW - 1)
    rank = F.when(F.col("df").isNotNull(), F.struct("df", "place", "gram"))
    windows = known.withColumn("best", F.min(rank).over(ahead))
    rarest = windows.where("best IS NOT NULL").select(F.col("best.gram").alias("gram"), "item", "n", F.col("best.place").alias("place"))
    return rarest.unionByName(known.where(F.col("df") <= RARE).select("gram", "item", "n", "place")).distinct()


def align(item: np.ndarray, text: np.ndarray, low: int, high: int) -> tuple[int, int, int]:
    """Points of the best local alignment of two word sequences, and the text's bounds.

    Only cells whose place in the text less that in the item is from ``low`` to ``high`` count.
    """
    k = np.arange(high - low + 2)  # the last is a wall
    padded = np.zeros(len(item) + len(k) + 1, text.dtype)
    inside = np.zeros(len(padded), bool)
    a, b = max(0, low), min(len(text), low + len(padded))
    if a < b:
        padded[a - low : b - low], inside[a - low : b - low] = text[a:b], True
    above, begin = np.zeros(len(k), np.int64), low - 1 + k + 1
    best = (0, 0, 0)
    for i, word in enumerate(item):
        j = low + i + k
        diagonal = above + np.where((padded[i : i + len(k)] == word) & inside[i : i + len(k)], 2, -1)
        now = np.maximum(diagonal, 0)
        start = np.where(diagonal > 0, begin, j + 1)
        down = above[1:] - 1 > now[:-1]
        now[:-1][down], start[:-1][down] = above[1:][down] - 1, begin[1:][down]
        now[-1] = 0
        # a gap in the item: the best of what stands to the left, less one for each step
        reach = np.maximum.accumulate(now + k)
        came = np.maximum.accumulate(np.where(now + k == reach, k, 0))
        across = reach - k > now
        now[across], start[across] = (reach - k)[across], start[came[across]]
        now[-1] = 0
        top = int(np.argmax(now))
        if now[top] > best[0]:
            best = (int(now[top]), int(start[top]), int(j[top]) + 1)
        above, begin = now, start
    return best


def slack_of(n: Column) -> Column:
    return F.least(F.floor(n / 2) + 4, F.lit(SLACK))


def _places(source: Batches) -> Batches:
    """Of documents with the seeds' ``hits`` (item, its length, band, least and greatest diagonal, first and last place), the words to align with each item.

    Hits of a band go together where their margins meet. ``base`` is the place of
    the first word, ``first, last`` are the bounds in the item.
    """
    for whole in source:
        for at in range(0, whole.num_rows, 200):
            batch = whole.slice(at, 200)
            ids, uids, keys, hits = batch["doc_id"].to_pylist(), batch["uid"].to_pylist(), batch["row_key"].to_pylist(), batch["hits"]
            for first_row, w in each_slice(batch["text"], marks=True):
                out: list[tuple] = []
                for r in range(len(w.rows) - 1):
                    row = first_row + r
                    words = w.hash[w.rows[r] : w.rows[r + 1]]
                    own = {c: v.to_numpy(zero_copy_only=False) for c, v in zip(("item", "n", "band", "low", "high", "first", "last"), hits[row].values.flatten(), strict=True)}
                    order = np.lexsort((own["first"], own["band"], own["item"]))
                    item, n, band, least, most, lo, hi = (x[order] for x in own.values())
                    slack = np.minimum(n // 2 + 4, SLACK)
                    new = np.ones(len(item), bool)
                    new[1:] = (item[1:] != item[:-1]) | (band[1:] != band[:-1]) | (lo[1:] - hi[:-1] > 2 * MARGIN)
                    begin = np.flatnonzero(new)
                    lo, hi = np.minimum.reduceat(lo, begin), np.maximum.reduceat(hi, begin)
                    low, high = np.minimum.reduceat(least, begin) - slack[begin], np.maximum.reduceat(most, begin) + slack[begin]
                    item, n = item[begin], n[begin]
                    i0, i1 = np.maximum(0, lo - MARGIN), np.minimum(n, hi + N + MARGIN)
                    t0, t1 = np.clip(low + i0, 0, len(words)), np.clip(high + i1, 0, len(words))
                    out += [(uids[row], ids[row], keys[row], *map(int, x[:-1]), words[x[1] : x[-1]].tobytes()) for x in zip(item, t0, i0, i1, low, high, t1, strict=True)]
                kinds = [pa.int64()] * 4 + [pa.int32()] * 5 + [pa.binary()]
                names = ["uid", "doc_id", "row_key", "item", "base", "first", "last", "low", "high", "words"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 10, kinds, strict=True)], names)


def _scores(threshold: float):
    """Alignments that are leaks, of rows of ``_places`` with the item's ``n`` and ``item_words``."""

    def run(source: Batches) -> Batches:
        for batch in source:
            out = []
            for r in zip(*(batch[c].to_pylist() for c in ("uid", "doc_id", "row_key", "item", "base", "first", "last", "low", "high", "n")), batch["item_words"], batch["words"], strict=True):
                uid, doc_id, row_key, item, base, first, last, low, high, n = r[:10]
                words, text = np.frombuffer(r[10].as_buffer(), np.uint64)[first:last], np.frombuffer(r[11].as_buffer(), np.uint64)
                least = min(math.ceil(threshold * 2 * n), PASSAGE)
                if 2 * int(np.isin(words, text).sum()) < least:
                    continue  # so few of its words are here that no alignment is a leak
                points, a, b = align(words, text, low + first - base, high + first - base)
                if points >= least and (points >= PASSAGE or points >= threshold * 2 * n):
                    out.append((uid, doc_id, row_key, item, points, points / (2 * n), base + a, base + b - 1))
            kinds = [pa.int64()] * 4 + [pa.int32(), pa.float64(), pa.int32(), pa.int32()]
            names = ["uid", "doc_id", "row_key", "item", "points", "score", "first_word", "last_word"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 8, kinds, strict=True)], names)

    return run


def _row_key() -> list:
    return [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("row_key")]


def _leaks(docs: DataFrame, benchmark: DataFrame, threshold: float) -> DataFrame:
    """``uid, doc_id, row_key, item_id, score, first_word, last_word`` of every leak; rows of equal doc_id and text share their key."""
    items = read_items(benchmark)
    lengths = _lengths(items)
    docs = docs.select(*_row_key())
    sequences = materialise(item_grams(items), "item-grams")
    found = held_sequences(docs, sequences.select("gram").distinct(), lengths)
    seeds = materialise(choose_seeds(sequences, document_frequencies(found, sequences.select("gram").distinct())), "seeds")
    found = found.join(small(seeds), "gram").withColumn("diagonal", F.col("at") - F.col("place"))
    # hits of a band of diagonals whose margins meet are aligned together, so those of one stretch of places are one already here
    band, part = F.floor(F.col("diagonal") / (2 * slack_of(F.col("n")))), F.floor(F.col("place") / (2 * MARGIN))
    ends = [F.min("diagonal").alias("low"), F.max("diagonal").alias("high"), F.min("place").alias("first"), F.max("place").alias("last")]
    found = found.groupBy("row_key", "item", "n", band.alias("band"), part.alias("part")).agg(*ends)
    hits = found.groupBy("row_key").agg(F.collect_list(F.struct("item", "n", "band", "low", "high", "first", "last")).alias("hits"))
    hits = materialise(hits, "hits")
    read = docs.withColumn("uid", F.monotonically_increasing_id()).join(small(hits, 48 * F.size("hits")), "row_key")
    places = read.select("uid", "doc_id", "row_key", "text", "hits").mapInArrow(_places, _PLACES)
    both = places.join(small(items.select("item", "n", F.col("words").alias("item_words")), F.octet_length("item_words")), "item")
    scored = both.mapInArrow(_scores(threshold), _SCORED)
    best = F.max_by(F.struct("score", "first_word", "last_word"), F.struct("points", -F.col("first_word"))).alias("best")
    best_of = scored.groupBy("uid", "doc_id", "row_key", "item").agg(best)
    return best_of.join(small(items.select("item", "item_id")), "item").select("uid", "doc_id", "row_key", "item_id", "best.*")


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, item_id, score, first_word, last_word`` of every leak, an item once for each document."""
    return _leaks(docs, benchmark, threshold).drop("uid", "row_key")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that leak an item, with all their columns."""
    row, leaked = fresh(docs, "__row"), fresh(docs, "__leaked")
    found = materialise(_leaks(docs, benchmark, threshold).select(F.col("row_key").alias(leaked)).distinct(), "leaked")
    kept = docs.withColumn(row, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return kept.join(small(found), F.col(row) == F.col(leaked), "left_anti").drop(row)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
