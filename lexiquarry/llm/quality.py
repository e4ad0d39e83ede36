"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

Features of a text are its words, pairs of words, word shapes (which kinds of characters a word
holds) and pairs of shapes (with whether both words are the same), hashed to ``2**BITS`` buckets. A
text's vector holds each bucket's share of its features, times ``SCALE``; a score is one sparse dot
product through the logistic function.

Training sees a bounded sample: at most ``SAMPLE`` labelled rows, those of least hash of doc_id,
``EPOCHS`` times, in one task that streams them. Only the weights (one float for each bucket) come back
to the driver. Everything else, scoring above all, covers every row and whole texts.

Defined cases: null and empty texts have no features and score by the bias; labels that are null
or belong to no document are ignored; if a document has several labels the least counts; without
any label all scores are 0.5; repeated rows are scored each and, of texts that share a labelled doc_id, the
least is learned from; extra columns stay.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table
from ._words import Words, each_slice, mix

BITS = 18
SCALE = 12.0
SAMPLE = 6000
EPOCHS = 3
THRESHOLD = 0.3
#: Every fifth document, by crc32 of its id, is held out of training.
FOLDS = 5
#: FTRL-proximal: step, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.01, 0.01

_KIND = np.zeros(256, np.uint8)  # lower, upper, digit, beyond ASCII, and four groups of marks
for _bit, _chars in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "", ".,;:'\"-()", "!?", "|/\\<>[]{}", "#$%&*+=@^_`~")):
    _KIND[[ord(c) for c in _chars]] = 1 << _bit
_KIND[128:] = 8

Batches = Iterator[pa.RecordBatch]


def features(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the slice's features, in the order of its rows, and the rows' bounds in them."""
    n = len(w.hash)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(w.rows), np.int64)
    shape = np.bitwise_or.reduceat(_KIND[w.data], np.stack([w.start, w.end], 1).ravel()[: 2 * n - (w.end[-1] == len(w.data))])[::2].astype(np.uint64)
    once = (w.end - w.start > 1).astype(np.uint64) << np.uint64(8)
    shape = shape | once | (np.uint64(1) << np.uint64(20))
    follows = np.ones(n, bool)  # the word has a word before it in its row
    follows[w.rows[:-1][np.diff(w.rows) > 0]] = False
    pair, shapes = mix(w.hash * np.uint64(3)), mix(shape)
    pair[1:] = mix(w.hash[:-1] * np.uint64(5) + w.hash[1:] * np.uint64(7))
    same = np.zeros(n, np.uint64)
    same[1:] = w.hash[:-1] == w.hash[1:]
    pairs = shapes.copy()
    pairs[1:] = mix((shape[:-1] << np.uint64(24)) + (shape[1:] << np.uint64(2)) + same[1:])
    keep = np.stack([np.ones(n, bool), follows, np.ones(n, bool), follows], 1).ravel()
    found = (np.stack([w.hash, pair, shapes, pairs], 1).ravel()[keep] >> np.uint64(64 - BITS)).astype(np.int64)
    before = np.concatenate([[0], np.cumsum(np.add.reduceat(keep, np.arange(0, 4 * n, 4)))])
    return found, before[w.rows]


class Ftrl:
    """FTRL-proximal logistic regression over hashed buckets; the last weight is the bias."""

    def __init__(self, size: int = 1 << BITS):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) > L1, w, 0.0)

    def learn(self, buckets: np.ndarray, label: int) -> None:
        at, count = np.unique(buckets, return_counts=True)
        at = np.append(at, len(self.z) - 1)
        x = np.append(count * (SCALE / max(1, len(buckets))), 1.0)
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


def _fit(source: Batches) -> Batches:
    model = Ftrl()
    for batch in source:
        labels = batch["label"].to_numpy(zero_copy_only=False)
        for first, w in each_slice(batch["text"], fold=False):
            found, rows = features(w)
            for r in range(len(rows) - 1):
                model.learn(found[rows[r] : rows[r + 1]], int(labels[first + r]))
    yield pa.RecordBatch.from_pydict({"weights": [model.weights().astype(np.float32).tobytes()]})


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE, epochs: int = EPOCHS) -> np.ndarray:
    """Weights from at most ``sample`` labelled rows outside the held-out fold."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
    known = known.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # a text for each, however often its row repeats
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    rows = rows.repartition(1).sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"))
    got = rows.select("text", "label").mapInArrow(_fit, "weights binary").collect()
    return np.frombuffer(got[0]["weights"], np.float32) if got else np.zeros((1 << BITS) + 1, np.float32)


def _scores(weights: np.ndarray, column: pa.Array) -> np.ndarray:
    out = np.zeros(len(column))
    for first, w in each_slice(column, fold=False):
        found, rows = features(w)
        sums = np.concatenate([[0.0], np.cumsum(weights[found], dtype=np.float64)])
        size = np.diff(rows)
        out[first : first + len(size)] = (sums[rows[1:]] - sums[rows[:-1]]) * (SCALE / np.maximum(1, size))
    return 1 / (1 + np.exp(-np.clip(out + weights[-1], -35, 35)))


def _with_scores(docs: DataFrame, weights: np.ndarray, schema, give: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]) -> DataFrame:
    model = docs.sparkSession.sparkContext.broadcast(weights)

    def run(source: Batches) -> Batches:
        for batch in source:
            yield give(batch, _scores(model.value, batch["text"]))

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``doc_id, score`` of every row."""
    give = lambda batch, scores: pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    return _with_scores(docs, weights, "doc_id long, score double", give)


def keep_good(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    return _with_scores(docs, weights, docs.schema, lambda batch, scores: batch.filter(pa.array(scores >= threshold)))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
