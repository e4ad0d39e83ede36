"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are the buckets of its words, of pairs of neighbouring words and of pairs with one word between
(skip-grams), each present or not however often it occurs: one insult among twenty thousand words weighs as much as
in a line. A word has the value 1, a pair ``PAIR``; of features that share a bucket the first kind counts. Words are
runs of letters, digits and characters beyond ASCII, without regard to ASCII case.

Each coordinate has a learning rate of its own, and the L1 penalty leaves a weight only to what occurs with toxicity
often, some hundreds of the ``2**BITS`` buckets. Those, as two short arrays, are all that is collected and broadcast.

Training sees a bounded sample: at most ``SAMPLE`` labelled rows, those of least hash of doc_id, ``EPOCHS`` times,
streamed through the learner in one task. A toxic row's gradient counts ``TOXIC`` times, as such rows are few.
Everything else covers every row and whole texts.

Defined cases: null and empty texts have no features and score by the bias; labels that are null or belong to no
document are ignored; if a document has several labels the greatest counts; without any label all scores are 0.5;
repeated rows are scored each and, of texts that share a labelled doc_id, the least is learned from; a null doc_id is
scored and in no fold; extra columns are ignored by ``score`` and kept by ``keep_clean``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table
from ._words import Words, each_slice, mix

BITS = 20
PAIR = 0.25
SAMPLE = 15_000
EPOCHS = 2
TOXIC = 3.0
THRESHOLD = 0.5
#: Every fifth document, by crc32 of its id, is held out of training.
FOLDS = 5
#: FTRL-proximal: step, its offset, and the two penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 6.0, 0.01

Batches = Iterator[pa.RecordBatch]


def occurrences(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, bucket and value of each word, then of each pair, then of each skip-gram of the slice."""
    row = np.repeat(np.arange(len(w.rows) - 1), np.diff(w.rows))
    found, rows = [mix(w.hash * np.uint64(3))], [row]
    for gap, factor in ((1, 5), (2, 11)):
        within = row[gap:] == row[:-gap]
        found.append(mix(w.hash[:-gap] * np.uint64(factor) + w.hash[gap:] * np.uint64(factor + 2))[within])
        rows.append(row[gap:][within])
    value = np.repeat([1.0, PAIR], [len(row), len(rows[1]) + len(rows[2])])
    return np.concatenate(rows), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64), value


def present(rows: np.ndarray, buckets: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same without repeats in a row, sorted by row; the first value counts."""
    key, first = np.unique((rows << BITS) | buckets, return_index=True)
    return key >> BITS, key & ((1 << BITS) - 1), value[first]


class Ftrl:
    """The learner; the last weight is the bias."""

    def __init__(self):
        self.z, self.n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) > L1, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2), 0.0)

    def learn(self, buckets: np.ndarray, value: np.ndarray, label: int) -> None:
        at, x = np.append(buckets, len(self.z) - 1), np.append(value, 1.0)
        w, before = self.weights(at), self.n[at]
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x * (TOXIC if label else 1.0)
        self.z[at] += g - (np.sqrt(before + g * g) - np.sqrt(before)) / ALPHA * w
        self.n[at] = before + g * g


def _fit(source: Batches) -> Batches:
    model = Ftrl()
    for batch in source:
        labels = batch["label"].to_pylist()
        for first, w in each_slice(batch["text"], marks=True):
            rows, buckets, value = present(*occurrences(w))
            cuts = np.searchsorted(rows, np.arange(len(w.rows)))
            for r, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                model.learn(buckets[a:z], value[a:z], labels[first + r])
    w = model.weights()
    held = np.flatnonzero(w[:-1]).astype("<i4")
    yield pa.RecordBatch.from_pydict({"buckets": [held.tobytes()], "weights": [w[held].astype("<f4").tobytes()], "bias": [float(w[-1])]})


class Model:
    """Sparse weights; a worker spreads them over all buckets when it first scores."""

    def __init__(self, buckets: np.ndarray, weights: np.ndarray, bias: float):
        self.buckets, self.weights, self.bias = buckets, weights, bias

    def scores(self, texts: pa.Array) -> np.ndarray:
        wide = np.zeros(1 << BITS, np.float32)
        wide[self.buckets] = self.weights
        out = np.full(len(texts), self.bias)
        for first, w in each_slice(texts, marks=True):
            rows, buckets, value = occurrences(w)
            held = np.flatnonzero(wide[buckets])
            rows, buckets, value = present(rows[held], buckets[held], value[held])
            out[first : first + len(w.rows) - 1] += np.bincount(rows, wide[buckets] * value, len(w.rows) - 1)
        return 1 / (1 + np.exp(-np.clip(out, -35, 35)))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", sample: int = SAMPLE, epochs: int = EPOCHS) -> Model:
    """The weights that at most ``sample`` labelled rows outside the held-out fold teach."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % FOLDS != 0)
    known = known.groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    known = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    rows = rows.repartition(1).sortWithinPartitions("epoch", F.xxhash64("doc_id", "epoch"))
    got = rows.select("text", "label").mapInArrow(_fit, "buckets binary, weights binary, bias double").first()
    if got is None:
        return Model(np.zeros(0, np.int32), np.zeros(0, np.float32), 0.0)
    return Model(np.frombuffer(got["buckets"], "<i4"), np.frombuffer(got["weights"], "<f4"), got["bias"])


def _with_scores(docs: DataFrame, model: Model, schema, give: Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]) -> DataFrame:
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(source: Batches) -> Batches:
        for batch in source:
            yield give(batch, held.value.scores(batch["text"]))

    return docs.mapInArrow(run, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of every row."""
    give = lambda batch, scores: pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(scores)], ["doc_id", "score"])
    return _with_scores(docs.select(F.col("doc_id").cast("long"), "text"), model, "doc_id long, score double", give)


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, with all their columns."""
    return _with_scores(docs, model, docs.schema, lambda batch, scores: batch.filter(pa.array(scores < threshold)))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
