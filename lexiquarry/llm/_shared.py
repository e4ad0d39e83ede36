"""Tables and files in the folder that the driver and all executors share, and what may be broadcast."""

from __future__ import annotations

import math
import tempfile
import uuid
from functools import cached_property

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a stored table that may be broadcast.
SMALL_BYTES = 16 << 20


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder's URI under ``spark.checkpoint.dir``.

    Where that is unset, a session of local threads, as in tests, uses a temporary folder; others fail, as their
    executors don't share one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.lexiquarry.shared", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='lexiquarry-')}"
        spark.conf.set("spark.lexiquarry.shared", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: cuts its lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores after it as long as ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def small(stored: DataFrame, *more: Column) -> DataFrame:
    """A stored table with a hint to broadcast it, if it is measured to be small; else Spark joins as it sees fit.

    ``more``: the bytes of columns that are not numbers.
    """
    size = stored.agg(F.sum(sum(more, F.lit(8 * len(stored.columns))).cast("long"))).first()[0] or 0
    return F.broadcast(stored) if size <= SMALL_BYTES else stored


class BitArray:
    """A broadcast set of 64-bit hashes: all that were added are in it, and some others."""

    def __init__(self, held: Broadcast, bits: int):
        self.held, self.bits = held, bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        low = hashes & np.uint64((1 << self.bits) - 1)
        return (self._words[(low >> np.uint64(6)).astype(np.int64)] >> (low & np.uint64(63))) & np.uint64(1) == 1

    @cached_property
    def _words(self) -> np.ndarray:
        return self.held.value

    def __getstate__(self):
        return {"held": self.held, "bits": self.bits}


def bit_array(hashes: DataFrame, column: str, most: int, each: int = 256) -> BitArray:
    """Of a column of 64-bit hashes, with ``each`` bits for each row but ``2**most`` at most; 1/64 as many rows come to the driver."""
    bits = max(10, min(most, math.ceil(math.log2(each * max(1, hashes.count())))))
    low = F.col(column).bitwiseAND((1 << bits) - 1)
    got = hashes.groupBy(F.shiftright(low, 6).alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, CAST({column} & 63 AS int)))").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return BitArray(hashes.sparkSession.sparkContext.broadcast(words), bits)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` words; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
