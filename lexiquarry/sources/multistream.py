"""Multistream archives as a Spark data source: partitions planned from the index, filters on ``page_id`` pushed into it.

``spark.read.format("multistream").option("index", folder).load(archive)``, after ``register(spark)``. The index is a Parquet
table ``page_id, offset`` sorted by offset (``archives.keep_index`` writes one; of all pages or of those wanted). A
partition is a stretch of the archive that holds wanted blocks; it reads its own part of the index, by the row groups'
statistics, and of the archive the blocks that the filters leave.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from .answers import filesystem
from .blocks import ARTICLES, ARTICLES_ARROW, pages_in, stream

#: Bytes of the archive that a partition covers.
SPLIT_BYTES = 64 << 20


@dataclass
class Stretch(InputPartition):
    """Blocks that start at ``start`` or later and before ``stop``."""

    start: int
    stop: int


def _condition(f: Filter) -> ds.Expression | None:
    """The filter on the index, if it is one on ``page_id`` that the index can tell."""
    if getattr(f, "attribute", None) != ("page_id",):
        return None
    column = ds.field("page_id")
    match f:
        case In():
            return column.isin([v for v in f.value if v is not None])
        case EqualTo() if f.value is not None:
            return column == f.value
        case GreaterThan() if f.value is not None:
            return column > f.value
        case GreaterThanOrEqual() if f.value is not None:
            return column >= f.value
        case LessThan() if f.value is not None:
            return column < f.value
        case LessThanOrEqual() if f.value is not None:
            return column <= f.value
        case IsNotNull():
            return column.is_valid()
    return None


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.archive, self.index = options["path"], options["index"]
        self.split, self.gap, self.read_bytes = (int(options[k]) for k in ("split", "gap", "read"))
        self.wanted: list[ds.Expression] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            condition = _condition(f)
            if condition is None:
                yield f
            else:
                self.wanted.append(condition)

    def _table(self) -> ds.Dataset:
        files, path = filesystem(self.index)
        return ds.dataset(path, filesystem=files, format="parquet")

    def _only(self, *more: ds.Expression) -> ds.Expression | None:
        out = None
        for e in (*self.wanted, *more):
            out = e if out is None else out & e
        return out

    def partitions(self) -> list[Stretch]:
        held: set[int] = set()
        for batch in self._table().to_batches(columns=["offset"], filter=self._only()):
            held.update(np.unique(batch["offset"].to_numpy() // self.split).tolist())
        return [Stretch(n * self.split, (n + 1) * self.split) for n in sorted(held)] or [Stretch(0, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        if partition.start == partition.stop:
            return
        offset = ds.field("offset")
        rows = self._table().to_table(columns=["offset", "page_id"], filter=self._only(offset >= partition.start, offset < partition.stop)).sort_by("offset")
        starts, first = np.unique(rows["offset"].to_numpy(), return_index=True)
        pages = np.split(rows["page_id"].to_numpy(), first[1:])
        files, path = filesystem(self.archive)
        with files.open_input_file(path) as opened:
            k = 0
            while k < len(starts):
                n = k  # blocks that lie near each other are read at once
                while n + 1 < len(starts) and starts[n + 1] - starts[n] <= self.gap and starts[n + 1] - starts[k] <= 4 * self.read_bytes:
                    n += 1
                at = int(starts[k])
                held = opened.read_at(int(starts[n]) - at + self.read_bytes // 4, at)
                for start, ids in zip(starts[k : n + 1], pages[k : n + 1], strict=True):
                    wanted = set(ids.tolist())
                    got = [(i, *page) for i, page in pages_in(stream(opened, int(start), held, at, self.read_bytes)).items() if i in wanted]
                    if got:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*got, strict=True), ARTICLES_ARROW, strict=True)], schema=ARTICLES_ARROW)
                k = n + 1


class MultistreamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "multistream"

    def schema(self) -> str:
        return ARTICLES

    def reader(self, schema: StructType) -> _Reader:
        from . import archives

        given = {"split": SPLIT_BYTES, "gap": archives.GAP_BYTES, "read": archives.READ_BYTES}
        return _Reader({**given, **dict(self.options)})


def register(spark: SparkSession) -> None:
    """Makes the format known; filters are pushed into Python sources only where the session says so."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(MultistreamSource)
