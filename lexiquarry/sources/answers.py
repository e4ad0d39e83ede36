"""Answers of services that cost time or money, each kept as it comes.

A task writes what it is answered, call by call, to a file of its own in the store's folder, and looks there before it asks,
so a retried task goes on where the killed one stopped; of a line that was cut off, nothing is taken. Files are ended once they
are ``OPEN_SECONDS`` old: where a file can't be seen before its end, no more than that is lost with a task. When all is
answered it becomes one Parquet table of the store and the tasks' files go. A later run takes what the store holds, tables and
what a run that died left, and asks only for the rest.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import stored

#: How long a task adds answers to one file.
OPEN_SECONDS = 1.0
KEPT = "key string, answer string, at double"
_FRESH = pa.schema([("key", pa.string()), ("answer", pa.string()), ("at", pa.float64()), ("keep", pa.bool_())])

#: ``(questions, wait) -> (answer, whether to keep it)`` of each question, in order; it calls ``wait`` before each request.
Call = Callable[[list[str], Callable[[], None]], list[tuple[str | None, bool]]]


def filesystem(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(folder) if "://" in folder else (pyarrow.fs.LocalFileSystem(), folder)


class Pace:
    """Waits so that tasks together make one request each ``pause`` seconds: task ``n`` of ``tasks`` has each ``tasks``-th slot.

    A task that comes late does not hurry after its slots, so the rate is never passed.
    """

    def __init__(self, pause: float, tasks: int, n: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.every, self.clock, self.sleep = pause * tasks, clock, sleep
        self.next = clock() + pause * n

    def __call__(self) -> None:
        now = self.clock()
        if self.next > now:
            self.sleep(self.next - now)
        self.next = max(self.next, now) + self.every


def _written(files: pyarrow.fs.FileSystem, place: str, prefix: str) -> dict[str, tuple[str | None, float]]:
    """What attempts at a task, whose files begin with ``prefix``, were answered."""
    found = {}
    for info in files.get_file_info(pyarrow.fs.FileSelector(place, allow_not_found=True)):
        if info.base_name.startswith(prefix) and info.base_name.endswith(".json"):
            with files.open_input_stream(info.path) as f:
                whole = f.read().rpartition(b"\n")[0]  # an attempt that was killed may leave half a line
            for line in whole.split(b"\n") if whole else ():
                x = json.loads(line)
                found[x["key"]] = (x["answer"], x["at"])
    return found


class _Noted:
    """Lines to files of one attempt at a task, each written through as it comes; a new file as soon as one is old."""

    def __init__(self, files: pyarrow.fs.FileSystem, name: str):
        self.files, self.name, self.n, self.out, self.since = files, name, 0, None, 0.0

    def add(self, lines: str) -> None:
        if self.out is None:
            self.out, self.since = self.files.open_output_stream(f"{self.name}-{self.n:07d}.json", compression=None), time.monotonic()
            self.n += 1
        self.out.write(lines.encode())
        self.out.flush()
        if time.monotonic() - self.since >= OPEN_SECONDS:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


class Answers:
    """A store of answers by key under a folder that the driver and all executors reach."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _below(self, name: str) -> list[str]:
        files, base = filesystem(self.folder)
        found = files.get_file_info(pyarrow.fs.FileSelector(f"{base}/{name}", allow_not_found=True))
        return [f"{self.folder}/{name}/{i.base_name}" for i in found if i.type == pyarrow.fs.FileType.Directory]

    def known(self, since: float = 0.0) -> DataFrame:
        """``key, answer``: the last of each key, of those given at ``since`` (seconds of the epoch) or later."""
        rows = self.spark.createDataFrame([], KEPT)
        if tables := self._below("kept"):
            rows = rows.unionByName(self.spark.read.schema(KEPT).parquet(*tables))
        if left := self._below("coming"):
            rows = rows.unionByName(self.spark.read.schema(KEPT).option("pathGlobFilter", "*.json").option("mode", "DROPMALFORMED").json(left))
        return rows.where(F.col("key").isNotNull() & (F.col("at") >= since)).groupBy("key").agg(F.max_by("answer", "at").alias("answer"))

    def ask(self, questions: DataFrame, call: Call, tasks: int = 4, pause: float = 0.0, batch: int = 1, since: float = 0.0) -> DataFrame:
        """``key, answer`` of all ``key, question`` rows, a key each; null where there is none. Asks for what the store lacks."""
        run = uuid.uuid4().hex
        asked = questions.join(self.known(since), "key", "left_anti").select("key", "question")
        # dealt round-robin, so that all tasks have as many to ask, whatever the number of shuffle partitions
        asked = stored(asked, "questions").repartition(tasks)
        folder = self.folder

        def work(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            task = TaskContext.get()
            files, base = filesystem(folder)
            place, prefix = f"{base}/coming/{run}", f"{task.partitionId():05d}-"
            before = _written(files, place, prefix)
            files.create_dir(place, recursive=True)
            wait, noted = Pace(pause, tasks, task.partitionId()), _Noted(files, f"{place}/{prefix}{task.taskAttemptId()}")

            def give(rows: list[tuple[str, str | None, float, bool]]) -> pa.RecordBatch:
                return pa.record_batch([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_FRESH)], schema=_FRESH)

            try:
                for rows in source:
                    pairs = list(zip(rows["key"].to_pylist(), rows["question"].to_pylist(), strict=True))
                    got = [(k, *before[k], True) for k, _ in pairs if k in before]
                    pairs = [p for p in pairs if p[0] not in before]
                    for a in range(0, len(pairs), batch):
                        part = pairs[a : a + batch]
                        came = [(k, answer, time.time(), keep) for (k, _), (answer, keep) in zip(part, call([q for _, q in part], wait), strict=True)]
                        if lines := "".join(json.dumps({"key": k, "answer": v, "at": at}) + "\n" for k, v, at, keep in came if keep):
                            noted.add(lines)
                        got += came
                    if got:
                        yield give(got)
            finally:
                noted.close()

        fresh = asked.mapInArrow(work, f"{KEPT}, keep boolean").where("keep").drop("keep")
        fresh.write.parquet(f"{self.folder}/kept/{run}")
        files, base = filesystem(self.folder)
        if files.get_file_info(f"{base}/coming/{run}").type == pyarrow.fs.FileType.Directory:
            files.delete_dir(f"{base}/coming/{run}")
        return questions.select("key").join(self.known(since), "key", "left")

    def clear(self) -> None:
        files, base = filesystem(self.folder)
        if files.get_file_info(base).type == pyarrow.fs.FileType.Directory:
            files.delete_dir(base)


def keys(column: str, *parts: str) -> Column:
    """A key for each value of a column, of one kind of question."""
    return F.sha2(F.concat(F.lit("".join(f"{p}\n" for p in parts)), F.col(column)), 256)
