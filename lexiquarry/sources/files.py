"""Pattern files, administrative regions, result tables, and the cache of parsed dumps."""

from __future__ import annotations

import json
import shutil
import uuid
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.titles import title_key


def read_patterns(path: Path) -> tuple[tuple[str, tuple[str, ...]], ...]:
    """``(stem, regexes)`` of a pattern file, or of each ``.txt`` of a folder by name; one regex a line, blanks dropped."""
    files = sorted(path.glob("*.txt")) if path.is_dir() else [path]
    return tuple((f.stem, tuple(line.strip() for line in f.read_text().splitlines() if line.strip())) for f in files)


_REGIONS = "features array<struct<properties: struct<GID_2: string, NAME_2: string, NAME_1: string>>>"


def read_regions(spark: SparkSession, folder: str) -> DataFrame:
    """``gid, key, source, place`` of the features in ``regions/*.json``; those without all three names drop out."""
    files = spark.read.schema(_REGIONS).option("multiLine", True).option("pathGlobFilter", "*.json").json(f"{folder}/regions")
    rows = files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source"), F.posexplode("features").alias("place", "f")).select("source", "place", "f.properties.*")
    named = rows.where("GID_2 <> '' AND NAME_2 <> '' AND NAME_1 <> ''")
    return named.select(F.col("GID_2").alias("gid"), title_key(F.concat_ws(", ", "NAME_2", "NAME_1")).alias("key"), "source", "place")


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """A result table, all strings, with ``row_at``, which orders rows as the files do."""
    rows = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return rows.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in rows.columns], F.monotonically_increasing_id().alias("row_at"))


def newest(folder: Path, pattern: str = "*.csv") -> Path:
    found = sorted(folder.glob(pattern), key=lambda p: p.stat().st_mtime)
    if not found:
        raise FileNotFoundError(f"{pattern} in {folder}")
    return found[-1]


class Cache:
    """Snapshots of parsed tables as Parquet; local paths hold the manifests.

    Tables that are saved together are one version, in a folder of its own. A table's manifest names its version and that
    version's sources, and the one before; manifests are replaced, one after the other, when all data is there, and the
    old data goes last. So, wherever a save ends, some version of all tables is whole.
    """

    SLACK_S = 0.01

    def __init__(self, spark: SparkSession, data_dir: Path, wiki: str = "enwiki"):
        self.spark, self.folder = spark, data_dir / "cache" / wiki

    def _entries(self, name: str) -> dict[str, dict[str, float]]:
        """Sources' times by version, the newest first."""
        try:
            held = json.loads((self.folder / f"{name}.json").read_text())
            return {v["version"]: v["sources"] for v in held["versions"]}
        except (OSError, ValueError, TypeError, KeyError):
            return {}

    def save_all(self, tables: dict[str, DataFrame], sources: list[Path]) -> None:
        version = uuid.uuid4().hex
        times = {str(p): p.stat().st_mtime for p in sources if p.exists()}
        for name, df in tables.items():
            df.write.parquet(str(self.folder / "data" / version / name))
        old = {n: self._entries(n) for n in tables}
        whole = [v for v in next(iter(old.values())) if all(v in e for e in old.values())][:1]
        for name in tables:
            kept = [{"version": version, "sources": times}, *({"version": v, "sources": old[name][v]} for v in whole)]
            fresh = self.folder / f"{name}.json.new"
            fresh.write_text(json.dumps({"versions": kept}))
            fresh.replace(self.folder / f"{name}.json")
        named = {next(iter(self._entries(p.stem)), None) for p in self.folder.glob("*.json")}
        for folder in (self.folder / "data").iterdir():
            if folder.name not in named:
                shutil.rmtree(folder, ignore_errors=True)

    def load_all(self, names: tuple[str, ...], sources: list[Path]) -> dict[str, DataFrame] | None:
        """The tables of one version, or None if one is missing, unreadable, or older than a source; absent sources are trusted."""
        entries = {n: self._entries(n) for n in names}
        for version, times in entries[names[0]].items():
            if not all(version in e for e in entries.values()):
                continue
            if any(str(p) not in times or p.exists() and abs(p.stat().st_mtime - times[str(p)]) > self.SLACK_S for p in sources):
                continue
            try:
                return {n: self.spark.read.parquet(str(self.folder / "data" / version / n)) for n in names}
            except AnalysisException:  # an unreadable table is a missing one
                continue
        return None

    def save(self, df: DataFrame, name: str, sources: list[Path]) -> None:
        self.save_all({name: df}, sources)

    def load(self, name: str, sources: list[Path]) -> DataFrame | None:
        held = self.load_all((name,), sources)
        return held and held[name]

    def clear(self) -> int:
        """Remove this wiki's tables; returns how many there were."""
        count = len(list(self.folder.glob("*.json")))
        shutil.rmtree(self.folder, ignore_errors=True)
        return count
