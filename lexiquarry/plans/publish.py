"""``python -m lexiquarry.plans.publish``: a run of one pattern file, its results joined to a country's regions and published."""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .run import PATTERNS_DIR, Config, parse_args, publish_regions, run, show


def parse(argv: list[str] | None = None) -> tuple[Path, Config]:
    """The country's folder, which holds ``regions/*.json``, and the run's configuration."""
    p = argparse.ArgumentParser(prog="lexiquarry-publish")
    p.add_argument("--country", required=True)
    p.add_argument("--map-data-dir", type=Path, default=Path("data"))
    p.add_argument("--patterns-file", type=Path, default=PATTERNS_DIR / "geo" / "admin_subdivisions.txt")
    p.add_argument("--wiki", default="enwiki")
    p.add_argument("--dry-run", action="store_true")
    a, rest = p.parse_known_args(argv)  # what is left configures the run
    folder = a.map_data_dir / a.country
    if not (folder / "regions").is_dir():
        p.error(f"no regions folder in {folder}")
    config = parse_args(["--patterns-file", str(a.patterns_file), "--wiki", a.wiki, "--extraction-mode", "geo", "--output-format", "csv", *(["--dry-run"] if a.dry_run else []), *rest])
    return folder, replace(config, results_dir=config.results_dir / "geo")


def publish(spark: SparkSession, folder: Path, config: Config, **kw) -> DataFrame:
    """Runs and publishes to ``wikipedia`` in the country's folder; returns what the run wrote, or a dry run's counts."""
    made = run(spark, config, **kw)
    if not config.dry_run:
        publish_regions(spark, made.first()["path"], str(folder), str(folder / "wikipedia"), config.lang)
    return made


def main(argv: list[str] | None = None) -> None:
    folder, config = parse(argv)
    show("done", publish(SparkSession.builder.appName("lexiquarry").getOrCreate(), folder, config, report=show))


if __name__ == "__main__":
    main(sys.argv[1:])
