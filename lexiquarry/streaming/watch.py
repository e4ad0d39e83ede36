"""Structured Streaming over dump files as they arrive: rows of a table, and categories that match."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.categories import matches
from ..sources.dumps import CATEGORY, inserts, pages


def watch_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of ``page_id, namespace, title, is_redirect, length`` from page dumps that appear in a folder."""
    return pages(inserts(spark.readStream.text(folder), "page"))


def watch_categories(spark: SparkSession, folder: str, patterns: tuple[str, ...]) -> DataFrame:
    """A stream of ``page_id, name`` of categories that a pattern matches."""
    found = watch_pages(spark, folder).where(F.col("namespace") == CATEGORY).select("page_id", F.col("title").alias("name"))
    return found.where(matches(F.col("name"), patterns))
