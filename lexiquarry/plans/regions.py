"""Results joined to administrative regions by title key, and published as keyed JSON."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.titles import article_url, title_key

# Columns that a published entry leaves out.
INTERNAL = ("page_id", "title", "article_bytes", "word_count", "row_at")


def first_of_key(regions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Regions of which each ``key`` keeps the first by file and place, and the others as ``key, winner_gid, loser_gid, source``."""
    own = W.partitionBy("key").orderBy("source", "place")
    ranked = regions.withColumn("_n", F.row_number().over(own)).withColumn("_winner", F.first("gid").over(own))
    lost = ranked.where("_n > 1").select("key", F.col("_winner").alias("winner_gid"), F.col("gid").alias("loser_gid"), "source")
    return ranked.where("_n = 1").select("key", "gid"), lost


class Joined(NamedTuple):
    matched: DataFrame  # gid, the results' columns
    unmatched: DataFrame  # the results' columns
    collisions: DataFrame  # gid, winner_title, loser_title


def join_regions(results: DataFrame, regions: DataFrame) -> Joined:
    """Results by region; of results for one region the first row stands. ``regions`` holds each key once."""
    found = results.withColumn("_key", title_key(F.col("title"))).join(regions.select(F.col("key").alias("_key"), "gid"), "_key", "left").drop("_key")
    own = W.partitionBy("gid").orderBy("row_at")
    hits = found.where("gid IS NOT NULL").withColumn("_n", F.row_number().over(own)).withColumn("_winner", F.first("title").over(own))
    lost = hits.where("_n > 1").select("gid", F.col("_winner").alias("winner_title"), F.col("title").alias("loser_title"))
    return Joined(hits.where("_n = 1").drop("_n", "_winner"), found.where("gid IS NULL").drop("gid"), lost)


def entries(matched: DataFrame, lang: str = "en") -> DataFrame:
    """``gid, row_at, entry``: a struct of title, filled fields and the article's address; blanks are null and left out."""
    kept = [c for c in matched.columns if c not in INTERNAL and c != "gid" and not c.endswith("_note")]
    fields = [F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")).alias(c) for c in kept]
    return matched.select("gid", "row_at", F.struct("title", *fields, article_url(F.col("title"), lang).alias("wikipedia_url")).alias("entry"))
