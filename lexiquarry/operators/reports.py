"""Counts that tell how a run went."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fill_rates(records: DataFrame, fields: list[str] | tuple[str, ...]) -> DataFrame:
    """``field, filled, total, rate``: one aggregate over all fields, then a row each."""
    counts = records.agg(F.count("*").alias("total"), *[F.count(f).alias(f"n_{f}") for f in fields])
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"n_{f}").alias("filled")) for f in fields])
    rows = counts.select("total", F.explode(each).alias("x")).select("x.field", "x.filled", "total")
    return rows.withColumn("rate", F.when(F.col("total") > 0, F.col("filled") / F.col("total")).otherwise(F.lit(0.0)))


def tier_mix(records: DataFrame, by_infobox: list[str], by_text: list[str]) -> DataFrame:
    """``tier, articles``: which tiers filled a record. The lists name the fields of either tier."""
    some = lambda names: F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(True)) for n in names], F.lit(False))
    box, text = some(by_infobox), some(by_text)
    tier = F.when(box & text, "infobox+text").when(box, "infobox").when(text, "text").otherwise("none")
    return records.groupBy(tier.alias("tier")).agg(F.count("*").alias("articles"))


def group_stats(tagged: DataFrame, articles: DataFrame, targets: DataFrame) -> DataFrame:
    """Per stem: categories, articles, and articles that pass the filters."""
    names = tagged.groupBy("stem").agg(F.count("*").alias("categories"))
    kept = targets.select("page_id").withColumn("_kept", F.lit(1))
    counts = articles.join(kept, "page_id", "left").groupBy("stem").agg(F.count("*").alias("articles"), F.count("_kept").alias("targets"))
    return names.join(counts, "stem", "left").select("stem", "categories", F.coalesce("articles", F.lit(0)).alias("articles"), F.coalesce("targets", F.lit(0)).alias("targets"))


# The shares of articles that a dry run expects in the text and model tiers, and a reply's cost.
TEXT_SHARE, MODEL_SHARE, REPLY_COST = 0.3, 0.1, 0.001


def dry_run(targets: DataFrame) -> DataFrame:
    """``articles, text_tier, model_tier, model_cost``: what a run would have to do."""
    counts = targets.agg(F.count("*").alias("articles"))
    counts = counts.withColumn("text_tier", F.floor(F.col("articles") * TEXT_SHARE)).withColumn("model_tier", F.floor(F.col("articles") * MODEL_SHARE))
    return counts.withColumn("model_cost", F.col("model_tier") * REPLY_COST)


def sample(pages: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """``n`` pages by hash of their id: the same ones on every run and partitioning."""
    return pages.orderBy(F.md5(F.concat_ws(":", "page_id", F.lit(seed))), "page_id").limit(n)
