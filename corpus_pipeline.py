"""The corpus pipeline: documents in, a mixed training corpus out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept. All but the
last return the columns of ``documents``; the last adds ``size``, ``taken`` and ``virtual_finish``.

An empty table passes through every stage as one. Extra columns stay, whatever their names; the stages' own are named apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiquarry.llm import decontaminate, mixing, near_dedup, quality, substrings
from lexiquarry.llm._shared import materialise, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    Null and empty texts score by the bias, and repeated rows alike; without labels all score 0.5 and stay.
    """
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of least doc_id.

    Null texts and texts without words are linked with nothing and stay, as do rows without a doc_id; rows of one doc_id
    are one document and stay or go together.
    """
    return near_dedup.drop_near_duplicates(docs)


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds are cut; the document stays.

    Null texts stay null, empty ones empty; rows of one doc_id count as one document, one without comes after all others.
    ``n_chars``, where there is such a column, is counted anew.
    """
    out = substrings.dedup_substrings(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak a test item go.

    Null and empty texts and items match nothing; repeated rows are judged alike; without items all stay.
    """
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mixture, with the words that it takes of each.

    Null and empty texts have no words, so they are not in it; of equal rows as many are as something is taken of; null is a
    source of its own.
    """
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("minhash near-dedup", near_dedup_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("source mixing", mixing_stage),
]

#: Training a model and rolling hashes have no SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
