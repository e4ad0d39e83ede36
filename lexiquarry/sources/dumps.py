"""Relational dumps: ``INSERT INTO `table` VALUES (…),(…);`` lines as rows, parsed in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Positions of the columns that are read.
PAGE = {"page_id": 0, "namespace": 1, "title": 2, "is_redirect": 3, "length": 9}
LINK_TARGET = {"lt_id": 0, "namespace": 1, "title": 2}
CATEGORY_LINK = {"page_id": 0, "kind": 4, "target_id": 6}
CATEGORY, ARTICLE = 14, 0

_QUOTED = r"'(?:[^'\\]++|\\.)*+'"
_TUPLE = rf"(?s)\((?:[^()']++|{_QUOTED})*+\)"
_FIELD = rf"(?s)(?<=^|,)[ \t]*+({_QUOTED}|[^,']*+)"


def _head(table: str) -> str:
    return f"INSERT INTO `{table}` VALUES "


def inserts(lines: DataFrame, table: str, column: str = "value") -> DataFrame:
    """A ``fields`` array of text for each row of the table in the dump lines; unquoted NULL is null.

    Other lines and other tables drop out before anything is split. A backslash keeps the character after
    it as it is; tuples that are not closed drop out.
    """
    head = _head(table)
    rows = lines.where(F.col(column).startswith(head)).select(F.explode(F.regexp_extract_all(F.substr(column, F.lit(len(head) + 1)), F.lit(_TUPLE), F.lit(0))).alias("row"))
    inside = F.expr("substr(row, 2, length(row) - 2)")
    fields = F.regexp_extract_all(inside, F.lit(_FIELD), F.lit(1))

    def value(raw: Column) -> Column:
        bare = F.rtrim(raw)
        text = F.regexp_replace(F.regexp_replace(bare, r"(?s)^'(.*)'$", "$1"), r"(?s)\\(.)", "$1")
        return F.when(bare.startswith("'"), text).when(bare != "NULL", bare)

    return rows.select(F.transform(fields, value).alias("fields"))


def read_dump(spark: SparkSession, path: str, table: str) -> DataFrame:
    """``fields`` of a dump file, plain or gzip; a gzip file is unzipped in one task, so its lines are dealt out before they are split."""
    lines = spark.read.text(path)
    if path.endswith(".gz"):
        at = F.monotonically_increasing_id()
        lines = lines.where(F.col("value").startswith(_head(table))).select("value", at.alias("at")).repartition("at").select("value")
    return inserts(lines, table)


def _named(rows: DataFrame, positions: dict[str, int], numbers: tuple[str, ...]) -> DataFrame:
    columns = {n: F.get("fields", F.lit(i)) for n, i in positions.items()}
    return rows.select(*[(c.try_cast("long") if n in numbers else c).alias(n) for n, c in columns.items()])


def pages(rows: DataFrame) -> DataFrame:
    """``page_id, namespace, title, is_redirect, length``."""
    return _named(rows, PAGE, ("page_id", "namespace", "is_redirect", "length"))


def split_pages(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Categories ``page_id, name`` (redirects too) and articles ``page_id, title, length`` (no redirects)."""
    categories = pages.where(F.col("namespace") == CATEGORY).select("page_id", F.col("title").alias("name"))
    redirect = F.coalesce(F.col("is_redirect") == 1, F.lit(False))
    return categories, pages.where((F.col("namespace") == ARTICLE) & ~redirect).select("page_id", "title", "length")


def link_targets(rows: DataFrame) -> DataFrame:
    """``lt_id, name`` of targets that are categories."""
    found = _named(rows, LINK_TARGET, ("lt_id", "namespace"))
    return found.where(F.col("namespace") == CATEGORY).select("lt_id", F.col("title").alias("name"))


def category_links(rows: DataFrame) -> DataFrame:
    """``page_id, kind, target_id``."""
    return _named(rows, CATEGORY_LINK, ("page_id", "target_id"))
