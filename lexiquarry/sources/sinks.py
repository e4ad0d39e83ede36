"""Sinks: delimited text, workbooks, one keyed JSON document. Rows go from executors to files."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .answers import filesystem
from .workbooks import WorkbookSource, take_written

#: Rows that one sheet can hold besides its header.
SHEET_ROWS = (1 << 20) - 1


def write_delimited(df: DataFrame, path: str, separator: str = ",", one_file: bool = False) -> None:
    """CSV or TSV with a header and nulls as nothing; a table without rows makes a file without a header.

    The table is looked at before it is written, so hand in a stored one.
    """
    header = not df.isEmpty()
    df = df.coalesce(1) if one_file else df
    df.write.mode("overwrite").csv(path, header=header, sep=separator, nullValue="", emptyValue="", escape='"')


def write_workbooks(df: DataFrame, folder: str, sheet: str = "Sheet", by: str | None = None) -> DataFrame:
    """One workbook of each partition (more where a sheet is full) under ``folder``; returns ``name, path, rows`` once they are written.

    With ``by``, a column that partitions are sorted by, its values get workbooks of their own, each in a folder and with a sheet
    of that name; the column itself is left out. ``df.coalesce(1)`` makes one workbook of a small table. They appear all at
    once, when every task is done, in place of those that an earlier call wrote there; a call that fails leaves none.
    """
    spark, job = df.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(WorkbookSource)
    options = {"path": folder, "sheet": sheet, "sheet_rows": str(SHEET_ROWS), "job": job} | ({"by": by} if by else {})
    files, base = filesystem(folder)
    files.create_dir(f"{base}/_writing-{job}", recursive=True)  # tasks that outlive a failed write find it gone
    df.write.format(WorkbookSource.name()).options(**options).mode("overwrite").save()
    return spark.createDataFrame(take_written(folder, job), "name string, path string, rows long")  # a row for each file


def read_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """``name, path, row, cells`` of all workbooks under ``folder``: each row of their first sheets, from 1, as texts."""
    spark.dataSource.register(WorkbookSource)
    return spark.read.format(WorkbookSource.name()).load(folder)


def _quoted(text: Column) -> Column:
    """A JSON string."""
    listed = F.to_json(F.array(text))
    return F.substr(listed, F.lit(2), F.length(listed) - 2)


def write_keyed_json(entries: DataFrame, path: str) -> None:
    """One JSON document, indented by 2, of ``gid`` and ``entry`` (a struct of texts; nulls are left out), in the order of ``row_at``.

    The table is looked at before it is written, so hand in a stored one. A document is one file, so one task writes it; it has
    an entry for each region.
    """
    last = entries.agg(F.max("row_at")).first()[0]
    fields = [F.when(F.col(f"entry.`{f}`").isNotNull(), F.concat(F.lit(f"    {json.dumps(f)}: "), _quoted(F.col(f"entry.`{f}`")))) for f in entries.schema["entry"].dataType.names]
    body = F.concat(F.lit("  "), _quoted(F.col("gid")), F.lit(": {\n"), F.array_join(F.array_compact(F.array(*fields)), ",\n"), F.lit("\n  }"))
    line = F.concat(body, F.when(F.col("row_at") == F.lit(last), "").otherwise(","))
    lines = entries.select(F.col("row_at").alias("at"), line.alias("value"), F.lit(1).alias("part"))
    edge = entries.sparkSession.sql("SELECT * FROM VALUES (0L, '{', 0), (0L, '}', 2) AS t(at, value, part)")
    whole = lines.unionByName(edge).coalesce(1).sortWithinPartitions("part", "at").select("value")
    whole.write.mode("overwrite").text(path)
