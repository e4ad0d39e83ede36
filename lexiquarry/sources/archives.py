"""Article archives: multistream bz2 read block by block through its index, or XML read whole."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.plaintext import plaintext
from ..storage import shared_root, stored
from .blocks import pages_in  # noqa: F401
from .multistream import MultistreamSource, register

#: Blocks whose starts lie closer are read together.
GAP_BYTES = 2 << 20
#: Compressed bytes that are asked for at once beyond the last start of a batch.
READ_BYTES = 4 << 20

# Names of a wiki's archive files.
NAMES = {
    "multistream": "{wiki}-latest-pages-articles-multistream.xml.bz2",
    "multistream-index": "{wiki}-latest-pages-articles-multistream-index.txt.bz2",
    "bz2": "{wiki}-latest-pages-articles.xml.bz2",
    "xml": "{wiki}-latest-pages-articles.xml",
}


def archive_name(wiki: str, variant: str) -> str:
    return NAMES[variant].format(wiki=wiki)


def find_archive(folder: Path, wiki: str = "enwiki") -> Path:
    """The plain XML if it is there, else the bz2 one."""
    for variant in ("xml", "bz2"):
        if (path := folder / archive_name(wiki, variant)).exists():
            return path
    raise FileNotFoundError(f"no article archive of {wiki} in {folder}")


def find_multistream(folder: Path, wiki: str = "enwiki") -> tuple[Path, Path]:
    """The multistream archive and its index; both must be there."""
    archive, index = (folder / archive_name(wiki, v) for v in ("multistream", "multistream-index"))
    index = index if index.exists() else index.with_suffix("")
    for path in (archive, index):
        if not path.exists():
            raise FileNotFoundError(str(path))
    return archive, index


def parse_index(lines: DataFrame, column: str = "value") -> DataFrame:
    """``page_id, offset, title`` of ``offset:page_id:title`` lines (titles may hold colons); other lines drop out.

    Of lines with one page_id the greatest offset holds, which in an index is the last.
    """
    parts = F.split(column, ":", 3)
    rows = lines.where(F.size(parts) == 3).select(F.get(parts, F.lit(1)).try_cast("long").alias("page_id"), F.get(parts, F.lit(0)).try_cast("long").alias("offset"), F.get(parts, F.lit(2)).alias("title"))
    rows = rows.where("page_id IS NOT NULL AND offset IS NOT NULL")
    return rows.groupBy("page_id").agg(F.max(F.struct("offset", "title")).alias("x")).select("page_id", "x.offset", "x.title")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return parse_index(spark.read.text(path))


def blocks_of(targets: DataFrame, index: DataFrame) -> DataFrame:
    """``offset, page_ids``: the blocks that hold the wanted pages. Pages that the index lacks drop out."""
    return targets.select("page_id").distinct().join(index, "page_id").groupBy("offset").agg(F.collect_set("page_id").alias("page_ids"))


def missing_from(targets: DataFrame, index: DataFrame) -> DataFrame:
    return targets.join(index, "page_id", "left_anti")


def batches_of(blocks: DataFrame, gap: int = GAP_BYTES, stripe: int = 1 << 30) -> DataFrame:
    """``blocks`` with ``batch``: runs of offsets no more than ``gap`` apart, within a stripe of the archive.

    Stripes keep the running count off a single task; a run that crosses one is two batches.
    """
    own = W.partitionBy("stripe").orderBy("offset")
    near = blocks.withColumn("stripe", F.floor(F.col("offset") / stripe))
    new = F.coalesce((F.col("offset") - F.lag("offset").over(own) > gap).cast("int"), F.lit(0))
    return near.withColumn("_new", new).withColumn("batch", F.sum("_new").over(own)).drop("_new")


def keep_index(index: DataFrame, folder: str) -> str:
    """Writes ``page_id, offset, title`` of an index sorted by offset, as the ``multistream`` source reads it; returns the folder."""
    index.repartitionByRange("offset").sortWithinPartitions("offset").write.parquet(folder)
    return folder


def read_multistream(targets: DataFrame, index: DataFrame, archive: str, limit: int | None = None) -> DataFrame:
    """``page_id, title, wikitext`` of the wanted pages that the archive holds.

    The index of the wanted pages is stored, and the ``multistream`` source plans its partitions from that. Only their
    blocks are unpacked, and a limit cuts the wanted pages before anything is read.
    """
    spark = targets.sparkSession
    known = stored(index.join(targets.select("page_id"), "page_id", "left_semi").select("page_id", "offset"), "known-pages")
    register(spark)
    wanted = keep_index(known.limit(limit) if limit else known, f"{shared_root(spark)}/wanted-{uuid.uuid4().hex}")
    return spark.read.format(MultistreamSource.name()).option("index", wanted).load(archive)


_PAGE_XML = "title string, ns int, id long, revision struct<text: struct<_VALUE: string, _bytes: long>>"


def read_xml(spark: SparkSession, path: str, targets: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """``page_id, title, wikitext`` of an XML archive, plain or bz2, scanned whole; pages that do not parse drop out.

    Text that ends with a page's end tag is a row, so the file (bz2 too) is split over many tasks.
    """
    chunks = spark.read.option("lineSep", "</page>").text(path).where(F.instr("value", "<page>") > 0)
    page = F.concat(F.expr("substring(value, instr(value, '<page>'))"), F.lit("</page>"))
    pages = chunks.select(F.from_xml(page, _PAGE_XML, {"ignoreSurroundingSpaces": "false"}).alias("page")).select("page.*")
    articles = pages.where("ns = 0 AND revision.text._VALUE IS NOT NULL").select(F.col("id").alias("page_id"), "title", F.col("revision.text._VALUE").alias("wikitext"))
    if targets is not None:
        articles = articles.join(targets.select("page_id"), "page_id", "left_semi")
    return articles.limit(limit) if limit else articles


def content(articles: DataFrame) -> DataFrame:
    """Articles with ``plaintext``; it costs nothing where no later step reads it."""
    return articles.withColumn("plaintext", plaintext(F.col("wikitext")))
