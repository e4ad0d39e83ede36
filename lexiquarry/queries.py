"""Queries over the test tables, and SQL that must give the same rows.

The tables hold no dumps or wikitext, so queries render them from key columns and read them back.
"""

from __future__ import annotations

import bz2
import http.client
import json
import re
import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from pathlib import Path

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import biography
from .functions.dates import normalise_with_note
from .functions.etymology import from_lead, from_section
from .functions.infobox import Infobox, fields, template_date
from .functions.model_reply import text_field
from .functions.modes import FIELDS, MODES
from .functions.plaintext import plaintext, word_count
from .functions.titles import article_url, title_key
from .operators import categories as cat
from .operators import reports
from .plans.extract import fill_by_model, records, tiered
from .plans.regions import entries, first_of_key, join_regions
from .plans.run import parse_args, run
from .sources import dumps
from .sources.archives import archive_name, batches_of, blocks_of, missing_from, parse_index, read_multistream, read_xml
from .sources.files import Cache, read_regions, read_results
from .sources.remote import ask_model, fetch_articles
from .sources.sinks import read_workbooks, write_delimited, write_keyed_json, write_workbooks
from .storage import shared_root, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

PATTERNS = ("ring|bolt", r"(?:^|\s)wid", "^RED", "gear$")
GROUPS = (("rings", (r"\bring",)), ("warm", ("^red", "^orange")), ("small", ("SMALL", "^tiny")))


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with its SQL."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a dealt table that one task takes, about, at most.
DEALT_ROWS = 1 << 18


def dealt_out(spark: SparkSession, df: DataFrame, rows: int | None = None) -> DataFrame:
    """Rows over all cores, ahead of costly text rules, and over more tasks the more there are, as many for each core; the test tables are one row group each.

    ``rows``: their number where it is known, else it is read from the files' footers.
    """
    rows = df.count() if rows is None else rows
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores * max(1, -(-rows // (cores * DEALT_ROWS))))


def say(*parts: Column | str) -> Column:
    """Text from columns and literals; a null column says nothing."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("")) for p in parts])


# --- dumps ---------------------------------------------------------------------------------------


@query(
    r"""SELECT n_nationkey::BIGINT AS id, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 'it''s (' || n_name || '), a\b' END AS name,
    n_regionkey::BIGINT AS region FROM nation"""
)
def insert_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    name = F.when(F.col("n_nationkey") % 5 == 0, "NULL").otherwise(say(r"'it\'s (", F.col("n_name"), r"), a\\b'"))
    rows = n.select(F.col("n_regionkey").alias("line"), say("(", F.col("n_nationkey"), ", ", name, ",", F.col("n_regionkey"), ")").alias("row"))
    lines = rows.groupBy("line").agg(say("INSERT INTO `nation` VALUES ", F.array_join(F.collect_list("row"), ","), ";").alias("value"))
    other = spark.sql("SELECT * FROM VALUES ('-- dump'), ('INSERT INTO `other` VALUES (1,2,3);') AS t(value)")
    got = dumps.inserts(lines.select("value").unionByName(other), "nation")
    return got.select(F.get("fields", F.lit(0)).cast("long").alias("id"), F.get("fields", F.lit(1)).alias("name"), F.get("fields", F.lit(2)).cast("long").alias("region"))


def _page_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    row = say("(", k, ",", F.when(k % 3 == 0, "14").otherwise("0"), ",'", F.translate("p_name", " ", "_"), "_", k, "',", F.when(k % 7 == 0, "1").otherwise("0"), ",0,0.5,'2024',NULL,1,", F.col("p_size") * 100, ",'wikitext',NULL)")
    return p.select(say("INSERT INTO `page` VALUES ", row, ";").alias("value"))


@query(
    """SELECT 'category' AS kind, p_partkey AS page_id, replace(p_name, ' ', '_') || '_' || p_partkey AS title, NULL::BIGINT AS length FROM part WHERE p_partkey % 3 = 0
    UNION ALL SELECT 'article', p_partkey, replace(p_name, ' ', '_') || '_' || p_partkey, p_size::BIGINT * 100 FROM part WHERE p_partkey % 3 <> 0 AND p_partkey % 7 <> 0"""
)
def page_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories, articles = dumps.split_pages(dumps.pages(dumps.inserts(_page_lines(spark, sf_dir), "page")))
    first = categories.select(F.lit("category").alias("kind"), "page_id", F.col("name").alias("title"), F.lit(None).cast("long").alias("length"))
    return first.unionByName(articles.select(F.lit("article").alias("kind"), "page_id", "title", "length"))


@query("SELECT page_id, page_id * 10 AS \"offset\", url AS title FROM pages")
def index_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    lines = p.select(say(F.col("page_id") * 10, ":", F.col("page_id"), ":", F.col("url")).alias("value"))
    return parse_index(lines.unionByName(spark.sql("SELECT * FROM VALUES ('short:1'), ('x:y:z') AS t(value)")))


def _graph(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Root > regions > nations > suppliers as categories, customers as members of nations; one edge leads back."""
    region, nation, supplier, customer = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier", "customer"))
    name = lambda kind, key: say(kind, "_", F.col(key))
    sub = region.select(F.lit("root").alias("parent"), name("region", "r_regionkey").alias("child"))
    sub = sub.unionByName(nation.select(name("region", "n_regionkey").alias("parent"), name("nation", "n_nationkey").alias("child")))
    sub = sub.unionByName(supplier.select(name("nation", "s_nationkey").alias("parent"), name("supplier", "s_suppkey").alias("child")))
    sub = sub.unionByName(spark.sql("SELECT 'nation_3' AS parent, 'root' AS child"))
    members = customer.select(name("nation", "c_nationkey").alias("category"), F.col("c_custkey").alias("page_id"))
    members = members.unionByName(customer.where("c_custkey % 10 = 0").select(F.lit("root").alias("category"), F.col("c_custkey").alias("page_id")))
    return sub.distinct(), members.distinct()


_GRAPH_SQL = """sub AS (
  SELECT 'root' AS parent, 'region_' || r_regionkey AS child FROM region UNION SELECT 'region_' || n_regionkey, 'nation_' || n_nationkey FROM nation
  UNION SELECT 'nation_' || s_nationkey, 'supplier_' || s_suppkey FROM supplier UNION SELECT 'nation_3', 'root'),
members AS (SELECT 'nation_' || c_nationkey AS category, c_custkey AS page_id FROM customer UNION SELECT 'root', c_custkey FROM customer WHERE c_custkey % 10 = 0),
walk(name, depth) AS (SELECT 'root', 0 UNION SELECT s.child, w.depth + 1 FROM walk w JOIN sub s ON s.parent = w.name WHERE w.depth < 6),
visited AS (SELECT name, min(depth) AS depth FROM walk GROUP BY name)"""


@query(
    """WITH links AS (SELECT s_suppkey, s_nationkey FROM supplier WHERE s_suppkey % 4 <> 3)
    SELECT 'child' AS kind, n_name AS parent, CASE WHEN s_suppkey % 4 = 0 THEN r_name ELSE 'SUB_' || n_regionkey END AS target
    FROM links JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey WHERE s_suppkey % 4 IN (0) GROUP BY ALL
    UNION ALL SELECT 'member', n_name, s_suppkey::VARCHAR FROM links JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 4 IN (1, 2)"""
)
def category_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers link to nations: every fourth as a subcategory (its region's name), every fourth as a file, which drops out."""
    s, n, r = (table(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    kind = F.element_at(F.array(F.lit("subcat"), F.lit("page"), F.lit("page"), F.lit("file")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    both = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    links = both.select(F.when(kind == "subcat", F.col("n_regionkey") - 100).otherwise(F.col("s_suppkey")).cast("long").alias("page_id"), kind.alias("kind"), (F.col("s_nationkey") + 1000).cast("long").alias("target_id"))
    links = links.unionByName(spark.sql("SELECT 1L AS page_id, 'page' AS kind, 99999L AS target_id"))
    targets = n.select((F.col("n_nationkey") + 1000).cast("long").alias("lt_id"), F.col("n_name").alias("name"))
    names = r.select((F.col("r_regionkey") - 100).cast("long").alias("page_id"), F.col("r_name").alias("name"))
    sub, members = cat.edges(links, targets, names)
    return sub.select(F.lit("child").alias("kind"), "parent", F.col("child").alias("target")).unionByName(members.select(F.lit("member").alias("kind"), F.col("category").alias("parent"), F.col("page_id").cast("string").alias("target")))


# --- search --------------------------------------------------------------------------------------

def _named_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_name").alias("name"), F.col("p_partkey").alias("part"), "p_size")


_MATCH_SQL = " OR ".join(f"regexp_matches(p_name, '{p}', 'i')" for p in PATTERNS)


@query(f"SELECT DISTINCT p_name AS name FROM part WHERE {_MATCH_SQL}")
def regex_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.find_categories(_named_parts(spark, sf_dir), PATTERNS)


@query(f"SELECT DISTINCT p_name AS name FROM part, (VALUES {', '.join(f'({p!r})' for p in PATTERNS)}) AS t(regex) WHERE regexp_matches(p_name, regex, 'i')".replace("\\\\", "\\"))
def regex_theta(spark: SparkSession, sf_dir: str) -> DataFrame:
    patterns = spark.createDataFrame([(p,) for p in PATTERNS], "regex string")
    return cat.find_by_table(_named_parts(spark, sf_dir), patterns)


_WIDE = (
    *(f"^{w}_(?:ring|gear)s?_of_[0-9]+7_" for w in ("small", "hot", "red", "blue", "large", "old", "cold", "new")),
    *(f"(?:^|_){w}s?_of_[0-9]*{n}_in_[1-3]$" for n, w in enumerate(("widget", "gear", "plate", "bolt", "rod", "ring", "gizmo", "anvil"), 11)),
    *(f"_of_{n}[0-9]+_in_{n}$" for n in range(1, 8)),
)


def _line_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_orderkey", "l_linenumber")
    named = lines.join(table(spark, sf_dir, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    each = dealt_out(spark, named.drop("l_partkey", "p_partkey"), lines.count())
    each = each.select(say(F.translate("p_name", " ", "_"), "_of_", F.col("l_orderkey"), "_in_").alias("line"), "l_linenumber")
    each = each.select("line", F.explode(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.col("l_linenumber") + 10 * i)).alias("n"))
    name = say(F.col("line"), F.col("n"))
    return each.select(name.alias("name"))


@query(
    f"""WITH x AS (SELECT replace(p_name, ' ', '_') || '_of_' || l_orderkey || '_in_' || (l_linenumber + 10 * i) AS name FROM lineitem JOIN part ON p_partkey = l_partkey, range(4) AS t(i))
    SELECT DISTINCT name FROM x WHERE {' OR '.join(f"regexp_matches(name, '{p}', 'i')" for p in _WIDE)}"""
)
def wide_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four names of every line (2.4 million at sf0.1) against 23 patterns."""
    return cat.find_categories(_line_names(spark, sf_dir), _WIDE)


_THINGS = ("widget", "gear", "plate", "bolt", "rod", "ring", "gizmo", "anvil")
#: 298 patterns, of which most match no name, as patterns of one field don't match the categories of others.
_MANY = ("^small_(?:ring|gear)s?_of_[0-9]+77_", "(?:^|_)anvils?_of_[0-9]*99_in_[12]$", *(f"(?:^|_){x}{y}{w}s?(?:_of|$)" for x in "cdfklmprt" for y in "aeio" for w in _THINGS), *(f"(?:^|_)su{w}s?_(?:of|in)_" for w in _THINGS))


@query(
    f"""WITH x AS (SELECT replace(p_name, ' ', '_') || '_of_' || l_orderkey || '_in_' || (l_linenumber + 10 * i) AS name FROM lineitem JOIN part ON p_partkey = l_partkey, range(4) AS t(i))
    SELECT DISTINCT name FROM x WHERE regexp_matches(name, '{"|".join(_MANY)}', 'i')"""
)
def many_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four names of every line (2.4 million at sf0.1) against 298 patterns."""
    return cat.find_categories(_line_names(spark, sf_dir), _MANY)


def _part_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_name").alias("category"))
    return table(spark, sf_dir, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("category", F.col("l_orderkey").alias("page_id"))


@query(f"SELECT DISTINCT l_orderkey AS page_id FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE {_MATCH_SQL})")
def collect_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.collect_articles(_part_members(spark, sf_dir), cat.find_categories(_named_parts(spark, sf_dir), PATTERNS))


@query("SELECT doc_id AS page_id, source AS title, n_chars AS length FROM documents WHERE n_chars >= 1500")
def min_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return cat.long_enough(docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("title"), F.col("n_chars").alias("length")), 1500)


@query(
    """SELECT o_orderkey AS page_id, o_orderpriority AS title, floor(o_totalprice)::BIGINT AS length FROM orders WHERE o_orderstatus <> 'P' AND floor(o_totalprice)::BIGINT >= 200000
    AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45)"""
)
def filter_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    pages = o.select(F.col("o_orderkey").alias("page_id"), F.lit(0).alias("namespace"), F.col("o_orderpriority").alias("title"), (F.col("o_orderstatus") == "P").cast("int").alias("is_redirect"), F.floor("o_totalprice").alias("length"))
    return cat.filter_pages(pages, table(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("page_id")), 200000)


_GROUP_SQL = " UNION ALL ".join(f"SELECT '{stem}' AS stem, p_partkey, p_name FROM part WHERE " + " OR ".join(f"regexp_matches(p_name, '{p}', 'i')" for p in patterns) for stem, patterns in GROUPS)


@query(f"WITH g AS ({_GROUP_SQL}) SELECT DISTINCT stem, l_orderkey AS page_id FROM g JOIN lineitem ON l_partkey = p_partkey")
def group_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = cat.tag_groups(_named_parts(spark, sf_dir).select("name").distinct(), GROUPS)
    return cat.group_articles(_part_members(spark, sf_dir), tagged)


@query(
    f"""WITH g AS ({_GROUP_SQL}), a AS (SELECT DISTINCT stem, l_orderkey AS page_id FROM g JOIN lineitem ON l_partkey = p_partkey)
    SELECT a.stem, max(n)::BIGINT AS categories, count(*)::BIGINT AS articles, (count(*) FILTER (WHERE o_totalprice >= 250000))::BIGINT AS targets
    FROM a JOIN orders ON o_orderkey = page_id JOIN (SELECT stem, count(DISTINCT p_name) AS n FROM g GROUP BY stem) c ON c.stem = a.stem GROUP BY a.stem"""
)
def group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: search by group, collect, filter by length, count."""
    tagged = cat.tag_groups(_named_parts(spark, sf_dir).select("name").distinct(), GROUPS)
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), F.col("o_totalprice").alias("length"))
    articles = cat.group_articles(_part_members(spark, sf_dir), tagged)
    return reports.group_stats(tagged, articles, cat.long_enough(orders, 250000))


@query(f"WITH RECURSIVE {_GRAPH_SQL} SELECT name, depth::INT AS depth FROM visited")
def bfs_visited(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cat.traverse(_graph(spark, sf_dir)[0], "root")


@query(f"WITH RECURSIVE {_GRAPH_SQL} SELECT s.parent, s.child FROM sub s JOIN visited v ON v.name = s.parent WHERE v.depth < 2")
def bfs_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, _ = _graph(spark, sf_dir)
    return cat.expanded(sub, cat.traverse(sub, "root", 2), 2)


@query(
    f"""WITH RECURSIVE {_GRAPH_SQL}, seen AS (SELECT page_id, min(depth) AS depth FROM members JOIN visited ON category = name GROUP BY page_id),
    lv AS (SELECT depth, count(*) AS categories FROM visited GROUP BY depth), ar AS (SELECT depth, count(*) AS articles FROM seen GROUP BY depth)
    SELECT depth::INT AS depth, categories::BIGINT AS categories, coalesce(articles, 0)::BIGINT AS articles, sum(categories) OVER (ORDER BY depth)::BIGINT AS all_categories,
    sum(coalesce(articles, 0)) OVER (ORDER BY depth)::BIGINT AS all_articles FROM lv LEFT JOIN ar USING (depth)"""
)
def bfs_depth_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, members = _graph(spark, sf_dir)
    return cat.depth_stats(cat.traverse(sub, "root"), members)


@query(f"WITH RECURSIVE {_GRAPH_SQL} SELECT DISTINCT page_id FROM members JOIN visited ON category = name WHERE depth <= 1")
def bfs_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, members = _graph(spark, sf_dir)
    return cat.reached_articles(members, cat.traverse(sub, "root", 1))


@query(f"WITH RECURSIVE {_GRAPH_SQL}, seen AS (SELECT page_id, min(depth) AS depth FROM members JOIN visited ON category = name GROUP BY page_id) SELECT page_id FROM seen WHERE depth = 2")
def bfs_new_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    sub, members = _graph(spark, sf_dir)
    return cat.new_at_depth(cat.traverse(sub, "root", 2), members, 2)


@query("SELECT c_custkey AS page_id, c_name AS title FROM customer WHERE replace(c_name, 'Customer', '') IN (SELECT replace(s_name, 'Supplier', '') FROM supplier)")
def title_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of one wiki that another has: customers and suppliers of one number."""
    one = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("page_id"), F.col("c_name").alias("title"))
    other = table(spark, sf_dir, "supplier").select(F.replace("s_name", F.lit("Supplier"), F.lit("Customer")).alias("title"))
    return cat.shared_titles(one, other)


# --- archives ------------------------------------------------------------------------------------


@query(
    """WITH b AS (SELECT DISTINCT epoch_us(ts) // 1000000 * 1000 AS off FROM events), m AS (SELECT off, off // 50000000 AS stripe,
    off - lag(off) OVER (PARTITION BY off // 50000000 ORDER BY off) > 100000 AS new FROM b)
    SELECT off AS "offset", sum(coalesce(new, FALSE)::INT) OVER (PARTITION BY stripe ORDER BY off)::BIGINT AS batch, stripe FROM m"""
)
def block_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    offset = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000000) * 1000
    blocks = table(spark, sf_dir, "events").select(offset.alias("offset")).distinct()
    return batches_of(blocks, 100_000, 50_000_000).select("offset", "batch", "stripe")


@query(
    """SELECT o_custkey * 100 AS "offset", count(DISTINCT o_orderkey)::BIGINT AS pages, 0::BIGINT AS missing FROM orders WHERE o_orderkey % 3 = 0 GROUP BY o_custkey
    UNION ALL SELECT -1, 0, 2"""
)
def block_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), (F.col("o_custkey") * 100).alias("offset"), F.col("o_orderpriority").alias("title"))
    targets = index.where("page_id % 3 = 0").select("page_id").unionByName(spark.sql("SELECT * FROM VALUES (-1L), (-2L) AS t(page_id)"))
    blocks = blocks_of(targets, index).select("offset", F.size("page_ids").cast("long").alias("pages"), F.lit(0).cast("long").alias("missing"))
    misses = missing_from(targets, index).agg(F.count("*").alias("missing")).select(F.lit(-1).cast("long").alias("offset"), F.lit(0).cast("long").alias("pages"), "missing")
    return blocks.unionByName(misses)


def _content(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Documents as targets, and an infobox for those that have a label."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    targets = docs.select(F.col("doc_id").alias("page_id"), say("Page_no_", F.col("doc_id")).alias("title"), F.coalesce("n_chars", F.lit(0)).alias("length"))
    box = say("{{Infobox settlement|population=1,00", F.col("quality"), "}}")
    return targets, labels.select(say("Page no ", F.col("doc_id")).alias("title"), box.alias("wikitext"), say("It has ", F.col("quality"), " words").alias("plaintext"))


_CONTENT_SQL = """SELECT d.doc_id AS page_id, 'Page no ' || d.doc_id AS title, '100' || l.quality AS population, coalesce(d.n_chars, 0)::BIGINT AS article_bytes,
    CASE WHEN l.doc_id IS NULL THEN 0 ELSE 4 END::BIGINT AS word_count FROM documents d"""


@query(f"{_CONTENT_SQL} LEFT JOIN labels l USING (doc_id)")
def content_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all documents, also of those without content."""
    return records(*_content(spark, sf_dir), "geo", ("population",))


@query(f"{_CONTENT_SQL} JOIN labels l USING (doc_id)")
def content_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the documents that have content."""
    return records(*_content(spark, sf_dir), "geo", ("population",), how="inner")


def _articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, title, xml`` of a page for every document: every ninth is a category, every seventh empty."""
    d, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    text = F.when(k % 7 == 0, "").otherwise(say("&lt;b&gt;", F.md5(F.coalesce("text", F.lit(""))), "&lt;/b&gt; of [[", F.col("source"), "]]"))
    title, namespace = say("P:", k), F.when(k % 9 == 0, "14").otherwise("0")
    xml = say("<page><title>", title, "</title><ns>", namespace, "</ns><id>", k, '</id><revision><id>1</id><text bytes="1">', text, "</text></revision></page>")
    return d.select(k.alias("page_id"), title.alias("title"), xml.alias("xml"))


_ARTICLES_SQL = "SELECT doc_id AS page_id, 'P:' || doc_id AS title, '<b>' || md5(coalesce(text, '')) || '</b> of [[' || coalesce(source, '') || ']]' AS wikitext FROM documents WHERE doc_id % 7 <> 0 AND doc_id % 9 <> 0"


def _multistream(spark: SparkSession, sf_dir: str, folder: str) -> DataFrame:
    """Archives of 50 pages a block, one each task, in ``folder``; ``archive, offset, page_id, title`` as their indexes say."""

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = pyarrow.fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, at, rows = f"{uuid.uuid4().hex}.xml.bz2", 0, []
        with files.open_output_stream(f"{base}/{name}", compression=None) as out:
            for batch in source:
                for a in range(0, batch.num_rows, 50):
                    part = batch.slice(a, 50)
                    block = bz2.compress("\n".join(part["xml"].to_pylist()).encode())
                    rows += [(name, at, i, t) for i, t in zip(part["page_id"].to_pylist(), part["title"].to_pylist(), strict=True)]
                    at += out.write(block)
        yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], ["archive", "offset", "page_id", "title"])

    pages = _articles(spark, sf_dir).repartition(3, "page_id").sortWithinPartitions("page_id")
    return stored(pages.mapInArrow(write, "archive string, offset long, page_id long, title string"), "index")


@query(f"{_ARTICLES_SQL} AND doc_id % 2 = 0")
def multistream_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other page read back from the archives of three tasks through their indexes."""
    folder = f"{shared_root(spark)}/archives-{uuid.uuid4().hex}"
    index = _multistream(spark, sf_dir, folder)
    lines = index.select("archive", say(F.col("offset"), ":", F.col("page_id"), ":", F.col("title")).alias("value"))
    wanted = table(spark, sf_dir, "documents").where("doc_id % 2 = 0").select(F.col("doc_id").alias("page_id"))
    names = [r.archive for r in index.select("archive").distinct().collect()]  # a few
    parts = [read_multistream(wanted, parse_index(lines.where(F.col("archive") == n)), f"{folder}/{n}") for n in names]
    return reduce(DataFrame.unionByName, parts)


@query(_ARTICLES_SQL)
def xml_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages of an XML archive, read whole."""
    path = f"{shared_root(spark)}/xml-{uuid.uuid4().hex}"
    _articles(spark, sf_dir).select("xml").write.text(path)
    return read_xml(spark, path)


@query("SELECT n_nationkey::BIGINT AS lt_id, n_name AS name FROM nation WHERE n_regionkey <> 1")
def link_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    row = say("(", F.col("n_nationkey"), ",", F.when(F.col("n_regionkey") != 1, "14").otherwise("0"), ",'", F.col("n_name"), "')")
    return dumps.link_targets(dumps.inserts(n.select(say("INSERT INTO `linktarget` VALUES ", row, ";").alias("value")), "linktarget"))


# --- text ----------------------------------------------------------------------------------------


def _sql_chain(text: str, steps: list[tuple[str, str, str]]) -> str:
    for pattern, to, flags in steps:
        text = f"regexp_replace({text}, '{pattern}', '{to}', '{flags}')"
    return text


_PLAIN_SQL = _sql_chain(
    "w",
    [
        (r"<!--.*?-->", "", "gs"),
        (r"<ref[^>]*>.*?</ref>|<ref[^/]*/?>", "", "gs"),
        (r"\[\[Category:[^\]]*\]\]", "", "gi"),
        (r"\[\[(?:File|Image):[^\]]*\]\]", "", "gi"),
        *[(r"\{\{[^{}]*\}\}", "", "g")] * 3,
        (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", r"\1", "g"),
        (r"\[https?://[^\s\]]+(?: ([^\]]*))?\]", r"\1", "g"),
        (r"<[^>]+>", "", "g"),
        (r"''{2,5}", "", "g"),
        (r"(?m)^=+\s*(.*?)\s*=+$", r"\1", "g"),
        (r"\n{3,}", "\n\n", "g"),
        (r" {2,}", " ", "g"),
        (r"^\s+|\s+$", "", "g"),
    ],
)


@query(
    f"""WITH x AS (SELECT doc_id, '== ' || source || ' ==' || chr(10) || '<!-- no --><ref name="a">r</ref>''''''' || lang || ''''''' [[Link ' || doc_id || '|label]] {{{{a|{{{{b}}}}}}}} [https://x.org site] [[File:f.png|thumb]]'
    || chr(10) || chr(10) || chr(10) || coalesce(text, '') || ' [[Category:C]]' AS w FROM documents) SELECT doc_id, md5({_PLAIN_SQL}) AS text_md5 FROM x"""
)
def strip_markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = dealt_out(spark, table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text"))
    wiki = say("== ", F.col("source"), ' ==\n<!-- no --><ref name="a">r</ref>\'\'\'', F.col("lang"), "''' [[Link ", F.col("doc_id"), "|label]] {{a|{{b}}}} [https://x.org site] [[File:f.png|thumb]]\n\n\n", F.col("text"), " [[Category:C]]")
    return docs.select("doc_id", F.md5(plaintext(wiki)).alias("text_md5"))


@query(r"SELECT doc_id, len(list_filter(string_split_regex(coalesce(text, ''), '\s+'), lambda x: x <> ''))::BIGINT AS words FROM documents")
def plain_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", word_count(F.col("text")).alias("words"))


@query(
    """SELECT c_custkey AS id, lower('x ' || c_mktsegment || ' y') || ', ' || lower(c_name) AS title_key,
    'https://en.wikipedia.org/wiki/' || replace(replace('X_' || c_mktsegment || '_Y_County,__' || c_name, ' ', '_'), '#', '%23') AS url FROM customer"""
)
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    title = say("X_", F.col("c_mktsegment"), "_Y County,  ", F.col("c_name"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), title_key(title).alias("title_key"), article_url(title).alias("url"))


_MONTH_FORMS = (
    # o_orderkey % 16: how the date is written, and what it reads as (DuckDB)
    ("d 'of' MMMM, yyyy", "strftime(d, '%Y-%m-%d')"),
    ("MMMM d, yyyy", "strftime(d, '%Y-%m-%d')"),
    ("yyyy-M-d", "strftime(d, '%Y-%m-%d')"),
    ("dd.MM.yyyy", "strftime(d, '%Y-%m-%d')"),
    ("MMMM yyyy", "strftime(d, '%Y-%m')"),
    ("'c. 'yyyy", "'c. ' || strftime(d, '%Y')"),
    ("yyyy' BC'", "strftime(d, '%Y') || ' BC'"),
    ("MMMM d, yyyy' (aged 72)'", "strftime(d, '%Y-%m-%d')"),
    ("yyyy'/42'", "strftime(d, '%Y')"),
    ("'early 'yyyy's'", "strftime(d, '%Y') || '-01-01'"),
    ("MMMM d", "'9999-' || strftime(d, '%m-%d')"),
    ("'Possibly 'd MMMM yyyy' or later'", "strftime(d, '%Y-%m-%d')"),
    ("d'th 'MMMM yyyy", "strftime(d, '%Y-%m-%d')"),
    ("yyyy'}} ()}}'", "strftime(d, '%Y')"),
    ("'unknown'", "NULL"),
    ("yyyy', 'yyyy", "strftime(d, '%Y')"),
)


def _written(day: Column, key: Column) -> Column:
    text = F.lit(None).cast("string")
    for n, (form, _) in enumerate(_MONTH_FORMS):
        text = F.when(key % len(_MONTH_FORMS) == n, F.date_format(day, form)).otherwise(text)
    return text


@query(
    "WITH x AS (SELECT o_orderkey, o_orderdate AS d, o_orderkey % 16 AS k FROM orders) SELECT o_orderkey AS id, CASE "
    + " ".join(f"WHEN k = {n} THEN {sql}" for n, (_, sql) in enumerate(_MONTH_FORMS))
    + " END AS date, CASE WHEN k = 9 THEN '~early ' || strftime(d, '%Y') || 's' WHEN k = 10 THEN '~' || strftime(d, '%B %-d') || ' (no year)' END AS note FROM x"
)
def normalize_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("x", normalise_with_note(_written(F.col("o_orderdate"), F.col("o_orderkey"))))
    return o.select(F.col("o_orderkey").alias("id"), "x.date", "x.note")


@query(
    """WITH x AS (SELECT c_custkey AS k, c_custkey % 20 + 1 AS c FROM customer) SELECT k AS id, lpad(((c - 1) * 100 + 1)::VARCHAR, 4, '0') || '-01-01' AS date,
    '~' || CASE WHEN k % 3 = 0 THEN c || ' century' WHEN k % 3 = 1 THEN 'c. ' || c || 'th century' ELSE c || 'th-century' END AS note FROM x"""
)
def centuries(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    c = k % 20 + 1
    raw = F.when(k % 3 == 0, say(c, " century")).when(k % 3 == 1, say("c. ", c, "th century")).otherwise(say(" ", c, "th-century "))
    return table(spark, sf_dir, "customer").select(k.alias("id"), normalise_with_note(raw).alias("x")).select("id", "x.date", "x.note")


@query(
    """SELECT o_orderkey AS id, strftime(o_orderdate, '%Y-%m-%d') AS date FROM orders"""
)
def date_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    numbers = say("before {{Birth date and age|df=y|", F.year(d), "|", F.month(d), "|", F.dayofmonth(d), "}} after")
    words = say("{{x}}{{start date|", F.date_format(d, "MMMM d, yyyy"), "|{{nested}}}}")
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), template_date(F.when(F.col("o_orderkey") % 2 == 0, numbers).otherwise(words)).alias("date"))


def _infobox_query(mode: str) -> None:
    """An infobox of every customer: each field by one of its aliases, the first of them blank for some."""
    spec: Infobox = MODES[mode]
    wanted = FIELDS[mode]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        key, name, segment = F.col("c_custkey"), F.col("c_name"), F.col("c_mktsegment")
        parts: list[Column | str] = ["Text {{other|x=1}} before {{ ", spec.names[0].title(), "\n"]
        for n, f in enumerate(wanted):
            aliases = spec.aliases[f]
            value = say("'''[[", name, "|", segment, "]]''' <ref>r</ref> {{tpl|a={{b}}}}&nbsp;", key + n)
            if f in spec.dates:
                value = say("{{start date|", F.lit(1900) + key % 100, "|", key % 12 + 1, "|", F.lit(n + 1), "}} text")
            elif f in spec.numbers:
                value = say("1,", F.lit(100) + key % 900, " ")
            parts += [f"| {aliases[0]} = ", F.when(key % 2 == 0, value).otherwise(F.lit("<!-- -->" if f not in spec.dates else "")), "\n"]
            if len(aliases) > 1:
                parts += [f"|{aliases[-1]}=", F.when(key % 2 == 1, value).otherwise(F.lit("second")), "\n"]
        wiki = say(*parts, "}} after '''", name, "'''")
        customers = dealt_out(spark, table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))
        got = customers.withColumn("x", fields(wiki, spec, wanted))
        return got.select(F.col("c_custkey").alias("id"), "x.*")

    columns = []
    for n, f in enumerate(wanted):
        value = f"c_mktsegment || ' ' || (c_custkey + {n})"
        if f in spec.dates:
            value = f"(1900 + c_custkey % 100) || '-' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || '-' || lpad('{n + 1}', 2, '0')"
        elif f in spec.numbers:
            value = "'1' || (100 + c_custkey % 900)"
        odd = value if len(spec.aliases[f]) > 1 else "NULL"
        columns.append(f"CASE WHEN c_custkey % 2 = 0 THEN {value} ELSE {odd} END AS {f}")
    run.__name__ = f"infobox_{mode}"
    query(f"SELECT c_custkey AS id, {', '.join(columns)} FROM customer")(run)


for _mode in MODES:
    _infobox_query(_mode)


@query(
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 <> 2 OR c_custkey % 2 = 0 THEN (1900 + c_custkey % 100) || '-' || lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') || '-09' END AS birth_date,
    CASE WHEN c_custkey % 3 <> 2 OR c_custkey % 2 = 0 THEN c_name END AS nationality, CASE WHEN c_custkey % 3 <> 2 OR c_custkey % 2 = 0 THEN c_mktsegment END AS occupation FROM customer"""
)
def infobox_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infoboxes among, within and around templates that nest up to 200 levels deep; every third one is not, but for the braces of a template around it."""
    key = F.col("c_custkey")
    depth = (key % 201).cast("int")
    wrap = lambda text: F.concat(F.repeat(F.lit("{{t|k="), depth), text, F.repeat(F.lit("}}"), depth))
    born = wrap(say("{{birth date|", F.lit(1900) + key % 100, "|", key % 12 + 1, "|9|df={{yes}}}}"))
    box = say("{{infobox person |note= ", wrap(F.lit("[[a|b]]|c")), " |birth_date = ", born, " |nationality=", F.col("c_name"), "|last={{x|", wrap(F.lit("y")), "}}|occupation = ", F.col("c_mktsegment"), F.when(key % 3 != 2, " }}").otherwise(" {{ }}"))
    wiki = say("{{never closed|", wrap(F.lit("z")), F.when(key % 2 == 0, say("{{wrapper|of=", box, "}}")).otherwise(box), " text")
    customers = dealt_out(spark, table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"))
    wanted = ("birth_date", "nationality", "occupation")
    return customers.select(key.alias("id"), fields(wiki, MODES["bio"], wanted).alias("x")).select("id", "x.*")


_NATIONS = ("french", "german", "new zealand", "south african", "austro-hungarian")
_TRADES = ("painter", "theoretical physicist", "singer-songwriter", "poet and novelist", "politician")
_TRADE_RESULTS = ("painter", "theoretical physicist", "singer-songwriter", "poet, novelist", "politician")
_NATION_RESULTS = ("French", "German", "New Zealand", "South African", "Hungarian, Austro-hungarian")


def _pick(values: tuple[str, ...], n: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (n % len(values) + 1).cast("int"))


def _sql_pick(values: tuple[str, ...], n: str) -> str:
    return f"[{', '.join(repr(v) for v in values)}][({n} % {len(values)} + 1)::INT]"


def _life(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first sentence of every order: dates in five styles, a nationality, an occupation."""
    o = dealt_out(spark, table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"))
    k, d = F.col("o_orderkey"), F.col("o_orderdate")
    born, died = F.date_format(d, "d MMMM yyyy"), F.date_format(F.date_add(F.to_date(d), 20000), "MMMM d, yyyy")
    life = (
        F.when(k % 5 == 0, say("(", born, " – ", died, ")"))
        .when(k % 5 == 1, say("(born ", born, ")"))
        .when(k % 5 == 2, say("(", born, " in Town – ", died, " or ", F.lit("1700"), ")"))
        .when(k % 5 == 3, say("(born c. ", F.year(d), " – ", died, "; aged 54)"))
        .otherwise(F.lit("(no dates)"))
    )
    text = say("Person ", k, " ", life, " was a ", F.initcap(_pick(_NATIONS, k)), " ", _pick(_TRADES, F.floor(k / 5)), " who lived.\n\nLater (1500 – 1600) he was a Danish king.")
    return o.select(k.alias("id"), F.when(k % 11 == 10, say("Person ", k, " of Polish descent.")).otherwise(text).alias("text"))


_LIFE_SQL = "SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m-%d') AS born, strftime(o_orderdate, '%Y') AS y, strftime(o_orderdate::DATE + 20000, '%Y-%m-%d') AS died FROM orders"


@query(
    f"""WITH x AS ({_LIFE_SQL}) SELECT k AS id, CASE WHEN k % 11 = 10 OR k % 5 = 4 THEN NULL WHEN k % 5 = 3 THEN 'c. ' || y ELSE born END AS birth_date,
    CASE WHEN k % 11 = 10 OR k % 5 IN (1, 4) THEN NULL ELSE died END AS death_date FROM x"""
)
def bio_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return biography.told(_life(spark, sf_dir), F.col("text"), ("birth_date", "death_date")).drop("text")


@query(f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 10 THEN 'Polish' ELSE {_sql_pick(_NATION_RESULTS, 'o_orderkey')} END AS nationality FROM orders")
def bio_nationality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return biography.told(_life(spark, sf_dir), F.col("text"), ("nationality",)).drop("text")


@query(f"SELECT o_orderkey AS id, CASE WHEN o_orderkey % 11 = 10 THEN NULL ELSE {_sql_pick(_TRADE_RESULTS, 'o_orderkey // 5')} END AS occupation FROM orders")
def bio_occupation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return biography.told(_life(spark, sf_dir), F.col("text"), ("occupation",)).drop("text")


@query(
    """SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'It was named after ' || p_name || ' of ' || p_brand || ' long ago.'
    WHEN p_partkey % 3 = 1 THEN 'Its name means ' || p_name || ' in the old tongue' END AS etymology FROM part"""
)
def etymology_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("p_partkey"), F.col("p_name")
    text = F.when(k % 3 == 0, say("A place. It was named after ", name, " of ", F.col("p_brand"), " long ago. More.")).when(k % 3 == 1, say("A place. Its name means ", name, " in the old tongue")).otherwise(F.lit("A place. Named for X."))
    return table(spark, sf_dir, "part").select(k.alias("id"), from_lead(text).alias("etymology"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 4 <> 3 THEN 'From ' || p_name || ' and ' || p_type || '. Second line.' END AS etymology FROM part")
def etymology_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    heading = F.element_at(F.array(*map(F.lit, ("==Etymology==", "=== Origin of the name ===", "== Naming ==", "== History =="))), (k % 4 + 1).cast("int"))
    wiki = say("Lead text.\n", heading, "\n{{main|x}}From '''", F.col("p_name"), "''' and [[t|", F.col("p_type"), "]].<ref>r</ref>\n\nSecond line.\n== Other ==\nNo.")
    return table(spark, sf_dir, "part").select(k.alias("id"), from_section(wiki).alias("etymology"))


def _two_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Infoboxes that lack what the text says, by turns."""
    lives = _life(spark, sf_dir)
    k = F.col("id")
    box = say("{{Infobox person|nationality=", F.when(k % 2 == 0, "Danish").otherwise(""), "|occupation=", F.when(k % 3 == 0, "[[x|Baker]]").otherwise(""), "}}")
    return lives.select("id", F.when(k % 4 < 3, box).otherwise("no box").alias("wikitext"), F.when(k % 7 < 6, F.col("text")).alias("plaintext"))


_TIER_SQL = f"""x AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 < 3 AND o_orderkey % 2 = 0 THEN 'Danish' END AS bn, CASE WHEN o_orderkey % 4 < 3 AND o_orderkey % 3 = 0 THEN 'Baker' END AS bo,
  CASE WHEN o_orderkey % 7 < 6 THEN CASE WHEN o_orderkey % 11 = 10 THEN 'Polish' ELSE {_sql_pick(_NATION_RESULTS, 'o_orderkey')} END END AS tn,
  CASE WHEN o_orderkey % 7 < 6 AND o_orderkey % 11 <> 10 THEN {_sql_pick(_TRADE_RESULTS, 'o_orderkey // 5')} END AS tc FROM orders)"""


@query(f"WITH {_TIER_SQL} SELECT id, coalesce(bn, tn) AS nationality, coalesce(bo, tc) AS occupation FROM x")
def tiered_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiered(_two_tiers(spark, sf_dir), "bio", ("nationality", "occupation")).select("id", "nationality", "occupation")


@query(
    f"""WITH {_TIER_SQL}, y AS ({_LIFE_SQL}), z AS (SELECT id, floor(o_totalprice)::BIGINT AS article_bytes FROM x JOIN orders ON o_orderkey = id WHERE o_totalprice >= 100000)
    SELECT z.id AS page_id, 'T ' || z.id AS title,
    CASE WHEN k % 9 = 8 OR k % 7 = 6 OR k % 11 = 10 OR k % 5 = 4 THEN NULL WHEN k % 5 = 3 THEN 'c. ' || y ELSE born END AS birth_date,
    CASE WHEN k % 9 = 8 OR k % 7 = 6 OR k % 11 = 10 OR k % 5 IN (1, 4) THEN NULL ELSE died END AS death_date, CASE WHEN k % 9 < 8 THEN coalesce(bn, tn) END AS nationality,
    CASE WHEN k % 9 < 8 THEN coalesce(bo, tc) END AS occupation, NULL::VARCHAR AS birth_date_note, NULL::VARCHAR AS death_date_note, article_bytes
    FROM z JOIN x ON x.id = z.id JOIN y ON k = z.id"""
)
def bio_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of long orders; every ninth has no content and stays with empty fields."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("page_id"), say("T_", F.col("o_orderkey")).alias("title"), F.floor("o_totalprice").alias("length"))
    content = _two_tiers(spark, sf_dir).where("id % 9 < 8").select(say("T ", F.col("id")).alias("title"), "wikitext", "plaintext")
    return records(cat.long_enough(orders, 100000), content, "bio").drop("word_count")


@query(
    f"""WITH {_TIER_SQL} SELECT CASE WHEN bn IS NOT NULL OR bo IS NOT NULL THEN CASE WHEN tn IS NOT NULL OR tc IS NOT NULL THEN 'infobox+text' ELSE 'infobox' END
    WHEN tn IS NOT NULL OR tc IS NOT NULL THEN 'text' ELSE 'none' END AS tier, count(*)::BIGINT AS articles FROM x GROUP BY 1"""
)
def tier_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = ("nationality", "occupation")
    rows = biography.told(_two_tiers(spark, sf_dir), F.col("plaintext"), asked, "t_").withColumn("b", fields(F.col("wikitext"), MODES["bio"], asked))
    return reports.tier_mix(rows.select("b.*", "t_nationality", "t_occupation"), list(asked), [f"t_{f}" for f in asked])


@query(
    f"""WITH {_TIER_SQL}, c AS (SELECT count(*) AS n, count(coalesce(bn, tn)) AS a, count(coalesce(bo, tc)) AS b FROM x)
    SELECT 'nationality' AS field, a::BIGINT AS filled, n::BIGINT AS total, a / n AS rate FROM c UNION ALL SELECT 'occupation', b, n, b / n FROM c"""
)
def fill_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.fill_rates(tiered(_two_tiers(spark, sf_dir), "bio", ("nationality", "occupation")), ("nationality", "occupation"))


@query(
    """SELECT p_partkey AS page_id, p_partkey::VARCHAR AS title, CASE p_partkey % 3 WHEN 0 THEN 'From ' || p_name || '.' WHEN 1 THEN 'It was named after ' || p_name || ' long ago.' END AS etymology,
    p_size::BIGINT AS article_bytes, CASE WHEN p_partkey % 3 = 2 THEN 0 ELSE len(string_split(p_name, ' ')) + 8 END::BIGINT AS word_count FROM part"""
)
def etymology_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name's origin by its section, else by the lead; some articles have neither."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    targets = p.select(k.alias("page_id"), say(k).alias("title"), F.col("p_size").cast("long").alias("length"))
    section = F.when(k % 3 == 0, say("Lead.\n== Etymology ==\nFrom '''", F.col("p_name"), "'''.\n== Next ==\nNo.")).otherwise(F.lit("Lead.\n== History ==\nNone."))
    content = p.select(say(k).alias("title"), section.alias("wikitext"), F.when(k % 3 < 2, say("A place. It was named after ", F.col("p_name"), " long ago.")).alias("plaintext"))
    return records(targets, content, "etymology")


@query(
    f"""WITH {_TIER_SQL} SELECT id, coalesce(bn, tn, CASE WHEN id % 7 < 6 THEN 'Told' END) AS nationality, coalesce(bo, tc) AS occupation,
    id % 7 < 6 AND (coalesce(bn, tn) IS NULL OR coalesce(bo, tc) IS NULL) AS asked FROM x"""
)
def model_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model that answers every prompt: only records with gaps and text are asked, and only blank fields filled, by texts."""
    answer = F.lit('```json\n{"nationality": " Told ", "occupation": 3,}\n```')
    wanted = ("nationality", "occupation")
    rows = tiered(_two_tiers(spark, sf_dir), "bio", wanted).withColumn("asked", F.lit(False))
    model = lambda df, prompt: df.withColumn("asked", prompt.isNotNull()).withColumn("reply", F.when(F.col("asked"), answer))
    return fill_by_model(rows, wanted, model).select("id", *wanted, "asked")


# --- regions -------------------------------------------------------------------------------------


def _regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as regions; those of equal remainder by 20 share a key."""
    n = table(spark, sf_dir, "nation")
    key = title_key(say("Place ", F.col("n_nationkey") % 20, " County, Land"))
    return n.select(say("G.", F.col("n_nationkey")).alias("gid"), key.alias("key"), F.lit("a.json").alias("source"), F.col("n_nationkey").alias("place"))


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    return s.select(say("Place_", k % 23, ", Land").alias("title"), F.when(k % 2 == 0, say(F.round("s_acctbal").cast("long"))).otherwise("").alias("population"), F.lit("x").alias("word_count"), k.alias("row_at"))


_JOIN_SQL = """r AS (SELECT s_suppkey AS k, 'Place_' || s_suppkey % 23 || ', Land' AS title, CASE WHEN s_suppkey % 2 = 0 THEN round(s_acctbal)::BIGINT::VARCHAR ELSE '' END AS population, s_suppkey % 23 AS m FROM supplier),
w AS (SELECT *, row_number() OVER (PARTITION BY m ORDER BY k) AS n, first_value(title) OVER (PARTITION BY m ORDER BY k) AS winner FROM r WHERE m < 20)"""


@query(
    f"""WITH {_JOIN_SQL} SELECT 'G.' || m AS gid, k AS row_at, title, nullif(population, '') AS population, 'https://en.wikipedia.org/wiki/' || replace(title, ' ', '_') AS wikipedia_url FROM w WHERE n = 1"""
)
def geo_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = join_regions(_results(spark, sf_dir), first_of_key(_regions(spark, sf_dir))[0])
    return entries(joined.matched).select("gid", "row_at", "entry.*")


@query(f"WITH {_JOIN_SQL} SELECT title, population, 'x' AS word_count, k AS row_at FROM r WHERE m >= 20")
def geo_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_regions(_results(spark, sf_dir), first_of_key(_regions(spark, sf_dir))[0]).unmatched


@query(f"WITH {_JOIN_SQL} SELECT 'G.' || m AS gid, winner AS winner_title, title AS loser_title FROM w WHERE n > 1")
def geo_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_regions(_results(spark, sf_dir), first_of_key(_regions(spark, sf_dir))[0]).collisions


@query("SELECT 'place ' || n_nationkey % 20 || ', land' AS key, 'G.' || n_nationkey % 20 AS winner_gid, 'G.' || n_nationkey AS loser_gid, 'a.json' AS source FROM nation WHERE n_nationkey >= 20")
def region_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_of_key(_regions(spark, sf_dir))[1]


@query(
    f"""WITH {_JOIN_SQL} SELECT 'G.' || m AS gid, title, nullif(population, '') AS population, 'https://en.wikipedia.org/wiki/' || replace(title, ' ', '_') AS wikipedia_url FROM w WHERE n = 1"""
)
def keyed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published document, read back."""
    path = f"{shared_root(spark)}/json-{uuid.uuid4().hex}"
    joined = join_regions(_results(spark, sf_dir), first_of_key(_regions(spark, sf_dir))[0])
    write_keyed_json(stored(entries(joined.matched), "entries"), path)
    read = F.from_json("value", "map<string, struct<title: string, population: string, wikipedia_url: string>>")
    whole = spark.read.text(path, wholetext=True).where("length(value) > 0")
    return whole.select(F.explode(read).alias("gid", "entry")).select("gid", "entry.*")


@query("SELECT s_suppkey::VARCHAR AS id, s_name || ', \"' || s_nationkey || chr(10) || '\"' AS name, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_nationkey::VARCHAR END AS nation FROM supplier")
def delimited_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results written as delimited text and read back: quotes, commas, line feeds, and nulls as nothing."""
    s = table(spark, sf_dir, "supplier")
    path = f"{shared_root(spark)}/csv-{uuid.uuid4().hex}"
    name = say(F.col("s_name"), ', "', F.col("s_nationkey"), '\n"')
    write_delimited(s.select(F.col("s_suppkey").alias("id"), name.alias("name"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_nationkey")).alias("nation")), path)
    return read_results(spark, path).drop("row_at")


def _books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of workbooks of suppliers, one or more for each nation, read back from the files."""
    both = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rows = both.select("n_name", "s_suppkey", "s_name", "s_acctbal", F.when(F.col("s_suppkey") % 4 != 0, say("a<&>\"b\n", F.col("s_suppkey"))).alias("note"))
    folder = f"{shared_root(spark)}/xlsx-{uuid.uuid4().hex}"
    write_workbooks(rows.repartitionByRange("n_name", "s_name").sortWithinPartitions("n_name", "s_name"), folder, by="n_name")
    return read_workbooks(spark, folder)


@query(
    """SELECT n_name AS name, s_suppkey::BIGINT AS id, s_name AS title, round(s_acctbal, 2)::DOUBLE AS balance, CASE WHEN s_suppkey % 4 <> 0 THEN 'a<&>"b' || chr(10) || s_suppkey END AS note
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""
)
def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers, texts with markup in them, and empty cells come back from the files as they went in."""
    cell = lambda n: F.get("cells", F.lit(n))
    return _books(spark, sf_dir).where("row > 1").select("name", cell(0).cast("long").alias("id"), cell(1).alias("title"), F.round(cell(2).cast("double"), 2).alias("balance"), cell(3).alias("note"))


@query("SELECT r_name AS name, count(*)::BIGINT AS rows FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY r_name")
def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workbook of nations for every region, and the rows that the files hold."""
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = both.select("r_name", "n_nationkey", "n_name").repartitionByRange("r_name", "n_name").sortWithinPartitions("r_name", "n_name")
    folder = f"{shared_root(spark)}/xlsx-{uuid.uuid4().hex}"
    write_workbooks(rows, folder, by="r_name")
    return read_workbooks(spark, folder).where("row > 1").groupBy("name").agg(F.count("*").alias("rows"))


# --- services, files and whole runs --------------------------------------------------------------


def _told_of(url: str, asked: dict) -> dict:
    """A service that tells of each title but those that end in 0, in two parts."""
    titles = asked["titles"].split("|")
    part = titles[1::2] if "go" in asked else titles[::2]
    pages = [{"title": t, "extract": f"About {t}."} if not t.endswith("0") else {"title": t, "missing": True} for t in part]
    return {"query": {"pages": pages}} | ({} if "go" in asked or len(titles) < 2 else {"continue": {"go": "on"}})


@query("SELECT c_name AS title, 'About ' || c_name || '.' AS plaintext FROM customer WHERE c_name NOT LIKE '%0'")
def api_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of all customers by a paged interface, 50 titles a request."""
    titles = table(spark, sf_dir, "customer").select(F.col("c_name").alias("title"))
    return fetch_articles(titles.unionByName(titles.limit(5)), "api", _told_of, "plaintext", pause=0.001)


def _hears(url: str, asked: dict) -> object:
    """A model that finds what someone works as, and whose replies to every seventh are broken in one way or another."""
    key, trade = re.search(r"\((\d+)\) works as an? ([A-Z ]+)\.", asked["prompt"]).groups()
    match int(key) % 28:
        case 0:
            raise http.client.IncompleteRead(b"")
        case 7:
            return ["no reply"]
        case 14:
            raise ValueError("not JSON")
        case 21:
            return {"response": '{"occupation": 5}'}
    return {"response": json.dumps({"occupation": f" {trade.lower()} ", "nationality": "Martian"})}


@query(
    """SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'Thai' ELSE 'Martian' END AS nationality, lower(c_mktsegment) AS occupation FROM customer WHERE c_custkey % 7 <> 0
    UNION ALL SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Thai' END, NULL FROM customer WHERE c_custkey % 7 = 0"""
)
def model_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gaps filled by a model, some of whose replies fail; those records stay as they were."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 3 == 0, "Thai").alias("nationality"), F.lit(None).cast("string").alias("occupation"), say("Customer (", k, ") works as a ", F.col("c_mktsegment"), ".").alias("plaintext"))
    model = lambda df, prompt: ask_model(df, prompt, "model", "m", _hears, tries=1)
    return fill_by_model(rows, ("nationality", "occupation"), model).drop("plaintext")


def _local(spark: SparkSession, name: str) -> Path:
    """A new folder under the shared one, by its path."""
    folder = Path(shared_root(spark).removeprefix("file:")) / f"{name}-{uuid.uuid4().hex}"
    folder.mkdir(parents=True)
    return folder


@query("SELECT 'G.' || n_nationkey AS gid, replace(lower(n_name), '_', ' ') || ', ' || replace(lower(r_name), '_', ' ') AS key FROM nation JOIN region ON r_regionkey = n_regionkey WHERE n_nationkey % 6 <> 5")
def region_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of a file for each region, read back; those without a name drop out."""
    both = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = F.struct(say("G.", F.col("n_nationkey")).alias("GID_2"), F.when(F.col("n_nationkey") % 6 != 5, F.col("n_name")).otherwise("").alias("NAME_2"), F.col("r_name").alias("NAME_1"))
    files = both.groupBy("r_name").agg(F.lit("FeatureCollection").alias("type"), F.collect_list(F.struct(named.alias("properties"))).alias("features")).drop("r_name")
    folder = f"{shared_root(spark)}/geo-{uuid.uuid4().hex}"
    files.write.option("maxRecordsPerFile", 1).json(f"{folder}/regions")
    return read_regions(spark, folder).select("gid", "key")


@query("SELECT 'nation' AS name, n_nationkey::BIGINT AS key FROM nation WHERE n_nationkey % 2 = 0 UNION ALL SELECT 'region', r_regionkey FROM region")
def cache_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables of one snapshot, which took the place of an earlier one."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    cache = Cache(spark, _local(spark, "cache"), "xwiki")
    cache.save_all({"nation": nation, "region": region}, [])
    cache.save_all({"nation": nation.where("n_nationkey % 2 = 0"), "region": region}, [])
    held = cache.load_all(("nation", "region"), [])
    return reduce(DataFrame.unionByName, [held[n].select(F.lit(n).alias("name"), F.col(f"{n[0]}_{n}key").cast("long").alias("key")) for n in held])


_RUN_PATTERNS = {"visual_artists": ("(?:^|_)gear", "^small.*bolt"), "historians": ("widget",)}


@query(
    f"""WITH c AS (SELECT p_partkey AS k, replace(p_name, ' ', '_') || '_' || p_partkey AS name FROM part WHERE p_partkey % 3 = 0),
    g AS (SELECT k, stem FROM c, (VALUES {", ".join(f"('{stem}', '{'|'.join(p)}')" for stem, p in _RUN_PATTERNS.items())}) AS t(stem, regex) WHERE regexp_matches(name, regex, 'i'))
    SELECT stem, p_partkey::BIGINT AS page_id, p_name || ' ' || p_partkey AS title, (1900 + p_partkey % 90) || '-05-03' AS birth_date, p_brand AS nationality,
    CASE WHEN p_partkey % 2 = 0 THEN 'poet' WHEN p_partkey % 7 <> 0 THEN lower(p_type) END AS occupation, p_size::BIGINT * 100 AS article_bytes
    FROM part JOIN g ON k = p_partkey - p_partkey % 3 WHERE p_partkey % 3 <> 0 AND p_partkey % 7 <> 0 AND p_size >= 20"""
)
def whole_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From dumps, an archive and pattern files to the cells of each group's workbooks, with a model for what infoboxes lack."""
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    folder = _local(spark, "run")
    name = say(F.translate("p_name", " ", "_"), "_", k)
    target = say("INSERT INTO `linktarget` VALUES (", k, ",14,'", name, "');")
    link = say("INSERT INTO `categorylinks` VALUES (", k, ",'key','2024','p','page',1,", k - k % 3, ");")
    for dump, lines in (("page", _page_lines(spark, sf_dir)), ("linktarget", p.where(k % 3 == 0).select(target)), ("categorylinks", p.where(k % 3 != 0).select(link))):
        lines.write.option("compression", "gzip").text(f"file://{folder}/xwiki-latest-{dump}.sql.gz")
    box = say("{{Infobox person|birth_date=3 May ", F.lit(1900) + k % 90, "|nationality=", F.col("p_brand"), F.when(k % 2 == 0, "|occupation=poet").otherwise(""), "}} Part (", k, ") works as a ", F.upper("p_type"), ".")
    page = say("<page><title>", F.col("p_name"), " ", k, "</title><ns>0</ns><id>", k, "</id><revision><text>", box, "</text></revision></page>")
    p.select(page).write.text(f"file://{folder}/{archive_name('xwiki', 'xml')}")
    (folder / "patterns").mkdir()
    for stem, patterns in _RUN_PATTERNS.items():
        (folder / "patterns" / f"{stem}.txt").write_text("\n".join((*patterns, "", " ")))
    config = parse_args(["--all", str(folder / "patterns"), "--wiki", "xwiki", "--data-dir", str(folder), "--results-dir", str(folder / "results"), "--min-page-length", "2000", "--no-multistream"])
    run(spark, config, lambda rows, prompt: ask_model(rows, prompt, "model", "m", _hears, tries=1))
    books = read_workbooks(spark, str(folder / "results"))
    header = books.where("row = 1").first()["cells"]
    cell = {h: F.get("cells", F.lit(n)) for n, h in enumerate(header)}
    number = lambda c: cell[c].cast("long").alias(c)
    return books.where("row > 1").select(F.col("name").alias("stem"), number("page_id"), cell["title"].alias("title"), *[cell[f].alias(f) for f in ("birth_date", "nationality", "occupation")], number("article_bytes"))


# --- model replies and reports -------------------------------------------------------------------


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE event_type END AS kind, NULL::VARCHAR AS amount FROM events"""
)
def json_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, e = F.col("event_id"), F.col("event_type")
    body = say('{"kind": " ', e, ' ", "amount": ', F.col("value"))
    reply = F.when(k % 4 == 0, say("```json\n", body, "}\n```")).when(k % 4 == 1, say(body, ',}')).when(k % 4 == 2, say(body, "}")).otherwise(say(body, " and no more"))
    return table(spark, sf_dir, "events").select("event_id", text_field(reply, "kind").alias("kind"), text_field(reply, "amount").alias("amount"))


@query("SELECT count(*)::BIGINT AS articles, floor(count(*) * 0.3)::BIGINT AS text_tier, floor(count(*) * 0.1)::BIGINT AS model_tier, floor(count(*) * 0.1)::BIGINT * 0.001::DOUBLE AS model_cost FROM documents")
def dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.dry_run(table(spark, sf_dir, "documents"))


@query("SELECT page_id, url FROM pages ORDER BY md5(page_id || ':42'), page_id LIMIT 100")
def page_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.sample(table(spark, sf_dir, "pages").select("page_id", "url"), 100)
