"""The category graph: edges from link tables, search by pattern, and traversal by levels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.literals import beginnings, joined, required, trie
from ..functions.text import ANY_CASE
from ..storage import checkpointed


#: Fewer beginnings of patterns are tried on every name at once.
FEW = 4


def edges(links: DataFrame, targets: DataFrame, categories: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct ``parent, child`` of subcategories and ``category, page_id`` of members.

    Links to unknown targets drop out, and so do subcategories that are unknown or have no name.
    """
    named = links.where(F.col("kind").isin("subcat", "page")).join(targets, F.col("target_id") == F.col("lt_id")).select("page_id", "kind", F.col("name").alias("parent"))
    children = categories.where("name <> ''").select("page_id", F.col("name").alias("child"))
    subcategories = named.where("kind = 'subcat'").join(children, "page_id").select("parent", "child").distinct()
    members = named.where("kind = 'page'").select(F.col("parent").alias("category"), "page_id").distinct()
    return subcategories, members


def _any(name: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Patterns joined into one alternation. Those with a back-reference count their own groups, so each of them stands alone."""
    alone = [p for p in patterns if any(f"\\{n}" in p for n in range(1, 10))]
    others = [p for p in patterns if p not in alone]
    tests = [name.rlike(ANY_CASE + joined(others))] if others else []
    return reduce(lambda a, b: a | b, tests + [name.rlike(ANY_CASE + p) for p in alone], F.lit(False))


def possible(name: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Whether the name holds what one of the patterns can't match without; true if that can't be told of each."""
    needs = [required(p) for p in patterns]
    return F.lower(name).rlike(trie(frozenset().union(*needs))) if needs and all(needs) else F.lit(bool(needs))


def matches(name: Column, patterns: list[str] | tuple[str, ...]) -> Column:
    """Whether any pattern is found in the name, in any case; without patterns, never.

    Patterns with literals of their own are tried on names that hold one of those literals only, unless they begin in a few ways.
    """
    with_literals = [p for p in patterns if required(p)]
    if beginnings(with_literals) < FEW:
        return _any(name, patterns)
    tested = possible(name, with_literals) & _any(name, with_literals)
    return tested | _any(name, [p for p in patterns if p not in with_literals])


def find_categories(categories: DataFrame, patterns: list[str] | tuple[str, ...]) -> DataFrame:
    """Distinct ``name`` of the categories that a pattern matches."""
    return categories.where(matches(F.col("name"), patterns)).select("name").distinct()


def find_by_table(categories: DataFrame, patterns: DataFrame) -> DataFrame:
    """The same for patterns that are rows (``regex``): a semi join on the match itself."""
    test = F.expr(f"name rlike concat('{ANY_CASE}', regex)")
    return categories.join(patterns.select("regex"), test, "left_semi").select("name").distinct()


def collect_articles(members: DataFrame, names: DataFrame) -> DataFrame:
    """Distinct ``page_id`` in any of the named categories."""
    return members.join(names.select(F.col("name").alias("category")), "category", "left_semi").select("page_id").distinct()


def long_enough(articles: DataFrame, least: int) -> DataFrame:
    return articles.where(F.col("length") >= least)


def target_pages(articles: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """``page_id, title, length`` of wanted articles of at least that length."""
    return long_enough(articles, least).join(wanted.select("page_id"), "page_id", "left_semi")


def filter_pages(pages: DataFrame, wanted: DataFrame, least: int) -> DataFrame:
    """The same straight from page rows: articles, no redirects."""
    redirect = F.coalesce(F.col("is_redirect") == 1, F.lit(False))
    return target_pages(pages.where((F.col("namespace") == 0) & ~redirect).select("page_id", "title", "length"), wanted, least)


def tag_groups(categories: DataFrame, groups: list[tuple[str, tuple[str, ...]]] | tuple) -> DataFrame:
    """``stem, name``: each category once for each pattern group that matches it, from one pass over the names."""
    hits = F.array_compact(F.array(*[F.when(matches(F.col("name"), patterns), F.lit(stem)) for stem, patterns in groups]))
    every = [p for _, patterns in groups for p in patterns]
    return categories.where(possible(F.col("name"), every)).select(F.explode(hits).alias("stem"), "name").distinct()


def group_articles(members: DataFrame, tagged: DataFrame) -> DataFrame:
    """Distinct ``stem, page_id``."""
    return members.join(tagged.withColumnRenamed("name", "category"), "category").select("stem", "page_id").distinct()


def traverse(subcategories: DataFrame, root: str, max_depth: int | None = None) -> DataFrame:
    """``name, depth`` of every category that the root reaches, by the shortest way; the root itself at 0.

    One join a level, against edges that are dealt by parent once; the driver sees only whether the level
    found anything. Cycles end as visited names never come again.
    """
    spark = subcategories.sparkSession
    below = checkpointed(subcategories.select("parent", "child").repartition("parent"))
    visited = spark.range(1).select(F.lit(root).alias("name"), F.lit(0).alias("depth"))
    frontier, depth = visited, 0
    while max_depth is None or depth < max_depth:
        depth += 1
        found = below.join(frontier.select(F.col("name").alias("parent")), "parent").select(F.col("child").alias("name")).distinct()
        frontier = checkpointed(found.join(visited, "name", "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            break
        visited = visited.unionByName(frontier)
    return visited


def expanded(subcategories: DataFrame, visited: DataFrame, max_depth: int | None = None) -> DataFrame:
    """``parent, child`` of the categories that the traversal opened."""
    opened = visited if max_depth is None else visited.where(F.col("depth") < max_depth)
    return subcategories.join(opened.select(F.col("name").alias("parent")), "parent", "left_semi")


def depth_stats(visited: DataFrame, members: DataFrame) -> DataFrame:
    """Per depth from 0: ``categories``, articles first seen there, and both running totals."""
    seen = members.join(visited, F.col("category") == F.col("name")).groupBy("page_id").agg(F.min("depth").alias("depth"))
    articles = seen.groupBy("depth").agg(F.count("*").alias("articles"))
    levels = visited.groupBy("depth").agg(F.count("*").alias("categories"))
    so_far = W.partitionBy(F.lit(0)).orderBy("depth").rowsBetween(W.unboundedPreceding, 0)  # a row for each depth
    out = levels.join(articles, "depth", "left").select("depth", "categories", F.coalesce("articles", F.lit(0)).alias("articles"))
    return out.withColumn("all_categories", F.sum("categories").over(so_far)).withColumn("all_articles", F.sum("articles").over(so_far))


def reached_articles(members: DataFrame, visited: DataFrame) -> DataFrame:
    return collect_articles(members, visited)


def shared_titles(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose title another wiki's table has too."""
    return left.join(right.select("title"), "title", "left_semi")


def new_at_depth(visited: DataFrame, members: DataFrame, depth: int) -> DataFrame:
    """Distinct ``page_id`` of articles that a depth reaches and no lesser depth does."""
    at = lambda test: collect_articles(members, visited.where(test))
    return at(F.col("depth") == depth).join(at(F.col("depth") < depth), "page_id", "left_anti")
