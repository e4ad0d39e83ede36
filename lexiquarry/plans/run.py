"""A run from dumps to results: search, filter, fetch, extract, write.

``python -m lexiquarry`` runs it; ``python -m lexiquarry.plans.publish`` runs it for a region's patterns and publishes
the results. What is dear is evaluated once: parsed dumps, fetched texts and records are stored before they are read twice.
"""

from __future__ import annotations

import argparse
import os
from collections.abc import Callable
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.modes import FIELDS, mode_of
from ..operators import categories as cat
from ..operators import reports
from ..sources import archives, dumps, remote, sinks
from ..sources.answers import Answers
from ..sources.files import Cache, newest, read_patterns, read_regions, read_results
from ..storage import stored
from .extract import Model, records
from .regions import entries, first_of_key, join_regions

# Flags, their defaults, and what they stand for.
#: Least article length of wikis unless it is given; 0 for the simple one, whose articles are short.
LEAST_LENGTH = 5000
#: Where pattern files are unless a folder is given.
PATTERNS_DIR = Path("patterns")
MODES = ("bio", "geo", "etymology", "battle", "exploration", "astronomy", "biology", "math", "auto")


@dataclass(frozen=True)
class Config:
    wiki: str = "enwiki"
    root_category: str | None = None
    patterns: tuple[str, ...] = ()
    groups: tuple[tuple[str, tuple[str, ...]], ...] = ()
    min_length: int = LEAST_LENGTH
    data_dir: Path = Path("data")
    results_dir: Path = Path("results")
    mode: str = "auto"
    wanted: tuple[str, ...] | None = None
    output: str = "xlsx"
    max_depth: int | None = None
    dry_run: bool = False
    use_cache: bool = True
    clear_cache: bool = False
    download_articles: bool = False
    use_api: bool = False
    multistream: bool = True
    limit: int | None = None
    use_model: bool = True
    model_name: str = "llama3.1:8b"
    model_url: str = "http://localhost:11434"
    api_batch: int = remote.TITLES_PER_CALL
    api_pause: float = 0.1

    @property
    def lang(self) -> str:
        return self.wiki.removesuffix("wiki")

    @property
    def cache_dir(self) -> Path:
        return self.data_dir / "cache" / self.wiki

    @property
    def search(self) -> str:
        """``regex`` if there are patterns, else ``bfs``."""
        return "bfs" if self.root_category and not self.patterns else "regex"

    @property
    def name(self) -> str:
        return self.root_category.replace(" ", "_") if self.root_category else "regex_results"


def parse_args(argv: list[str] | None = None) -> Config:
    p = argparse.ArgumentParser(prog="lexiquarry")
    p.add_argument("root_category", nargs="?")
    p.add_argument("--patterns", nargs="+", default=[])
    p.add_argument("--patterns-file", type=Path)
    p.add_argument("--all", type=Path, nargs="?", const=PATTERNS_DIR, metavar="FOLDER", help="every pattern file of a folder")
    p.add_argument("--min-page-length", type=int, default=LEAST_LENGTH)
    p.add_argument("--wiki", default="enwiki")
    p.add_argument("--data-dir", type=Path, default=Path("data"))
    p.add_argument("--results-dir", type=Path, default=Path("results"))
    p.add_argument("--api-batch-size", type=int, default=remote.TITLES_PER_CALL)
    p.add_argument("--api-rate-limit", type=float, default=0.1)
    p.add_argument("--model", "--ollama-model", default=os.environ.get("OLLAMA_MODEL", "llama3.1:8b"))
    p.add_argument("--model-url", "--ollama-base-url", default=os.environ.get("OLLAMA_BASE_URL", "http://localhost:11434"))
    p.add_argument("--extraction-mode", choices=MODES, default="auto")
    p.add_argument("--required-fields", nargs="+")
    p.add_argument("--output-format", choices=("xlsx", "csv", "tsv"), default="xlsx")
    p.add_argument("--max-depth", type=int)
    p.add_argument("--limit", type=int)
    for flag in ("dry-run", "no-cache", "clear-cache", "download-articles", "use-api", "no-multistream", "no-llm"):
        p.add_argument(f"--{flag}", action="store_true")
    a = p.parse_args(argv)
    groups = read_patterns(a.patterns_file) if a.patterns_file else ()
    idle = not (a.use_api or a.patterns or groups or a.root_category or a.download_articles)
    if (a.all or idle) and not (a.patterns or groups):
        folder = a.all or PATTERNS_DIR
        folder = folder / "geo" if a.extraction_mode in ("geo", "etymology") and (folder / "geo").is_dir() else folder
        groups = read_patterns(folder) if folder.is_dir() else ()
    patterns = (*a.patterns, *(x for _, own in groups for x in own))
    if not (a.root_category or patterns or a.download_articles):
        p.error("a root category, patterns or --download-articles is needed")
    least = 0 if a.wiki == "simplewiki" and a.min_page_length == LEAST_LENGTH else a.min_page_length
    return Config(
        wiki=a.wiki, root_category=a.root_category, patterns=patterns, groups=groups, min_length=least, data_dir=a.data_dir, results_dir=a.results_dir,
        mode=a.extraction_mode, wanted=tuple(a.required_fields) if a.required_fields else None, output=a.output_format, max_depth=a.max_depth,
        dry_run=a.dry_run, use_cache=not a.no_cache, clear_cache=a.clear_cache, download_articles=a.download_articles, use_api=a.use_api,
        multistream=not a.no_multistream, limit=a.limit or None, use_model=not a.no_llm, model_name=a.model, model_url=a.model_url,
        api_batch=a.api_batch_size, api_pause=a.api_rate_limit,
    )


TABLES = ("page", "linktarget", "categorylinks")


def parsed_dumps(spark: SparkSession, config: Config) -> dict[str, DataFrame]:
    """``categories, articles, subcategories, members``: from the cache if it holds, else parsed from the dumps and kept."""
    files = {t: config.data_dir / f"{config.wiki}-latest-{t}.sql.gz" for t in TABLES}
    cache = Cache(spark, config.data_dir, config.wiki)
    if config.clear_cache:
        cache.clear()
    names = ("categories", "articles", "subcategories", "members")
    if config.use_cache and (held := cache.load_all(names, list(files.values()))):
        return held
    for t, path in files.items():
        if not path.exists():
            remote.download(f"https://dumps.wikimedia.org/{config.wiki}/latest/{path.name}", path)
    rows = {t: dumps.read_dump(spark, str(p), t) for t, p in files.items()}
    # each dump is unzipped and split once, whatever reads it
    categories, articles = dumps.split_pages(stored(dumps.pages(rows["page"]), "pages"))
    links, link_targets = stored(dumps.category_links(rows["categorylinks"]), "links"), stored(dumps.link_targets(rows["linktarget"]), "targets")
    subcategories, members = cat.edges(links, link_targets, categories)
    fresh = dict(zip(names, (categories, articles, subcategories, members), strict=True))
    if config.use_cache:
        cache.save_all(fresh, list(files.values()))
        return cache.load_all(names, list(files.values()))
    return fresh


#: Called with a name and a table that tells how the run goes.
Report = Callable[[str, DataFrame], None]


def wanted_articles(tables: dict[str, DataFrame], config: Config, report: Report | None = None) -> DataFrame:
    if config.search == "bfs":
        visited = cat.traverse(tables["subcategories"], config.root_category.replace(" ", "_"), config.max_depth)
        if report:
            report("depths", cat.depth_stats(visited, tables["members"]).orderBy("depth"))
        return cat.collect_articles(tables["members"], visited)
    return cat.collect_articles(tables["members"], cat.find_categories(tables["categories"], config.patterns))


def _index(spark: SparkSession, path: Path, config: Config) -> DataFrame:
    """The parsed index: of the cache, or parsed once and kept there, or for this run only."""
    if not config.use_cache:
        return stored(archives.read_index(spark, str(path)), "index")
    cache = Cache(spark, config.data_dir, config.wiki)
    if cache.load("index", [path]) is None:
        cache.save(archives.read_index(spark, str(path)), "index", [path])
    return cache.load("index", [path])


def fetch(spark: SparkSession, targets: DataFrame, config: Config, transport: remote.Transport = remote.http_get, report: Report | None = None) -> DataFrame:
    """``title, wikitext, plaintext`` of the targets, by API, multistream archive or full scan."""
    if config.use_api:
        titles = targets.select(F.translate("title", "_", " ").alias("title"))
        titles = stored(titles.limit(config.limit), "titles") if config.limit else titles
        url = f"https://{config.lang}.wikipedia.org/w/api.php"
        store = str(config.cache_dir / "fetched") if config.use_cache else None
        both = [remote.fetch_articles(titles, url, transport, kind, config.api_batch, config.api_pause, store=store) for kind in ("wikitext", "plaintext")]
        return both[0].join(both[1], "title", "left")
    if config.multistream:
        archive, path = archives.find_multistream(config.data_dir, config.wiki)
        index = _index(spark, path, config)
        if report:
            report("not in the index", archives.missing_from(targets, index).agg(F.count("*").alias("articles")))
        return archives.content(archives.read_multistream(targets, index, str(archive), config.limit))
    return archives.content(archives.read_xml(spark, str(archives.find_archive(config.data_dir, config.wiki)), targets, config.limit))


def _write_groups(tables: dict[str, DataFrame], content: DataFrame, config: Config, model: Model | None) -> DataFrame:
    """Workbooks of every pattern group: articles are extracted once for each mode and written by stem in one plan."""
    tagged = cat.tag_groups(tables["categories"], config.groups)
    by_group = stored(cat.group_articles(tables["members"], tagged), "groups")
    modes: dict[str, list[str]] = {}
    for stem, _ in config.groups:
        modes.setdefault(mode_of(stem, config.mode), []).append(stem)
    written = None
    for mode, stems in modes.items():
        own = by_group.where(F.col("stem").isin(stems))
        targets = cat.target_pages(tables["articles"], own, config.min_length)
        rows = stored(records(targets, content, mode, None, model, config.lang, "inner"), "records")
        rows = rows.join(own, "page_id").repartitionByRange("stem", "title").sortWithinPartitions("stem", "title")
        made = sinks.write_workbooks(rows, str(config.results_dir), by="stem")
        written = made if written is None else written.unionByName(made)
    return written


def run(spark: SparkSession, config: Config, model: Model | None = None, transport: remote.Transport = remote.http_get, report: Report | None = None) -> DataFrame:
    """Runs it all; returns ``name, path`` of what it wrote (or downloaded, where nothing else is asked for), or the dry run's counts."""
    if config.download_articles:
        got = []
        for variant in ("multistream", "multistream-index") if config.multistream else ("bz2",):
            name = archives.archive_name(config.wiki, variant)
            got.append((name, str(remote.download(f"https://dumps.wikimedia.org/{config.wiki}/latest/{name}", config.data_dir / name))))
        if not (config.root_category or config.patterns):
            return spark.createDataFrame(got, "name string, path string")
    if model is None and config.use_model:
        replies = str(config.cache_dir / "replies") if config.use_cache else None
        model = lambda rows, prompt: remote.ask_model(rows, prompt, config.model_url, config.model_name, store=replies)
    model = model if config.use_model else None
    tables = parsed_dumps(spark, config)
    targets = cat.target_pages(tables["articles"], wanted_articles(tables, config, report), config.min_length)
    if config.dry_run:
        return reports.dry_run(targets)
    targets = stored(targets, "targets")
    content = stored(fetch(spark, targets, config, transport, report), "content")
    if config.use_api and config.use_cache:  # articles change: what was fetched serves to resume this run only
        Answers(spark, str(config.cache_dir / "fetched")).clear()
    if config.groups and config.output == "xlsx":
        written = _write_groups(tables, content, config, model)
        if report:
            report("workbooks", written)
        return spark.createDataFrame([(stem, f"{config.results_dir}/{stem}") for stem, _ in config.groups], "name string, path string")
    mode = "bio" if config.mode == "auto" else config.mode
    rows = stored(records(targets, content, mode, config.wanted, model, config.lang), "records")
    if report:
        report("fields", reports.fill_rates(rows, config.wanted or FIELDS[mode]))
    path = f"{config.results_dir}/{config.name}"
    if config.output == "xlsx":
        sinks.write_workbooks(rows.orderBy("page_id"), path, config.name)
    else:
        sinks.write_delimited(stored(rows.orderBy("page_id"), "sorted"), path, "\t" if config.output == "tsv" else ",")
    return spark.createDataFrame([(config.name, path)], "name string, path string")


def publish_regions(spark: SparkSession, results: DataFrame | str, region_dir: str, out: str, lang: str = "en") -> None:
    """Results (or a folder of CSV, of which the newest counts) joined to regions: keyed JSON, unmatched rows, collisions."""
    if isinstance(results, str):
        results = read_results(spark, str(newest(Path(results), "*.csv") if Path(results).is_dir() and not list(Path(results).glob("part-*")) else results))
    keys, lost_keys = first_of_key(read_regions(spark, region_dir))
    joined = join_regions(results, keys)
    sinks.write_keyed_json(stored(entries(joined.matched, lang), "entries"), f"{out}/entries")
    for name, df in (("unmatched", joined.unmatched.drop("row_at")), ("collisions", joined.collisions), ("key_collisions", lost_keys)):
        df = stored(df, name)
        if not df.isEmpty():
            sinks.write_delimited(df, f"{out}/{name}")


def show(name: str, rows: DataFrame) -> None:
    print(f"{name}:")
    rows.show(100, truncate=False)


def main(argv: list[str] | None = None) -> None:
    config = parse_args(argv)
    spark = SparkSession.builder.appName("lexiquarry").getOrCreate()
    show("done", run(spark, config, report=show))


if __name__ == "__main__":
    main()
