"""Remote sources: article text by API in batches, a text model, and resumable downloads.

Calls go through ``transport``, a function that pickles; tests hand in their own. Answers are kept as they come.
"""

from __future__ import annotations

import json
import time
import urllib.parse
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import shared_root, stored
from .answers import Answers, Call, keys

#: ``(url, parameters) -> reply`` for reads, ``(url, body) -> reply`` for posts.
Transport = Callable[[str, dict], dict]

TITLES_PER_CALL = 50
_AGENT = "lexiquarry/1.0"


def http_get(url: str, parameters: dict) -> dict:
    request = urllib.request.Request(f"{url}?{urllib.parse.urlencode(parameters)}", headers={"User-Agent": _AGENT})
    with urllib.request.urlopen(request, timeout=30) as reply:
        return json.load(reply)


def http_post(url: str, body: dict) -> dict:
    request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=120) as reply:
        return json.load(reply)


def all_pages(transport: Transport, url: str, parameters: dict) -> Iterator[dict]:
    """Pages of a query, through its continuations."""
    asked = dict(parameters)
    while True:
        reply = transport(url, asked)
        yield from reply.get("query", {}).get("pages", [])
        if "continue" not in reply:
            return
        asked = {**asked, **reply["continue"]}


def _asked_titles(transport: Transport, url: str, kind: str) -> Call:
    """The texts of up to a batch of titles; null for pages without content."""
    common = {"action": "query", "format": "json", "formatversion": "2"}
    ask = {"wikitext": {"prop": "revisions", "rvprop": "content", "rvslots": "main"}, "plaintext": {"prop": "extracts", "explaintext": "1", "exlimit": "max"}}[kind]

    def text(page: dict) -> str | None:
        if kind == "plaintext":
            return page.get("extract")
        return page["revisions"][0]["slots"]["main"]["content"] if page.get("revisions") else None

    def call(titles: list[str], wait: Callable[[], None]) -> list[tuple[str | None, bool]]:
        def paced(to: str, parameters: dict) -> dict:
            wait()
            return transport(to, parameters)

        # a page may come in several parts; only one of them has its text
        found = {p["title"]: text(p) for p in all_pages(paced, url, {**common, **ask, "titles": "|".join(titles)}) if text(p)}
        return [(found.get(t), True) for t in titles]

    return call


def fetch_articles(
    titles: DataFrame, url: str, transport: Transport = http_get, kind: str = "wikitext", batch: int = TITLES_PER_CALL, pause: float = 0.1, tasks: int = 4, store: str | None = None
) -> DataFrame:
    """``title, <kind>`` by API, ``kind`` being wikitext or plaintext; pages without content drop out.

    All tasks together make a request each ``pause`` seconds at most, continuations too. What came is in the ``store`` (a
    folder; else one for this call), so neither a retried task nor, with a store, a second run asks for it again.
    """
    spark = titles.sparkSession
    asked = stored(titles.where("title IS NOT NULL").select("title").distinct().withColumn("key", keys("title", url, kind)), "titles")
    answers = Answers(spark, store or f"{shared_root(spark)}/fetched-{uuid.uuid4().hex}")
    got = answers.ask(asked.select("key", F.col("title").alias("question")), _asked_titles(transport, url, kind), tasks, pause, batch)
    return asked.join(got, "key").where(F.col("answer") != "").select("title", F.col("answer").alias(kind))


def ask_model(
    rows: DataFrame, prompt: Column, url: str, model: str, transport: Transport = http_post, tries: int = 3, backoff: float = 1.0, tasks: int | None = None, store: str | None = None
) -> DataFrame:
    """``rows`` with ``reply``, the model's text; null where every try failed, whatever the reason, or the prompt is null.

    A prompt is asked once, however many rows have it, and not at all if the ``store`` (a folder; else one for this call) has
    the model's reply. Failures aren't kept. As many tasks ask as the session has cores, or ``tasks``. Replies are read by
    column functions.
    """
    spark = rows.sparkSession
    asked = rows.withColumn("_prompt", prompt).withColumn("_key", keys("_prompt", url, model))
    asked = stored(asked, "prompted")

    def one(text: str, wait: Callable[[], None]) -> str | None:
        for attempt in range(tries):
            wait()
            try:
                reply = transport(f"{url}/api/generate", {"model": model, "prompt": text, "stream": False, "format": "json"})["response"]
                if isinstance(reply, str):
                    return reply
            except Exception:  # a reply may be broken in any way; it costs this record's tier, not the run
                pass
            if attempt + 1 < tries:
                time.sleep(backoff * 2**attempt)
        return None

    def call(prompts: list[str], wait: Callable[[], None]) -> list[tuple[str | None, bool]]:
        replies = [one(p, wait) for p in prompts]
        return [(r, r is not None) for r in replies]

    questions = asked.where("_prompt IS NOT NULL").groupBy("_key").agg(F.min("_prompt").alias("question")).withColumnRenamed("_key", "key")
    answers = Answers(spark, store or f"{shared_root(spark)}/replies-{uuid.uuid4().hex}")
    got = answers.ask(stored(questions, "prompts"), call, tasks or spark.sparkContext.defaultParallelism)
    return asked.join(got.select(F.col("key").alias("_key"), F.col("answer").alias("reply")), "_key", "left").select(*[F.col(f"`{c}`") for c in rows.columns], "reply")


def download(url: str, to: Path, opener: Callable = urllib.request.urlopen, tries: int = 5, backoff: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Path:
    """Fetch a file: skipped if its size is right, resumed from ``.partial``, renamed when whole."""
    to.parent.mkdir(parents=True, exist_ok=True)
    with opener(urllib.request.Request(url, method="HEAD", headers={"User-Agent": _AGENT}), timeout=30) as head:
        size = int(head.headers.get("Content-Length") or 0)
    if size and to.exists() and to.stat().st_size == size:
        return to
    partial = to.with_name(to.name + ".partial")
    for attempt in range(tries):
        try:
            have = partial.stat().st_size if partial.exists() else 0
            headers = {"User-Agent": _AGENT} | ({"Range": f"bytes={have}-"} if have else {})
            with opener(urllib.request.Request(url, headers=headers), timeout=60) as reply, partial.open("ab" if have and reply.status == 206 else "wb") as out:
                while piece := reply.read(1 << 20):
                    out.write(piece)
            return partial.replace(to)
        except OSError:
            if attempt + 1 == tries:
                raise
            sleep(backoff * 2**attempt)
    raise AssertionError


