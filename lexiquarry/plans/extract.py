"""Records of articles by tiers: infobox, then text, then, where asked for, a text model."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import biography
from ..functions.dates import normalise_with_note
from ..functions.etymology import etymology
from ..functions.infobox import fields
from ..functions.model_reply import etymology_prompt, parsed, prompt, text_of
from ..functions.modes import DATE_FIELDS, FIELDS, MODES
from ..functions.plaintext import word_count

#: ``(rows, prompt) -> rows with reply``; a null prompt asks nothing.
Model = Callable[[DataFrame, Column], DataFrame]


def tiered(content: DataFrame, mode: str, wanted: tuple[str, ...] | None = None) -> DataFrame:
    """``content`` (``wikitext, plaintext``) with a column for each wanted field, null where no tier tells it.

    The text tier knows biographical fields; in other modes it fills those of the same name only.
    """
    wanted = wanted or FIELDS[mode]
    content = content.drop(*wanted)
    if mode == "etymology":
        return content.withColumn("etymology", etymology(F.col("wikitext"), F.col("plaintext")))
    spec = MODES[mode]
    boxed = content.withColumn("_box", fields(F.col("wikitext"), spec, wanted))
    by_text = [f for f in wanted if f in biography.FIELDS]
    if by_text:
        boxed = biography.told(boxed, F.col("plaintext"), by_text, "_text_")
    value = lambda f: F.coalesce(F.col("_box")[f], F.col(f"_text_{f}")) if f in by_text else F.col("_box")[f]
    return boxed.withColumns({f: value(f) for f in wanted}).drop("_box", *[f"_text_{f}" for f in by_text])


def fill_by_model(rows: DataFrame, wanted: tuple[str, ...], model: Model, mode: str = "bio", lang: str = "en") -> DataFrame:
    """Rows with gaps asked of a model, the others left alone, in one pass. A reply fills gaps by non-blank strings only."""
    gap = F.lit(False)
    for f in wanted:
        gap = gap | F.col(f).isNull()
    gap = gap & F.coalesce(F.col("plaintext") != "", F.lit(False))
    missing = F.array_compact(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in wanted]))
    text = F.col("plaintext")
    asked = model(rows, F.when(gap, etymology_prompt(text, lang) if mode == "etymology" else prompt(text, missing, lang)))
    said = asked.withColumn("_said", parsed(F.col("reply")))
    return said.withColumns({f: F.coalesce(F.col(f), text_of(F.col("_said"), f)) for f in wanted}).select(rows.columns)


def dated(rows: DataFrame, wanted: tuple[str, ...]) -> DataFrame:
    """Date fields normalised, each with its ``_note``; notes follow the fields, in the fields' order."""
    dates = [f for f in wanted if f in DATE_FIELDS]
    rows = rows.withColumns({f"_{f}": normalise_with_note(F.col(f)) for f in dates})
    return rows.withColumns({f: F.col(f"_{f}.date") for f in dates} | {f"{f}_note": F.col(f"_{f}.note") for f in dates}).drop(*[f"_{f}" for f in dates])


def records(targets: DataFrame, content: DataFrame, mode: str, wanted: tuple[str, ...] | None = None, model: Model | None = None, lang: str = "en", how: str = "left") -> DataFrame:
    """``page_id, title, <fields>, <notes>, article_bytes, word_count`` of the targets.

    ``how``: ``left`` keeps targets without content, with empty fields; ``inner`` drops them. Titles
    match with spaces for underscores. Other columns of the targets follow.
    """
    wanted = wanted or FIELDS[mode]
    wiki = content.select(F.translate("title", "_", " ").alias("title"), "wikitext", "plaintext")
    kept = [c for c in targets.columns if c not in ("page_id", "title", "length")]
    rows = targets.select("page_id", F.translate("title", "_", " ").alias("title"), "length", *kept).join(wiki, "title", how)
    rows = tiered(rows, mode, wanted)
    if model is not None:
        rows = fill_by_model(rows, wanted, model, mode, lang)
    rows = dated(rows, wanted)
    notes = [f"{f}_note" for f in wanted if f in DATE_FIELDS]
    return rows.select(F.coalesce("page_id", F.lit(0)).alias("page_id"), "title", *wanted, *notes, F.coalesce("length", F.lit(0)).alias("article_bytes"), word_count(F.col("plaintext")).alias("word_count"), *kept)
