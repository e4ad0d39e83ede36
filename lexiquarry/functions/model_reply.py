"""Prompts for a text model, and its replies read with care."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, present, strip, sub

PROMPT_CHARACTERS = 3000


def _ask(task: str, lang: str) -> str:
    other = "" if lang == "en" else f" (written in the language with the code {lang})"
    return f"Read the article{other} at the end. {task} Answer with one JSON object and nothing else; a value is a short text, or null if the article does not tell it. "


def prompt(text: Column, missing: Column, lang: str = "en") -> Column:
    """Asks for the missing fields (an array of names) of a biography as JSON."""
    ask = _ask("It is about a person, of whom some facts are wanted.", lang)
    return F.concat(F.lit(ask + "Keys: "), F.array_join(missing, ", "), F.lit(".\nArticle:\n"), F.substring(text, 1, PROMPT_CHARACTERS))


def etymology_prompt(text: Column, lang: str = "en") -> Column:
    ask = _ask("It is about a place. Say in up to three sentences where the place's name comes from.", lang)
    return F.concat(F.lit(ask + 'The only key: "etymology".\nArticle:\n'), F.substring(text, 1, PROMPT_CHARACTERS))


def parsed(reply: Column) -> Column:
    """The reply as a variant: code fences off, and trailing commas if it does not parse with them; else null."""
    bare = strip(sub(sub(strip(reply), r"^```(?:json)?\s*"), r"\s*```$"))
    return let(bare, lambda b: F.coalesce(F.try_parse_json(b), F.try_parse_json(sub(b, r",\s*([}\]])", "$1"))))


def text_of(said: Column, name: str) -> Column:
    """A key's value in a ``parsed`` reply if it is a non-blank string, stripped; numbers and other kinds are refused."""
    path = f"$['{name}']"
    value = F.try_variant_get(said, path, "variant")
    return F.when(F.schema_of_variant(value) == "STRING", present(strip(F.try_variant_get(said, path, "string"))))


def text_field(reply: Column, name: str) -> Column:
    """``text_of`` a reply that is read for this key only."""
    return let(parsed(reply), lambda said: text_of(said, name))
