"""Main text of web pages by the maximum-scoring subsequence of words and tags.

A page becomes a sequence of blocks of words with the tags before them. Each word has the score of its
block's kind (element, linked or not, long or short) and each tag a negative one. One linear scan finds
the contiguous stretch of greatest sum. Where that lies in an ``<article>`` (or ``itemprop=articleBody``), the text is
all of it but furniture, so linked headings and paragraphs at its edges stay. Else, within the innermost element
that holds the stretch (if that is less than the body), the text runs from the first to the last block of positive
score, so that a table or list of links amid an article doesn't break it.

The scores are log-odds learned from labelled pages: pages that mark their own article (``<article>``,
``<main>`` or ``itemprop=articleBody``) label their words and tags by it. Training reads at most
``SAMPLE`` pages, those of least hash of page_id; only counts by feature come to the driver. A kind that was never
seen scores as its element's other kinds do on average; on a page where nothing scores above zero, as one in bare
``div`` elements, the priors decide in place of what was learned.

Elements have features too: their tag (``nav``, ``footer``, ...), and the words of class, id and role of
containers, whole or by their head (``ad-slot``, ``site-header``; not ``has-sidebar``). A container of negative
features is furniture if the sum over its words, of their kind's score and the container's, is
negative: a ``<section id="discussion">`` of an article's paragraphs is none, one of link lists is. What
holds most of the page's positive score is none by class. Words in furniture don't come out, and each such
block costs the stretch as much as a tag. Single paragraphs, headings and cells are furniture only by a
whole class that says no more than that (``<p class="ad">``, not ``<p class="share-price">`` or ``<p class="reply">``).
An ``<aside>`` that holds a quotation is none.

Text of a block: character references decoded, white space runs to one space, trimmed; blocks in
page order joined by one space. Inline tags do not break words; ``<br>`` is white space. Defined
cases: null, empty or tagless html of nothing gives an empty text; plain text without tags is its
own main text; what looks like a tag inside a script is none; unclosed tags and a tag cut off at the end
are tolerated; repeated pages are extracted each; without labelled pages the priors alone decide; extra
columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import table

SAMPLE = 2000

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>"']|"[^"]*"|'[^']*')*+)>|<(/?)([A-Za-z][A-Za-z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_RAW = frozenset("script style noscript template iframe textarea svg title xmp".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br input".split())
#: Elements that hold one block each, as a rule; classes of theirs say little.
_LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr caption figcaption pre blockquote".split()) | _INLINE
#: Kinds of text by the innermost element; others are ``div``, or ``in`` inside an element marked as an article.
_KIND = {"p": "p", "blockquote": "p", "pre": "p", "li": "li", "dt": "li", "dd": "li", "td": "td", "th": "td"} | {f"h{n}": "h" for n in range(1, 7)}
#: Elements whose words are no article's, and those that are never any's.
_FURNITURE = "nav footer aside form select button option dialog menu head".split()
_NEVER = frozenset("nav footer aside select button option dialog menu head header".split())
_CONTENT = frozenset("article main".split())
#: Words of classes, ids and roles that tell furniture for sure, nearly so, and by their company.
_SURE = (
    "ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo cookie cookies consent gdpr popup modal newsletter subscribe "
    "comment comments commentlist disqus reply replies respond nav navbar navigation breadcrumb breadcrumbs masthead contentinfo hidden"
).split()
_NEARLY = "related recommended recommendations banner notice notices alert overlay sidebar sidenav aside menu footer header topbar toolbar complementary rail".split()
#: The words that tell a single paragraph or heading, and an item of a list or a cell, as which comments come.
_TEXT_SURE, _ITEM_SURE = frozenset("ad ads advert adverts advertisement advertising adsense adslot sponsor sponsored promo hidden".split()), frozenset(_SURE)
_ITEMS = frozenset("li dt dd td th tr".split())
_MAYBE = "discussion responses reactions share sharing social widget widgets pagination pager search login signup skip promotion subscription copyright disclaimer".split()
_HIDDEN = frozenset("hidden visuallyhidden visually-hidden is-hidden".split())
_ARTICLE_WORDS = frozenset("article post entry content body main story text".split())
#: Words that only place the word after them, as in ``site-header``.
_PLACES = _ARTICLE_WORDS | frozenset("site page global top bottom left right primary secondary inner outer user google blog web home".split())
_SPLIT = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")

#: Counts that stand in for a small labelled page: feature, words inside, words outside.
PRIOR = (
    ("w:p:text:long", 300, 10),
    ("w:p:text:short", 100, 5),
    ("w:h:text:long", 20, 5),
    ("w:h:text:short", 40, 10),
    ("w:li:text:long", 20, 10),
    ("w:li:text:short", 25, 20),
    ("w:td:text:long", 20, 10),
    ("w:td:text:short", 22, 20),
    ("w:in:text:long", 200, 10),
    ("w:in:text:short", 60, 20),
    ("w:in:link:long", 20, 10),
    ("w:in:link:short", 20, 20),
    ("w:div:text:long", 200, 20),
    ("w:div:text:short", 20, 40),
    ("w:p:link:long", 10, 10),
    ("w:p:link:short", 5, 20),
    ("w:li:link:long", 3, 20),
    ("w:li:link:short", 3, 40),
    ("w:div:link:long", 3, 20),
    ("w:div:link:short", 2, 40),
    ("t:open", 30, 60),
    *((f"c:<{tag}>", 0, 400) for tag in (*_FURNITURE, "header", "!hidden")),
    *((f"c:{word}", 0, 400) for word in _SURE),
    *((f"c:{word}", 0, 40) for word in _NEARLY),
    *((f"c:{word}", 0, 11) for word in _MAYBE),
)
_KNOWN = frozenset(f for f, _, _ in PRIOR)
#: Words on either side that a class without a prior starts from.
UNKNOWN = 20
#: Words that make a block a long one.
LONG = 15
#: Open elements that a start tag ends, where their end tags may be left out.
_CELLS = frozenset(("td", "th"))
_ROWS = _CELLS | {"tr"}
_GROUPS = _ROWS | {"thead", "tbody", "tfoot", "caption", "colgroup"}
_ENDS = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "td": _CELLS, "th": _CELLS, "tr": _ROWS, "thead": _GROUPS, "tbody": _GROUPS, "tfoot": _GROUPS}


class Block(NamedTuple):
    text: str
    words: int
    tags: int
    feature: str
    place: int  # number of the innermost open element with a number, 0 for none
    labelled: bool  # inside an element that the page marks as its article


class Tree(NamedTuple):
    """By number of an element, 0 for the page: tag name, parent's number (which is less), and its features."""

    names: list[str]
    parents: list[int]
    features: list[tuple[str, ...]]


@lru_cache(1 << 16)
def _class_words(token: str) -> tuple[str, ...]:
    """The words that a class, id or role stands for: all of it, its first, or its last after words of place."""
    low = token.lower()
    if low in _HIDDEN:
        return ("hidden",)
    parts = [p.lower() for p in _SPLIT.split(token) if p]
    if not parts:
        return ()
    found = {low, parts[0]}
    if all(p in _PLACES for p in parts[:-1]):
        found.add(parts[-1])
    if _ARTICLE_WORDS.intersection(parts):
        found.discard("header")
    return tuple(sorted(found - _ARTICLE_WORDS - {"hidden"}))


def _features(attributes: str, leaf: frozenset[str] | None) -> tuple[str, ...]:
    """Features of an element's attributes; of a leaf only those words that tell furniture for sure."""
    found = []
    seen = set()
    for m in _ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key in seen:  # the first of a name holds
            continue
        seen.add(key)
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and "display:none" in value.lower().replace(" ", ""):
            found.append("c:<!hidden>")
        elif key in ("class", "id", "role"):
            for token in value.split():
                if leaf is not None:
                    low = "hidden" if token.lower() in _HIDDEN else token.lower()
                    found += [f"c:{low}"] * (key != "id" and low in leaf)
                else:
                    found += [f"c:{word}" for word in _class_words(token)]
    return tuple(found)


class Open(NamedTuple):
    """An open element; the flags hold for all that is in it, so depth costs a tag nothing."""

    name: str
    number: int
    article: bool
    content: bool  # it is, or is in, an <article> or <main>


def blocks(page: str) -> tuple[list[Block], Tree]:
    """The page's blocks in order and its elements."""
    out: list[Block] = []
    tree = Tree([""], [0], [()])
    stack = [Open("", 0, False, False)]
    opened: Counter = Counter()  # open elements by name
    pieces: list[str] = []
    in_link = link_words = tags = at = 0
    kind = "div"

    def flush() -> None:
        nonlocal pieces, tags, link_words
        words = html.unescape("".join(pieces)).split() if pieces else ()
        if words:
            feature = f"w:{kind}:{'link' if 2 * link_words > len(words) else 'text'}:{'long' if len(words) >= LONG else 'short'}"
            out.append(Block(" ".join(words), len(words), tags, feature, stack[-1].number, stack[-1].article))
            tags = 0
        pieces, link_words = [], 0

    def settle() -> None:
        nonlocal kind
        kind = _KIND.get(stack[-1].name) or ("in" if stack[-1].content else "div")
        if kind in ("li", "td") and stack[-1].content:
            kind = "in"

    def push(name: str, article: bool, features: tuple[str, ...]) -> None:
        up = stack[-1]
        stack.append(Open(name, len(tree.names), up.article or article, up.content or name in _CONTENT))
        tree.names.append("article" if article and name != "main" else name)
        tree.parents.append(up.number)
        tree.features.append(features)
        opened[name] += 1

    def pop() -> str:
        name = stack.pop().name
        opened[name] -= 1
        return name

    def said(text: str) -> None:
        nonlocal link_words
        if text:
            pieces.append(text)
            if in_link:
                link_words += len(text.split())

    while m := _TOKEN.search(page, at):
        said(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        tags += 1
        if name in _RAW and not closing:
            if not attributes.rstrip().endswith("/") or name in ("script", "style"):
                end = re.compile(rf"</{name}(?=[\s/>])[^>]*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            flush()
            continue
        if name in _INLINE:
            if name == "br":
                pieces.append(" ")
            elif name == "a":
                in_link = 0 if closing else 1
            elif not closing and name not in _VOID and attributes and (features := _features(attributes, _TEXT_SURE)):
                flush()
                push(name, False, features)
                settle()
            elif closing and stack[-1].name == name:
                flush()
                pop()
                settle()
            continue
        flush()
        if name in _VOID:
            continue
        if closing:
            while opened[name] and pop() != name:
                pass
        else:
            if stack[-1].name in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                pop()
            while stack[-1].name in _ENDS.get(name, ()):
                pop()
            inside = stack[-1].content
            judge = name not in ("html", "body", "main") and (name != "article" or inside)
            features = _features(attributes, _ITEM_SURE if name in _ITEMS else _TEXT_SURE if name in _LEAVES else None) if judge and attributes else ()
            if (name in _FURNITURE or name == "header" and not inside) and not (name == "aside" and "quote" in attributes.lower()):
                features = (f"c:<{name}>", *features)
            if name == "blockquote" and stack[-1].name == "aside":
                at_ = stack[-1].number
                tree.features[at_] = tuple(f for f in tree.features[at_] if f != "c:<aside>")
            push(name, name in _CONTENT or "articleBody" in attributes, features)
        in_link = 0
        settle()
    said(page[at:])
    flush()
    return out, tree


def furniture(found: list[Block], tree: Tree, weight: dict[str, float]) -> list[bool]:
    """Of each block, whether it is furniture by the features of an element that holds it."""
    names, parents, features = tree
    if not any(features):
        return [False] * len(found)
    size = len(parents)
    evidence = [min((weight.get(f, 0.0) for f in own), default=0.0) for own in features]
    never = [bool(own) and own[0][3:-1] in _NEVER for own in features]
    score, words, positive, holds, marked = [0.0] * size, [0] * size, [0.0] * size, [False] * size, [False] * size
    hard, by_class = [False] * size, [False] * size
    for n in range(1, size):
        hard[n] = hard[parents[n]] or never[n] and evidence[n] < -1
        by_class[n] = by_class[parents[n]] or evidence[n] < -1
    long_outside = False
    for b in found:
        own = weight.get(b.feature, 0.0) * b.words
        score[b.place] += own
        words[b.place] += b.words
        if not hard[b.place]:
            positive[b.place] += max(0.0, own)
            holds[b.place] = True
            long_outside |= not by_class[b.place] and b.feature.endswith("text:long")
    for n in range(size - 1, 0, -1):
        up = parents[n]
        score[up] += score[n]
        words[up] += words[n]
        positive[up] += positive[n]
        holds[up] |= holds[n]
        marked[up] |= marked[n] or names[n] in _CONTENT and evidence[n] >= -1 and holds[n]
    bad = [False] * size
    for n in range(1, size):
        if bad[parents[n]]:
            bad[n] = True
        elif evidence[n] < -1 and score[n] + evidence[n] * words[n] < 0:
            # text of readers and related pages is rich too, so it is let off only if no long text stands outside
            most = marked[n] or 2 * positive[n] > positive[0]
            bad[n] = hard[n] or not most or evidence[n] < -3.2 and long_outside or "c:<!hidden>" in features[n]
    return [bad[b.place] for b in found]


def best_stretch(scores: list[float], costs: list[float]) -> tuple[int, int]:
    """``start, stop`` of the greatest sum of consecutive scores, less the costs of passing on to each but the first; (0, 0) if none is above 0."""
    best, stretch, sum_, start = 0.0, (0, 0), 0.0, 0
    for k, own in enumerate(scores):
        if sum_ <= costs[k]:
            sum_, start = 0.0, k
        else:
            sum_ -= costs[k]
        sum_ += own
        if sum_ > best:
            best, stretch = sum_, (start, k + 1)
    return stretch


def count_features(page: str) -> Counter:
    """``(feature, inside)`` counts of a page that marks its article, else nothing."""
    found, tree = blocks(page)
    bad = furniture(found, tree, weights({}))
    counts: Counter = Counter()
    if not any(b.labelled and not out for b, out in zip(found, bad, strict=True)):
        return counts
    words = [[0] * len(tree.names), [0] * len(tree.names)]
    for b, out in zip(found, bad, strict=True):
        inside = b.labelled and not out
        counts[b.feature, inside] += b.words
        counts["t:open", inside] += b.tags
        words[inside][b.place] += b.words
    for n in range(len(tree.names) - 1, 0, -1):
        for inside in (False, True):
            words[inside][tree.parents[n]] += words[inside][n]
            if words[inside][n]:
                for f in tree.features[n]:
                    counts[f, inside] += words[inside][n]
    return counts


def weights(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """Log-odds of each feature inside the article against outside; tags are negative."""
    total: Counter = Counter(counts)
    for feature, inside, outside in PRIOR:
        total[feature, True] += inside
        total[feature, False] += outside
    out = {}
    for f in {f for f, _ in total}:
        least = 1 if f in _KNOWN else UNKNOWN
        odds = math.log((total[f, True] + least) / (total[f, False] + least))
        out[f] = min(-0.1, max(-1.0, odds)) if f[0] == "t" else max(-6.0, min(0.0, odds)) if f[0] == "c" else max(-3.0, min(3.0, odds))
    return out


def score_of(weight: dict[str, float], feature: str) -> float:
    """A word's score; of a kind never seen, the average of those of its element."""
    if feature in weight:
        return weight[feature]
    like = [v for f, v in weight.items() if f.startswith(feature[: feature.index(":", 2) + 1])]
    return sum(like) / len(like) if like else 0.0


@lru_cache(1)
def prior() -> dict[str, float]:
    return weights({})


def main_text(page: str | None, weight: dict[str, float]) -> str:
    found, tree = blocks(page or "")
    bad = furniture(found, tree, weight)
    for by in (weight, prior()):
        score = {f: score_of(by, f) for f in {b.feature for b in found}}
        scores = [0.0 if out else b.words * score[b.feature] for b, out in zip(found, bad, strict=True)]
        costs = [-by["t:open"] if out else -by["t:open"] * b.tags for b, out in zip(found, bad, strict=True)]
        start, stop = best_stretch(scores, costs)
        if start < stop:
            break
    else:  # nothing scores above zero: all that is not furniture
        return " ".join(b.text for b, out in zip(found, bad, strict=True) if not out)
    held = [0] * len(tree.names)
    for b, out in zip(found[start:stop], bad[start:stop], strict=True):
        held[b.place] += not out
    for n in range(len(held) - 1, 0, -1):
        held[tree.parents[n]] += held[n]
    holder = max(n for n in range(len(held)) if held[n] == held[0])  # the innermost element that holds all
    while tree.names[holder] in _LEAVES:
        holder = tree.parents[holder]
    marked = holder
    while marked and tree.names[marked] != "article":
        marked = tree.parents[marked]
    holder = marked or holder
    if tree.names[holder] not in ("", "html", "body"):
        within = [False] * len(tree.names)
        for n in range(holder, len(within)):
            within[n] = n == holder or within[tree.parents[n]]
        rich = [k for k, b in enumerate(found) if within[b.place] and (scores[k] > 0 or marked and not bad[k])]
        start, stop = min(start, rich[0]), max(stop, rich[-1] + 1)
    return " ".join(b.text for b, out in zip(found[start:stop], bad[start:stop], strict=True) if not out)


def train(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Weights from at most ``sample`` pages."""
    chosen = pages.where("page_id IS NOT NULL").select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(sample)
    rows = pages.select("page_id", "html").join(F.broadcast(chosen), "page_id")

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in source:
            for page in batch["html"]:
                total.update(count_features(page.as_py() or ""))
        yield pa.RecordBatch.from_pydict({"feature": pa.array([f for f, _ in total], pa.string()), "inside": pa.array([i for _, i in total], pa.bool_()), "n": pa.array(list(total.values()), pa.int64())})

    got = rows.select("html").mapInArrow(count, "feature string, inside boolean, n long").groupBy("feature", "inside").agg(F.sum("n").alias("n"))
    return weights({(r["feature"], r["inside"]): r["n"] for r in got.collect()})


def extract(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in source:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                texts = [main_text(page.as_py(), weight) for page in batch["html"]]
                yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    return pages.mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op1_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


#: The same text for pages that mark their article and hold nothing else in it, as those of the test tables do.
OP1_SQL = r"""
WITH bodies AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)(?:</article>|$)', 1) AS body FROM pages),
bare AS (SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(?:p|h[1-6]|div|ul|li|br)[^>]*>', ' ', 'g'), '<[^>]*(?:>|$)', '', 'g') AS body FROM bodies),
decoded AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(body, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '&amp', '&') AS body FROM bare),
texts AS (SELECT page_id, url, trim(regexp_replace(body, '\s+', ' ', 'g')) AS text FROM decoded)
SELECT page_id, url, text, len(text)::BIGINT AS n_chars FROM texts
"""
