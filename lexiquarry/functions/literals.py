"""What a regular expression cannot match without: literals, and one trie of many as a cheap test before the expressions.

Each expression gives a set of literals of which every text that it matches holds one, in any case; or none can be told.
The literals of all expressions make one trie, written as a regular expression that looks at each place of a text once,
so that texts without any of them, which are most, cost the same for three hundred expressions as for ten.

Expressions that begin alike are joined into one that tries what they share once, so that texts with a literal cost little more.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import lru_cache
from re import _constants as op
from re import _parser as parser

#: Shorter literals leave too little out.
LEAST = 3
#: Characters beyond ASCII that stand for an ASCII letter where case is left aside; texts with them are not left out.
ALIASES = "İıſK"
#: What means other things here than where the expressions run: classes in classes, and free spacing.
_OTHER = re.compile(r"\[[^\]]*\[|&&|\(\?[a-zA-Z]*x")

Literals = frozenset[str]


def _better(a: Literals | None, b: Literals | None) -> Literals | None:
    """Of two sets that both hold, the one whose shortest literal is longer, then the smaller."""
    if a is None or b is None:
        return b if a is None else a
    rank = lambda s: (min(map(len, s)), -len(s))
    return max(a, b, key=rank)


def _of(sequence) -> Literals | None:
    best: Literals | None = None
    run = ""

    def end() -> None:
        nonlocal best, run
        if len(run) >= LEAST:
            best = _better(best, frozenset([run]))
        run = ""

    for kind, value in sequence:
        if kind is op.LITERAL and value < 128 and (chr(value).isalnum() or value == ord("_")):
            run += chr(value).lower()
            continue
        end()
        if kind is op.SUBPATTERN:
            best = _better(best, _of(value[3]))
        elif kind is op.BRANCH:
            each = [_of(way) for way in value[1]]
            if all(each):
                best = _better(best, frozenset().union(*each))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and value[0] >= 1:
            best = _better(best, _of(value[2]))
        elif kind is op.ATOMIC_GROUP:
            best = _better(best, _of(value))
    end()
    return best


@lru_cache(1 << 12)
def required(pattern: str) -> Literals | None:
    """Literals, in lower case, of which each text that the pattern matches in any case holds one; None if that can't be told."""
    if _OTHER.search(pattern):
        return None
    try:
        return _of(parser.parse(pattern))
    except (re.error, OverflowError, RecursionError):
        return None


def _written(at: dict) -> str:
    """The expression of a trie, whose edges are pieces of expressions; a node with ``""`` ends one."""
    if "" in at:  # a shorter one is enough
        return ""
    ways = [c + _written(at[c]) for c in sorted(at)]
    return ways[0] if len(ways) == 1 else f"(?:{'|'.join(ways)})"


def _trie(sequences: Iterable[Sequence[str]]) -> dict:
    root: dict = {}
    for sequence in sequences:
        at = root
        for piece in sequence:
            at = at.setdefault(piece, {})
        at[""] = {}
    return root


def trie(literals: Literals) -> str:
    """An expression that finds any of the literals (or an alias) in a text in lower case."""
    root = _trie(literals)
    return f"(?=[{''.join(sorted(root))}{ALIASES}])(?:[{ALIASES}]|{_written(root)})"


#: One piece of an expression: an escape that is whole by itself, a class, or any character that means itself or has no parts.
_PIECE = re.compile(r"\\(?:[bBdDsSwWAzZnt]|[^A-Za-z0-9])|\[\^?(?!\])(?:[^\[\]\\]|\\[^QEcxu0-9pPN])+\]|[^\\\[\](){}*+?|]", re.S)
_REPEAT = re.compile(r"(?:[*+?]|\{[0-9]+(?:,[0-9]*)?\})[?+]?")
_GROUP = re.compile(r"\((?:\?(?::|=|!|>|<=|<!))?")


def _ways(pattern: str, at: int = 0) -> tuple[list[list[str]], int] | None:
    """The pieces, repeats with them, of each alternative from a place on up to a closing bracket or the end; None if any is not known."""
    ways: list[list[str]] = [[]]
    while at < len(pattern) and pattern[at] != ")":
        if pattern[at] == "|":
            ways.append([])
            at += 1
            continue
        began = at
        if opened := _GROUP.match(pattern, at):
            inner = _ways(pattern, opened.end())
            if inner is None or inner[1] == len(pattern) or pattern.startswith("?", opened.end()):
                return None
            at = inner[1] + 1
        elif piece := _PIECE.match(pattern, at):
            at = piece.end()
        else:
            return None
        if repeat := _REPEAT.match(pattern, at):
            at = repeat.end()
        ways[-1].append(pattern[began:at])
    return ways, at


def _parted(patterns: Iterable[str]) -> tuple[dict, list[str]]:
    """The trie of all patterns made of common pieces only, and the others."""
    shared, whole = [], []
    for p in dict.fromkeys(patterns):
        read = None if _OTHER.search(p) else _ways(p)
        if read is None or read[1] < len(p):
            whole.append(p)
        else:
            shared += read[0]
    return _trie(shared), whole


def joined(patterns: Iterable[str]) -> str:
    """One expression that is found in a text if one of the patterns, none of which refers to its own groups, is.

    What patterns begin with alike is tried once for all of them; a pattern with uncommon pieces stands as it is.
    """
    root, whole = _parted(patterns)
    return "|".join(([f"(?:{_written(root)})"] if root else []) + [f"(?:{p})" for p in whole])


def beginnings(patterns: Iterable[str]) -> int:
    """How many ways ``joined`` tries at each place of a text."""
    root, whole = _parted(patterns)
    return len(root) + len(whole)
