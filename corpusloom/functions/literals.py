"""Many literals in one pass over a text."""

from __future__ import annotations

import json
import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.folding import held_once

# A choice of more branches is made by groups, each behind the class of its first characters.
FEW_BRANCHES = 4


def _quoted(char: str) -> str:
    return char if char.isalnum() or ord(char) > 127 or char.isspace() else "\\" + char


def prefix_pattern(words: list[str]) -> str:
    """A pattern that matches the longest of some words at a place; words with a common beginning share it.

    A pattern tries its branches one after another, so many branches are put into groups of groups that one class of
    characters opens or skips.
    """
    tree: dict = {}
    for word in words:
        node = tree
        for char in word:
            node = node.setdefault(char, {})
        node[""] = {}

    def choice(branches: list[tuple[str, str]]) -> str:
        if len(branches) <= FEW_BRANCHES:
            return "|".join(branch for _, branch in branches)
        size = -(-len(branches) // FEW_BRANCHES)
        groups = [branches[i : i + size] for i in range(0, len(branches), size)]
        opened = ["".join(f"\\x{{{ord(first):x}}}" for first, _ in group) for group in groups]
        return "|".join(f"(?=[{firsts}])(?:{choice(group)})" for firsts, group in zip(opened, groups))

    def render(node: dict) -> str:
        branches = []
        for char, below in node.items():
            if char:
                first, head = char, _quoted(char)
                while len(below) == 1 and "" not in below:
                    char, below = next(iter(below.items()))
                    head += _quoted(char)
                branches.append((first, head + render(below)))
        if not branches:
            return ""
        return f"(?:{choice(sorted(branches))})" + ("?" if "" in node else "")

    return render(tree)


def literals_in(text: Column, words: list[str]) -> Column:
    """The distinct ``words`` that a text holds, as an array; words inside or across others count as well.

    One search looks ahead at every place for the longest word there; all others that begin at that place are its
    beginnings, so they follow from it.
    """
    if not words:
        return F.array().cast("array<string>")
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?=({prefix_pattern(words)}))"), F.lit(1)))
    known = set(words)
    shorter = {w: [w[:n] for n in range(len(w)) if w[:n] in known] for w in known}
    shorter = {w: s for w, s in shorter.items() if s}
    if not shorter:
        return found
    # A map is searched from its first entry on, so there are many small ones.
    mask = (1 << len(shorter).bit_length()) - 1
    buckets: list[dict[str, list[str]]] = [{} for _ in range(mask + 1)]
    for word, beginnings in shorter.items():
        buckets[zlib.crc32(word.encode()) & mask][word] = beginnings
    inner = F.from_json(F.lit(json.dumps(buckets)), "array<map<string,array<string>>>")
    none = F.array().cast("array<string>")

    def beginnings_of(word: Column) -> Column:
        place = F.crc32(word.cast("binary")).bitwiseAND(F.lit(mask).cast("bigint")).cast("int")
        return F.coalesce(F.get(inner, place)[word], none)

    # The search runs once, though its result is read twice.
    return held_once(
        found, lambda held: F.array_distinct(F.concat(held, F.flatten(F.transform(held, beginnings_of)))), "array<string>"
    )
