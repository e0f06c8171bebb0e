"""Ranked merges of one word at a time: a fold that looks its neighbours up in a constant map.

The cost of a word follows its length and not the number of merges: each step makes the merge of lowest rank that is
present, and only the two neighbourhoods that it changes are looked up again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.idstrings import GAP, MISSING

# Characters above every id: no merge (it is larger than all that stand for one), and the end of a word.
NONE, END = GAP, MISSING
# The factor that deals a pair of characters to a bucket of the map, and the width of a character in a key.
FACTOR = 40503
WIDTH_BITS = 21
WIDTH = 1 << WIDTH_BITS


class MergeMap:
    """``left, right -> merged`` (one character each) as a constant: an array of buckets with about one entry each.

    Spark searches a map from its first entry on, so one map of all merges would be read whole for each pair.
    """

    def __init__(self, merges: Iterable[tuple[str, str, str]]):
        merges = list(merges)
        self.mask = (1 << max(6, len(merges).bit_length())) - 1
        buckets: list[dict[str, str]] = [{} for _ in range(self.mask + 1)]
        for left, right, merged in merges:
            key = ord(left) * WIDTH + ord(right)
            buckets[((key >> WIDTH_BITS) * FACTOR + key) & self.mask][str(key)] = merged
        parsed = F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,string>>")
        self.column = parsed.cast("array<map<bigint,string>>")

    def folding(self, body: Callable[[Callable[[Column], Column]], Column], kind: str) -> Column:
        """``body(fold)`` of type ``kind``, where ``fold`` merges a word; the constant is held once for all words."""
        return held_once(self.column, lambda held: body(lambda word: ranked_merges(word, held, self.mask)), kind)


def held_once(constant: Column, body: Callable[[Column], Column], kind: str) -> Column:
    """``body(constant)`` of type ``kind``, with a large constant kept once however often the body reads it."""
    return F.aggregate(F.array(constant), F.lit(None).cast(kind), lambda _, held: body(held))


def _big(value: int) -> Column:
    return F.lit(value).cast("bigint")


def _code(char: Column) -> Column:
    return F.ascii(char).cast("bigint")


def _char(text: Column, i: Column) -> Column:
    return F.substring(text, i, F.lit(1))


def ranked_merges(word: Column, buckets: Column, mask: int) -> Column:
    """An id string after its merges: that of the smallest character first, leftmost first, until none is left.

    The state is the word between two ``END`` and, for each two neighbours in it, the character they merge to, both as
    strings; when no neighbours merge, the second is emptied and the steps that are left do nothing.  A value that is needed
    more than once is an element of an array that is aggregated or transformed, which computes it once and copies
    nothing.  The time grows with the square of the length, so long strings want another way.
    """

    def look(key: Column) -> Column:
        place = (F.shiftright(key, WIDTH_BITS) * _big(FACTOR) + key).bitwiseAND(_big(mask)).cast("int")
        return F.coalesce(F.get(buckets, place)[key], F.lit(NONE))

    def start(ends: Column, codes: Column) -> Column:
        # The last one has no neighbour: its key is null and is not found.
        keys = F.transform(codes, lambda a, i: a * _big(WIDTH) + F.get(codes, i + 1))
        joins = F.array_join(F.transform(keys, look), "")
        return F.struct(ends.alias("pieces"), F.concat(F.lit(NONE), joins).alias("joins"))

    def merge(state: Column, new: Column, i: Column) -> Column:
        pieces = state["pieces"]
        before, after = _code(_char(pieces, i - 1)), _code(_char(pieces, i + 2))
        keys = F.array(before * _big(WIDTH) + _code(new), _code(new) * _big(WIDTH) + after)
        both = F.array_join(F.transform(keys, look), "")
        return F.struct(
            F.overlay(pieces, new, i, F.lit(2)).alias("pieces"), F.overlay(state["joins"], both, i - 1, F.lit(3)).alias("joins")
        )

    def lowest(state: Column, new: Column) -> Column:
        merges = F.aggregate(F.array(F.instr(state["joins"], new)), state, lambda s, i: merge(s, new, i))
        return F.when(new == NONE, F.struct(state["pieces"].alias("pieces"), F.lit("").alias("joins"))).otherwise(merges)

    def step(state: Column, _: Column) -> Column:
        made = F.aggregate(F.array(F.array_min(F.split(state["joins"], ""))), state, lowest)
        return F.when(state["joins"] == "", state).otherwise(made)

    def all_steps(_: Column, codes: Column) -> Column:
        begun = start(F.concat(F.lit(END), word, F.lit(END)), codes)
        return F.aggregate(codes, begun, step, lambda state: F.substring(state["pieces"], F.lit(2), F.length(state["pieces"]) - 2))

    codes = F.transform(F.split(word, ""), _code)
    folded = F.aggregate(F.array(codes), F.lit(""), all_steps)
    return F.when(F.length(word) < 2, word).otherwise(folded)
