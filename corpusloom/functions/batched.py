"""Merges and pair counts over whole Arrow batches of texts.

As in ``packed``, each function defines what runs in the workers inside itself, so that it travels with the plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.idstrings import SURROGATES_SIZE, SURROGATES_START
from corpusloom.functions.packed import IDS, WIDTH

# Text that is worked on in one go inside a batch (or one longer text).
CHUNK_BYTES = 1 << 20
# Merges of one step: its table has a cell for each left part and each right part.
STEP_MERGES = 1_024
# Looks at all places of a chunk before only those that are left are listed.
FULL_LOOKS = 3
# Pairs of token kinds up to which they are counted in a table.
PAIR_CELLS = 1 << 20
PAIRS = "left int, right int, cnt bigint, first_key bigint"

Merge = tuple[int, int, int]


def merge_steps(merges: list[Merge]) -> list[list[Merge]]:
    """The merges in runs of which none makes a token that another one takes.

    Inside such a run no merge makes a place for another one, so all places are known from the start.
    """
    steps: list[list[Merge]] = []
    made: set[int] = set()
    for left, right, token_id in merges:
        if not steps or left in made or right in made or len(steps[-1]) == STEP_MERGES:
            steps.append([])
            made = set()
        steps[-1].append((left, right, token_id))
        made.add(token_id)
    return steps


def _step_tables(step: list[Merge], n_ids: int) -> tuple[np.ndarray, ...]:
    """For each id its row as left part and its column as right part (0: none), the table's ranks, the tokens by rank, and
    where all parts are bytes the ranks of all pairs of bytes."""
    lefts, rights = sorted({m[0] for m in step}), sorted({m[1] for m in step})
    row, column = np.zeros(n_ids, np.int32), np.zeros(n_ids, np.int32)
    row[lefts] = np.arange(1, len(lefts) + 1) * (len(rights) + 1)
    column[rights] = np.arange(1, len(rights) + 1)
    ranks = np.full((len(lefts) + 1) * (len(rights) + 1), len(step), np.int16)
    for rank, (left, right, _) in enumerate(step):
        ranks[row[left] + column[right]] = rank
    of_bytes = ranks[(row[:256, None] + column[None, :256]).ravel()] if lefts[-1] < 256 and rights[-1] < 256 else None
    return row, column, ranks, np.array([m[2] for m in step]), of_bytes


def merged_ids(text: Column, merges: list[Merge], lead: int | None = None, packed: bool = False) -> Column:
    """The ids of whole texts after all merges in rank order, the id ``lead`` before them; null for a null text.

    A step finds the places of all its merges at once.  Places that overlap go by rank, then from left to right: a place
    is taken when no neighbour comes before it, its neighbours are dropped, and so on until none is left.  In a run of
    one token places are every second one.  The cost is the text by the number of steps, not of merges.
    """
    n_ids = 1 + max([255] + [m[2] for m in merges])
    steps = [_step_tables(step, n_ids) for step in merge_steps(merges)]
    kind = np.uint16 if n_ids <= 1 << 16 else np.int32

    def every_second(taken: np.ndarray, goes_on: np.ndarray) -> None:
        """Runs, of which each place but the first goes on, are taken where neither end waits for a neighbour."""
        in_run = goes_on.copy()
        in_run[:-1] |= goes_on[1:]
        runs = np.flatnonzero(in_run)
        starts = np.flatnonzero(~goes_on[runs])
        sizes = np.diff(np.append(starts, len(runs)))
        waits = np.logical_or.reduceat(~taken[runs], starts)
        taken[runs] = ~np.repeat(waits, sizes) & ((np.arange(len(runs)) - np.repeat(starts, sizes)) % 2 == 0)

    def few_places(at: np.ndarray, rank: np.ndarray, here: np.ndarray) -> None:
        """Marks those of the places ``at`` that are taken."""
        while len(at):
            beside = np.diff(at) == 1
            change = np.diff(rank)
            taken = np.ones(len(at), bool)
            taken[1:] = ~(beside & (change > 0))
            taken[:-1] &= ~(beside & (change < 0))
            same = beside & (change == 0)
            if same.any():
                every_second(taken, np.concatenate([[False], same]))
            here[at[taken]] = True
            stays = ~taken
            stays[1:] &= ~(taken[:-1] & beside)
            stays[:-1] &= ~(taken[1:] & beside)
            at, rank = at[stays], rank[stays]

    def many_places(found: np.ndarray, none: int, here: np.ndarray) -> None:
        """The same where nearly every place has a rank: all are looked at until few are left."""
        open_ = np.full(len(found) + 2, none, found.dtype)
        mid = open_[1:-1]
        mid[:] = found
        for _ in range(FULL_LOOKS):
            alive = mid < none
            taken = (open_[:-2] >= mid) & (open_[2:] >= mid) & alive
            goes_on = (open_[:-2] == mid) & alive
            if goes_on.any():
                every_second(taken, goes_on)
            here[:-1] |= taken
            gone = taken.copy()
            gone[1:] |= taken[:-1]
            gone[:-1] |= taken[1:]
            np.putmask(mid, gone, none)
        at = np.flatnonzero(mid < none)
        few_places(at, mid[at], here)

    def merged(ids: np.ndarray, ends: np.ndarray, step: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
        row, column, ranks, tokens, of_bytes = step
        if len(ids) < 2:
            return ids, ends
        none = len(tokens)
        here, closed = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        closed[ends[ends > 0] - 1] = True  # texts do not merge into the next one
        if ids.dtype == np.uint8 and of_bytes is not None:
            found = of_bytes.take((ids[:-1].astype(np.uint16) << 8) | ids[1:])
            np.putmask(found, closed[:-1], none)
            many_places(found, none, here)
            at = np.flatnonzero(here)
            rank = found[at]
        else:
            left = row.take(ids)
            at = np.flatnonzero((left[:-1] > 0) & ~closed[:-1])
            rank = ranks.take(left[at] + column.take(ids[at + 1]))
            held = rank < none
            at, rank = at[held], rank[held]
            few_places(at, rank, here)
            held = here[at]
            at, rank = at[held], rank[held]
        if not len(at):
            return ids, ends
        ids = ids.astype(kind)
        ids[at] = tokens.take(rank)
        stays = np.ones(len(ids), bool)
        np.logical_not(here[:-1], out=stays[1:])
        return ids[stays], ends - np.searchsorted(at, ends)

    @F.arrow_udf(T.BinaryType() if packed else IDS)
    def encoded(rows: pa.Array) -> pa.Array:
        rows = rows.cast(pa.large_binary())
        at = np.frombuffer(rows.buffers()[1], np.int64)[rows.offset : rows.offset + len(rows) + 1]
        data = np.frombuffer(rows.buffers()[2] or b"", np.uint8)
        valid = ~np.asarray(rows.is_null())
        parts, counts, first = [], [], 0
        while first < len(rows):
            last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
            ids, ends = data[at[first] : at[last]], at[first + 1 : last + 1] - at[first]
            for step in steps:
                ids, ends = merged(ids, ends, step)
            sizes = np.diff(ends, prepend=0)
            if lead is not None:
                led = valid[first:last]
                ids = np.insert(ids.astype(np.int32), (ends - sizes)[led], lead)
                sizes = sizes + led
            parts.append(ids.astype("<i4"))
            counts.append(sizes)
            first = last
        ids = np.concatenate(parts) if parts else np.zeros(0, "<i4")
        ends = np.concatenate([[0], *counts]).cumsum()
        if packed:
            mask = pa.array(valid).buffers()[1] if rows.null_count else None
            ends = (ends * WIDTH).astype(np.int32)
            return pa.Array.from_buffers(pa.binary(), len(rows), [mask, pa.py_buffer(ends), pa.py_buffer(ids)])
        mask = rows.is_null() if rows.null_count else None
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids), mask=mask)

    return encoded(text.cast("binary"))


def counted_pairs(sequences: DataFrame) -> DataFrame:
    """``(left, right, cnt, first_key)`` of the adjacent ids of sequences ``(seq, n, start)``: counted for each chunk of a
    batch, of which a task then gives a row for each pair, and summed."""

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tally(codes: np.ndarray, sizes: np.ndarray, n: np.ndarray | None, start: np.ndarray | None) -> pa.RecordBatch:
            """The pairs of sequences laid one after another; without ``n`` or ``start`` that column is null."""
            numbered = np.arange(256)
            own = codes
            if codes.dtype != np.uint8:
                kinds, numbered = np.zeros(int(codes.max()) + 1, np.int64), np.flatnonzero(np.bincount(codes))
                kinds[numbered] = np.arange(len(numbered))
                own = kinds[codes]
            key = own[:-1].astype(np.int64)
            key *= len(numbered)
            key += own[1:]
            places = np.arange(len(numbered) ** 2) if len(numbered) ** 2 <= PAIR_CELLS else None
            if places is None:
                places, key = np.unique(key, return_inverse=True)
            # What a text ends with and the next one begins with goes to a place of its own.
            begins = np.cumsum(sizes) - sizes
            key[begins[1:] - 1] = len(places)
            seen = np.bincount(key, minlength=len(places) + 1)[:-1]
            kept = np.flatnonzero(seen)
            cnt = first = None
            if n is not None and (n == n[0]).all():
                cnt = seen[kept] * n[0]
            elif n is not None:
                cnt = np.zeros(len(places) + 1, np.int64)
                np.add.at(cnt, key, np.repeat(n, sizes)[:-1])
                cnt = cnt[kept]
            if start is not None:
                ahead = start - begins
                if (ahead[1:] >= ahead[:-1]).all():  # places rise: the last one written from behind is the first one
                    place = np.zeros(len(places) + 1, np.int64)
                    place[key[::-1]] = np.arange(len(key) - 1, -1, -1)
                    place = place[kept]
                    first = place + ahead[np.searchsorted(begins, place, "right") - 1]
                else:
                    first = np.full(len(places) + 1, np.iinfo(np.int64).max)
                    np.minimum.at(first, key, np.arange(len(key)) + np.repeat(ahead, sizes)[:-1])
                    first = first[kept]
            left, right = np.divmod(places[kept], len(numbered))
            columns = [pa.array(numbered[side].astype(np.int32)) for side in (left, right)]
            columns += [pa.nulls(len(kept), pa.int64()) if c is None else pa.array(c) for c in (cnt, first)]
            return pa.RecordBatch.from_arrays(columns, names=["left", "right", "cnt", "first_key"])

        def codes_of(part: memoryview) -> np.ndarray:
            text = str(part, "utf-8")
            try:
                return np.frombuffer(text.encode("latin-1"), np.uint8)
            except UnicodeEncodeError:
                codes = np.frombuffer(text.encode("utf-32-le"), "<i4")
                return codes - SURROGATES_SIZE * (codes >= SURROGATES_START)

        for batch in batches:
            seqs, n, start = batch.columns
            seqs = seqs.cast(pa.large_string())
            at = np.frombuffer(seqs.buffers()[1], np.int64)[seqs.offset : seqs.offset + len(seqs) + 1]
            data = memoryview(seqs.buffers()[2] or b"")
            nulls = [np.asarray(c.is_null()) for c in (n, start)]
            n, start = (c.fill_null(0).to_numpy() for c in (n, start))
            first = 0
            while first < len(seqs):
                last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK_BYTES, "right")) - 1)
                part = data[at[first] : at[last]]
                codes = codes_of(part)
                before = np.zeros(len(part) + 1, np.int64)
                np.cumsum((np.frombuffer(part, np.uint8) & 0xC0) != 0x80, out=before[1:])
                sizes = np.diff(before[at[first : last + 1] - at[first]])
                chunk = slice(first, last)
                for no_n, no_start in ((False, False), (False, True), (True, False), (True, True)):
                    some = (nulls[0][chunk] == no_n) & (nulls[1][chunk] == no_start) & (sizes > 1)
                    if some.any():
                        held = codes if some.all() else codes[np.repeat(some, sizes)]
                        given = [None if no else c[chunk][some] for no, c in ((no_n, n), (no_start, start))]
                        yield tally(held, sizes[some], *given)
                first = last

    rows = sequences.select("seq", F.col("n").cast("bigint"), F.col("start").cast("bigint")).where(F.col("seq").isNotNull())
    return rows.mapInArrow(pairs, PAIRS).groupBy("left", "right").agg(F.sum("cnt").alias("cnt"), F.min("first_key").alias("first_key"))
