"""Token ids of whole texts by a public tokenizer's file, each distinct chunk of a text encoded once per worker."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.textbytes import slices, span_hashes, word_bounds
from corpusloom.session import stage_table

END_ID = 2
ENCODED_BYTES = 1 << 20
TABLE_BITS = 21
TRAILING = b".,!?;:*$%&#"
"""Closing marks that the split rule always cuts off from a letter or digit and that are part of no special token."""

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MARK = np.zeros(256, bool)
_MARK[list(TRAILING)] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_LATIN = np.zeros(256, bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True  # after C3: the letters of U+00C0 to U+00FF
_workers: dict[str, "SpanEncoder"] = {}


class _SpanTable:
    """Spans by hash with their ids, in flat arrays; it is emptied when half full, so its memory is bounded."""

    def __init__(self, kind: str):
        self.kind = kind
        self.clear()

    def clear(self) -> None:
        size = 1 << TABLE_BITS
        self.used = 0
        self.keys, self.checks = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.begins, self.counts = np.zeros(size, np.int64), np.zeros(size, np.int32)
        self.filled, self.ids = 0, np.zeros(1 << 16, self.kind)

    def find(self, keys: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The slot of each span, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        at = (keys & mask).astype(np.int64)
        there = self.keys[at]
        found = np.where((there == keys) & (self.checks[at] == checks), at, -1)
        left = np.flatnonzero((found < 0) & (there != 0))
        while len(left):
            at[left] = (at[left] + 1) & int(mask)
            there = self.keys[at[left]]
            hit = (there == keys[left]) & (self.checks[at[left]] == checks[left])
            found[left[hit]] = at[left[hit]]
            left = left[~hit & (there != 0)]
        return found

    def add(self, keys: np.ndarray, checks: np.ndarray, ids: list[list[int]]) -> None:
        counts = np.array([len(x) for x in ids], np.int32)
        total = int(counts.sum())
        if self.filled + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), total), self.kind)])
        self.ids[self.filled : self.filled + total] = np.fromiter((i for x in ids for i in x), self.kind, total)
        begins = self.filled + np.cumsum(counts) - counts
        self.filled += total
        self.used += len(keys)
        mask = len(self.keys) - 1
        at = (keys & np.uint64(mask)).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == 0]
            _, one = np.unique(at[free], return_index=True)
            put = free[one]
            slots = at[put]
            self.keys[slots], self.checks[slots], self.begins[slots], self.counts[slots] = keys[put], checks[put], begins[put], counts[put]
            left = np.setdiff1d(left, put, assume_unique=True)
            at[left] = (at[left] + 1) & mask


class SpanEncoder:
    """Encodes texts span by span and keeps the ids of each distinct span.

    A chunk between ASCII white space is lower-cased in A to Z (the tokenizer lower-cases, too) and loses the closing
    marks after a letter or digit, which make a span of their own; no token crosses these borders.  Chunks with ``<|``
    are taken as they are, as special tokens are known in one case only.  A tokenizer for which the borders do not hold
    is found out when it is loaded: its texts are encoded whole.  Spans are recognised by a 64-bit hash, their first
    eight bytes and their length.  ``kind`` is the stored width of an id: two bytes if the vocabulary allows, else four.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.table = _SpanTable(self.kind)
        words, marks = ["word", "ünï", "12", "ñé", "Æß"], TRAILING.decode()
        self.splits = all(
            self.ids([a.title() + m + m + " " + b]) == [sum(self.ids([a, m + m, b]), [])] for a in words for b in words for m in marks
        )

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def spans(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(bytes, starts, ends, first span of each row and the total)``."""
        starts, ends, firsts = word_bounds(data, at)
        low = _LOWER[data]
        if not len(starts):
            return low, starts, ends, firsts
        stem = np.maximum.accumulate(np.where(_MARK[data], -1, np.arange(len(data))))[ends - 1]
        closed = _ALNUM[data[stem]] | (_LATIN[data[stem]] & (data[np.maximum(stem - 1, 0)] == 0xC3) & (stem > starts))
        cut = np.where((stem >= starts) & (stem + 1 < ends) & closed, stem + 1, ends)
        raw = data.tobytes()
        place = raw.find(b"<|")
        while place >= 0:
            i = int(np.searchsorted(starts, place, "right")) - 1
            low[starts[i] : ends[i]] = data[starts[i] : ends[i]]
            cut[i] = ends[i]
            place = raw.find(b"<|", int(ends[i]))
        tails = np.flatnonzero(cut < ends)
        parts = np.ones(len(starts), np.int64)
        parts[tails] = 2
        before = np.concatenate([[0], np.cumsum(parts)])
        span_starts, span_ends = np.repeat(starts, parts), np.repeat(cut, parts)
        span_starts[before[tails] + 1], span_ends[before[tails] + 1] = cut[tails], ends[tails]
        return low, span_starts, span_ends, before[firsts]

    def encode(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a slice, and where each row's ids begin (and the total)."""
        if not self.splits:
            raw = data.tobytes()
            ids = self.ids([raw[a:b].decode() for a, b in zip(at.tolist(), at[1:].tolist())])
            return np.fromiter((i for x in ids for i in x), self.kind), np.cumsum([0, *map(len, ids)])
        low, starts, ends, firsts = self.spans(data, at)
        keys = span_hashes(low, starts, ends) | np.uint64(1)
        padded = np.concatenate([low, np.zeros(8, np.uint8)])
        width = np.minimum(ends - starts, 8).astype(np.uint64)
        heads = np.ndarray(len(low) + 1, "<u8", padded.tobytes(), strides=(1,))[starts]
        checks = (heads << (np.uint64(64) - width * np.uint64(8))) ^ (ends - starts).astype(np.uint64)
        table = self.table
        slots = table.find(keys, checks)
        raw = low.tobytes()
        while len(missing := np.flatnonzero(slots < 0)):
            if table.used > len(table.keys) // 2:
                table.clear()
                missing = np.arange(len(keys))
            _, one = np.unique(keys[missing], return_index=True)
            new = missing[one]
            table.add(keys[new], checks[new], self.ids([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())]))
            slots[missing] = table.find(keys[missing], checks[missing])
        counts = table.counts[slots].astype(np.int64)
        before = np.concatenate([[0], np.cumsum(counts)])
        ids = table.ids[np.repeat(table.begins[slots] - before[:-1], counts) + np.arange(before[-1])]
        return ids, before[firsts]

    def documents(self, data: np.ndarray, at: np.ndarray, end_id: int) -> list[bytes]:
        """Each row's ids and the end id, as bytes."""
        ids, cuts = self.encode(data, at)
        raw, size = memoryview(ids.tobytes()), ids.itemsize
        one = np.array([end_id], self.kind).tobytes()
        return [bytes(raw[a * size : b * size]) + one for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def encoder(path: str) -> SpanEncoder:
    """The encoder of this worker process; tasks that reuse the worker find its spans."""
    if path not in _workers:
        _workers[path] = SpanEncoder(path)
    return _workers[path]


def staged_ids(docs: DataFrame, tokenizer: str, id_col: str, text_col: str, end_id: int = END_ID) -> DataFrame:
    """A written table ``(doc_id, part, local_start, n_tokens, ids)``: each text is encoded once, by one task.

    ``part`` is the task and ``local_start`` the number of ids before the document there, so the number of ids before it
    overall is the total of the tasks before plus ``local_start``.  What a lost executor wrote stays in the shared
    folder; a task that runs again writes its file anew, whole.
    """

    def encode(batches):
        part, start = TaskContext.get().partitionId(), 0
        coder = encoder(tokenizer)
        for batch in batches:
            for row, end, data, at in slices(batch.column(1), ENCODED_BYTES):
                ids = coder.documents(data, at, end_id)
                counts = np.array([len(b) for b in ids], np.int64) // np.dtype(coder.kind).itemsize
                starts = start + np.cumsum(counts) - counts
                start += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(row, end - row),
                        pa.array(np.full(len(ids), part, np.int32)),
                        pa.array(starts),
                        pa.array(counts),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc_id", "part", "local_start", "n_tokens", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        encode, f"doc_id {kind}, part int, local_start bigint, n_tokens bigint, ids binary"
    )
    return stage_table(rows, "ids")


def widened(ids: bytes, count: int) -> np.ndarray:
    """Stored ids as little-endian unsigned 32-bit integers."""
    return np.frombuffer(ids, f"<u{len(ids) // count}" if count else "<u4").astype("<u4")


def part_bases(staged: DataFrame, part: str = "part", count: str = "n_tokens") -> np.ndarray:
    """Ids before each task: one number for each task of the writing job, which the driver tracks anyway."""
    totals = staged.groupBy(part).agg(F.sum(count).alias("n")).toPandas()
    size = int(totals[part].max()) + 1 if len(totals) else 0
    sums = np.zeros(size + 1, np.int64)
    sums[totals[part].to_numpy(np.int64) + 1] = totals["n"].to_numpy(np.int64)
    return np.cumsum(sums)
