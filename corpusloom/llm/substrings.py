"""Removal of word windows that occur earlier in the corpus, found level by level at doubled lengths."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.textbytes import SLICE_BYTES, mix, row_of, slices, span_hashes, window_hashes, word_bounds
from corpusloom.session import stage_table

WINDOW = 20
LEVELS = 1
LAST = np.iinfo(np.int64).max


def repeated_windows(
    docs: DataFrame,
    window: int = WINDOW,
    levels: int = LEVELS,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """What is left of each text when every word is removed that a window of ``window`` words covers whose word
    sequence also starts earlier: in a document of smaller id, or further left in the same one.

    Level by level: the lengths are ``window`` halved ``levels`` times, doubling up to ``window``.  At a shorter length
    a window of full length is represented by its smallest sub-window (the leftmost of the smallest hash), which equal
    windows share; those whose sub-window occurs once in the corpus are out, the others are extended to the next
    length, and the work ends when none survives.  At full length every surviving window is compared.

    Documents are put into chunks of about 2 MB.  A chunk asks about each distinct hash once, so a passage that a third of
    all documents share is one entry a chunk; questions are dealt by hash, and the answers are bits in the order of
    the questions.  Hashes have 64 bits: two different windows are mixed up with a chance of 2^-64 a pair.

    Returns ``doc_id, n_words, n_removed, kept_sha256`` (``with_text``: also ``kept``, the kept words joined by spaces).

    Defined cases: null text has no words; the hash of no kept words is that of the empty string; of rows with one id
    the one read first is the earlier, and a null id comes last; shorter texts keep all words; no rows give no rows;
    other columns are ignored.  Ids must be whole numbers.
    """
    chunks = _chunks(docs, id_col, text_col)
    n_chunks = chunks.count()
    buckets = max(1, math.ceil(n_chunks**0.75))
    lengths = [max(1, window >> k) for k in range(levels, -1, -1)]
    answers: list[DataFrame] = []
    for level, length in enumerate(lengths):
        asked = _with_answers(chunks, answers).mapInArrow(
            _questions(window, lengths[: level + 1], buckets), "bucket int, chunk bigint, hashes binary, more binary, base bigint"
        )
        judge = _first_of_all if length == window else _repeated
        bits = asked.groupBy("bucket").applyInArrow(judge, "chunk bigint, bucket int, bits binary")
        answer = bits.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "bits")).alias(f"answer{level}"))
        answers.append(stage_table(answer, f"level{length}"))
        if answers[-1].isEmpty():
            break
    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept string" * with_text
    complete = len(answers) == len(lengths)
    return _with_answers(chunks, answers).mapInArrow(_kept(window, lengths, buckets, complete, with_text), schema)


def _chunks(docs: DataFrame, id_col: str, text_col: str, kind: str = "bigint", limit: int = SLICE_BYTES) -> DataFrame:
    """The texts as a written table of compressed chunks, each with its ids and text lengths."""

    def gather(batches):
        import zstandard

        packer = zstandard.ZstdCompressor(level=3)
        part, chunk = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        size = 0

        def flush():
            nonlocal held, size, chunk
            ids = pa.concat_arrays([i for _, _, i in held])
            sizes = np.concatenate([np.diff(at) for _, at, _ in held])
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([(part << 32) | chunk], pa.int64()),
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([packer.compress(b"".join(d.tobytes() for d, _, _ in held))], pa.binary()),
                ],
                names=["chunk", "ids", "sizes", "texts"],
            )
            held, size = [], 0
            chunk += 1
            return row

        for batch in batches:
            ids = batch.column(0)
            for row, end, data, at in slices(batch.column(1)):
                if held and size + len(data) > limit:
                    yield flush()
                held.append((data.copy(), at, ids.slice(row, end - row)))
                size += len(data)
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast(kind).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    made = rows.mapInArrow(gather, f"chunk bigint, ids array<{kind}>, sizes array<bigint>, texts binary")
    return stage_table(made, "chunks")


def _with_answers(chunks: DataFrame, answers: list[DataFrame]) -> DataFrame:
    for answer in answers:
        chunks = chunks.join(answer, "chunk", "left")
    return chunks


def _leftmost_smallest(h: np.ndarray, span: int) -> np.ndarray:
    """For each i, where the leftmost smallest value of ``h[i:i+span]`` is."""
    at, have = np.arange(len(h)), 1
    while have < span:
        step = min(have, span - have)
        left, right = at[:-step], at[step:]
        at = np.where(h[right] < h[left], right, left)
        have += step
    return at


class _Chunk:
    """One chunk's words, and its surviving windows after the answered levels."""

    def __init__(self, batch: pa.RecordBatch, i: int):
        import zstandard

        self.chunk = batch.column(0)[i].as_py()
        self.ids = batch.column(1)[i].values
        sizes = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        raw = zstandard.ZstdDecompressor().decompress(batch.column(3)[i].as_buffer())
        self.data = np.frombuffer(raw, np.uint8)
        self.answers = [batch.column(k)[i] for k in range(4, batch.num_columns)]
        self.starts, self.ends, self.firsts = word_bounds(self.data, self.at)
        self.rows = row_of(self.firsts)
        self.order = self.ids.fill_null(LAST).to_numpy(zero_copy_only=False)

    def windows(self, window: int) -> np.ndarray:
        """Where windows start: none leaves its document."""
        self.words = span_hashes(self.data, self.starts, self.ends)
        return np.flatnonzero(np.arange(len(self.rows)) + window <= self.firsts[1:][self.rows])

    def values(self, alive: np.ndarray, length: int, window: int):
        """Distinct hashes that stand for the windows, each window's among them, and where each window's one lies."""
        if not len(alive):
            return np.zeros(0, np.uint64), alive, alive
        h = window_hashes(self.words, length)
        at = alive if length == window else _leftmost_smallest(h, window - length + 1)[alive]
        chosen = h[at] if length == window else mix(h[at])  # smallest hashes lie low; mixed again they fill all buckets
        distinct, which = np.unique(chosen, return_inverse=True)
        return distinct, which, at

    def bits(self, level: int, distinct: np.ndarray, buckets: int) -> np.ndarray:
        """The answer of a level for each distinct hash."""
        found = np.zeros(len(distinct), bool)
        cuts = _cuts(distinct, buckets)
        for one in self.answers[level].as_py() or []:
            a, b = cuts[one["bucket"]], cuts[one["bucket"] + 1]
            found[a:b] = np.unpackbits(np.frombuffer(one["bits"], np.uint8), count=b - a).astype(bool)
        return found

    def first_window(self, alive: np.ndarray, which: np.ndarray, count: int) -> np.ndarray:
        """For each distinct hash the surviving window that comes first by document and start."""
        order = np.argsort(self.order[self.rows[alive]], kind="stable")
        first = np.zeros(count, np.int64)
        first[which[order[::-1]]] = order[::-1]
        return first


def _cuts(distinct: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's hashes begin: buckets are equal ranges of the upper 32 bits."""
    ends = (np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32)) // np.uint64(buckets)
    return np.searchsorted(distinct >> np.uint64(32), ends)


def _questions(window: int, lengths: list[int], buckets: int):
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch, i)
                alive = chunk.windows(window)
                for level, length in enumerate(lengths[:-1]):
                    distinct, which, _ = chunk.values(alive, length, window)
                    alive = alive[chunk.bits(level, distinct, buckets)[which]]
                distinct, which, at = chunk.values(alive, lengths[-1], window)
                base = 0
                if lengths[-1] == window:
                    more = chunk.order[chunk.rows[alive[chunk.first_window(alive, which, len(distinct))]]]
                    base = int(more.min()) if len(more) else 0
                    span = int(more.max()) - base if len(more) else 0
                    more = (more - base).astype(np.min_scalar_type(span)) if span <= LAST else more
                    base = base if span <= LAST else 0
                else:
                    places, once = np.unique(at, return_index=True)
                    more = np.bincount(which[once], minlength=len(distinct)) > 1
                cuts = _cuts(distinct, buckets)
                full = np.flatnonzero(np.diff(cuts))
                if len(full):
                    pieces = [(int(cuts[b]), int(cuts[b + 1])) for b in full]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(full.astype(np.int32)),
                            pa.array(np.full(len(full), chunk.chunk, np.int64)),
                            pa.array([distinct[a:b].tobytes() for a, b in pieces], pa.binary()),
                            pa.array([more[a:b].tobytes() for a, b in pieces], pa.binary()),
                            pa.array(np.full(len(full), base, np.int64)),
                        ],
                        names=["bucket", "chunk", "hashes", "more", "base"],
                    )

    return ask


def _pieces(asked: pa.Table):
    columns = [asked.column(n).to_pylist() for n in ("chunk", "hashes", "more", "base")]
    hashes = [np.frombuffer(h, np.uint64) for h in columns[1]]
    return columns[0], hashes, columns[2], columns[3]


def _answers(asked: pa.Table, chunks: list[int], hashes: list[np.ndarray], bits: np.ndarray) -> pa.Table:
    cuts = np.cumsum([0, *map(len, hashes)])
    packed = [np.packbits(bits[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "bucket": asked.column("bucket"), "bits": pa.array(packed, pa.binary())})


def _repeated(asked: pa.Table) -> pa.Table:
    """Whether each hash of a bucket lies at two places at least."""
    chunks, hashes, more, _ = _pieces(asked)
    every = np.concatenate(hashes)
    twice = np.concatenate([np.frombuffer(m, bool) for m in more])
    order = np.argsort(every, kind="stable")
    ranked = every[order]
    same = ranked[1:] == ranked[:-1]
    bits = np.zeros(len(every), bool)
    bits[order[1:]] |= same
    bits[order[:-1]] |= same
    return _answers(asked, chunks, hashes, bits | twice)


def _first_of_all(asked: pa.Table) -> pa.Table:
    """Whether the chunk's first window of each hash is the first of the whole corpus."""
    chunks, hashes, more, bases = _pieces(asked)
    every = np.concatenate(hashes)
    docs = np.concatenate(
        [np.frombuffer(m, _width(len(m) // max(1, len(h)))).astype(np.int64) + b for h, m, b in zip(hashes, more, bases)]
    )
    chunk = np.repeat(np.array(chunks, np.int64), [len(h) for h in hashes])
    order = np.lexsort((chunk, docs, every))
    bits = np.zeros(len(every), bool)
    bits[order] = np.concatenate([[True], every[order][1:] != every[order][:-1]])
    return _answers(asked, chunks, hashes, bits)


def _width(size: int) -> str:
    return {1: "u1", 2: "u2", 4: "u4", 8: "i8"}[size]


def _kept(window: int, lengths: list[int], buckets: int, complete: bool, with_text: bool):
    def write(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                chunk = _Chunk(batch, i)
                n = len(chunk.starts)
                cover = np.zeros(n + 1, np.int64)
                if complete:
                    alive = chunk.windows(window)
                    for level, length in enumerate(lengths[:-1]):
                        distinct, which, _ = chunk.values(alive, length, window)
                        alive = alive[chunk.bits(level, distinct, buckets)[which]]
                    distinct, which, _ = chunk.values(alive, window, window)
                    first = chunk.first_window(alive, which, len(distinct))
                    stays = np.zeros(len(alive), bool)
                    stays[first[chunk.bits(len(lengths) - 1, distinct, buckets)]] = True
                    gone = alive[~stays]
                    np.add.at(cover, gone, 1)
                    np.add.at(cover, gone + window, -1)
                removed = np.cumsum(cover)[:n] > 0
                out, cuts = _joined(chunk, ~removed)
                counts = np.diff(chunk.firsts)
                gone = np.concatenate([[0], np.cumsum(removed)])[chunk.firsts]
                kept = [out[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]
                columns = [
                    chunk.ids.cast(pa.int64()),
                    pa.array(counts.astype(np.int64)),
                    pa.array(np.diff(gone).astype(np.int64)),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ]
                names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array([bytes(k).decode() for k in kept], pa.string()))
                    names.append("kept")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return write


def _joined(chunk: _Chunk, keep: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The kept words of every document joined by one space each, and where each document begins."""
    starts, ends, rows = chunk.starts[keep], chunk.ends[keep], chunk.rows[keep]
    edge = np.zeros(len(chunk.data) + 2, np.int32)
    edge[starts] += 1
    edge[ends] -= 1
    inside = np.cumsum(edge[:-1])[: len(chunk.data) + 1] > 0
    out = np.append(chunk.data, np.uint8(0))
    follows = ends[:-1][rows[1:] == rows[:-1]]
    inside[follows] = True
    out[follows] = 32
    cuts = np.concatenate([[0], np.cumsum(inside)])[chunk.at]
    return memoryview(out[inside]), cuts
