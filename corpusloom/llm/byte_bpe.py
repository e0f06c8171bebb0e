"""Byte-level BPE by a file of ranks: merges are folded over distinct words by Spark's higher-order functions."""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.folding import END, WIDTH, MergeMap, held_once
from corpusloom.functions.idstrings import MISSING, SURROGATES_SIZE, SURROGATES_START, id_char, string_array
from corpusloom.llm.textbytes import slices, span_checks, span_hashes

# Fixed value: the split rule of the rank files, which ``split_words`` follows.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
ONE_LETTER, TWO_LETTERS = "stmd", ("re", "ve", "ll")

LETTER, NUMBER, SPACE = 1, 2, 3
MAX_RANK = 1 << 19
LONG = 64
HELD_WORDS = 1 << 20
SLICE = 1 << 19


def character_classes() -> np.ndarray:
    """For each code point whether it is a letter, a number, white space or none of them (0).

    The Unicode tables of regular expressions differ between libraries and versions, so the library whose splits must be
    matched is asked: an encoding that splits by one class keeps only the characters of that class.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for value, one in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        codec = tiktoken.Encoding("class", pat_str=one, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        found = codec.decode_bytes(codec.encode_ordinary(every)).decode()
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = value
    return table


def split_words(data: np.ndarray, at: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, each row's first word and the total)`` in bytes of the matches of ``PATTERN``, which leave no gap.

    A word is a run of one class.  The last white-space character before another class stands alone, and a plain space
    goes to the word it precedes.  An apostrophe that begins a word takes the letters of a contraction with it.
    """
    c = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4")
    n = len(c)
    kind = classes[c]
    place = np.concatenate([[0], np.cumsum(1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF))])
    rows = np.searchsorted(place, at)
    edge = np.zeros(n + 1, bool)
    edge[rows] = True
    begins = edge.copy()
    begins[1:n] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    last = np.flatnonzero(space[:-1] & ~space[1:] & ~edge[1:n])
    begins[last] = True
    begins[last + 1] = c[last] != 0x20
    quote = np.flatnonzero((c[:-1] == 0x27) & begins[: max(0, n - 1)] & ~edge[1:n])
    after = np.concatenate([c, [0, 0]])
    one = quote[np.isin(after[quote + 1], [ord(x) for x in ONE_LETTER])]
    both = after[quote + 1].astype(np.int64) * WIDTH + after[quote + 2]
    two = quote[np.isin(both, [ord(a) * WIDTH + ord(b) for a, b in TWO_LETTERS]) & ~edge[np.minimum(quote + 2, n)]]
    begins[one + 1] = begins[two + 1] = False
    begins[one + 2] = begins[two + 3] = True
    first = np.flatnonzero(begins[:n])
    return place[first], place[np.append(first[1:], n)] if n else first, np.searchsorted(first, rows)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ranks of a word's pieces: the neighbours whose union has the lowest rank, the leftmost of them first, are merged
    until none is left.  A heap makes this quick for long words."""
    ends = list(range(1, len(word) + 1))
    before = list(range(-1, len(word) - 1))
    heap = [(r, i, i + 2) for i in range(len(word) - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, end = heapq.heappop(heap)
        j = ends[i]
        if not j or j >= len(word) or ends[j] != end:
            continue
        ends[i], ends[j] = end, 0
        if end < len(word):
            before[end] = i
            if (r := ranks.get(word[i : ends[end]])) is not None:
                heapq.heappush(heap, (r, i, ends[end]))
        if i and (r := ranks.get(word[before[i] : end])) is not None:
            heapq.heappush(heap, (r, before[i], end))
    out, i = [], 0
    while i < len(word):
        out.append(ranks[word[i : ends[i]]])
        i = ends[i]
    return out


class RankTable:
    """The ranks of a file: the bytes of each id, and which ids two neighbouring ids become.

    A word that is an id is that id and needs no fold; ``whole`` has those whose merges do not lead there.
    """

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([i]) not in ranks for i in range(256)):
            raise ValueError("the ranks must have all single bytes")
        if len(set(ranks.values())) != len(ranks) or not all(0 <= r < MAX_RANK for r in ranks.values()):
            raise ValueError(f"ranks must differ and lie in 0 to {MAX_RANK - 1}")
        self.ranks = ranks
        self.pairs = {
            (ranks[w[:i]], ranks[w[i:]]): r for w, r in ranks.items() for i in range(1, len(w)) if w[:i] in ranks and w[i:] in ranks
        }
        self.whole = {w: r for w, r in ranks.items() if merged(w, ranks) != [r]}

    @classmethod
    def load(cls, path: str) -> RankTable:
        with open(path, "rb") as lines:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, filter(bytes.strip, lines))})

    def pieces(self) -> Column:
        """Constant array of each id's bytes as an ISO-8859-1 string."""
        words = {r: w.decode("latin-1") for w, r in self.ranks.items()}
        return string_array(words.get(r, MISSING) for r in range(max(words) + 1))

    def binary_pieces(self) -> pa.Array:
        """Each id's bytes, null where there is no such id."""
        words = {r: w for w, r in self.ranks.items()}
        return pa.array([words.get(r) for r in range(max(words) + 1)], pa.binary())

    def merges(self) -> MergeMap:
        """The rank map as a constant."""
        return MergeMap((_char(left), _char(right), _char(rank)) for (left, right), rank in self.pairs.items())


def _char(rank: int) -> str:
    """The character of an id; none is NUL, which ``translate`` would delete."""
    return id_char(rank + 1)


def folded(words: Column, table: RankTable) -> Column:
    """Each of an array of words (bytes as ISO-8859-1 characters) as its ids' characters between two ``END``.

    The smallest character that two neighbours merge to is the lowest rank.  A word that begins with ``END`` has its ids
    already.
    """
    bytes_, chars = zip(*((chr(i), _char(table.ranks[bytes([i])])) for i in range(256)))

    def all_words(fold: Callable[[Column], Column]) -> Column:
        def one(word: Column) -> Column:
            ids = fold(F.translate(word, "".join(bytes_), "".join(chars)))
            return F.when(F.startswith(word, F.lit(END)), word).otherwise(F.concat(F.lit(END), ids, F.lit(END)))

        return F.transform(words, one)

    return table.merges().folding(all_words, "array<string>")


def _split(docs: DataFrame, table: RankTable, classes: np.ndarray, kind: str) -> DataFrame:
    """A row for each slice of texts: the words that are new in this task, and all words as numbers in order of first use.

    A task forgets its words when it has met ``HELD_WORDS``; ``anew`` says so.
    """
    ranks = table.ranks

    def shown(word: bytes) -> str:
        if (rank := ranks.get(word)) is not None:
            return END + _char(rank) + END
        if len(word) <= LONG:
            return word.decode("latin-1")
        return END + "".join(map(_char, merged(word, ranks))) + END

    def run(batches: Iterator[pa.RecordBatch]):
        held: dict[bytes, int] = {}
        for batch in batches:
            for row, end, data, at in slices(batch.column(1), SLICE):
                anew = len(held) >= HELD_WORDS
                if anew:
                    held = {}
                known = len(held)
                starts, ends, firsts = split_words(data, at, classes)
                hashes, checks = span_hashes(data, starts, ends), span_checks(data, starts, ends)
                _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
                if not (checks[first][which] == checks).all():
                    first = which = np.arange(len(starts))
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
                numbers = np.fromiter((held.setdefault(w, len(held)) for w in words), "<u4", len(words))
                fresh = [shown(w) for w, _ in zip(reversed(held), range(len(held) - known))][::-1]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([anew]),
                        pa.array([fresh], pa.list_(pa.string())),
                        pa.ListArray.from_arrays([0, end - row], batch.column(0).slice(row, end - row)),
                        pa.array([np.diff(firsts)], pa.list_(pa.int64())),
                        pa.array([numbers[which].tobytes()], pa.binary()),
                    ],
                    names=["anew", "words", "doc_ids", "counts", "stream"],
                )

    schema = f"anew boolean, words array<string>, doc_ids array<{kind}>, counts array<bigint>, stream binary"
    return docs.mapInArrow(run, schema)


def _few_tasks(docs: DataFrame) -> DataFrame:
    """Two parts of a scan in one task where it has many: a word is folded once a task, and twice the text has about one and
    a half times the words.  Nothing is shuffled, and each core still has two tasks."""
    parts = docs.rdd.getNumPartitions()
    return docs.coalesce(max(2 * docs.sparkSession.sparkContext.defaultParallelism, parts // 2))


def _ids(lists: pa.ListArray) -> dict[str, pa.Array]:
    return {"ids": lists}


def _joined(rows: DataFrame, kind: str, finish: Callable[[pa.ListArray], dict[str, pa.Array]], columns: str) -> DataFrame:
    """The ids of each word put where the word stands, and what ``finish`` makes of the texts' lists of ids, as ``columns``
    after ``doc_id``.  Rows come in the order they were split in."""
    end = ord(END)

    def run(batches: Iterator[pa.RecordBatch]):
        ids, before = np.zeros(0, np.int32), np.zeros(1, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py():
                    ids, before = ids[:0], before[:1]
                chars = np.frombuffer("".join(batch.column(1)[i].as_py()).encode("utf-32-le"), "<u4").astype(np.int32)
                marks = np.flatnonzero(chars == end)
                lengths = marks[1::2] - marks[::2] - 1
                chars = np.delete(chars, marks) - 1
                ids = np.concatenate([ids, np.where(chars < SURROGATES_START, chars, chars - SURROGATES_SIZE)])
                before = np.concatenate([before, before[-1] + np.cumsum(lengths)])
                stream = np.frombuffer(batch.column(4)[i].as_buffer(), "<u4")
                counts = before[stream + 1] - before[stream]
                at = np.concatenate([[0], np.cumsum(counts)])
                found = ids[np.repeat(before[stream] - at[:-1], counts) + np.arange(at[-1])]
                words = np.concatenate([[0], np.cumsum(batch.column(3)[i].values.to_numpy())])
                made = finish(pa.ListArray.from_arrays(at[words].astype(np.int32), found))
                yield pa.RecordBatch.from_arrays([batch.column(2)[i].values, *made.values()], names=["doc_id", *made])

    return rows.mapInArrow(run, f"doc_id {kind}, {columns}")


def _encoded(
    docs: DataFrame, table: RankTable, id_col: str, text_col: str, finish: Callable[[pa.ListArray], dict[str, pa.Array]], columns: str
) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    split = _split(_few_tasks(rows), table, character_classes(), kind)
    return _joined(split.withColumn("words", folded(F.col("words"), table)), kind, finish, columns)


def encode(docs: DataFrame, table: RankTable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids``: every whole text as the ids of its words, each match of ``PATTERN`` encoded on its own.

    Three steps in one stage, without a shuffle: a task splits a slice of texts and numbers the words that are new to it
    (up to ``HELD_WORDS``, then anew), two parts of a scan in one task where there are many; higher-order functions merge these words, each once, by a literal rank map; the
    ids are put where the words stand.  Words of more than ``LONG`` bytes are merged by a heap while they are split,
    as a fold takes time by the square of the length.

    Defined cases: null and empty texts have no ids; repeated rows and ids keep a row each, null ids too; no rows give no
    rows; other columns are ignored.
    """
    return _encoded(docs, table, id_col, text_col, _ids, "ids array<int>")


def decoded(ids: Column, table: RankTable) -> Column:
    """The bytes of an array of ids: their pieces one after the other.  An id that the file does not have raises."""
    joined = held_once(table.pieces(), lambda held: F.array_join(F.transform(ids, lambda i: F.element_at(held, i + 1)), ""), "string")
    unknown = F.raise_error(F.lit("an id that the ranks do not have")).cast("string")
    return F.encode(F.when(F.contains(joined, F.lit(MISSING)), unknown).otherwise(joined), "ISO-8859-1")


def concatenated(lists: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """The bytes of lists of ids in a task: their pieces one after the other.  An id that the file does not have raises."""
    parts = pieces.take(lists.values)
    if parts.null_count:
        raise ValueError("an id that the ranks do not have")
    return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, parts), b"")


def _sha256(values: pa.Array) -> pa.Array:
    return pa.array([hashlib.sha256(v.as_buffer()).hexdigest() for v in values], pa.string())


def bpe_digest(docs: DataFrame, table: RankTable, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and digests of every text's ids and of the bytes that they decode to, one row a document.

    The ids are those of ``encode``; they are written as decimals and decoded where they are put together, so the lists
    need not leave the task.
    """
    pieces = table.binary_pieces()

    def digests(lists: pa.ListArray) -> dict[str, pa.Array]:
        decimals = pa.ListArray.from_arrays(lists.offsets, lists.values.cast(pa.string()))
        return {
            "n_tokens": pc.list_value_length(lists).cast(pa.int64()),
            "ids_sha256": _sha256(pc.binary_join(decimals, ",")),
            "decoded_sha256": _sha256(concatenated(lists, pieces)),
        }

    return _encoded(docs, table, id_col, text_col, digests, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")
