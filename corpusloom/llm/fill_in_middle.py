"""Fill-in-the-middle: a text is cut at two token boundaries, found by select in a Roaring-style set, and rearranged."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.textbytes import slices

CONTAINER = 1 << 16
ARRAY_LIMIT = 4096
FIM_PERCENT = 90
SPM_PERCENT = 20
SEED = 1
PLAIN, PSM, SPM = "plain", "psm", "spm"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


@dataclass(frozen=True)
class Marks:
    """What stands before the prefix, the suffix and the middle.

    A mark's first character occurs nowhere else in any mark, so no mark can begin in the text before another one and
    the first occurrence of each is the right one when a text is restored.
    """

    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        every = (self.prefix, self.suffix, self.middle)
        if len(set(every)) < 3 or not all(every) or any(a[0] in b[1:] for a in every for b in every):
            raise ValueError("marks must differ, and the first character of one must not occur later in any")


class ArrayContainer:
    """Sorted positions of two bytes each."""

    def __init__(self, part: np.ndarray):
        self.values = np.flatnonzero(part).astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.values[k])


class BitmapContainer:
    """One bit a position, and how many are set before each word of 64."""

    def __init__(self, part: np.ndarray):
        bits = np.zeros(CONTAINER // 8, np.uint8)
        packed = np.packbits(part, bitorder="little")
        bits[: len(packed)] = packed
        self.words = bits.view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.cumsum(counts) - counts

    def select(self, k: int) -> int:
        w = int(np.searchsorted(self.before, k, "right")) - 1
        word = int(self.words[w])
        for _ in range(k - int(self.before[w])):
            word &= word - 1
        return w * 64 + (word & -word).bit_length() - 1


class RunContainer:
    """Starts of the runs of neighbouring positions, and how many positions lie before each run."""

    def __init__(self, part: np.ndarray):
        edges = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0))
        self.starts = edges[::2].astype(np.uint16)
        lengths = (edges[1::2] - edges[::2]).astype(np.int32)
        self.before = np.cumsum(lengths) - lengths

    def select(self, k: int) -> int:
        r = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[r]) + k - int(self.before[r])


class BoundarySet:
    """The set positions of a mask, in containers of 65,536 positions with cumulative cardinalities.

    A container is the smallest of an array (2 bytes a position, up to 4,096 of them), a bitmap (8,192 bytes) and runs
    (4 bytes each).  ``select`` searches the container by rank, then selects inside it.
    """

    def __init__(self, mask: np.ndarray):
        self.keys, self.containers, totals = [], [], []
        for begin in range(0, len(mask), CONTAINER):
            part = mask[begin : begin + CONTAINER]
            count = int(np.count_nonzero(part))
            if not count:
                continue
            runs = int(part[0]) + int(np.count_nonzero(part[1:] & ~part[:-1]))
            kind = ArrayContainer if count <= ARRAY_LIMIT else BitmapContainer
            if 4 * runs < min(2 * count, CONTAINER // 8):
                kind = RunContainer
            self.keys.append(begin)
            self.containers.append(kind(part))
            totals.append(count)
        self.cumulative = np.cumsum(totals, dtype=np.int64)

    def __len__(self) -> int:
        return int(self.cumulative[-1]) if len(self.cumulative) else 0

    def select(self, k: int) -> int:
        """The position that has ``k`` set positions before it."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        i = int(np.searchsorted(self.cumulative, k, "right"))
        return self.keys[i] + self.containers[i].select(k - (int(self.cumulative[i - 1]) if i else 0))


def boundaries(text: np.ndarray) -> BoundarySet:
    """Code-point positions of the borders of the tokens ``[A-Za-z]+|[^A-Za-z]`` of a UTF-8 text, both ends included."""
    letters = _LETTER[text[(text & 0xC0) != 0x80]]
    mask = np.ones(len(letters) + 1, bool)
    mask[1:-1] = ~(letters[1:] & letters[:-1])
    return BoundarySet(mask)


def draws(doc_id, seed: int) -> list[int]:
    """The first four groups of eight hexadecimal digits of sha256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _one(doc_id, raw: np.ndarray, seed: int, fim_percent: int, spm_percent: int, marks: Marks) -> tuple:
    cuts = boundaries(raw)
    n = len(cuts) - 1
    text = raw.tobytes().decode()
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not n or h3 % 100 >= fim_percent or any(m in text for m in (marks.prefix, marks.suffix, marks.middle)):
        return n, PLAIN, None, None, text
    first, last = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = cuts.select(first), cuts.select(last)
    prefix, suffix, middle = marks.prefix + text[:a], marks.suffix + text[b:], marks.middle + text[a:b]
    if h4 % 100 < spm_percent:
        return n, SPM, a, b - a, suffix + prefix + middle
    return n, PSM, a, b - a, prefix + suffix + middle


def fill_in_middle(
    docs: DataFrame,
    seed: int = SEED,
    fim_percent: int = FIM_PERCENT,
    spm_percent: int = SPM_PERCENT,
    marks: Marks = Marks(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output``: every text rearranged for fill-in-the-middle training.

    A text of ``n`` tokens is cut at two of its ``n + 1`` boundaries, which sha256 of the id picks.  ``psm`` is prefix,
    suffix, middle, ``spm`` suffix, prefix, middle, each after its mark.  ``plain`` texts stay as they are: empty ones,
    those that hold a mark, and ``100 - fim_percent`` of a hundred others.  No row is shuffled; a task holds a slice of
    about 2 MB, or one longer text and its boundary set.

    Defined cases: null text is empty; a null id draws as the empty string; repeated rows are kept and come out alike;
    no rows give no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for row, end, data, at in slices(batch.column(1)):
                ids = batch.column(0).slice(row, end - row)
                rows = [
                    _one(i, data[a:b], seed, fim_percent, spm_percent, marks)
                    for i, a, b in zip(ids.to_pylist(), at.tolist(), at[1:].tolist())
                ]
                n, form, prefix, middle, output = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n, pa.int64()),
                        pa.array(form, pa.string()),
                        pa.array(prefix, pa.int64()),
                        pa.array(middle, pa.int64()),
                        pa.array(output, pa.string()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that an output of ``fill_in_middle`` was made from."""

    def parts(first: str, second: str) -> tuple[Column, Column, Column]:
        """What stands after each of the three marks, of which ``middle`` is the last."""
        at, last = F.instr(output, F.lit(second)), F.instr(output, F.lit(marks.middle))
        return (
            F.substr(output, F.lit(len(first) + 1), at - len(first) - 1),
            F.substr(output, at + len(second), last - at - len(second)),
            F.substr(output, last + len(marks.middle)),
        )

    prefix, suffix, middle = parts(marks.prefix, marks.suffix)
    late_suffix, late_prefix, late_middle = parts(marks.suffix, marks.prefix)
    return (
        F.when(form == PSM, F.concat(prefix, middle, suffix))
        .when(form == SPM, F.concat(late_prefix, late_middle, late_suffix))
        .otherwise(output)
    )


def fim_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, forms and digests of the outputs and of the texts rebuilt from them, one row a document."""
    rows = fill_in_middle(docs, id_col=id_col, text_col=text_col)
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
