"""SimHash near-duplicates: fingerprints, links within a Hamming radius by meeting in the middle, and their groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.components import connected_components
from corpusloom.llm.staging import staged
from corpusloom.llm.textbytes import slices, word_bounds
from corpusloom.plans.offsets import small_side

SHINGLE = 3
SEED = 42
RADIUS = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPREAD = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).view(np.uint64)[:, 0]


def _bit_counts(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """How often each of the 64 bits (highest first) is set among each row's hashes."""
    rows = len(firsts) - 1
    total = np.zeros((rows, 64), np.int64)
    filled = np.flatnonzero(np.diff(firsts))
    if not len(filled):
        return total
    # eight counters of one byte lie in a word; 255 hashes at most are added before they are spread out
    cuts, owner = [], []
    for r in filled.tolist():
        more = range(int(firsts[r]), int(firsts[r + 1]), 255)
        cuts += more
        owner += [r] * len(more)
    lanes = _SPREAD[hashes.astype(">u8").view(np.uint8).reshape(-1, 8)]
    sums = np.add.reduceat(lanes, cuts, axis=0).view(np.uint8).reshape(len(cuts), 64)
    np.add.at(total, np.array(owner), sums.astype(np.int64))
    return total


def _fingerprints(data: np.ndarray, at: np.ndarray, shingle: int, seed: int) -> np.ndarray:
    import xxhash

    digest = xxhash.xxh64_intdigest
    lowered = _LOWER[data]
    starts, ends, firsts = word_bounds(lowered, at)
    lengths = ends - starts
    text = lowered.tobytes()
    words = [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
    joined = b" ".join(words)
    begin = np.cumsum(lengths + 1) - lengths - 1
    counts = np.diff(firsts)
    shingles = np.where(counts >= shingle, counts - shingle + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(shingles)])
    total = int(bounds[-1])
    first = np.arange(total) - np.repeat(bounds[:-1] - firsts[:-1], shingles)
    last = np.minimum(first + shingle, np.repeat(firsts[1:], shingles)) - 1
    a = begin[first].tolist() if total else []
    b = (begin[last] + lengths[last]).tolist() if total else []
    view = memoryview(joined)
    hashes = np.fromiter((digest(view[i:j], seed) for i, j in zip(a, b)), np.uint64, total)
    majority = _bit_counts(hashes, bounds) * 2 > shingles[:, None]
    return np.packbits(majority, axis=1).view(">u8")[:, 0].astype(np.uint64)


def fingerprints(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, fingerprint bigint)`` of every text: bit k is set if it is set in over half of its shingles' hashes.

    Texts are lower-cased in A to Z, words are ``[^\\x20\\x09-\\x0D]+``, shingles are ``shingle`` consecutive words joined
    by spaces, repeats included; fewer words are one shingle, and no words (or null) give fingerprint zero.
    """

    def run(batches):
        for batch in batches:
            for row, end, data, at in slices(batch.column(1)):
                bits = _fingerprints(data, at, shingle, seed)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(bits.view(np.int64))], names=["doc_id", "fingerprint"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, fingerprint bigint")


def ball(fingerprint, radius: int):
    """All values within ``radius`` bits of a 64-bit fingerprint, itself included."""
    masks = [0]
    for _ in range(radius):
        masks = sorted({m ^ (1 << k) for m in masks for k in range(64)} | set(masks))
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    return F.transform(F.array(*map(F.lit, signed)), lambda m: fingerprint.bitwiseXOR(m))


def near_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links ``(a, b)`` between different values of ``fingerprint`` that join the same groups as all pairs of ``radius``
    or fewer differing bits.

    Meeting in the middle: every distinct fingerprint emits all variants within half the radius, rounded up; two
    fingerprints within the radius share a variant.  With an even radius all that share one are within the radius of
    each other, so the smallest of them is linked to each other one and no pair of groups is lost.  With an odd radius
    all pairs of a variant are formed and measured.  A variant has as many different fingerprints as a ball has
    values (65 for radius 1), so neither can grow with the number of copies.
    """
    distinct = prints.select("fingerprint").where("fingerprint IS NOT NULL").distinct()
    emitted = distinct.select("fingerprint", F.explode(ball(F.col("fingerprint"), (radius + 1) // 2)).alias("variant"))
    if radius % 2 == 0:
        met = emitted.select(F.min("fingerprint").over(Window.partitionBy("variant")).alias("a"), F.col("fingerprint").alias("b"))
    else:
        met = emitted.withColumnRenamed("fingerprint", "a").join(emitted.withColumnRenamed("fingerprint", "b"), "variant")
    pairs = met.where("a < b").select("a", "b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def rooted_fingerprints(prints: DataFrame, radius: int) -> DataFrame:
    """``(fingerprint, root)`` of every distinct fingerprint: ``root`` is one of its component, the same for all."""
    groups = connected_components(near_links(prints, radius)).withColumnRenamed("node", "fingerprint")
    distinct = prints.select("fingerprint").distinct()
    return staged(distinct.join(groups, "fingerprint", "left").select("fingerprint", F.coalesce("root", "fingerprint").alias("root")), "rooted")


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED, radius: int = RADIUS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One document of each group of near-duplicates, with all its columns: the smallest id, of equal ids the one read
    first; a null id stays only where the whole group has none.

    The documents are written once with their fingerprints and a row number; groups are formed from these two narrow
    columns, and the rows that go are dropped by row number.
    """
    at_column, names = docs.columns.index(text_col), docs.columns

    def run(batches):
        for batch in batches:
            bits = [_fingerprints(data, at, shingle, seed).view(np.int64) for _, _, data, at in slices(batch.column(at_column))]
            if bits:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(np.concatenate(bits))], names=[*(f"c{i}" for i in range(len(names))), "_print"]
                )

    schema = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema)] + [T.StructField("_print", T.LongType())])
    rows = staged(docs.mapInArrow(run, schema).withColumn("_row", F.monotonically_increasing_id()), "printed")
    narrow = rows.select(F.col(f"c{names.index(id_col)}").alias("doc_id"), F.col("_print").alias("fingerprint"), "_row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")).alias("first")
    roots = rooted_fingerprints(narrow, radius)
    best = narrow.groupBy("fingerprint").agg(first).join(roots, "fingerprint").groupBy("root").agg(F.min("first").alias("first"))
    # Rows that go are fewer than rows that stay; while they are counted to be few, no text is shuffled.
    gone = staged(narrow.select("_row").join(best.select(F.col("first._row").alias("_row")), "_row", "left_anti"), "gone")
    stay = rows.join(small_side(gone), "_row", "left_anti")
    return stay.select(*(F.col(f"c{i}").alias(n) for i, n in enumerate(names)))


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    seed: int = SEED,
    radius: int = RADIUS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fingerprint (16 hex digits), component_id``: the smallest id that links can reach.

    Defined cases: null and empty texts have fingerprint zero and link like any other; repeated rows and ids keep a row
    each; null ids do not count as smallest, and a group of null ids alone has a null component; no rows give no rows;
    other columns are ignored.
    """
    prints = staged(fingerprints(docs, shingle, seed, id_col, text_col), "prints")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    rooted = staged(least.join(rooted_fingerprints(prints, radius), "fingerprint"), "least")
    smallest = staged(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    named = staged(rooted.join(smallest, "root").select("fingerprint", "component_id"), "named")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )
