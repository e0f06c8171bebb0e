"""Ranked lexical search: documents with the same bag of an item vocabulary and the same length factor are scored once."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.staging import staged
from corpusloom.llm.textbytes import row_of, slices, span_checks, span_hashes, word_bounds

TOP = 10
ITEM_BYTES = 1 << 20
PAIRS = 1 << 21
CELLS = 1 << 21
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 32
_LAST = np.iinfo(np.int64).max
_RANKED = "item_id bigint, rank int, doc_id bigint, score bigint"


def _terms(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(hash, check, each row's first)`` of the terms: runs of ASCII letters and digits and of all beyond ASCII."""
    clean = _CLEAN[data]
    starts, ends, firsts = word_bounds(clean, at)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), firsts
    return span_hashes(clean, starts, ends), span_checks(clean, starts, ends), firsts


class ItemTerms:
    """The terms of a block of items: the vocabulary in order of hashes, and each term's items with their counts."""

    def __init__(self, ids: list, texts: list[str | None]):
        self.ids = ids
        raw = [(t or "").encode() for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        hashes, checks, firsts = _terms(data, np.cumsum([0, *map(len, raw)]))
        self.hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.checks = checks[first]
        if not (self.checks[which] == checks).all():
            raise ValueError("two terms of the items share a hash")
        items = max(1, len(ids))
        cells, self.counts = np.unique(which * items + row_of(firsts), return_counts=True)
        self.items = cells % items
        self.begins = np.searchsorted(cells // items, np.arange(len(self.hashes) + 1))

    def find(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """The number of each term in the vocabulary, or -1."""
        if not len(self.hashes):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where((self.hashes[at] == hashes) & (self.checks[at] == checks), at, -1)


def _binary(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary values that lie one after the other in ``data``."""
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data.tobytes())])


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(term, count, each row's first)`` of a column of bags."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    both = np.frombuffer(data, "<u4")[at[0] // 4 : at[-1] // 4].reshape(-1, 2) if data is not None else np.zeros((0, 2), "<u4")
    return both[:, 0].astype(np.int64), both[:, 1].astype(np.int64), (at - at[0]) // 8


def _bags(docs: DataFrame, block: ItemTerms) -> DataFrame:
    """``(doc_id, n, bag)``: all terms of a document counted, and those of the items with their counts, by number."""

    def run(batches):
        size = max(1, len(block.hashes))
        for batch in batches:
            for row, end, data, at in slices(batch.column(1)):
                hashes, checks, firsts = _terms(data, at)
                found = block.find(hashes, checks)
                known = found >= 0
                cells, counts = np.unique(row_of(firsts)[known] * size + found[known], return_counts=True)
                bags = np.stack([cells % size, counts], axis=1).astype("<u4")
                bounds = np.searchsorted(cells // size, np.arange(end - row + 1)) * 8
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(row, end - row), pa.array(np.diff(firsts).astype(np.int64)), _binary(bags, bounds)],
                    names=["doc_id", "n", "bag"],
                )

    return docs.mapInArrow(run, "doc_id bigint, n bigint, bag binary")


def _holders(bags: DataFrame, size: int) -> np.ndarray:
    """How many documents hold each term of the vocabulary."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(_pairs(batch.column(0))[0], minlength=size)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["term", "n"])

    sums = bags.select("bag").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size, np.int64)
    out[sums["term"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def bag_classes(bags: DataFrame, documents: int, terms: int, top: int) -> DataFrame:
    """``(hash, m, bag, members)``: documents that no item tells apart, as their bags and length factors are the same.

    Classes are dealt by hash and verified whole, as the bag itself is part of the key.  ``members`` are the ``top``
    smallest ids: of documents with one score, no others can be among an item's best.  Each task keeps only so many of
    a class before the shuffle, so a class that holds a third of all rows is a few rows a task.
    """
    m = F.expr(f"CAST(25 + (75 * n * {documents}L) DIV {terms}L AS BIGINT)")
    keyed = bags.where("octet_length(bag) > 0").select("doc_id", m.alias("m"), "bag").withColumn("hash", F.xxhash64("m", "bag"))
    order = Window.partitionBy("hash", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    first = keyed.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top)
    return first.groupBy("hash", "m", "bag").agg(F.sort_array(F.collect_list(F.struct("k", "doc_id"))).alias("members"))


class _Best:
    """The best classes of each item so far: by score, then by smallest member."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.least = np.ones(items, np.int64)
        self.item, self.score, self.first = (np.zeros(0, np.int64) for _ in range(3))
        self.members: list = []

    def add(self, scores: np.ndarray, first: np.ndarray, members: pa.ListArray) -> None:
        """``scores`` has a row for each class and a column for each item; ``first`` is each class's smallest id."""
        floor = self.least
        if len(scores) > self.top:
            floor = np.maximum(floor, np.partition(scores, len(scores) - self.top, axis=0)[len(scores) - self.top])
        classes, items = np.nonzero(scores >= floor)
        if not len(classes):
            return
        kept = len(self.members)
        item, score = np.concatenate([self.item, items]), np.concatenate([self.score, scores[classes, items]])
        ids = np.concatenate([self.first, first[classes]])
        order = np.lexsort((ids, -score, item))
        ranked = item[order]
        place = np.arange(len(order)) - np.searchsorted(ranked, ranked)
        tenth = place == self.top - 1
        self.least[ranked[tenth]] = score[order[tenth]]
        order = order[place < self.top]
        fresh = classes[order[order >= kept] - kept]
        lists = {c: [p["doc_id"] for p in members[c].as_py()] for c in np.unique(fresh).tolist()}
        self.members = [self.members[o] if o < kept else lists[int(classes[o - kept])] for o in order.tolist()]
        self.item, self.score, self.first = item[order], score[order], ids[order]


def _scored(classes: DataFrame, block: ItemTerms, weights: np.ndarray, top: int) -> DataFrame:
    """``(item, item_id, score, members)``: the best classes of each item in each task."""
    begins, posting_items = block.begins, block.items
    posting_weights = block.counts * weights[np.repeat(np.arange(len(weights)), np.diff(begins))]
    ids, size = block.ids, len(block.ids)

    def run(batches):
        best = _Best(size, top)
        for batch in batches:
            terms, counts, firsts = _pairs(batch.column(1))
            m = batch.column(0).to_numpy(zero_copy_only=False)
            owner = row_of(firsts)
            parts = (1_000_000_000 * counts) // (1000 * counts + 8 * m[owner])
            lengths = begins[terms + 1] - begins[terms]
            before = np.concatenate([[0], np.cumsum(lengths)])
            at, row = before[firsts], 0
            while row < len(m):
                end = max(row + 1, min(int(np.searchsorted(at, at[row] + PAIRS, "right")) - 1, row + max(1, CELLS // size)))
                entries = slice(int(firsts[row]), int(firsts[end]))
                lens = lengths[entries]
                posting = np.repeat(begins[terms[entries]] - (before[entries] - at[row]), lens) + np.arange(int(lens.sum()))
                cells = np.repeat(owner[entries] - row, lens) * size + posting_items[posting]
                scores = np.zeros((end - row) * size, np.int64)
                np.add.at(scores, cells, np.repeat(parts[entries], lens) * posting_weights[posting])
                members = batch.column(2).slice(row, end - row)
                smallest = members.flatten().field("doc_id").take(pa.array(members.offsets.to_numpy()[:-1] - members.offsets[0].as_py()))
                best.add(scores.reshape(-1, size), smallest.fill_null(_LAST).to_numpy(zero_copy_only=False), members)
                row = end
        if best.members:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(best.item),
                    pa.array([ids[i] for i in best.item.tolist()], pa.int64()),
                    pa.array(best.score),
                    pa.array(best.members, pa.list_(pa.int64())),
                ],
                names=["item", "item_id", "score", "members"],
            )

    return classes.select("m", "bag", "members").mapInArrow(run, "item bigint, item_id bigint, score bigint, members array<bigint>")


def _search_block(docs: DataFrame, block: ItemTerms, top: int) -> DataFrame | None:
    bags = staged(_bags(docs, block), "bags")
    documents, terms = bags.agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
    if not terms or not len(block.hashes):
        return None
    holders = _holders(bags, len(block.hashes))
    weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in holders], np.int64)
    best = _scored(bag_classes(bags, documents, terms, top), block, weights, top)
    rows = best.select("item", "item_id", "score", F.explode("members").alias("doc_id"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")


def lexical_search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item, highest score first, then smallest id.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, lower-cased in A to Z.  A term's weight is
    floor(1000 ln((2 N + 2) / (2 df + 1))), a document's score the sum over an item's terms of weight x (10^9 tf div
    (1000 tf + 8 m)) with m = 25 + 75 n N div L, all in whole numbers.

    One pass over the texts writes each document's bag: the counts of its terms that occur in an item.  Documents with
    the same bag and m are one class, formed by hash and verified by the bag; classes are scored, then expanded by
    ascending id.  Items are taken in blocks of about 1 MB, each of which passes over all documents; only a block's
    terms are sent to tasks, and one number a term comes back to the driver.

    Defined cases: null or empty text has no terms and is never found; repeated documents and items are kept apart;
    null ids come last among equal scores; no documents or no items give no rows; ids are cast to BIGINT; other columns
    are ignored.
    """
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).cast("bigint").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    wanted = staged(wanted.withColumn("row", F.monotonically_increasing_id()), "items")
    size = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = math.ceil(size / ITEM_BYTES)
    found = None
    for b in range(blocks):
        rows = wanted.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").collect()
        one = _search_block(docs, ItemTerms([r["item_id"] for r in rows], [r["text"] for r in rows]), top)
        if one is not None:
            found = one if found is None else found.union(one)
    return docs.sparkSession.createDataFrame([], _RANKED) if found is None else found
