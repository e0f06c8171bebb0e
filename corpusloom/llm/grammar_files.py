"""Token ids as grammar-compressed files: Re-Pair per block, with random access through expansion lengths."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.encoding import ENCODED_BYTES, END_ID, encoder, part_bases
from corpusloom.llm.textbytes import slices

BLOCK_IDS = 1 << 20
MIN_COUNT = 4
RULES_A_ROUND = 16_384


def _in_order(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys and their ascending places, by key and then by place."""
    bits = int(places[-1]).bit_length()
    if int(keys.max()).bit_length() + bits > 64:
        order = np.argsort(keys, kind="stable")
        return keys[order], places[order]
    both = (keys << np.uint64(bits)) | places.astype(np.uint64)  # one sort of numbers is faster than one of indices
    both.sort()
    return both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)


def re_pair(
    ids: np.ndarray, min_count: int = MIN_COUNT, per_round: int = RULES_A_ROUND, min_gain: float = 0.0
) -> tuple[np.ndarray, np.ndarray, int]:
    """``(symbols, rules, base)``: rule k says that symbol ``base + k`` stands for two earlier symbols.

    Each round counts neighbouring pairs by sorting them, gives the most frequent ones a nonterminal each (``per_round``
    at most, the others wait for the next round; none below ``min_count``) and replaces them from the left.  It ends when
    no pair is frequent any more: when none has ``min_count`` occurrences, or none that keep clear of each other.
    ``min_gain`` ends it earlier, after a round that shortens the block by less than that share.

    A pair of old symbols never gains occurrences, so one that is not frequent is not looked at again: a round sorts the
    places of pairs that were frequent and those beside a new symbol, which are all places that pairs frequent now have.
    """
    symbols = ids.astype(np.uint32)
    base = int(ids.max()) + 1 if len(ids) else 0
    rules: list[np.ndarray] = []
    names = base
    live = np.arange(len(symbols) - 1)
    while len(live):
        half = np.uint64(names.bit_length())
        keys, places = _in_order((symbols[live].astype(np.uint64) << half) | symbols[live + 1], live)
        firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        counts = np.diff(firsts, append=len(keys))
        frequent = np.flatnonzero(counts >= min_count)
        if not len(frequent):
            break
        group = np.full(len(counts), -2, np.int32)  # -2: not frequent, -1: waits, else the number of the pair
        group[frequent] = -1
        if len(frequent) > per_round:
            frequent = np.sort(frequent[np.argsort(-counts[frequent], kind="stable")[:per_round]])
        group[frequent] = np.arange(len(frequent))
        pair_at = np.full(len(symbols), -2, np.int32)
        pair_at[places] = np.repeat(group, counts)
        at = np.flatnonzero(pair_at >= 0)
        which = pair_at[at]
        order = np.arange(len(at))
        opens = np.diff(at, prepend=-2) != 1
        turn = (order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0
        at, which = at[turn], which[turn]
        often = np.bincount(which, minlength=len(frequent)) >= min_count
        at, which = at[often[which]], which[often[which]]
        if not len(at):
            break
        chosen = keys[firsts[frequent[often]]]
        rules.append(np.stack([chosen >> half, chosen & ((np.uint64(1) << half) - np.uint64(1))], 1).astype(np.uint32))
        symbols[at] = (names + np.cumsum(often) - 1)[which]
        names += len(chosen)
        stays = pair_at >= -1
        stays[at] = True
        stays[np.maximum(at - 1, 0)] = True
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols = symbols[keep]
        live = np.flatnonzero(stays[keep][:-1])
        if len(at) < min_gain * len(keep):
            break
    return symbols, np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32), base


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each nonterminal stands for."""
    parts = rules.astype(np.int64) - base
    lengths, ready = np.ones(len(rules), np.int64), np.zeros(len(rules), bool)
    left = np.arange(len(rules))
    while len(left):  # as often as rules nest
        inner = np.maximum(parts[left], 0)
        plain = parts[left] < 0
        now = (plain | ready[inner]).all(1)
        lengths[left[now]] = np.where(plain, 1, lengths[inner])[now].sum(1)
        ready[left[now]] = True
        left = left[~now]
    return lengths


def _unfold(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for, one level of rules at a time."""
    symbols = symbols.astype(np.uint32)
    while len(open_ := np.flatnonzero(symbols >= base)) and len(rules):
        width = np.ones(len(symbols), np.int64)
        width[open_] = 2
        at = (np.cumsum(width) - width)[open_]
        pair = rules[symbols[open_] - base]
        symbols = np.repeat(symbols, width)
        symbols[at], symbols[at + 1] = pair[:, 0], pair[:, 1]
    return symbols


def expand(symbols: np.ndarray, rules: np.ndarray, base: int) -> np.ndarray:
    """The ids that symbols stand for.  Each rule is unfolded once where there are more symbols than rules."""
    if len(symbols) <= len(rules) or not len(rules):
        return _unfold(symbols, rules, base)
    lengths = expansion_lengths(rules, base)
    unfolded = _unfold(np.arange(base, base + len(rules), dtype=np.uint32), rules, base)
    begins = np.cumsum(lengths) - lengths
    rule = np.maximum(symbols.astype(np.int32), base - 1) - (base - 1)  # 0: an id
    width = np.append(1, lengths).astype(np.int32)[rule]
    own = np.arange(len(unfolded), len(unfolded) + len(symbols), dtype=np.int32)
    begin = np.where(rule > 0, np.append(0, begins).astype(np.int32)[rule], own)
    ends = np.cumsum(width, dtype=np.int32)
    place = np.repeat(begin - (ends - width), width)
    place += np.arange(len(place), dtype=np.int32)
    return np.concatenate([unfolded, symbols.astype(np.uint32)])[place]


def decode_range(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int, start: int, end: int) -> np.ndarray:
    """Ids ``start`` to ``end`` of a block: only symbols that reach into the range are expanded."""
    width = np.where(symbols >= base, lengths[np.maximum(symbols.astype(np.int64) - base, 0)] if len(lengths) else 1, 1)
    ends = np.cumsum(width)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, end, "left")
    if end <= start:
        return np.zeros(0, np.uint32)
    before = int(ends[first] - width[first])
    return expand(symbols[first : last + 1], rules, base)[start - before : end - before]


_FIELDS = (
    "part int, block int, block_start bigint, base bigint, counts array<bigint>, rule_left array<int>, "
    "rule_right array<int>, rule_length array<int>, symbols binary"
)


def write_grammar_files(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all texts and write them in ascending id order (null first; equal ids by a hash of their texts).

    A range exchange of the texts gives each task one stretch of ids.  The task encodes its documents and writes a
    block each ``block_ids`` ids: ids and counts of its documents, its rules with their expansion lengths, its symbols
    and how many ids of the task come before.  Blocks are Parquet rows, so the files can lie in any store.
    """

    def blocks(batches):
        part, block, done = TaskContext.get().partitionId(), 0, 0
        coder = encoder(tokenizer)
        width = np.dtype(coder.kind).itemsize
        held: list[bytes] = []
        names: list[pa.Array] = []
        size = 0

        def flush():
            nonlocal held, names, size, block, done
            counts = [len(b) // width for b in held]
            symbols, rules, base = re_pair(np.frombuffer(b"".join(held), coder.kind))
            lengths = expansion_lengths(rules, base)
            docs_of = pa.concat_arrays(names)
            row = pa.RecordBatch.from_arrays(
                [
                    pa.ListArray.from_arrays(pa.array([0, len(docs_of)], pa.int32()), docs_of),
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([done], pa.int64()),
                    pa.array([base], pa.int64()),
                    pa.array([counts], pa.list_(pa.int64())),
                    *(pa.array([x.astype(np.int32)], pa.list_(pa.int32())) for x in (rules[:, 0], rules[:, 1], lengths)),
                    pa.array([symbols.astype("<u4").tobytes()], pa.binary()),
                ],
                names=["doc_ids", *(f.split()[0] for f in _FIELDS.split(", "))],
            )
            done += sum(counts)
            block += 1
            held, names, size = [], [], 0
            return row

        for batch in batches:
            for row, end, data, at in slices(batch.column(1), ENCODED_BYTES):
                ids = coder.documents(data, at, end_id)
                held += ids
                names.append(batch.column(0).slice(row, end - row))
                size += sum(map(len, ids)) // width
                if size >= block_ids:
                    yield flush()
        if held:
            yield flush()

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.mapInArrow(blocks, f"doc_ids array<{kind}>, {_FIELDS}").write.option("compression", "zstd").parquet(path)


def read_grammar_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` (``with_ids``: also ``ids``) of every document in grammar files.

    Blocks are decoded independently.  ``start`` adds the totals of the tasks before, one number for each writing task.

    Defined cases: null or empty text is the end id alone; repeated rows are kept; no rows give no rows.
    """
    files = spark.read.parquet(path)
    totals = files.select("part", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, c: a + c).alias("n_tokens"))
    bases = part_bases(totals)

    def decode(batches):
        for batch in batches:
            rows = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                value = {n: c[i] for n, c in rows.items()}
                rules = np.stack([value[n].values.to_numpy(zero_copy_only=False) for n in ("rule_left", "rule_right")], 1)
                symbols = np.frombuffer(value["symbols"].as_buffer(), "<u4")
                ids = expand(symbols, rules.astype(np.uint32), value["base"].as_py()).astype("<u4")
                counts = value["counts"].values.to_numpy(zero_copy_only=False)
                ends = np.cumsum(counts)
                view = memoryview(ids).cast("B") if len(ids) else b""
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip((ends - counts).tolist(), ends.tolist())]
                start = int(bases[value["part"].as_py()]) + value["block_start"].as_py()
                columns = [value["doc_ids"].values, pa.array(start + ends - counts), pa.array(counts), pa.array(crcs, pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cuts = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(cuts, pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = files.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return files.mapInArrow(decode, schema)
