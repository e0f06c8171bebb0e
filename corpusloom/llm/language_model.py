"""Cross-entropy difference: every text is scored by two bigram models over one vocabulary, that of all words."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.staging import staged
from corpusloom.llm.substrings import _chunks, _cuts, _width
from corpusloom.llm.textbytes import SLICE_BYTES, mix, row_of, slices, span_hashes, word_bounds

BIGRAM = 0.7
UNIGRAM = 0.29
HELD_ENTRIES = 1 << 20
CHUNK_BYTES = 4 << 20
# Places of target texts, four bytes each, that are sent to every executor; more are shuffled.
BROADCAST_MARKS = 4_000_000
PAIR, TOKEN, CONTEXT = (np.uint64(k) for k in range(3))
_KIND = np.uint64(3)
_UNKNOWN, _START = np.uint64(1), np.uint64(2)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[65:91] += 32
_CLEAN[[*range(48), *range(58, 65), *range(91, 97), *range(123, 128)]] = 32


def _words(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased runs of letters, digits and bytes beyond ASCII, and each row's first one."""
    clean = _CLEAN[data]
    starts, ends, firsts = word_bounds(clean, at)
    if not len(starts):
        return np.zeros(0, np.int64), firsts
    return span_hashes(clean, starts, ends).view(np.int64), firsts


def _tokens(words: np.ndarray, vocabulary: np.ndarray | None) -> np.ndarray:
    """The words' hashes; with a given vocabulary any other word is one unknown token."""
    if vocabulary is None or not len(words):
        return words.view(np.uint64)
    if not len(vocabulary):
        return np.full(len(words), _UNKNOWN)
    at = np.minimum(np.searchsorted(vocabulary, words), len(vocabulary) - 1)
    return np.where(vocabulary[at] == words, words.view(np.uint64), _UNKNOWN)


def _contexts(tokens: np.ndarray, firsts: np.ndarray, start: np.uint64) -> np.ndarray:
    """The token before each one; ``start`` at the beginning of a text."""
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    opens = firsts[:-1][np.diff(firsts) > 0]
    before[opens] = start
    return before


def _keys(data: np.ndarray, at: np.ndarray, vocabulary: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Three keys of each token, for its pair with the token before, itself, and that token as a context; each row's first.

    The two lowest bits name the kind, the others are a hash of 62 bits.
    """
    words, firsts = _words(data, at)
    tokens = _tokens(words, vocabulary)
    before = _contexts(tokens, firsts, _START)
    return [(mix(h) & ~_KIND) | kind for h, kind in ((before * _ODD + tokens, PAIR), (tokens, TOKEN), (before, CONTEXT))], firsts


def _packed(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _unpacked(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, _width(len(data) // max(1, n)) if n else "u1").astype(np.int64)


def _squeezed(values: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: the upper bytes of small numbers take next to no room."""
    import zstandard

    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.ravel().astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _restored(data: bytes, n: int) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    values = np.zeros((n, 8), np.uint8)
    values[:, : len(planes) // max(1, n)] = planes.reshape(-1, n).T
    return values.view("<u8").ravel()


def _steps(keys: np.ndarray) -> np.ndarray:
    """Differences of sorted keys, which are smaller numbers; their sums are the keys again."""
    return np.diff(keys, prepend=np.uint64(0))


def _counted(texts: DataFrame, side: int, vocabulary: np.ndarray | None, buckets: int) -> DataFrame:
    """``(bucket, side, keys, counts)``: sorted keys of a task's stretch of texts, added up there and dealt by hash."""

    def run(batches):
        held: list[np.ndarray] = []
        size = 0

        def rows():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            cuts = _cuts(keys, buckets)
            full = np.flatnonzero(np.diff(cuts))
            pieces = [(int(cuts[b]), int(cuts[b + 1])) for b in full]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(full.astype(np.int32)),
                    pa.array(np.full(len(full), side, np.int32)),
                    pa.array([keys[a:b].tobytes() for a, b in pieces], pa.binary()),
                    pa.array([_packed(counts[a:b]) for a, b in pieces], pa.binary()),
                ],
                names=["bucket", "side", "keys", "counts"],
            )

        for batch in batches:
            for _, _, data, at in slices(batch.column(0)):
                held += _keys(data, at, vocabulary)[0]
                size += 3 * len(held[-1])
                if size >= 2 * HELD_ENTRIES:
                    yield rows()
                    held, size = [], 0
        if size:
            yield rows()

    return texts.mapInArrow(run, "bucket int, side int, keys binary, counts binary")


def _summed(part: pa.Table) -> pa.Table:
    """One row for a bucket: its distinct keys and their counts in both corpora."""
    keys = [np.frombuffer(k, np.uint64) for k in part.column("keys").to_pylist()]
    counts = [_unpacked(c, len(k)) for c, k in zip(part.column("counts").to_pylist(), keys)]
    sides = np.repeat(part.column("side").to_numpy(), [len(k) for k in keys])
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    weights = np.concatenate(counts)
    target, background = (np.bincount(which, weights * (sides == s), len(distinct)).astype(np.int64) for s in (0, 1))
    words = distinct & _KIND == TOKEN
    return pa.table(
        {
            "bucket": part.column("bucket")[:1],
            "keys": pa.array([distinct.tobytes()], pa.binary()),
            "target": pa.array([_packed(target)], pa.binary()),
            "background": pa.array([_packed(background)], pa.binary()),
            "words": pa.array([int(words.sum())], pa.int64()),
            "target_total": pa.array([int(target[words].sum())], pa.int64()),
            "background_total": pa.array([int(background[words].sum())], pa.int64()),
        }
    )


def _counts(texts: DataFrame, keys_of) -> DataFrame:
    """``(key, n)``: how often each key occurs in all texts; a task adds up its own counts before they are shuffled."""

    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def merged():
            parts = [np.unique(h, return_counts=True) for h in held]
            every = np.concatenate([keys, *(k for k, _ in parts)])
            distinct, which = np.unique(every, return_inverse=True)
            weights = np.concatenate([counts, *(c for _, c in parts)])
            return distinct, np.bincount(which, weights, len(distinct)).astype(np.int64)

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["key", "n"])

        for batch in batches:
            for _, _, data, at in slices(batch.column(0), 1 << 20):
                held.append(keys_of(data, at))
                size += len(held[-1])
                if size >= HELD_ENTRIES:
                    keys, counts = merged()
                    held, size = [], 0
                    if len(keys) >= HELD_ENTRIES:
                        yield rows()
                        keys, counts = keys[:0], counts[:0]
        if held:
            keys, counts = merged()
        if len(keys):
            yield rows()

    found = texts.mapInArrow(run, "key bigint, n bigint")
    return found.groupBy("key").agg(F.sum("n").alias("n"))


@dataclass
class BigramModels:
    """Counts of all pairs, tokens and contexts of two corpora, as a written table of ``buckets`` rows of sorted keys.

    ``size`` is the number of words plus one for words of neither corpus; ``totals`` are the corpora's tokens;
    ``vocabulary`` is null, or the hashes of a given vocabulary.  ``chunks`` is how many chunks of text were counted.
    ``own`` are the answers to the texts that were counted, where those are to be scored themselves.
    """

    vocabulary: np.ndarray | None
    counts: DataFrame
    buckets: int
    chunks: int
    size: int
    totals: tuple[int, int]
    own: OwnAnswers | None = None


@dataclass
class OwnAnswers:
    """``docs`` in ``chunks``, which are their own questions, and the ``answers``; ``starts`` are the texts with words, of
    the target and of all."""

    docs: DataFrame
    columns: tuple[str, str]
    chunks: DataFrame
    answers: DataFrame
    starts: tuple[int, int]


def _losses(pair: np.ndarray, token: np.ndarray, context: np.ndarray, total: int, size: int) -> np.ndarray:
    """Interpolated bigram, unigram and uniform probabilities in nats; an unseen context falls back to the unigrams."""
    uniform = 1.0 / size
    unigram = token / total if total else np.full(len(token), uniform)
    bigram = np.where(context > 0, pair / np.maximum(context, 1), unigram)
    return -np.log(BIGRAM * bigram + UNIGRAM * unigram + (1 - BIGRAM - UNIGRAM) * uniform)


def _most_frequent(texts: DataFrame, vocabulary: int | None) -> np.ndarray | None:
    if vocabulary is None:
        return None
    words = _counts(texts, lambda data, at: _words(data, at)[0])
    chosen = words.orderBy(F.desc("n"), "key").limit(vocabulary).select("key").toPandas()["key"]
    return np.sort(chosen.to_numpy(np.int64))


def _all_counts(target: DataFrame, background: DataFrame, known: np.ndarray | None, buckets: int) -> DataFrame:
    both = _counted(target, 0, known, buckets).union(_counted(background, 1, known, buckets))
    kinds = "bucket int, keys binary, target binary, background binary, words bigint, target_total bigint, background_total bigint"
    return both.groupBy("bucket").applyInArrow(_summed, kinds)


def train(target: DataFrame, background: DataFrame, vocabulary: int | None = None, text_col: str = "text") -> BigramModels:
    """Count both corpora whole.  The shared vocabulary is all words of both; with ``vocabulary`` it is that many of the
    background's most frequent words (ties by hash), and all others are one unknown token.  Both models have the same
    order and smoothing.

    Tasks add up stretches of text and deal the keys by hash into buckets, whose number grows with the corpora; a bucket
    is one written row.  A frequent key is one entry a stretch, so none is hot.  The driver receives three sums, and
    the words of a given vocabulary.
    """
    target, background = (t.select(F.col(text_col).cast("string").alias("text")) for t in (target, background))
    known = _most_frequent(background, vocabulary)
    length = F.sum(F.octet_length("text"))
    chunks = math.ceil(sum(t.agg(length).first()[0] or 0 for t in (target, background)) / CHUNK_BYTES)
    buckets = max(1, math.ceil(2 * chunks**0.75))
    counts = staged(_all_counts(target, background, known, buckets), "counts")
    sums = counts.agg(F.sum("words"), F.sum("target_total"), F.sum("background_total")).first()
    size = (sums[0] or 0) + 1 if known is None else len(known) + 1
    return BigramModels(known, counts.select("bucket", "keys", "target", "background"), buckets, chunks, size, (sums[1] or 0, sums[2] or 0))


def train_marked(
    docs: DataFrame, target_ids: DataFrame, vocabulary: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> BigramModels:
    """The models of ``train`` for the texts of ``docs`` whose id is in ``target_ids`` against all of them, where ``docs``
    are to be scored themselves: they are counted and answered at once.

    A chunk of 4 MB sends its distinct keys once, with its counts in both corpora, as compressed differences; a bucket
    adds them up and answers each chunk with the sums.  A word is one key with two counts: its uses and how often it
    ends a text, which is how often it is no context.  Only ids are joined with ``target_ids``, and the chunks get the places
    of their target texts in a broadcast while these are few.  ``counts`` is computed only if other texts are scored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    ids = target_ids.select(F.col(target_ids.columns[0]).cast(kind).alias("id"))
    chosen = docs.join(ids.hint("merge"), docs[id_col] == F.col("id"), "left_semi")
    target, background = (t.select(F.col(text_col).cast("string").alias("text")) for t in (chosen, docs))
    known = _most_frequent(background, vocabulary)
    chunks = _chunks(docs, id_col, text_col, kind, CHUNK_BYTES)
    n = chunks.count()
    buckets = max(1, math.ceil(2 * n**0.75))
    placed = chunks.select("chunk", F.posexplode("ids").alias("place", "id"))
    marks = placed.join(ids.hint("merge"), "id", "left_semi").groupBy("chunk").agg(F.collect_list("place").alias("marks"))
    marks = staged(marks, "marks")
    few = (marks.agg(F.sum(F.size("marks"))).first()[0] or 0) <= BROADCAST_MARKS
    asked = chunks.join(F.broadcast(marks) if few else marks, "chunk", "left")
    asked = asked.mapInArrow(_own_questions(known, buckets), "bucket int, chunk bigint, n int, keys binary, counts binary")
    kinds = "chunk bigint, bucket int, sums binary, words bigint, totals array<bigint>"
    answers = staged(asked.groupBy("bucket").applyInArrow(_own_answers, kinds), "answers")
    sums = answers.agg(F.sum("words"), *(F.sum(F.get("totals", F.lit(i))) for i in range(4))).first()
    size = (sums[0] or 0) + 1 if known is None else len(known) + 1
    totals, starts = (sums[1] or 0, sums[2] or 0), (sums[3] or 0, sums[4] or 0)
    counts = _all_counts(target, background, known, buckets).select("bucket", "keys", "target", "background")
    own = OwnAnswers(docs, (id_col, text_col), chunks, answers.select("chunk", "bucket", "sums"), starts)
    return BigramModels(known, counts, buckets, n, size, totals, own)


def _own_keys(batch: pa.RecordBatch, i: int, vocabulary: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A chunk's distinct keys, which of them are each token's pair and word, and each text's first token."""
    keys, firsts = _chunk_keys(batch, i, vocabulary)
    distinct, which = np.unique(np.concatenate(keys[:2]), return_inverse=True)
    pair, token = which.reshape(2, -1)
    return distinct, pair, token, firsts


def _ends(firsts: np.ndarray) -> np.ndarray:
    """The last token of each text that has any."""
    return firsts[1:][np.diff(firsts) > 0] - 1


def _own_questions(vocabulary: np.ndarray | None, buckets: int):
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                distinct, pair, token, firsts = _own_keys(batch, i, vocabulary)
                marked = np.zeros(len(firsts) - 1, bool)
                marked[batch.column(4)[i].as_py() or []] = True
                rows, ends = row_of(firsts), _ends(firsts)
                ours = marked[rows]
                uses = ((pair[ours], token[ours]), (pair, token))
                counts = [sum(np.bincount(k, minlength=len(distinct)) for k in both) for both in uses]
                counts += [np.bincount(token[e], minlength=len(distinct)) for e in (ends[ours[ends]], ends)]
                counts = np.stack(counts)
                cuts = _cuts(distinct, buckets)
                full = np.flatnonzero(np.diff(cuts))
                pieces = [slice(int(cuts[b]), int(cuts[b + 1])) for b in full]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array(np.full(len(full), batch.column(0)[i].as_py(), np.int64)),
                        pa.array(np.diff(cuts)[full].astype(np.int32)),
                        pa.array([_squeezed(_steps(distinct[p])) for p in pieces], pa.binary()),
                        pa.array([_squeezed(counts[:, p]) for p in pieces], pa.binary()),
                    ],
                    names=["bucket", "chunk", "n", "keys", "counts"],
                )

    return ask


def _own_answers(asked: pa.Table) -> pa.Table:
    """The sums of a bucket's keys over all chunks, for each chunk in the order of its questions; the first row has the
    bucket's words and the sums of theirs."""
    sizes = asked.column("n").to_numpy()
    at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    keys = [np.cumsum(_restored(k, n), dtype=np.uint64) for k, n in zip(asked.column("keys").to_pylist(), sizes)]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.zeros((4, len(distinct)), np.int64)
    for k, (counts, n) in enumerate(zip(asked.column("counts").to_pylist(), sizes)):
        sums[:, which[at[k] : at[k + 1]]] += _restored(counts, 4 * n).reshape(4, n).astype(np.int64)
    words = distinct & _KIND == TOKEN
    none = [None] * (len(sizes) - 1)
    return pa.table(
        {
            "chunk": asked.column("chunk").cast(pa.int64()),
            "bucket": asked.column("bucket").cast(pa.int32()),
            "sums": pa.array([_squeezed(sums[:, which[a:b]]) for a, b in zip(at, at[1:])], pa.binary()),
            "words": pa.array([int(words.sum()), *none], pa.int64()),
            "totals": pa.array([sums[:, words].sum(axis=1).tolist(), *none], pa.list_(pa.int64())),
        }
    )


def _own_losses(models: BigramModels, kind: str):
    vocabulary, buckets, size, totals, starts = models.vocabulary, models.buckets, models.size, models.totals, models.own.starts

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                distinct, pair, token, firsts = _own_keys(batch, i, vocabulary)
                cuts = _cuts(distinct, buckets)
                sums = np.zeros((4, len(distinct)), np.int64)
                for one in batch.column(4)[i].as_py() or []:
                    a, b = int(cuts[one["bucket"]]), int(cuts[one["bucket"] + 1])
                    sums[:, a:b] = _restored(one["sums"], 4 * (b - a)).reshape(4, -1)
                contexts = (_contexts((uses - ends)[token], firsts, start) for uses, ends, start in zip(sums[:2], sums[2:], starts))
                sides = zip(sums[:2], contexts, totals)
                losses = [_losses(uses[pair], uses[token], context, total, size) for uses, context, total in sides]
                yield _scored(batch.column(1)[i].values, firsts, *losses)

    return run


def _scored(ids: pa.Array, firsts: np.ndarray, target: np.ndarray, background: np.ndarray) -> pa.RecordBatch:
    """A row for each text, from the losses of the tokens."""
    rows, n = row_of(firsts), np.diff(firsts)
    target, background = (np.bincount(rows, losses, len(n)) / np.maximum(n, 1) for losses in (target, background))
    columns = [ids, pa.array(n.astype(np.int64)), pa.array(target), pa.array(background), pa.array(target - background)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "target_loss", "background_loss", "score"])


def _chunk_keys(batch: pa.RecordBatch, i: int, vocabulary: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """The keys of a chunk's tokens, read in slices, and each text's first."""
    import zstandard

    sizes = batch.column(2)[i].values.to_numpy(zero_copy_only=False)
    at = np.concatenate([[0], np.cumsum(sizes)])
    data = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column(3)[i].as_buffer()), np.uint8)
    parts: list[list[np.ndarray]] = []
    firsts = [np.zeros(1, np.int64)]
    row = 0
    while row < len(sizes):
        end = max(row + 1, int(np.searchsorted(at, at[row] + SLICE_BYTES, "right")) - 1)
        keys, begins = _keys(data[at[row] : at[end]], at[row : end + 1] - at[row], vocabulary)
        parts.append(keys)
        firsts.append(begins[1:] + firsts[-1][-1])
        row = end
    return [np.concatenate(kind) for kind in zip(*parts)], np.concatenate(firsts)


def _questions(vocabulary: np.ndarray | None, buckets: int):
    def ask(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                distinct = np.unique(np.concatenate(_chunk_keys(batch, i, vocabulary)[0]))
                cuts = _cuts(distinct, buckets)
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(full.astype(np.int32)),
                        pa.array(np.full(len(full), batch.column(0)[i].as_py(), np.int64)),
                        pa.array([distinct[cuts[b] : cuts[b + 1]].tobytes() for b in full], pa.binary()),
                    ],
                    names=["bucket", "chunk", "asked"],
                )

    return ask


def _answers(asked: pa.Table, counts: pa.Table) -> pa.Table:
    """Both counts of each asked key of a bucket, in the order of the questions; unseen keys have none."""
    known = np.frombuffer(counts.column("keys")[0].as_py() if len(counts) else b"", np.uint64)
    sides = [_unpacked(counts.column(n)[0].as_py() if len(counts) else b"", len(known)) for n in ("target", "background")]
    out: list[list[bytes]] = [[], []]
    for one in asked.column("asked").to_pylist():
        keys = np.frombuffer(one, np.uint64)
        at = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
        for side, lists in zip(sides, out):
            lists.append(_packed(np.where(known[at] == keys, side[at], 0) if len(known) else np.zeros(len(keys), np.int64)))
    return pa.table(
        {
            "chunk": asked.column("chunk").cast(pa.int64()),
            "bucket": asked.column("bucket").cast(pa.int32()),
            "target": pa.array(out[0], pa.binary()),
            "background": pa.array(out[1], pa.binary()),
        }
    )


def cross_entropy_difference(docs: DataFrame, models: BigramModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, target_loss, background_loss, score``: mean losses a token under both models, and their
    difference.  A negative score says that the text is more like the target than like the background.

    Texts are put into chunks of about 4 MB.  A chunk asks about each distinct key once; questions meet the counts in a
    shuffle by bucket (the counts are repeated where far more text is scored than was counted), and the answers
    come back to the chunk.  The very ``docs`` of ``train_marked`` have been asked about and answered there.

    Defined cases: null text or text without words has no tokens, losses and score 0; repeated rows are kept; models of
    empty corpora are uniform; no rows give no rows; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, target_loss double, background_loss double, score double"
    vocabulary, buckets, size, totals = models.vocabulary, models.buckets, models.size, models.totals
    if models.own and models.own.docs is docs and models.own.columns == (id_col, text_col):
        replies = models.own.answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "sums")).alias("replies"))
        return models.own.chunks.join(replies, "chunk", "left").mapInArrow(_own_losses(models, kind), schema)
    chunks = _chunks(docs, id_col, text_col, kind, CHUNK_BYTES)
    parts = max(1, math.ceil(chunks.count() / max(1, models.chunks)))
    asked = chunks.mapInArrow(_questions(vocabulary, buckets), "bucket int, chunk bigint, asked binary")
    asked = asked.withColumn("part", F.pmod(F.xxhash64("chunk"), F.lit(parts)).cast("int"))
    counts = models.counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    met = asked.groupBy("bucket", "part").cogroup(counts.groupBy("bucket", "part"))
    replies = met.applyInArrow(_answers, "chunk bigint, bucket int, target binary, background binary")
    replies = staged(replies.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "target", "background")).alias("replies")), "replies")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, firsts = _chunk_keys(batch, i, vocabulary)
                distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
                cuts = _cuts(distinct, buckets)
                sides = np.zeros((2, len(distinct)), np.int64)
                for one in batch.column(4)[i].as_py() or []:
                    a, b = int(cuts[one["bucket"]]), int(cuts[one["bucket"] + 1])
                    sides[:, a:b] = [_unpacked(one[n], b - a) for n in ("target", "background")]
                pair, token, context = which.reshape(3, -1)
                losses = [_losses(side[pair], side[token], side[context], total, size) for side, total in zip(sides, totals)]
                yield _scored(batch.column(1)[i].values, firsts, *losses)

    return chunks.join(replies, "chunk", "left").mapInArrow(run, schema)
