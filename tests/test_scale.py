"""Costs that must not grow faster than the input: what is shuffled, copied by the optimizer or left to one task."""

import os
import random
import re

import pytest
import regex
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom import queries
from corpusloom.functions import literals
from corpusloom.operators import batching, codec, packing, training
from corpusloom.plans import offsets
from tests import plain


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_codes_of_common_ids_come_from_a_constant(spark):
    ids = [0, 9, 255, 256, queries.CODED_IDS - 1, queries.CODED_IDS, 50_256, 65_535]
    df = spark.createDataFrame([(ids,), ([],)], "ids array<int>")
    assert [r[0] for r in df.select(queries.codes(F.col("ids"))).collect()] == ["".join(f"{t:04x}|" for t in ids), ""]


def test_bad_ids_are_looked_for_behind_the_shuffle(spark, texts):
    """A filter on the ids that moves below a repartitioning encodes the texts where they are scanned."""
    docs = texts(["plain", "é", None, "ü ß"]).repartition(3)
    tokens = docs.select("doc_id", cl.byte_tokens(F.col("text")).alias("tokens"))
    bad = cl.invalid_token_ids(tokens, bound=128)
    assert {r["doc_id"]: len(r["bad_ids"]) for r in bad.collect()} == {1: 2, 3: 4}
    assert optimized(bad).count("transform(") == 1


def merged_once(ids, left, right, new):
    out, i = [], 0
    while i < len(ids):
        pair = i + 1 < len(ids) and (ids[i], ids[i + 1]) == (left, right)
        out.append(new if pair else ids[i])
        i += 2 if pair else 1
    return out


def plain_merges(data: bytes, merges):
    ids = list(data)
    for merge in merges:
        ids = merged_once(ids, *merge)
    return ids


@pytest.mark.parametrize("n", [12, 300, 1_400])
@pytest.mark.parametrize("hot", [0, 3, 500_000])
def test_rare_pieces_are_encoded_in_place(spark, texts, monkeypatch, n, hot):
    """Occurrences outside the broadcast table are not shuffled: the compact texts are, once for each side of the join."""
    monkeypatch.setattr(codec, "HOT_ROWS", hot)
    letters = [ord(c) for c in "abcdefghijklmnopqrstuvwxyzäöü"]
    letters = sorted({b for c in letters for b in chr(c).encode()})
    merges = [(a, b, 256 + i) for i, (a, b) in enumerate([(a, b) for a in letters for b in letters][: min(n, 700)])]
    merges += [(256 + i, 257 + i, 956 + i) for i in range(n - len(merges))] if n > 700 else []
    if n > 700:
        merges = [(left, right, 256 + i) for i, (left, right, _) in enumerate(merges)]
    values = ["the cab abba", "ab" * 90 + "äöü" * 40, None, "", "the the cab", "zebra " * 50 + "abcdefgh" * 30]
    model = cl.TokenizerModel(merges, r"\S+|\s+")
    encoded = cl.encode_corpus(texts(values), model, strategy="dictionary")
    assert optimized(encoded).count("Repartition") == 2 and optimized(encoded).count("Join") == 2
    found = {r["doc_id"]: r["tokens"] for r in encoded.collect()}
    for i, value in enumerate(values):
        pieces = [] if value is None else re.findall(r"\S+|\s+", value)
        assert found[i] == (None if value is None else [t for p in pieces for t in plain_merges(p.encode(), merges)])


def test_slices_hold_equal_numbers_of_tokens(spark, monkeypatch):
    """A slice is what one task sorts, so long documents make more slices and not larger ones."""
    monkeypatch.setattr(packing, "TOKENS_PER_SLICE", 100)
    rows = [(i, [i % 7] * (1 if i < 300 else 60)) for i in range(340)]
    docs = spark.createDataFrame(rows, "doc_id bigint, tokens array<int>")
    seen = []
    monkeypatch.setattr(offsets, "slice_of", lambda key, bounds, real=offsets.slice_of: seen.append(bounds) or real(key, bounds))
    shards = cl.pack_shards(docs, 500)
    ends = [0, *seen[-1], 340]
    assert max(sum(len(t) for i, t in rows if low <= i < high) for low, high in zip(ends, ends[1:])) <= 2 * 100
    stream = [t for r in sorted(shards.collect(), key=lambda r: (r["shard"], r["shard_pos"])) for t in r["tokens"]]
    assert stream == [t for _, tokens in rows for t in tokens]


def test_many_literals_are_searched_once(texts):
    words = sorted({"a", "ab", "abc", "b c", "ö.", "x\\", "[", "-", "^", "]", *(chr(c) + chr(d) for c in range(97, 123) for d in (97, 101))})
    values = ["abc b c", "xx\\ö.^-[]", None, "", "zezaqe" * 3]
    frame = texts(values).select("doc_id", literals.literals_in(F.col("text"), words).alias("found"))
    assert optimized(frame).count("regexp_extract_all") == 1
    found = {r["doc_id"]: r["found"] for r in frame.collect()}
    assert {i: f and sorted(f) for i, f in found.items()} == {
        i: None if v is None else sorted(w for w in words if w in v) for i, v in enumerate(values)
    } | {3: []}


def test_choices_of_many_literals_are_grouped():
    """No choice has more branches than are tried in a row."""
    words = [chr(c) + chr(d) for c in range(97, 123) for d in range(97, 123)]
    pattern = re.sub(r"\\x\{(\w+)\}", r"\\x\1", literals.prefix_pattern(words))
    assert all(re.fullmatch(pattern, word) for word in words) and not re.match(pattern, "a1")
    assert max(len(run.split("|")) for run in re.split(r"\(\?:|\)", re.sub(r"\(\?=.*?\]\)", "", pattern))) <= literals.FEW_BRANCHES


def test_pretokens_of_dealt_texts_are_not_shuffled(spark, texts, tmp_path):
    texts(["a b", "c", "", "d e f"]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.q_split_pretokens(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("Generate") < plan.index("Exchange")
    assert {r["doc_id"]: r["n"] for r in rows.collect()} == {0: 3, 1: 1, 3: 5}


def test_texts_are_counted_once_a_pass(texts, monkeypatch):
    """Nearly every merge changes a whole text: giving up its old pairs would count each text twice."""
    monkeypatch.setattr(training, "_changed_counts", lambda *_: pytest.fail("texts were counted twice"))
    monkeypatch.setattr(training, "PIECE", 50)
    values = ["the cat sat on the mat " * 40, "that hat, then " * 60, "é" * 301, "x"]
    found = cl.train_bpe(texts(values), 256 + 40).merges
    seqs, merges = [list(v.encode()) for v in values], []
    for new in range(256, 296):
        counts, first = {}, {}
        for t, seq in enumerate(seqs):
            for i, pair in enumerate(zip(seq, seq[1:])):
                counts[pair] = counts.get(pair, 0) + 1
                first.setdefault(pair, (t, i))
        pair = min(counts, key=lambda p: (-counts[p], first[p]))
        if counts[pair] < 2:
            break
        merges.append((*pair, new))
        seqs = [merged_once(seq, *merges[-1]) for seq in seqs]
    assert found == merges


def test_slices_are_found_by_halving(spark):
    """The number of comparisons for a key does not grow with the root of the number of slices."""
    keys = [None, -(1 << 63), -5, 0, 1, 9, 10, 11, 3_999, 39_990, 39_991, 1 << 62]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint")
    for bounds in ([7], [0, 1], list(range(0, 40_000, 10)), [-(1 << 62), 5, 1 << 62]):
        found = df.select("k", offsets.slice_of("k", bounds).alias("s"))
        assert "filter(" not in optimized(found)
        assert [r["s"] for r in found.collect()] == [0 if k is None else sum(b <= k for b in bounds) for k in keys]


def test_many_shards_are_written_by_few_tasks(spark, tmp_path, monkeypatch):
    """As many tasks as shards make a shuffle whose blocks grow with the square of the input."""
    docs = spark.createDataFrame([(i, [i % 9] * 7) for i in range(300)], "doc_id bigint, tokens array<int>")
    wanted = []
    deal = type(docs).repartitionByRange
    monkeypatch.setattr(type(docs), "repartitionByRange", lambda df, n, *keys: wanted.append(n) or deal(df, n, *keys))
    cl.write_token_shards(cl.pack_shards(docs, 50), f"{tmp_path}/shards")
    assert wanted == [spark.sparkContext.defaultParallelism]
    files = list(tmp_path.glob("shards/split=*/shard=*/*.parquet"))
    assert len(files) == len({f.parent for f in files}) == 42
    read = cl.read_token_shards(spark, f"{tmp_path}/shards", "train").unionByName(cl.read_token_shards(spark, f"{tmp_path}/shards", "valid"))
    stream = [t for r in sorted(read.collect(), key=lambda r: (r["shard"], r["shard_pos"])) for t in r["tokens"]]
    assert stream == [i % 9 for i in range(300) for _ in range(7)]


def test_packed_tokens_equal_arrays(spark, texts):
    """Tokens are staged, shuffled and cut as bytes; ids beyond one byte, two bytes and the surrogates come back."""
    values = ["", "a", "é" * 40, "日本 text " * 30, "x" * 3_000] + [f"word {i} " * (i % 7) for i in range(40)]
    merges = [(97, 98, 55_295), (111, 114, 55_296), (120, 120, 70_000)]
    model = cl.TokenizerModel(merges, cl.GPT4PAT, {packing.END_OF_TEXT: 900_000})
    docs = texts(values)
    arrays, packed = cl.tokenize_documents(docs, model), cl.tokenize_documents(docs, model, packed=True)
    assert packed.schema["tokens"].dataType.simpleString() == "binary"
    found = {r["doc_id"]: list(r["tokens"]) for r in packing.unpacked_tokens(packed).collect()}
    assert found == {r["doc_id"]: list(r["tokens"]) for r in arrays.collect()}
    assert found == {i: [900_000, *plain_pieces(text, merges)] for i, text in enumerate(values)}
    shards = [cl.pack_shards(tokens, 400) for tokens in (arrays, packed)]
    plan = cl.batch_plan(cl.shard_manifest(shards[0]), 2, 16, 2)
    batches = [sorted(map(repr, cl.materialize_batches(s, plan, 2, 16).collect())) for s in shards]
    assert batches[0] == batches[1] and len(batches[0]) == 2 * plan.count()


def plain_pieces(text, merges):
    return [t for piece in regex.findall(cl.GPT4PAT, text) for t in plain_merges(piece.encode(), merges)]


def test_batches_are_cut_from_stretches(spark):
    """A piece is shuffled in stretches of many rows, and a planned row needs no array of its own before the join."""
    pieces = [(0, at, list(range(at, at + 700))) for at in range(0, 7_000, 700)]
    shards = spark.createDataFrame(pieces, "shard int, shard_pos bigint, tokens array<int>")
    stretches = batching.token_stretches(shards, 1_024)
    assert sorted((r["stretch"], r["begin"], r["end"], list(r["ids"])) for r in stretches.collect()) == [
        (i, 1_024 * i, end := min(1_024 * i + 1_025, 7_000), list(range(1_024 * i, end))) for i in range(7)
    ]


@pytest.mark.parametrize("as_bytes", [False, True])
def test_rows_beside_a_gap_are_found(spark, as_bytes):
    """Pieces that are missing or repeated concern the rows that need them alone, though others share their stretch."""
    pieces = [(0, at, list(range(at, at + 4))) for at in range(0, 40, 4) if at not in (12, 16)] + [(1, 0, [1, 2, 3, 4, 5]), (1, 0, [1, 2, 3, 4, 5])]
    shards = spark.createDataFrame(pieces, "shard int, shard_pos bigint, tokens array<int>")
    if as_bytes:
        pack = F.udf(lambda ids: b"".join(i.to_bytes(4, "little") for i in ids), "binary")
        shards = shards.withColumn("tokens", pack("tokens"))

    def rows(*starts):
        plan = spark.createDataFrame([(0, i, *s) for i, s in enumerate(starts)], "rank int, batch_index bigint, shard int, start bigint")
        return {(r["shard"], r["inputs"][0]): list(r["targets"]) for r in cl.materialize_batches(shards, plan, 1, 5).collect()}

    assert rows((0, 0), (0, 5), (0, 20), (0, 30)) == {(0, s): list(range(s + 1, s + 6)) for s in (0, 5, 20, 30)}
    for start in ((0, 10), (0, 15), (1, 0)):
        with pytest.raises(Exception, match="not in the shards"):
            rows((0, 0), start)


def test_digests_equal_codes(spark):
    """Ids are coded for a whole batch; null ids are left out and ids above four digits cut, as the codes have them."""
    values = [[], None, [0, 1, 255, 256, 4_096, 65_535], [70_000, 5], [-1, 3], [7, None, 9], *([i] * (i % 5) for i in range(60))]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "k int, tokens array<int>").repartition(2)
    native = df.select("k", F.size("tokens").alias("n"), F.md5(queries.codes(F.col("tokens"))).alias("d"))
    found = queries.digest(df, "k")
    assert sorted(map(repr, map(tuple, found.collect()))) == sorted(map(repr, map(tuple, native.collect())))


ODD_TEXTS = ["", "plain text", "a\U0010fffdb the\U0010fffd\U0010fffd the", "\U0010fffd", "é  日本\r\n\r\n x  ", "\x00the\x85 the"]


@pytest.mark.parametrize("pattern", [cl.GPT2PAT, cl.GPT4PAT, r"\p{L}+"])
def test_texts_without_merges_are_not_searched(spark, texts, pattern):
    """Pre-tokens that leave nothing out are the text; a pattern that does, or a text that is not UTF-8, is still searched."""
    model = cl.TokenizerModel([], pattern)
    docs = texts([*ODD_TEXTS, None]).union(spark.sql("select 99L, cast(x'61ff62' as string)"))
    found = {r["doc_id"]: r["tokens"] for r in cl.encode_corpus(docs, model).collect()}
    native = docs.select("doc_id", codec.ids_of(codec.byte_string(F.array_join(cl.pretokenize(F.col("text"), pattern), "")), 255).alias("ids"))
    assert found == {r["doc_id"]: r["ids"] for r in native.collect()}
    assert found[99] == list("ab".encode() if pattern == r"\p{L}+" else "a�b".encode())
    plan = optimized(cl.encode_corpus(docs, model))
    assert ("CASE WHEN" in plan) == (pattern != r"\p{L}+")


def test_pieces_are_joined_before_they_become_bytes(spark, texts):
    """One conversion a text and none a piece, also beside texts that hold the mark between the pieces."""
    merges = [(116, 104, 256), (256, 101, 257), (32, 257, 258), (189, 32, 259), (189, 116, 260)]
    model = cl.TokenizerModel(merges, cl.GPT4PAT)
    found = [r["tokens"] for r in cl.encode_corpus(texts(ODD_TEXTS), model, strategy="fold").orderBy("doc_id").collect()]
    assert found == [plain_pieces(text, merges) for text in ODD_TEXTS]
    plan = optimized(cl.encode_corpus(texts(ODD_TEXTS), model, strategy="fold"))
    assert "array_join(regexp_extract_all" in plan


def test_separators_are_put_before_the_ids_are_made(texts):
    """The ids of a document reach its digest without an array in the plan; a separator beyond all characters still works."""
    values = ["", "the cat", "日本"]
    for eot in (256, 999_999, 2_000_000):
        model = cl.TokenizerModel([(116, 104, 256)] if eot > 256 else [], cl.GPT4PAT, {packing.END_OF_TEXT: eot})
        tokens = cl.tokenize_documents(texts(values), model)
        found = [(r["n_tokens"], r["tokens"]) for r in tokens.orderBy("doc_id").collect()]
        expected = [[eot, *plain_pieces(text, model.merges)] for text in values]
        assert found == [(len(ids), ids) for ids in expected]
        plan = queries.digest(tokens, "doc_id")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython [") == (1 if eot < 2_000_000 else 2)


def test_staged_packed_tokens_take_little_room(spark, texts, tmp_path):
    """Four bytes a token are mostly zeros: staged, they take less than half a byte of disk for each byte of them."""
    words = random.Random(3)
    docs = texts([" ".join(words.choice(["the", "cat", "sat", "on", "mat"]) for _ in range(3_000)) for _ in range(12)])
    model = cl.TokenizerModel([], cl.GPT4PAT, {packing.END_OF_TEXT: 256})
    staged = cl.stage_table(cl.tokenize_documents(docs, model, packed=True), "tokens")
    files = [f.removeprefix("file://") for f in staged.inputFiles()]
    assert files and all(".zstd." in f for f in files)
    assert sum(map(os.path.getsize, files)) < staged.agg(F.sum("n_tokens")).first()[0] / 2


@pytest.mark.parametrize("used", [[], [0x1F], [0x1F, 0x1E, 0x1D, 0x1C]])
def test_a_byte_no_merge_takes_part_in_stands_between_pieces(spark, texts, used):
    """Texts that hold it, bytes that are not UTF-8 and merges of all such bytes take the longer way."""
    merges = [(116, 104, 256), (256, 101, 257), (32, 257, 258), *((byte, byte, 300 + i) for i, byte in enumerate(used))]
    values = [*ODD_TEXTS, "the\x1f\x1f\x1fthe", "a\x1e\x1eb\x1f", "\x1d\x1c\x1c", "'the don't $0 \\the"]
    docs = texts([*values, None]).union(spark.sql("select 99L, cast(x'7468ff1f6862' as string)"))
    for pattern in (cl.GPT4PAT, cl.GPT2PAT):
        model = cl.TokenizerModel(merges, pattern)
        encoded = cl.encode_corpus(docs, model, strategy="fold")
        found = {r["doc_id"]: r["tokens"] for r in encoded.collect()}
        assert found.pop(len(values)) is None
        rows = {**dict(enumerate(values)), 99: "th�\x1fhb"}
        assert found == {
            i: [t for piece in regex.findall(pattern, text) for t in plain_merges(piece.encode(), merges)] for i, text in rows.items()
        }
        assert ("regexp_replace" in optimized(encoded)) == (len(used) < 4)


def test_a_pass_counts_what_its_own_merges_change(texts, monkeypatch):
    """Sequences that earlier merges changed are not counted again, though the frame is not rewritten in between."""
    words = {f"{first}{second}{third}": 2 + 3 * i for i, (first, second, third) in enumerate(["abc", "bcd", "cde", "def", "efg", "fgh"])}
    values = [" ".join(word for word, n in words.items() for _ in range(n))]
    changes = []
    counted = training._changed_counts

    def spied(counts, merged, any_long):
        changes.append(merged.where("before is not null").count())
        return counted(counts, merged, any_long)

    monkeypatch.setattr(training, "_changed_counts", spied)
    pieces = [piece.encode() for value in values for piece in regex.findall(cl.GPT4PAT, value)]
    model = cl.train_bpe(texts(values), 256 + 7, cl.GPT4PAT)
    expected = plain.train(pieces, 7)
    assert [(r.left, r.right, r.token_id, r.cnt) for r in model.trace] == expected
    # What each merge changes, one at a time; passes may take some at once, the last one is not counted.
    current, alone = sorted({tuple(p) for p in pieces}), []
    for left, right, token_id, _ in expected:
        after = [tuple(plain.join_pair(seq, (left, right), token_id)) for seq in current]
        alone.append(sum(a != b for a, b in zip(current, after)))
        current = after
    assert len(changes) > 2 and sum(changes) <= sum(alone)
