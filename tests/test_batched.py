"""Merges and pair counts over whole batches, against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.functions import batched
from corpusloom.functions.idstrings import id_char
from corpusloom.operators import codec
from tests import plain
from tests.test_codec import EDGES, random_merges, tokens_of


def byte_merges(rng, count, letters=b"ab \x00\xc3\xa9-"):
    """Pairs of bytes in any order, then pairs of their tokens and bytes: runs, chains and overlaps of all kinds."""
    pairs = [(a, b) for a in letters for b in letters]
    rng.shuffle(pairs)
    merges = [(a, b, 256 + i) for i, (a, b) in enumerate(pairs[: count // 2])]
    while len(merges) < count:
        pool = list(letters) + [m[2] for m in merges]
        pair = (rng.choice(pool), rng.choice(pool))
        if pair not in {m[:2] for m in merges}:
            merges.append((*pair, 256 + len(merges)))
    return merges


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(3)
    runs = ["a" * n for n in range(1, 9)] + ["ab" * 20, "b" + "a" * 33 + "b", "-" * 5_000 + "a", "é" * 30, "\x00a\x00\x00a"]
    return EDGES + runs + ["".join(rng.choice("ab -\x00é") for _ in range(rng.randint(0, 90))) for _ in range(120)]


@pytest.mark.parametrize("seed,count,chunk,step,looks", [
    (0, 1, 1 << 20, 1024, 3), (1, 40, 1 << 20, 1024, 3), (2, 60, 64, 5, 0), (3, 60, 1, 1024, 1), (4, 80, 200, 16, 3),
])
def test_steps_are_the_merges_in_rank_order(texts, odd_texts, monkeypatch, seed, count, chunk, step, looks):
    monkeypatch.setattr(batched, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(batched, "STEP_MERGES", step)
    monkeypatch.setattr(batched, "FULL_LOOKS", looks)
    rng = random.Random(seed)
    merges = (byte_merges if seed % 2 else random_merges)(rng, count)
    model = cl.TokenizerModel(merges, cl.GPT4PAT)
    found = tokens_of(cl.encode_corpus(texts(odd_texts), model, mode="text", strategy="steps"))
    assert found == [plain.encode(text, merges) for text in odd_texts]


def test_merges_of_a_step_take_nothing_that_it_makes():
    rng = random.Random(7)
    for _ in range(50):
        merges = random_merges(rng, 40)
        steps = batched.merge_steps(merges)
        assert [m for step in steps for m in step] == merges
        for step in steps:
            assert not {m[2] for m in step} & {part for m in step for part in m[:2]}
    assert len(batched.merge_steps([(97, 98, 256), (98, 97, 257), (256, 257, 258), (257, 99, 259), (258, 97, 260)])) == 3


def test_many_merges_over_whole_texts_are_made_in_place(texts, monkeypatch):
    monkeypatch.setattr(codec, "FOLD_MERGES", 10)
    merges = byte_merges(random.Random(2), 24)
    model = cl.TokenizerModel(merges)
    values = ["aab", None, "", "a-b", "-" * 9, None]
    docs = texts(values)
    expected = [None if value is None else plain.encode(value, merges) for value in values]
    encoded = cl.encode_corpus(docs.coalesce(1), model, mode="text", lead=300)
    plan = encoded._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "corpusloom-" not in plan
    rows = encoded.orderBy("doc_id").collect()
    assert [r["tokens"] if r["tokens"] is None else list(r["tokens"]) for r in rows] == [x if x is None else [300, *x] for x in expected]
    packed = cl.encode_corpus(docs, model, mode="text", packed=True).orderBy("doc_id").collect()
    assert [None if r["tokens"] is None else memoryview(bytes(r["tokens"])).cast("i").tolist() for r in packed] == expected
    with pytest.raises(ValueError):
        cl.encode_corpus(docs, model, strategy="steps")


def test_many_steps_choose_the_dictionary(texts, monkeypatch):
    monkeypatch.setattr(codec, "FOLD_MERGES", 4)
    monkeypatch.setattr(codec, "BATCHED_STEPS", 2)
    merges = [(97, 98, 256), (256, 99, 257), (257, 100, 258), (258, 101, 259), (259, 102, 260)]
    values = ["abcdef", "abcabcdex", "xabcdefabcdef"]
    found = tokens_of(cl.encode_corpus(texts(values), cl.TokenizerModel(merges), mode="text"))
    assert found == [plain.encode(value, merges) for value in values]


@pytest.mark.parametrize("chunk,cells", [(1 << 20, 1 << 20), (40, 1 << 20), (1 << 20, 4)])
def test_pairs_of_any_ids_weights_and_keys(spark, monkeypatch, chunk, cells):
    monkeypatch.setattr(batched, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(batched, "PAIR_CELLS", cells)
    rng = random.Random(chunk + cells)
    pool = [97, 98, 0, 255, 300, 0xD7FF, 0xD800, 0xF000, 70_000]
    rows = []
    for i in range(120):
        ids = [rng.choice(pool[: 3 if i % 4 else None]) for _ in range(rng.choice([0, 1, 2, 3, 30]))]
        rows.append((ids, rng.choice([1, 5, None if i % 3 else 2]), rng.choice([i * 100, 5_000 - i, 7, None])))
    expected = {}
    for ids, n, start in rows:
        for i, pair in enumerate(zip(ids, ids[1:])):
            held = expected.setdefault(pair, ([], []))
            held[0].extend([] if n is None else [n])
            held[1].extend([] if start is None else [start + i])
    frame = spark.createDataFrame([("".join(map(id_char, ids)), n, s) for ids, n, s in rows], "seq string, n bigint, start bigint")
    counts = cl.pair_counts(frame.unionByName(frame.limit(0)).union(spark.createDataFrame([(None, 1, 1)], frame.schema)))
    found = {(r["left"], r["right"]): (r["cnt"], r["first_key"]) for r in counts.collect()}
    assert found == {p: (sum(n) if n else None, min(at, default=None)) for p, (n, at) in expected.items()}


def test_texts_are_counted_without_a_row_for_each_pair(texts):
    counts = cl.pair_counts(cl.byte_sequences(texts(["abab", "ba"])))
    assert "Generate" not in counts._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["left"], r["right"], r["cnt"]) for r in counts.collect()} == {(97, 98, 2), (98, 97, 2)}
    assert dict(counts.dtypes) == {"left": "int", "right": "int", "cnt": "bigint", "first_key": "bigint"}
    assert counts.where(F.col("left") == 98).orderBy("first_key").first()["first_key"] == 1


def test_a_null_text_is_not_counted_as_empty(texts):
    with pytest.raises(Exception, match="null text"):
        cl.pair_counts(cl.byte_sequences(texts(["abab", None]))).collect()
