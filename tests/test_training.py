import random

import pytest
import regex
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.functions.idstrings import char_id, id_char, ids_of
from corpusloom.operators import training
from tests import plain


def as_tuples(model):
    return [(r.left, r.right, r.token_id, r.cnt) for r in model.trace]


def test_runs_of_merges_equal_single_merges():
    """Many small alphabets, so that ties and overlaps are the rule."""
    rng = random.Random(7)
    longest = 0
    for _ in range(1500):
        letters = rng.randint(1, 7)
        sequences = [
            [rng.randrange(letters) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 8))
        ]
        expected = plain.train(sequences, 12)
        current, found = sequences, []
        while len(found) < 12:
            seen = plain.tally(current)
            leading = sorted(seen, key=lambda pair: (-seen[pair][0], seen[pair][1]))
            rows = [{"pair": "".join(map(id_char, pair)), "cnt": seen[pair][0]} for pair in leading]
            run = training.certain_run(rows, 12 - len(found))
            longest = max(longest, len(run))
            if not run:
                break
            for row in run:
                pair = tuple(map(char_id, row["pair"]))
                found.append((*pair, 256 + len(found), row["cnt"]))
                current = [plain.join_pair(seq, pair, found[-1][2]) for seq in current]
        assert found == expected
    assert longest > 2


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_text_training(texts, seed):
    rng = random.Random(seed)
    values = ["".join(rng.choice("abcdé ") for _ in range(rng.choice([0, 1, 9, 200, 500]))) for _ in range(12)]
    model = cl.train_bpe(texts(values), 256 + 25)
    assert as_tuples(model) == plain.train([v.encode() for v in values], 25)


def test_pretoken_training(texts):
    rng = random.Random(3)
    values = [
        " ".join(rng.choice(["the", "then", "hat", "aaaa", "don't", "x" * 90, "12345", "é!"]) for _ in range(30))
        for _ in range(10)
    ]
    pieces = [piece.encode() for value in values for piece in regex.findall(cl.GPT4PAT, value)]
    expected = plain.train(pieces, 30)
    model = cl.train_bpe(texts(values), 256 + 30, cl.GPT4PAT, partitions=5)
    assert as_tuples(model) == expected
    assert cl.train_bpe(texts(values), 256 + 30, cl.GPT4PAT, partitions=1).merges == model.merges


def test_frame_is_rewritten_on_the_way(texts, monkeypatch):
    monkeypatch.setattr(training, "MERGES_PER_REWRITE", 3)
    values = ["low lower lowest newer newest wide wider", "slow slower flow lower newer"]
    pieces = [piece.encode() for value in values for piece in regex.findall(cl.GPT4PAT, value)]
    assert as_tuples(cl.train_bpe(texts(values), 256 + 20, cl.GPT4PAT)) == plain.train(pieces, 20)


def test_stops_without_a_repeated_pair(texts):
    assert cl.train_bpe(texts(["ab", "ab"]), 300).merges == [(97, 98, 256)]
    assert cl.train_bpe(texts(["abc", ""]), 300).merges == []
    assert cl.train_bpe(texts(["aaaa"]), 256).merges == []
    with pytest.raises(ValueError):
        cl.train_bpe(texts(["a"]), 255)


def test_overlapping_pairs_all_count(texts):
    counts = cl.pair_counts(cl.byte_sequences(texts(["aaa", "a", ""]))).collect()
    assert [(r["left"], r["right"], r["cnt"]) for r in counts] == [(97, 97, 2)]


def test_merge_is_left_to_right(spark):
    df = spark.createDataFrame([("aaaa",), ("aaa",), ("",), ("ba",)], "s string")
    merged = df.select(ids_of(cl.merge_pair(F.col("s"), 97, 97, 300)).alias("ids")).collect()
    assert [list(row["ids"]) for row in merged] == [[300, 300], [300, 97], [], [98, 97]]


def test_id_strings_skip_the_surrogates(spark):
    ids = [0, 65, 255, 256, 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFEFF, 0xFFFF]
    assert [char_id(id_char(i)) for i in ids] == ids
    cases = [ids, [0xFEFF, 1], []]
    df = spark.createDataFrame([("".join(map(id_char, case)),) for case in cases], "s string")
    back = df.select(ids_of(F.col("s")).alias("ids")).collect()
    assert [list(row["ids"]) for row in back] == cases


def test_order_key_refuses_what_does_not_fit(spark):
    huge = spark.createDataFrame([(1 << 60, "abcdefghij")], "doc_id bigint, text string")
    with pytest.raises(Exception, match="order key"):
        cl.byte_sequences(huge).collect()
    with pytest.raises(ValueError):
        cl.byte_sequences(spark.createDataFrame([(-1, "a")], "doc_id bigint, text string"))


def test_untrained_model_is_refused():
    with pytest.raises(ValueError):
        cl.TokenizerModel().merges


def test_null_texts_raise(texts):
    for job in (cl.byte_sequences, cl.pretoken_counts):
        with pytest.raises(Exception, match="null text"):
            job(texts(["a", None])).collect()


@pytest.mark.parametrize("pattern", [None, cl.GPT4PAT])
def test_any_bigint_is_an_order(spark, pattern):
    """Ties are the rule here, so the order decides most merges."""
    rng = random.Random(11)
    values = [" ".join("".join(rng.choice("abcd") for _ in range(3)) for _ in range(6)) for _ in range(30)]
    ids = sorted({rng.randrange(-(1 << 63), 1 << 63) for _ in values} | {-(1 << 63), (1 << 63) - 1})[: len(values)]
    rows = list(zip(ids, values, range(30)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, _rank int").repartition(3)
    pieces = [p.encode() for v in values for p in (regex.findall(pattern, v) if pattern else [v])]
    assert as_tuples(cl.train_bpe(df, 256 + 20, pattern)) == plain.train(pieces, 20)
    ranked = cl.dense_order(df.drop("_rank")).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in ranked] == list(enumerate(values))


def test_dense_order_keeps_what_fits_and_repeated_values(spark):
    df = spark.createDataFrame([(5, "a"), (5, "b"), (9, "c")], "doc_id bigint, text string")
    assert cl.dense_order(df) is df
    far = cl.dense_order(df.withColumn("doc_id", F.col("doc_id") - 7))
    assert sorted(map(tuple, far.collect())) == [(0, "a"), (0, "b"), (1, "c")]
    assert cl.dense_order(df.limit(0)).count() == 0
