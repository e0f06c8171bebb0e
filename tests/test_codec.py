import random

import pytest
import regex
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators import codec
from tests import plain

EDGES = [
    "", "a", "aaa", "aaaa", "don'T shouLDN'T", "12345", "x\r\n\r\n  y  \n", "a　b\u0085 c", "nul\x00nul", "😀 ok",
    "'\\", "the <|endoftext|> end", "   ", "\n\n", "  lead", "tail  ", "word" * 60, "\U0010fffd gap",
]


def random_merges(rng, count):
    vocab = {i: bytes([i]) for i in range(256)}
    start = list(b"abcdehlotw'x 1\n\xc3\xa9")
    merges, seen = [], set()
    while len(merges) < count:
        pool = start + [m[2] for m in merges]
        pair = (rng.choice(pool), rng.choice(pool))
        if pair in seen or len(vocab[pair[0]] + vocab[pair[1]]) > 12:
            continue
        seen.add(pair)
        merges.append((*pair, 256 + len(merges)))
        vocab[merges[-1][2]] = vocab[pair[0]] + vocab[pair[1]]
    return merges


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    words = ["the", "hello", "what", "two", "été", "ox", "low", "tall", "deal'd", "111", "\n", "aaaaaaa"]
    return EDGES + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(30)]


def tokens_of(df):
    return [list(row["tokens"]) for row in df.select("doc_id", "tokens").orderBy("doc_id").collect()]


@pytest.mark.parametrize("count", [0, 12, 80])
def test_whole_text_encoding_is_greedy(texts, corpus, count):
    merges = random_merges(random.Random(count), count)
    model = cl.TokenizerModel(merges, cl.GPT4PAT)
    found = tokens_of(cl.encode_corpus(texts(corpus), model, mode="text"))
    assert found == [plain.encode(text, merges) for text in corpus]


@pytest.mark.parametrize("count", [0, 12, 80])
def test_whole_texts_fall_into_free_segments(texts, corpus, monkeypatch, count):
    monkeypatch.setattr(codec, "WORD_FOLD_MERGES", 40)
    merges = random_merges(random.Random(count), count)
    docs = texts(corpus)
    model = cl.TokenizerModel(merges, cl.GPT4PAT)
    expected = [plain.encode(text, merges) for text in corpus]
    assert tokens_of(cl.encode_corpus(docs, model, mode="text", strategy="dictionary")) == expected
    cut = docs.select("doc_id", F.array_join(codec.free_segments(F.col("text"), model), "").alias("joined"))
    assert [r["joined"] for r in cut.orderBy("doc_id").collect()] == [t.encode().decode("latin-1") for t in corpus]


def test_segments_are_words_for_word_bound_merges(texts):
    model = cl.TokenizerModel([(116, 104, 256), (32, 256, 257), (257, 101, 258)], cl.GPT4PAT)
    row = texts(["in the thin hat, then"]).select(codec.free_segments(F.col("text"), model).alias("s")).first()
    assert list(row["s"]) == ["i", "n", " the", " th", "i", "n", " ", "h", "a", "t", ",", " the", "n"]


@pytest.mark.parametrize("word_fold", [0, 1000])
@pytest.mark.parametrize("strategy,count,pattern", [
    ("fold", 12, cl.GPT4PAT), ("fold", 80, cl.GPT2PAT), ("dictionary", 80, cl.GPT4PAT), ("dictionary", 0, cl.GPT4PAT),
])
def test_pretoken_encoding(texts, corpus, monkeypatch, strategy, count, pattern, word_fold):
    monkeypatch.setattr(codec, "WORD_FOLD_MERGES", word_fold)
    merges = random_merges(random.Random(count), count)
    model = cl.TokenizerModel(merges, pattern)
    found = tokens_of(cl.encode_corpus(texts(corpus), model, strategy=strategy))
    assert found == [
        [token for piece in regex.findall(pattern, text) for token in plain.encode(piece, merges)] for text in corpus
    ]


def test_rare_words_are_joined_when_the_dictionary_is_large(texts, corpus, monkeypatch):
    model = cl.TokenizerModel(random_merges(random.Random(5), 60), cl.GPT4PAT)
    expected = tokens_of(cl.encode_corpus(texts(corpus), model, strategy="fold"))
    for rows in (12, 0):
        monkeypatch.setattr(codec, "HOT_ROWS", rows)
        assert tokens_of(cl.encode_corpus(texts(corpus), model, strategy="dictionary")) == expected


def test_many_merges_choose_the_dictionary(texts, corpus, monkeypatch):
    monkeypatch.setattr(codec, "FOLD_MERGES", 10)
    model = cl.TokenizerModel(random_merges(random.Random(6), 40), cl.GPT4PAT)
    expected = tokens_of(cl.encode_corpus(texts(corpus), model, strategy="fold"))
    assert tokens_of(cl.encode_corpus(texts(corpus), model)) == expected


def test_round_trip_and_report(texts, corpus):
    model = cl.TokenizerModel(random_merges(random.Random(8), 50), cl.GPT4PAT)
    docs = texts(corpus, lang=["x"] * len(corpus))
    report = cl.round_trip_report(docs, model).collect()
    assert len(report) == 1
    assert report[0]["docs"] == report[0]["exact"] == len(corpus)
    assert report[0]["bytes"] == sum(len(text.encode()) for text in corpus)


def test_decoding_of_invalid_bytes_and_unknown_ids(spark):
    rng = random.Random(9)
    rows = [[rng.randrange(256) for _ in range(rng.randint(0, 9))] for _ in range(400)]
    model = cl.TokenizerModel([], special_tokens={"<|endoftext|>": 300})
    df = spark.createDataFrame([(i, row) for i, row in enumerate(rows)], "doc_id bigint, tokens array<int>")
    found = [r["decoded"] for r in cl.decode_corpus(df, model).orderBy("doc_id").collect()]
    assert found == [bytes(row).decode("utf-8", errors="replace") for row in rows]
    for unknown in (256, 300, 1_000_000, -1):
        bad = spark.createDataFrame([(0, [65, unknown])], "doc_id bigint, tokens array<int>")
        with pytest.raises(Exception, match="unknown token id"):
            cl.decode_corpus(bad, model).collect()
    special = spark.createDataFrame([(0, [300, 65])], "doc_id bigint, tokens array<int>")
    assert cl.decode_corpus(special, model, render_special=True).first()["decoded"] == "<|endoftext|>A"


@pytest.mark.parametrize("pattern", [cl.GPT2PAT, cl.GPT4PAT, r"\w+|\W+"])
def test_splits_equal_the_unicode_regex(texts, corpus, pattern):
    df = texts(corpus).select("doc_id", cl.pretokenize(F.col("text"), pattern).alias("p")).orderBy("doc_id")
    found = [list(row["p"]) for row in df.collect()]
    assert found == [regex.findall(pattern, text) for text in corpus]
    assert ["".join(pieces) for pieces in found] == corpus


def test_patterns_with_groups_are_refused(spark):
    with pytest.raises(ValueError):
        cl.pretokenize(F.col("text"), "(a)|b")


def test_special_tokens(texts, spark):
    model = cl.TokenizerModel([], special_tokens={"<|a|>": 256, "<|b|>": 257})
    audit = cl.special_token_audit(texts(["x <|a|> <|a|>", "<|a|><|b|>", "none"]), model).collect()
    assert {r["token"]: r["docs"] for r in audit} == {"<|a|>": 2, "<|b|>": 1}
    model.add_special_tokens({"<|b|>": 300})
    assert model.special_ids == {256: "<|a|>", 300: "<|b|>"}
    with pytest.raises(ValueError):
        model.add_special_tokens({"<|c|>": 300})
    added = spark.createDataFrame([("<|b|>", 9), ("<|c|>", 300)], "token string, token_id int")
    table = cl.upsert_special_tokens(model.specials_table(spark), added)
    assert {r["token"]: r["token_id"] for r in table.collect()} == {"<|a|>": 256, "<|b|>": 9, "<|c|>": 300}


def test_rendering(spark):
    samples = [b"a\nb", b"\x00\x7f", "é​\U000e0001".encode(), b"\xff\xc3", b"", "\\".encode()]
    df = spark.createDataFrame([(i, bytearray(s)) for i, s in enumerate(samples)], "i int, b binary")
    shown = [r["s"] for r in df.select("i", cl.render_token(F.col("b")).alias("s")).orderBy("i").collect()]
    assert shown == ["a\\u000ab", "\\u0000\\u007f", "é\\u200b\\ue0001", "��", "", "\\"]


@pytest.mark.parametrize("count", [0, 31, 33, 255, 257, 2_000])
def test_one_result_for_all_strategies_and_numbers_of_merges(spark, corpus, count):
    """Null texts, null and repeated ids, long pieces: the rows come back alike from every path."""
    merges = random_merges(random.Random(count), count)
    model = cl.TokenizerModel(merges, cl.GPT4PAT)
    long = "the hello what ".replace(" ", "") * 40
    rows = [(i, t) for i, t in enumerate(corpus[:28])] + [(3, "hello two"), (None, "the low"), (None, None), (5, None), (90, long)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)

    def expected(text, in_pieces):
        if text is None:
            return None
        pieces = regex.findall(cl.GPT4PAT, text) if in_pieces else [text]
        return [token for piece in pieces for token in plain.encode(piece, merges)]

    for mode in ("text", "pretoken"):
        want = sorted(((i, t, expected(t, mode == "pretoken")) for i, t in rows), key=repr)
        for strategy in ("auto", "fold", "dictionary"):
            found = cl.encode_corpus(docs, model, mode, strategy).collect()
            got = [(r["doc_id"], r["text"], None if r["tokens"] is None else list(r["tokens"])) for r in found]
            assert sorted(got, key=repr) == want, (mode, strategy)


@pytest.mark.parametrize("merges", [
    [(97, 98, 257), (98, 99, 256)], [(97, 98, 256), (97, 98, 257)], [(97, 256, 256)], [(97, 98, 255)], [(-1, 98, 256)], [(97, 98, 1_000_000)],
])
def test_merges_out_of_order_are_refused(merges):
    with pytest.raises(ValueError):
        cl.TokenizerModel(merges)


def test_a_part_that_no_merge_makes_is_refused():
    with pytest.raises(ValueError, match="no merge makes"):
        cl.TokenizerModel([(97, 256, 300)]).vocab()


def test_many_literals_in_one_pass(texts, spark):
    rng = random.Random(5)
    some = {"".join(rng.choice("ab.<|\\é ") for _ in range(rng.randint(1, 5))) for _ in range(150)} | {"\n", "[x]", "😀", "😀a", "$"}
    model = cl.TokenizerModel([], special_tokens={word: 256 + i for i, word in enumerate(sorted(some))})
    values = ["".join(rng.choice("abab.<|\\é \n😀x[]$") for _ in range(rng.randint(0, 40))) for _ in range(80)]
    expected = {w: n for w in some if (n := sum(w in v for v in values))}
    assert {r["token"]: r["docs"] for r in cl.special_token_audit(texts(values), model).collect()} == expected
