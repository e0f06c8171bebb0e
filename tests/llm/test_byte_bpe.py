"""Byte-level BPE against the library whose ranks it reads."""

import hashlib
import random

import numpy as np
import pytest

from corpusloom.llm import byte_bpe

public = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def table():
    return byte_bpe.RankTable.load(public.path(NAME))


@pytest.fixture(scope="module")
def library(table):
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=table.ranks, special_tokens={})


def odd_texts(rng, n):
    alphabet = [*"aAstmdrevl' \n\t0 9.,'\x00", "é", "　", "\x85", " ", "日", "😀", "\x1c", "ª", "²", "͸", "՘", "'s", "'re", "  "]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(14))) for _ in range(n)]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_the_split_rule_is_that_of_the_files():
    assert byte_bpe.PATTERN == public.PATTERN


def test_words_are_those_of_the_library(library):
    """Texts side by side in one buffer; the bytes of the library's pieces show where it cuts."""
    single = tiktoken.Encoding("bytes", pat_str=public.PATTERN, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
    classes, rng = byte_bpe.character_classes(), random.Random(1)
    for _ in range(300):
        texts = odd_texts(rng, 20)
        raw = [t.encode() for t in texts]
        at = np.cumsum([0, *map(len, raw)])
        starts, ends, firsts = byte_bpe.split_words(np.frombuffer(b"".join(raw), np.uint8), at, classes)
        for k, text in enumerate(texts):
            words = [b"".join(raw)[a:b].decode() for a, b in zip(starts[firsts[k] : firsts[k + 1]], ends[firsts[k] : firsts[k + 1]])]
            assert "".join(words) == text
            assert sum((library.encode_ordinary(w) for w in words), []) == library.encode_ordinary(text)
            assert all(len(single.encode_ordinary(w)) == len(w.encode()) for w in words)


def test_query_digest_equals_the_library(docs, odd_rows, table, library):
    rng = random.Random(6)
    long_words = [(700 + i, "".join(rng.choice("abcdetinéo") for _ in range(n))) for i, n in enumerate((31, 63, 64, 65, 66, 900, 20_000))]
    rows = odd_rows + [(300 + i, t) for i, t in enumerate(odd_texts(rng, 200))] + long_words
    expected = []
    for i, text in rows:
        ids = library.encode_ordinary(text or "")
        expected.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode())))
    assert sorted(map(repr, (tuple(r) for r in byte_bpe.bpe_digest(docs(rows), table).collect()))) == sorted(map(repr, expected))


def test_no_rows(docs, table):
    assert byte_bpe.bpe_digest(docs([]), table).collect() == []


def test_a_task_may_forget_its_words(docs, table, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "HELD_WORDS", 40)
    monkeypatch.setattr(byte_bpe, "SLICE", 200)
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice(["the", "of", f"x{rng.randrange(90)}"]) for _ in range(30))) for i in range(120)]
    got = {r.doc_id: r.ids for r in byte_bpe.encode(docs(rows, 2), table).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in rows}


def test_merges_that_make_lower_ranks_and_words_out_of_reach(docs):
    """Ranks that no training would give: the fold and the heap must still take the lowest, leftmost pair each time."""
    rng = random.Random(5)
    words = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 6))) for _ in range(60)}
    ranks = {bytes([i]): i for i in range(256)}
    for k, word in enumerate(sorted(words, key=lambda w: rng.random())):
        ranks[word.encode()] = 256 + k
    table = byte_bpe.RankTable(ranks)
    assert table.whole
    library = tiktoken.Encoding("odd", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [(i, " ".join("".join(rng.choice("abc") for _ in range(rng.randrange(1, 90))) for _ in range(8))) for i in range(60)]
    got = {r.doc_id: r.ids for r in byte_bpe.encode(docs(rows), table).collect()}
    assert got == {i: library.encode_ordinary(t) for i, t in rows}


def test_ids_decode_to_their_bytes(spark, table):
    frame = spark.createDataFrame([([104, 256, 0, 255],), ([],), (None,)], "ids array<int>")
    words = {r: w for w, r in table.ranks.items()}
    found = [None if r.b is None else bytes(r.b) for r in frame.select(byte_bpe.decoded(frame.ids, table).alias("b")).collect()]
    assert found == [b"".join(words[i] for i in (104, 256, 0, 255)), b"", None]
    with pytest.raises(Exception):
        spark.createDataFrame([([60_000],)], "ids array<int>").select(byte_bpe.decoded(frame.ids, table)).collect()


def test_lists_of_ids_decode_in_a_task(table):
    pa = pytest.importorskip("pyarrow")
    pieces = table.binary_pieces()
    lists = pa.ListArray.from_arrays(pa.array([0, 4, 4, 5], pa.int32()), pa.array([104, 256, 0, 255, 300], pa.int32()))
    words = {r: w for w, r in table.ranks.items()}
    assert byte_bpe.concatenated(lists, pieces).to_pylist() == [b"".join(words[i] for i in (104, 256, 0, 255)), b"", words[300]]
    assert byte_bpe.concatenated(lists[1:2], pieces).to_pylist() == [b""]
    gaps = byte_bpe.RankTable({**{bytes([i]): i for i in range(256)}, b"ab": 300}).binary_pieces()
    with pytest.raises(ValueError):
        byte_bpe.concatenated(lists, gaps)


def test_bad_rank_files_are_refused():
    single = {bytes([i]): i for i in range(256)}
    for ranks in ({b"a": 0}, {**single, b"ab": 7}, {**single, b"ab": byte_bpe.MAX_RANK}):
        with pytest.raises(ValueError):
            byte_bpe.RankTable(ranks)


def test_two_parts_of_a_scan_are_one_task(docs, table, library, spark):
    """Words are folded once a task, so a task takes two of many parts; every row is still there."""
    cores = spark.sparkContext.defaultParallelism
    rows = [(i, f"word{i % 7} other{i}") for i in range(300)]
    frame = docs(rows, 8 * cores)
    encoded = byte_bpe.encode(frame, table)
    assert encoded.rdd.getNumPartitions() == 4 * cores
    assert {r.doc_id: r.ids for r in encoded.collect()} == {i: library.encode_ordinary(t) for i, t in rows}
    assert byte_bpe.encode(docs(rows, 2 * cores), table).rdd.getNumPartitions() == 2 * cores
