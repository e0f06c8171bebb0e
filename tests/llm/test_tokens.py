"""op7 and op10: against the tokenizer itself, ids and files back and forth."""

import zlib

import numpy as np
import pytest

from corpusloom.llm.encoding import SpanEncoder
from corpusloom.llm.grammar_files import decode_range, expand, expansion_lengths, re_pair, read_grammar_files, write_grammar_files
from corpusloom.llm.packing import pack_documents
from corpusloom.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def plain():
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_pieces_are_the_stream(docs, odd_rows, plain):
    rows = pack_documents(docs(odd_rows), tokenizer_path(), length=64, with_ids=True).collect()
    place = 0
    for p in sorted(rows, key=lambda p: (p.sequence_id, p.offset)):
        assert p.sequence_id * 64 + p.offset == place and p.offset + p.length <= 64
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length
        place += p.length
    assert place == sum(len(plain(t)) for _, t in odd_rows)
    for doc_id, text in odd_rows:
        if doc_id in (12, None):
            continue
        pieces = sorted((p for p in rows if p.doc_id == doc_id), key=lambda p: p.start)
        ids = [i for p in pieces for i in p.ids]
        assert ids == plain(text).tolist() and {p.doc_tokens for p in pieces} == {len(ids)}
        assert [p.start for p in pieces] == np.cumsum([0, *(p.length for p in pieces)])[:-1].tolist()


def test_files_come_back(spark, docs, odd_rows, plain, tmp_path):
    path = str(tmp_path / "files")
    write_grammar_files(docs(odd_rows), path, tokenizer_path(), block_ids=500)
    rows = sorted(read_grammar_files(spark, path, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i or 0))
    assert [r.start for r in rows] == np.cumsum([0, *(r.n_tokens for r in rows)])[:-1].tolist()
    texts = dict(odd_rows)
    for r in rows:
        assert r.ids == plain(texts[r.doc_id]).tolist() and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_empty_tables(spark, docs, tmp_path):
    assert pack_documents(docs([]), tokenizer_path()).count() == 0
    write_grammar_files(docs([]), str(tmp_path / "none"), tokenizer_path())
    assert read_grammar_files(spark, str(tmp_path / "none")).count() == 0


def test_encoder_equals_the_tokenizer_when_its_table_overflows(odd_rows, plain, monkeypatch):
    import pyarrow as pa

    import corpusloom.llm.encoding as module
    from corpusloom.llm.textbytes import slices

    monkeypatch.setattr(module, "TABLE_BITS", 6)
    coder = SpanEncoder(tokenizer_path())
    assert coder.splits
    marks = [f"{a}{m}{b}" for a in ("Ab", "é", "1", "-", "'", "") for m in (".", "!!", "*#", "'.", "|") for b in ("", "x", " ")]
    texts = [*marks, *(t or "" for _, t in odd_rows if len(t or "") < 10_000)]
    found = [b for _, _, data, at in slices(pa.array(texts), 400) for b in coder.documents(data, at, 2)]
    assert [np.frombuffer(b, coder.kind).tolist() for b in found] == [plain(t).tolist() for t in texts]


@pytest.mark.parametrize("seed", range(6))
def test_grammar_round_trip_and_random_access(seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, [1, 3, 50, 5000][seed % 4], rng.integers(0, 5000)).astype(np.uint32)
    symbols, rules, base = re_pair(ids, min_count=2, min_gain=0)
    assert (expand(symbols, rules, base) == ids).all()
    lengths = expansion_lengths(rules, base)
    assert [len(expand(np.array([base + k], np.uint32), rules, base)) for k in range(len(rules))] == lengths.tolist()
    for _ in range(20):
        a, b = sorted(rng.integers(0, len(ids) + 1, 2))
        assert (decode_range(symbols, rules, lengths, base, a, b) == ids[a:b]).all()


def test_frequent_pairs_are_replaced():
    symbols, rules, base = re_pair(np.array([5, 6] * 400, np.uint32), min_count=2)
    assert len(symbols) < 10 and rules[0].tolist() == [5, 6] and base == 7


@pytest.mark.parametrize("min_count", [2, 4])
def test_no_frequent_pair_is_left(min_count):
    rng = np.random.default_rng(min_count)
    ids = (rng.zipf(1.3, 60_000) % 3000).astype(np.uint32)
    symbols, rules, base = re_pair(ids, min_count=min_count, per_round=300)
    assert (expand(symbols, rules, base) == ids).all()
    pairs, counts = np.unique(np.stack([symbols[:-1], symbols[1:]]), axis=1, return_counts=True)
    # What is left often enough at all overlaps with itself or with other such pairs.
    often = {tuple(p) for p in pairs[:, counts >= min_count].T.tolist()}
    used, end = dict.fromkeys(often, 0), -1
    for i, p in enumerate(zip(symbols[:-1].tolist(), symbols[1:].tolist())):
        if p in often and i > end:
            used[p] += 1
            end = i + 1
    assert all(n < min_count for n in used.values())
    assert len(symbols) + 2 * len(rules) < 0.9 * len(ids)
