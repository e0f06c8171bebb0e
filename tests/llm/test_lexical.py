"""Ranked lexical search against all documents scored for all items."""

import math
import random
import re

import pytest

from corpusloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, top=10):
    bags = [(i, terms(t)) for i, t in rows]
    documents, total = sum(1 for _, b in bags if b), sum(len(b) for _, b in bags)
    df = {}
    for _, b in bags:
        for t in set(b):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for i, b in bags:
            score = 0
            for t in terms(text):
                if t in b:
                    m = 100 - 75 + (75 * len(b) * documents) // total
                    w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * b.count(t)) // (1000 * b.count(t) + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, rank, i, -score) for rank, (score, _, _, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.fixture
def items(spark):
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "item_id bigint, text string, doc_id string, score int")

    return make


def corpus(rng, n=300):
    vocabulary = [f"w{k}" for k in range(60)] + ["ärger", "日本", "İx", "A9"]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(25)))) for i in range(n)]
    # a third of all rows are the same text but for words of no item, and as long
    rows += [(1000 + i, f"w1 w2 w3 none{i}") for i in range(150)]
    return rows


def test_equals_brute_force(docs, items, odd_rows):
    rng = random.Random(2)
    rows = odd_rows + corpus(rng)
    asked = [(k, " ".join(t for t in (rows[rng.randrange(len(rows))][1] or "").split()[:12])) for k in range(25)]
    asked += [(50, None), (51, ""), (52, "w1 W1 w1, none7"), (52, "w1 w2"), (53, "nowhere at all"), (54, "日本-ärger ÄRGER")]
    assert found(lexical.lexical_search(docs(rows, 7), items(asked))) == brute(rows, asked)


def test_blocks_of_items_change_nothing(docs, items, monkeypatch):
    rng = random.Random(3)
    rows = corpus(rng, 80)
    asked = [(k, " ".join(f"w{rng.randrange(60)}" for _ in range(6))) for k in range(12)]
    monkeypatch.setattr(lexical, "ITEM_BYTES", 60)
    monkeypatch.setattr(lexical, "CELLS", 40)
    monkeypatch.setattr(lexical, "PAIRS", 30)
    assert found(lexical.lexical_search(docs(rows), items(asked), top=3)) == brute(rows, asked, 3)


def test_classes_hold_the_smallest_ids_of_all_copies(spark, docs):
    block = lexical.ItemTerms([1], ["w1 w2"])
    bags = lexical._bags(docs([(i, f"w1 other{i}") for i in range(40)] + [(99, "w2"), (98, "none")], 5).select("doc_id", "text"), block)
    rows = lexical.bag_classes(bags, 42, 82, 10).collect()
    members = sorted([m.doc_id for m in r.members] for r in rows)
    assert members == [list(range(10)), [99]]


def test_empty_tables(docs, items):
    assert found(lexical.lexical_search(docs([]), items([(1, "w1")]))) == []
    assert found(lexical.lexical_search(docs([(1, "w1")]), items([]))) == []
    assert found(lexical.lexical_search(docs([(1, None), (2, "...")]), items([(1, "w1")]))) == []
