"""op6 against all pairs of fingerprints."""

import random
import re

import pytest
import xxhash

from corpusloom.llm.components import connected_components
from corpusloom.llm.simhash import keep_one, near_duplicates, near_links

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fingerprint(text, n=3):
    found = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(found[i : i + n]) for i in range(max(1, len(found) - n + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def groups(items, linked):
    root = {i: i for i in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in items:
        for b in items:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {i: find(i) for i in items}


def test_equals_all_pairs(docs, odd_rows):
    rows = near_duplicates(docs(odd_rows)).collect()
    prints = {(i, t): fingerprint(t) for i, t in odd_rows}
    of = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for (i, t), p in prints.items():
        if i is not None:
            least[of[p]] = min(least.get(of[p], i), i)
    expected = sorted((repr(i), f"{prints[i, t]:016x}", least.get(of[prints[i, t]])) for i, t in odd_rows)
    assert sorted((repr(r.doc_id), r.fingerprint, r.component_id) for r in rows) == expected
    assert len({r.component_id for r in rows if r.doc_id in (None, 12)}) == 1


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_links_join_the_same_groups_as_all_pairs(spark, radius):
    rng = random.Random(radius)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    values = set(seeds)
    while len(values) < 150:
        p = rng.choice(sorted(values))
        for _ in range(rng.randrange(1, 5)):
            p ^= 1 << rng.randrange(64)
        values.add(p)
    values = sorted(p - (1 << 63) for p in values)
    frame = spark.createDataFrame([(p,) for p in values] * 2 + [(None,)], "fingerprint bigint")
    links = near_links(frame, radius)
    assert all(((r.a + (1 << 63)) ^ (r.b + (1 << 63))).bit_count() <= radius for r in links.collect())
    got = {r.node: r.root for r in connected_components(links).collect()}
    want = groups(values, lambda a, b: ((a + (1 << 63)) ^ (b + (1 << 63))).bit_count() <= radius)
    assert {p: got.get(p, p) for p in values} == want


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (None, 4), (2000, 2001)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a int, b int")).collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(300)} | {2000: 2000, 2001: 2000}


def test_one_of_each_group_stays(docs, odd_rows):
    frame = docs(odd_rows)
    kept = keep_one(frame)
    assert kept.columns == frame.columns
    rows = kept.collect()
    prints = [fingerprint(r.text) for r in rows]
    assert all((a ^ b).bit_count() > 2 for i, a in enumerate(prints) for b in prints[:i])
    of = groups(sorted({fingerprint(t) for _, t in odd_rows}), lambda a, b: (a ^ b).bit_count() <= 2)
    assert len(rows) == len(set(of.values())) and None not in {r.doc_id for r in rows}


def test_empty_table(docs):
    assert near_duplicates(docs([])).count() == 0 and keep_one(docs([])).count() == 0
