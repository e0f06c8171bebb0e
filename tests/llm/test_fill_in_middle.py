"""Fill-in-the-middle against a plain statement, and the boundary set against a sorted list."""

import hashlib
import random
import re

import numpy as np
import pytest

from corpusloom.llm import fill_in_middle as fim

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def plain(doc_id, text):
    text = text or ""
    tokens = TOKEN.findall(text)
    n = len(tokens)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digest_equals_plain_statement(docs, odd_rows):
    rng = random.Random(4)
    marks = [(500 + i, "".join(rng.choice(["<", "P", ">", "S", "M", "<P>", "a b", "\n", "日"]) for _ in range(rng.randrange(9)))) for i in range(150)]
    rows = odd_rows + marks
    found = sorted(map(repr, (tuple(r) for r in fim.fim_digest(docs(rows)).collect())))
    expected = []
    for i, text in rows:
        n, form, prefix, middle, output = plain(i, text)
        expected.append((i, n, form, prefix, middle, sha(output), sha(text or "")))
    assert found == sorted(map(repr, expected))
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}


def test_outputs_and_other_marks(spark, docs):
    marks = fim.Marks("[pre]", "{suf}", "(mid)")
    rows = [(i, f"some {i} [pr {{s words<P>") for i in range(60)]
    found = fim.fill_in_middle(docs(rows), seed=9, fim_percent=100, spm_percent=50, marks=marks)
    out = found.select("doc_id", "form", "output", fim.restored(found.output, found.form, marks).alias("back")).collect()
    texts = dict(rows)
    assert all(r.back == texts[r.doc_id] for r in out) and {r.form for r in out} == {"psm", "spm"}
    assert all(r.output.startswith("[pre]" if r.form == "psm" else "{suf}") for r in out)


def test_no_rows(docs):
    assert fim.fim_digest(docs([])).collect() == []


def test_marks_that_could_run_into_each_other_are_refused():
    for bad in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("<P<", "S", "M"), ("ab", "bc", "d")):
        with pytest.raises(ValueError):
            fim.Marks(*bad)


@pytest.mark.parametrize("fill", [0.0005, 0.3, 0.97, 1.0])
def test_boundary_set_selects_like_a_list(fill):
    rng = np.random.default_rng(7)
    mask = rng.random(3 * fim.CONTAINER + 77) < fill
    mask[fim.CONTAINER : 2 * fim.CONTAINER] = False
    places = np.flatnonzero(mask)
    chosen = fim.BoundarySet(mask)
    assert len(chosen) == len(places)
    for k in [0, len(places) - 1, *rng.integers(0, len(places), 300).tolist()]:
        assert chosen.select(k) == places[k]
    for k in (-1, len(places)):
        with pytest.raises(IndexError):
            chosen.select(k)


def test_containers_are_the_smallest():
    kinds = {
        fim.ArrayContainer: np.arange(fim.CONTAINER) % 100 == 0,
        fim.BitmapContainer: np.arange(fim.CONTAINER) % 3 == 0,
        fim.RunContainer: np.arange(fim.CONTAINER) % 30_000 > 5,
    }
    for kind, mask in kinds.items():
        assert [type(c) for c in fim.BoundarySet(mask).containers] == [kind]
    assert len(fim.BoundarySet(np.zeros(0, bool))) == 0
