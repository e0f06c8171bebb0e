"""op9 against a dictionary of all windows."""

import hashlib
import random
import re

import pytest

from corpusloom.llm.substrings import repeated_windows
from tests.llm.conftest import words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected(rows, n):
    seen, out = set(), []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        found = WORD.findall(text or "")
        gone = [False] * len(found)
        for i in range(len(found) - n + 1):
            key = tuple(found[i : i + n])
            if key in seen:
                gone[i : i + n] = [True] * n
            seen.add(key)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        out.append((repr(doc_id), len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out)


def got(frame, n, **more):
    rows = repeated_windows(frame, n, with_text=True, **more).collect()
    return sorted((repr(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept) for r in rows)


def test_equals_all_windows(docs, odd_rows):
    assert got(docs(odd_rows), 20) == expected(odd_rows, 20)


@pytest.mark.parametrize("n,levels", [(1, 0), (2, 1), (4, 2), (7, 1), (8, 3)])
def test_other_lengths(docs, n, levels):
    rng = random.Random(n)
    rows = [(i, words(rng, rng.randrange(60), ["a", "b", "cc"])) for i in range(30)] + [(None, "a a a a a a a a a a")]
    assert got(docs(rows), n, levels=levels) == expected(rows, n)


def test_nothing_repeats_and_no_rows(docs):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(30))) for i in range(5)]
    assert got(docs(rows), 20) == expected(rows, 20)
    assert repeated_windows(docs([]), 20).count() == 0
