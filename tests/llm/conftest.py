import random

import pytest

SCHEMA = "doc_id bigint, text string, base string, score double, fingerprint string, _row int"
VOCABULARY = "alpha Beta gamma delta épsilon zeta Êta theta iota kappa 日本 λάμδα".split()


@pytest.fixture
def docs(spark):
    """Rows with clashing extra columns: ``make([(doc_id, text), …])``."""

    def make(rows, parts=3):
        rows = [(i, t, None, None, "x", 1) for i, t in rows]
        frame = spark.createDataFrame(rows, SCHEMA)
        return frame.repartition(parts) if rows else frame

    return make


def words(rng: random.Random, n: int, vocabulary=VOCABULARY) -> str:
    return "".join(rng.choice(vocabulary) + rng.choice([" ", " ", "\n", "\t ", ", "]) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null and empty texts, only spaces, ties, repeated rows, a null id, copies and one very long text."""
    rng = random.Random(5)
    shared = words(rng, 45)
    rows = [
        (7, None), (8, ""), (9, " \n\t "), (10, "one"), (11, "one two"), (None, shared), (12, shared), (12, shared),
        (13, words(rng, 30) + shared + words(rng, 9)), (3, "tail " + shared[5:]), (14, shared.upper()),
        (15, words(rng, 60_000)), (16, "　wide space\x1c\x85 áb İ. ﬁ! <|endoftext|>. <|ENDOFTEXT|> don'. x».\x0b\x00é"),
    ]
    return rows + [(100 + i, words(rng, rng.randrange(80))) for i in range(40)]
