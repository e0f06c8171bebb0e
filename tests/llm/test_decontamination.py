"""op4: plain copies, other numbers, names and units, inconsistent slots, and texts that only look alike; brute force."""

import math
import random
import re
from collections import defaultdict

import pytest

from corpusloom.llm.decontamination import UNITS, contaminated, decontaminate
from tests.llm.conftest import words

ITEMS = [
    (1, "A train leaves Boston at 7 in the morning and runs 60 km to reach the old mill where Alice waits with 7 apples."),
    (2, "Which of these rivers flows through the largest city in the country and then turns south towards the open sea?"),
    (3, None), (4, "too short"), (5, ""),
]
CHANGED = "A train leaves Denver at 9 in the morning and runs 85 miles to reach the old mill where Bob waits with 9 apples."
BROKEN = "A train leaves Denver at 9 in the morning and runs 85 miles to reach the old mill where Bob waits with 4 apples."


def items(spark):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in ITEMS], "item_id int, text string, doc_id string, h int")


def test_cases(spark, docs):
    rng = random.Random(2)
    noise = words(rng, 200)
    copy = ITEMS[1][1]
    rows = [
        (1, f"{noise} {copy} {noise}"), (2, copy.upper()), (3, CHANGED), (4, noise), (5, None), (6, ""), (None, copy), (7, copy), (7, copy),
        (8, " ".join(copy.split()[:8])), (9, "A train leaves the country."), (10, f"{noise} {CHANGED}"), (11, " ".join(copy.split()[2:17])),
    ]
    found = contaminated(docs(rows), items(spark))
    got = {(r.doc_id, r.item_id): r for r in found.collect()}
    assert set(got) == {(1, 2), (2, 2), (3, 1), (None, 2), (7, 2), (10, 1), (11, 2)}
    assert {k for k, r in got.items() if r.changed_slots} == {(3, 1), (10, 1)} and got[3, 1].changed_slots >= 3
    assert all(r.share == 1 for k, r in got.items() if k[0] not in (11, 10, 3))
    frame = docs(rows)
    left = decontaminate(frame, items(spark))
    assert left.columns == frame.columns
    assert sorted(r.doc_id for r in left.collect()) == [4, 5, 6, 8, 9]


def test_inconsistent_slots_count_only_words(spark, docs):
    got = contaminated(docs([(1, CHANGED), (2, BROKEN)]), items(spark), share=0.0, run=99).collect()
    share = {r.doc_id: r.share for r in got}
    assert share[1] > 0.8 and share[2] < 0.5


def test_empty_tables(spark, docs):
    assert contaminated(docs([]), items(spark)).count() == 0
    assert contaminated(docs([(1, CHANGED)]), items(spark).limit(0)).count() == 0
    assert decontaminate(docs([(1, CHANGED)]), items(spark).limit(0)).count() == 1


QUESTIONS = [
    ("What is 12 plus 7 times 3?", "What is 45 plus 9 times 8?", "What is the name of the 3 rivers?"),
    (
        "Find the mean of the numbers 4, 8, 15, 16, 23 and 42 and round it.",
        "Find the mean of the numbers 5, 9, 11, 13, 77 and 90 and round it.",
        "Find the sum of the numbers 5, 9, 11, 13, 77 and 90 and print it twice.",
    ),
    (
        "Tom buys 3 kg of apples at 4 dollars a kg. Tom pays with a note of 20 dollars. How much does he get back?",
        "Anna buys 5 kg of apples at 2 dollars a kg. Anna pays with a note of 50 dollars. How much does he get back?",
        "Tom sells 3 kg of pears to 4 old friends. Tom walks home with a bag of 20 coins. How far is it to the town?",
    ),
    (
        "Natalia sold clips to 48 of her friends in April, and then she sold half as many clips in May. How many did she sell?",
        "Sonia sold clips to 96 of her friends in June, and then she sold half as many clips in July. How many did she sell?",
        "Natalia met 48 of her friends in April, and then they all went to the sea in May. How many of them could swim?",
    ),
]


@pytest.mark.parametrize("inside", [False, True])
def test_questions_with_other_numbers_and_names(spark, docs, inside):
    rng = random.Random(1)
    noise = (lambda: words(rng, 40) + ". ") if inside else (lambda: "")
    rows = [(10 * i + k, noise() + t + " " + noise()) for i, q in enumerate(QUESTIONS) for k, t in enumerate(q)]
    asked = spark.createDataFrame([(i, q[0]) for i, q in enumerate(QUESTIONS)], "item_id int, text string")
    got = {(r.doc_id, r.item_id): r.changed_slots for r in contaminated(docs(rows), asked).collect()}
    assert set(got) == {(10 * i + k, i) for i in range(len(QUESTIONS)) for k in (0, 1)}
    assert all((n > 0) == (doc % 10 == 1) for (doc, _), n in got.items())


def plain_windows(text, window=5, literals=3, stretch=4):
    """``({place: [(what, slots)]}, total)`` of a text."""
    tokens, values = [], []
    for word in (text or "").split():
        word = re.sub("^[^0-9A-Za-z]+|[^0-9A-Za-z]+$", "", word)
        if not word:
            continue
        kind = word.lower()
        if word[0].isdigit():
            kind = 1
        elif kind in UNITS and tokens and tokens[-1] == 1:
            kind = 3
        elif word[0].isupper() and re.search("[a-z]", word):
            kind = 2
        tokens.append(kind)
        values.append(word.lower())
    out, forms = defaultdict(list), 0
    for i in range(len(tokens)):
        for j in range(i + window, min(len(tokens), i + stretch * window) + 1):
            if sum(isinstance(t, str) for t in tokens[i:j]) >= literals:
                out[i].append((tuple(tokens[i:j]), tuple(v for t, v in zip(tokens[i:j], values[i:j]) if not isinstance(t, str))))
                forms += 1
                break
        if i + window <= len(tokens) and any(not isinstance(t, str) for t in tokens[i : i + window]):
            out[i].append((tuple(values[i : i + window]), ()))
    return out, forms or len(out)


def plain_contaminated(rows, asked, window=5, share=0.8, run=13):
    found = {}
    for doc, text in set(rows):
        here = plain_windows(text)[0]
        for item, question in asked:
            there, total = plain_windows(question)
            aligned = defaultdict(set)
            for at, wants in there.items():
                for pos, has in here.items():
                    for what, slots in wants:
                        aligned[pos - at] |= {(at, tuple(zip(slots, mine))) for other, mine in has if other == what}
            places, longest = set(), 0
            for met in aligned.values():
                pairs = {p for _, ps in met for p in ps}
                steady = len({a for a, _ in pairs}) == len(pairs)
                mine = {at for at, ps in met if steady or not ps}
                places |= mine
                for at in mine:
                    n = next(n for n in range(len(text) + 2) if at + n not in mine)
                    longest = max(longest, n + window - 1)
            part = min(1.0, len(places) / total) if total else 0
            if places and (part >= share or longest >= run):
                found[doc, item] = (round(part, 9), longest)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, docs, seed):
    rng = random.Random(seed)
    vocabulary = "the of and red Tom Ann Paris 3 17 42 kg km days runs sees. where house".split()
    asked = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 7, 12, 30])))) for i in range(12)]
    swap = {"Tom": "Bob", "Ann": "Eve", "3": "8", "17": "99", "kg": "km", "Paris": "Rome"}
    rows = []
    for i in range(60):
        question = rng.choice(asked)[1].split()
        kind = rng.randrange(4)
        if kind == 1:
            question = [swap.get(w, w) for w in question]
        if kind == 2:
            question = [rng.choice(vocabulary) if rng.random() < 0.15 else w for w in question]
        if kind == 3:
            question = " ".join(question).upper().split()
        before, after = ([rng.choice(vocabulary) for _ in range(rng.randrange(12))] for _ in range(2))
        rows.append((i, " ".join(before + question + after)))
    got = contaminated(docs(rows), spark.createDataFrame(asked, "item_id int, text string")).collect()
    assert {(r.doc_id, r.item_id): (round(r.share, 9), r.run) for r in got} == plain_contaminated(rows, asked)


def test_a_common_phrase_opens_no_pairs(spark, docs):
    from corpusloom.llm.decontamination import _candidates, template_windows

    rng = random.Random(7)
    phrase = "please read all of the text below"
    rare = ["".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(2000)]
    asked = [(i, phrase + " " + " ".join(rng.sample(rare, 12))) for i in range(100)]
    rows = [(i, " ".join(rng.sample(rare, 12)) + " " + phrase) for i in range(100)] + [(1000, asked[5][1])]
    frame = spark.createDataFrame(asked, "item_id int, text string")
    items = template_windows(frame.withColumnRenamed("text", "_item"), ["item_id"], "_item")
    texts = docs(rows).selectExpr("doc_id", "xxhash64(text) AS text_hash", "text AS _doc")
    found = template_windows(texts, ["doc_id", "text_hash"], "_doc")
    assert [(r.doc_id, r.item_id) for r in _candidates(found, items, 5, 0.8, 13).collect()] == [(1000, 5)]
    assert [(r.doc_id, r.item_id) for r in contaminated(docs(rows), frame).collect()] == [(1000, 5)]


def test_columns_of_any_name_keep_their_values(spark):
    rows = [(1, CHANGED, 3, "a", "b"), (2, "nothing of the kind", 4, "c", "d"), (None, None, 5, "e", "f")]
    frame = spark.createDataFrame(rows, "bad_id int, bad_text string, c0 int, _row string, h string")
    left = decontaminate(frame, items(spark), id_col="bad_id", text_col="bad_text")
    assert left.columns == frame.columns and sorted(map(tuple, left.collect()), key=str) == sorted(rows[1:], key=str)
