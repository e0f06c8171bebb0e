"""op2, op3 and op8: held-out accuracy on the tables, plain versions of the sums, and odd inputs."""

import collections
import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import language, language_model, quality
from corpusloom.llm.queries import op2_quality, op3_language
from corpusloom.llm.splits import held_out

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@needs_tables
def test_quality_of_held_out_documents(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = op2_quality(spark, SF_DIR).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [r.predicted == labels[r.doc_id] for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and sum(judged) / len(judged) > 0.95


@needs_tables
def test_language_of_held_out_documents(spark):
    known = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    rows = op3_language(spark, SF_DIR).collect()
    judged = [r.lang_pred == known[r.doc_id] for r in rows if r.held_out]
    assert len(rows) == 1000 and len(judged) > 200 and sum(judged) / len(judged) > 0.97


def test_held_out_rows(spark):
    import zlib

    ids = [*range(50), None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id bigint").select("doc_id", held_out(F.col("doc_id")).alias("h")).collect()
    assert {r.doc_id: r.h for r in rows} == {i: zlib.crc32(str(i).encode() if i is not None else b"") % 4 == 2 for i in ids}


def test_neighbours_are_exact():
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["aa", "Bb!", "c1", "dd|"], rng.integers(1, 30))) for _ in range(60)]
    labels = rng.integers(0, 2, 60).tolist()
    model = quality.fit(texts, labels, 8)
    import pyarrow as pa

    from corpusloom.llm.textbytes import text_buffer

    weights = quality.features(*text_buffer(pa.array(texts)))
    got = model.score(weights, 5)
    latent = (weights - model.mean) @ model.projection
    for row, score in zip(latent, got):
        near = sorted(((float(v @ row / np.linalg.norm(row)), y) for v, y in zip(model.vectors, labels)), reverse=True)[:5]
        w = [max(s, 0) ** 4 for s, _ in near]
        assert score == pytest.approx(sum(a * y for a, (_, y) in zip(w, near)) / sum(w), abs=1e-3)


def test_quality_of_odd_rows(docs, odd_rows, spark):
    labels = spark.createDataFrame([(i, i % 2, None) for i, _ in odd_rows if i] + [(999, None, 1), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    rows = quality.classify_held_out(docs(odd_rows), labels).collect()
    assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    empty = {r.score for r in rows if r.doc_id in (7, 8, 9)}
    assert len(empty) <= 2
    bare = quality.classify_held_out(docs(odd_rows), labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in bare} == {(0.5, 0)}
    assert quality.classify_held_out(docs([]), labels).count() == 0
    kept = quality.keep_good(docs(odd_rows), quality.learn(docs(odd_rows), labels))
    good = sum(r.predicted for r in rows)
    assert kept.count() == good and kept.columns == docs([]).columns


def test_language_of_odd_rows(spark):
    schema = "doc_id bigint, text string, lang string, score double, margin int"
    rows = [(i, t, lang, None, 1) for i, (t, lang) in enumerate([
        ("the cat and the dog went to the house " * 9, "en"), ("der Hund und die Katze gehen nach Haus " * 9, "de"), (None, "en"), ("", "de"),
        ("12345 !! ² ½", "en"), ("the dog went to the house and the cat", None), ("die Katze und der Hund gehen nach Haus", None), ("DIE KATZE UND DER HUND", None), ("the cat " * 20_000, None), (None, None),
    ])]
    frame = spark.createDataFrame(rows, schema)
    learned = language.learn_dictionaries(frame)
    assert set(learned) == {"en", "de"}
    found = {r.doc_id: r for r in language.identify(frame, learned).collect()}
    assert [found[i].lang_pred for i in range(10)] == ["en", "de", "und", "und", "und", "en", "de", "de", "en", "und"]
    assert all((r.lang_pred == "und") == (r.score == 0) and 0 <= r.score <= 1 for r in found.values())
    assert {r.lang_pred for r in language.identify(frame, {}).collect()} == {"und"}
    assert {r.lang_pred for r in language.identify(frame, {"en": b""}).collect()} == {"und", "en"}
    assert language.identify_held_out(frame.limit(0)).count() == 0


def test_losses_are_the_interpolated_bigrams(docs, odd_rows):
    rows = [(i, t) for i, t in odd_rows if i != 15]
    good = [(i, t) for i, t in rows if i and i % 3 == 0]
    size = 6
    models = language_model.train(docs(good), docs(rows), vocabulary=size)
    got = language_model.cross_entropy_difference(docs(rows), models).collect()

    def split(t):
        return re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in t or ""))

    known = {tuple(sorted(models.vocabulary.tolist()))}
    assert len(next(iter(known))) == size
    counts = collections.Counter(w for _, t in rows for w in split(t))
    import pyarrow as pa

    from corpusloom.llm.textbytes import text_buffer

    hashes = {w: int(language_model._words(*text_buffer(pa.array([w])))[0][0]) for w in counts}
    chosen = set(sorted(counts, key=lambda w: (-counts[w], hashes[w]))[:size])
    assert {hashes[w] for w in chosen} == set(models.vocabulary.tolist())

    def model(texts):
        pairs, ones, heads = collections.Counter(), collections.Counter(), collections.Counter()
        for _, t in texts:
            before = "<s>"
            for w in split(t):
                w = w if w in chosen else "<unk>"
                pairs[before, w] += 1
                ones[w] += 1
                heads[before] += 1
                before = w
        total = sum(ones.values())

        def loss(before, w):
            one = ones[w] / total
            two = pairs[before, w] / heads[before] if heads[before] else one
            return -math.log(0.7 * two + 0.29 * one + 0.01 / (size + 1))

        return loss

    target, background = model(good), model(rows)
    want = []
    for i, t in rows:
        tokens = [w if w in chosen else "<unk>" for w in split(t)]
        steps = list(zip(["<s>", *tokens], tokens))
        n = max(1, len(steps))
        want.append((repr(i), len(tokens), sum(target(*s) for s in steps) / n, sum(background(*s) for s in steps) / n))
    for g, w in zip(sorted((repr(r.doc_id), r.n_tokens, r.target_loss, r.background_loss, r.score) for r in got), sorted(want)):
        assert g[:2] == w[:2] and g[2:] == pytest.approx((w[2], w[3], w[2] - w[3]), abs=1e-4)


def test_language_models_of_nothing(docs):
    models = language_model.train(docs([]), docs([]))
    rows = language_model.cross_entropy_difference(docs([(1, "a b"), (2, None)]), models).collect()
    assert {(r.doc_id, r.n_tokens, r.score) for r in rows} == {(1, 2, 0.0), (2, 0, 0.0)}
    assert language_model.cross_entropy_difference(docs([]), models).count() == 0


def test_losses_cover_all_words(docs):
    words = [f"w{i}" for i in range(1_600)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:1_200])), (3, " ".join(w for w in words[::-1] for _ in range(2)))]
    good = rows[1:2]
    scored = [(10, "w5 w1100"), (11, "w5 w1500"), (12, "w1198 w1199 w1200"), (13, "w9 never seen"), (14, "w9 seen never w1"), *rows]
    models = language_model.train(docs(good), docs(rows))
    assert models.vocabulary is None and models.size == len(words) + 1
    got = {r.doc_id: r for r in language_model.cross_entropy_difference(docs(scored), models).collect()}

    def model(texts):
        pairs, ones, heads = collections.Counter(), collections.Counter(), collections.Counter()
        for _, t in texts:
            found = t.split()
            pairs.update(zip(["<s>", *found], found))
            ones.update(found)
            heads.update(["<s>", *found[:-1]])
        total = sum(ones.values())

        def loss(before, w):
            one = ones[w] / total
            return -math.log(0.7 * (pairs[before, w] / heads[before] if heads[before] else one) + 0.29 * one + 0.01 / (len(words) + 1))

        return loss

    target, background = model(good), model(rows)
    for i, t in scored:
        found = t.split()
        steps = list(zip(["<s>", *found], found))
        want = [sum(m(*s) for s in steps) / len(steps) for m in (target, background)]
        assert got[i].n_tokens == len(found) and (got[i].target_loss, got[i].background_loss) == pytest.approx(want, abs=1e-9)
    assert got[10].score < got[11].score


@pytest.mark.parametrize("vocabulary", [None, 6])
def test_marked_texts_are_counted_and_answered_at_once(docs, odd_rows, monkeypatch, spark, vocabulary):
    """The models and losses are those of ``train`` over the texts of the ids, with several chunks and many buckets."""
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 500)
    good = [r for r in odd_rows if r[0] and r[0] % 3 == 0]
    assert len({i for i, _ in good}) < len(good) and any(not (t or '').strip() for _, t in good)
    ids = spark.createDataFrame([(i,) for i, _ in good + good[:4]] + [(None,), (5_000,)], "doc_id bigint")
    every = docs(odd_rows)
    plain = language_model.train(docs(good), every, vocabulary)
    for few in (language_model.BROADCAST_MARKS, 0):
        monkeypatch.setattr(language_model, "BROADCAST_MARKS", few)
        marked = language_model.train_marked(every, ids, vocabulary)
        assert (marked.size, marked.totals) == (plain.size, plain.totals)

        def rows(texts, models):
            return sorted(map(tuple, language_model.cross_entropy_difference(texts, models).collect()), key=repr)

        assert rows(every, marked) == rows(every, plain)
    assert rows(docs(odd_rows[:9]), marked) == rows(docs(odd_rows[:9]), plain)


def test_marked_texts_without_words(docs, spark):
    ids = spark.createDataFrame([(1,)], "doc_id bigint")
    for some in ([], [(1, None), (2, " ")]):
        frame = docs(some)
        got = language_model.cross_entropy_difference(frame, language_model.train_marked(frame, ids)).collect()
        assert {(r.doc_id, r.n_tokens, r.score) for r in got} == {(i, 0, 0.0) for i, _ in some}


def test_keys_of_a_chunk_take_less_room():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(2**62, 2**62 + 2**57, 5_000).astype(np.uint64))
    steps = language_model._squeezed(language_model._steps(keys))
    assert len(steps) < 6.3 * len(keys)
    assert (np.cumsum(language_model._restored(steps, len(keys)), dtype=np.uint64) == keys).all()
    counts = np.array([[1, 0, 70_000], [0, 0, 3]])
    assert language_model._restored(language_model._squeezed(counts), 6).reshape(2, 3).tolist() == counts.tolist()
