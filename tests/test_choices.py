import datetime
import json
import math
import random

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.operators.choices import shifted_positions

BYTES = cl.TokenizerModel([], special_tokens={"<|endoftext|>": 256})


@pytest.fixture
def items(spark):
    rows = [
        (0, "the cat", ["sat", "ran off", "x", ""], 0),
        (1, "", ["a", "a", "b", "a"], 2),
        (2, "one two", ["three", "four", "five", "six"], 1),
    ]
    return spark.createDataFrame(rows, "item_id bigint, ctx string, endings array<string>, label int")


def test_rendering_and_padding(items):
    rows = {(r["item_id"], r["ending_idx"]): r for r in cl.pad_choices(cl.render_choices(items, BYTES)).collect()}
    assert len(rows) == 12
    row = rows[0, 0]
    assert list(row["tokens"]) == [*b"the cat sat", 0, 0, 0, 0]
    assert list(row["mask"]) == [0] * 7 + [1] * 4 + [0] * 4
    assert row["max_len"] == 15
    checked = cl.pad_choices(cl.render_choices(items, BYTES), max_len=12).collect()
    assert {r["item_id"]: r["fits"] for r in checked} == {0: False, 1: True, 2: False}


def test_special_literals_are_refused(spark):
    bad = spark.createDataFrame(
        [(0, "x <|endoftext|>", ["a"], 0)], "item_id bigint, ctx string, endings array<string>, label int"
    )
    with pytest.raises(Exception, match="special token"):
        cl.render_choices(bad, BYTES).collect()


def test_losses_from_logits(items, spark):
    rng = random.Random(2)
    rendered = cl.pad_choices(cl.render_choices(items, BYTES))
    shapes = rendered.select("item_id", "ending_idx", "tokens", "mask").collect()
    logits, expected = [], {}
    for row in shapes:
        for pos in range(len(row["tokens"])):
            values = [rng.uniform(-30, 30) for _ in range(257)]
            logits.append((row["item_id"], row["ending_idx"], pos, values))
            if pos + 1 < len(row["tokens"]):
                target = row["tokens"][pos + 1]
                expected[row["item_id"], row["ending_idx"], pos] = (
                    math.log(sum(math.exp(v) for v in values)) - values[target]
                )
    table = spark.createDataFrame(logits, "item_id bigint, ending_idx int, pos int, logits array<double>")
    losses = cl.position_losses(table, rendered)
    found = {(r["item_id"], r["ending_idx"], r["pos"]): r["loss"] for r in losses.collect()}
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[key], expected[key], abs_tol=1e-9) for key in expected)
    masks = {(r["item_id"], r["ending_idx"]): r["mask"] for r in shapes}
    for row in cl.choice_scores(losses).collect():
        key = row["item_id"], row["ending_idx"]
        chosen = [expected[(*key, p)] for p in range(len(masks[key]) - 1) if masks[key][p + 1]]
        assert math.isclose(row["sum_loss"], sum(chosen), abs_tol=1e-8)
        if chosen:
            assert math.isclose(row["avg_loss"], sum(chosen) / len(chosen), abs_tol=1e-8)
        else:
            assert row["avg_loss"] is None


def test_predictions_break_ties_by_place_and_skip_missing_means(spark):
    scores = spark.createDataFrame(
        [(0, 0, 5.0, None), (0, 1, 3.0, 2.0), (0, 2, 3.0, 1.0), (0, 3, 4.0, 1.0), (1, 0, 1.0, None), (1, 1, 2.0, None)],
        "item_id bigint, ending_idx int, sum_loss double, avg_loss double",
    )
    found = {r["item_id"]: (r["pred"], r["pred_norm"]) for r in cl.choice_predictions(scores).collect()}
    assert found == {0: (1, 2), 1: (0, 0)}


def test_accuracy_and_ranks(spark):
    preds = spark.createDataFrame(
        [(i, i % 4, (i + i // 3) % 4, i % 4 if i < 6 else 9) for i in range(10)],
        "item_id bigint, pred int, pred_norm int, label int",
    )
    whole = cl.choice_accuracy(preds).first()
    assert (whole["num_total"], whole["num_correct"], whole["acc"]) == (10, 6, 0.6)
    rows = {r["rank"]: r for r in cl.choice_accuracy_by_rank(preds, 3).collect()}
    assert set(rows) == {None, 0, 1, 2}
    for name in ("num_total", "num_correct", "num_correct_norm"):
        assert sum(rows[rank][name] for rank in range(3)) == rows[None][name] == whole[name]
    empty = cl.choice_accuracy(preds.limit(0)).first()
    assert (empty["num_total"], empty["acc"], empty["acc_norm"]) == (0, None, None)


def test_bigram_scores_equal_the_dense_logits(texts, items):
    tokens = cl.tokenize_documents(texts(["the cat sat on the mat", "a cat", ""]), BYTES)
    bigrams = cl.bigram_counts(tokens)
    rendered = cl.pad_choices(cl.render_choices(items, BYTES))
    sparse = cl.bigram_scores(rendered, bigrams, 257)
    at = rendered.select("item_id", "ending_idx", F.posexplode("tokens").alias("pos", "prev"))
    flat = F.array_repeat(F.lit(0.0), 257)
    logits = at.join(cl.bigram_logits(bigrams, 257), "prev", "left").withColumn("logits", F.coalesce("logits", flat))
    dense = cl.position_losses(logits, rendered)
    key = ["item_id", "ending_idx", "pos"]
    both = sparse.join(dense.withColumnRenamed("loss", "other"), key)
    assert both.count() == sparse.count() == dense.count()
    assert both.where(F.abs(F.col("loss") - F.col("other")) > 1e-9).count() == 0
    scores = cl.choice_scores(sparse)
    examples = cl.choice_examples(items, scores, cl.choice_predictions(scores), n=2).collect()
    assert [r["item_id"] for r in examples] == [0, 1]
    assert examples[0]["endings"][0].startswith("0 (loss: ") and examples[0]["endings"][0].endswith(" sat")


def test_validation_loss_is_a_mean_of_batch_means(texts):
    docs = texts(["abcabcabd" * 9, "xyz" * 30])
    tokens = cl.tokenize_documents(docs, BYTES)
    shards = cl.pack_shards(tokens, 1000)
    plan = cl.validation_batches(cl.batch_plan(cl.shard_manifest(shards), 2, 5, 2), 4)
    batches = cl.materialize_batches(shards, plan, 2, 5)
    losses = cl.batch_losses(batches, cl.bigram_counts(tokens), 257)
    row = cl.validation_loss(losses).first()
    assert (row["batches"], row["ranks"]) == (8, 2)
    stream = [t for text in ("abcabcabd" * 9, "xyz" * 30) for t in (256, *text.encode())]
    rows = [[256, *b"abcabcabd" * 9], [256, *b"xyz" * 30]]
    pairs = [pair for r in rows for pair in zip(r, r[1:])]

    def loss(a, b):
        return -math.log((pairs.count((a, b)) + 1) / (sum(p[0] == a for p in pairs) + 257))

    each = []
    for rank in range(2):
        for k in range(4):
            start = (rank + k * 2) * 10
            each.append(sum(loss(a, b) for a, b in zip(stream[start : start + 10], stream[start + 1 : start + 11])) / 10)
    assert math.isclose(row["val_loss"], sum(each) / len(each), abs_tol=1e-9)


def test_step_log(spark):
    second = datetime.datetime(2024, 1, 1)
    rows = [(i // 2, float(i), second + datetime.timedelta(seconds=i), second + datetime.timedelta(seconds=i + 1)) for i in range(4)]
    log = spark.createDataFrame(rows, "step int, loss double, t0 timestamp, t1 timestamp")
    found = {r["step"]: r for r in cl.step_log_report(log, 2, 8, 4, 1).collect()}
    assert found[0]["loss"] == 0.5 and found[0]["elapsed_ms"] == 2000.0 and found[0]["tokens_per_sec"] == 32.0


def test_item_lines_keep_their_number(spark, tmp_path):
    lines = [json.dumps({"ctx": f"c{i}", "label": i % 4, "endings": ["a", "b", "c", "d"], "ind": i}) for i in range(23)]
    (tmp_path / "items_val.jsonl").write_text("\n".join(lines[:11]) + "\n")
    one = cl.read_choice_items(spark, str(tmp_path / "items_{split}.jsonl"), "val").orderBy("item_id").collect()
    assert [(r["item_id"], r["ind"], r["ctx"]) for r in one] == [(i, i, f"c{i}") for i in range(11)]
    folder = tmp_path / "parts"
    folder.mkdir()
    (folder / "part-1.jsonl").write_text("\n".join(lines[2:]) + "\n")
    (folder / "part-0.jsonl").write_text("\n".join(lines[:2]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        many = cl.read_choice_items(spark, str(folder)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r["item_id"], r["ind"]) for r in many) == [(i, i) for i in range(23)]
    (tmp_path / "bad.jsonl").write_text('{"ctx": \n')
    with pytest.raises(Exception):
        cl.read_choice_items(spark, str(tmp_path / "bad.jsonl")).collect()


def test_a_missing_row_of_logits_raises(items, spark):
    rendered = cl.render_choices(items, BYTES)
    at = rendered.select("item_id", "ending_idx", F.posexplode("tokens").alias("pos", "prev"))
    logits = at.select("item_id", "ending_idx", "pos", F.array_repeat(F.lit(0.0), 257).alias("logits"))
    assert cl.position_losses(logits, rendered).count() > 0
    with pytest.raises(Exception, match="no logits"):
        cl.position_losses(logits.where("item_id <> 0 OR pos <> 2"), rendered).collect()


def test_losses_of_batches_from_logits(spark):
    batches = spark.createDataFrame([(0, 0, 0, [1, 2], [2, 0])], "rank int, batch_index bigint, row int, inputs array<int>, targets array<int>")
    logits = spark.createDataFrame(
        [(0, 0, 0, 0, [0.0, 1.0, 2.0]), (0, 0, 0, 1, [3.0, 0.0, 0.0])], "rank int, batch_index bigint, row int, pos int, logits array<double>"
    )
    found = {r["pos"]: r["loss"] for r in cl.batch_position_losses(logits, batches).collect()}
    assert math.isclose(found[0], math.log(1 + math.e + math.e**2) - 2) and math.isclose(found[1], math.log(math.e**3 + 2) - 3)
    with pytest.raises(Exception, match="no logits"):
        cl.batch_position_losses(logits.where("pos = 0"), batches).collect()


def test_counts_of_a_stream_cross_documents_but_not_shards(spark):
    rows = [(0, 0, [1, 2]), (0, 2, [3]), (0, 3, [1, 2]), (1, 0, [9, 9]), (1, 2, [])]
    shards = spark.createDataFrame(rows, "shard int, shard_pos bigint, tokens array<int>")
    found = {(r["prev"], r["next"]): r["n"] for r in cl.stream_bigram_counts(shards).collect()}
    assert found == {(1, 2): 2, (2, 3): 1, (3, 1): 1, (9, 9): 1}


def test_dense_logits(spark):
    counts = spark.createDataFrame([(5, 0, 3), (5, 4, 1), (6, 7, 2), (6, 9, 8)], "prev int, next int, n bigint")
    found = {r["prev"]: list(r["logits"]) for r in cl.bigram_logits(counts, 8).collect()}
    want = {5: [math.log(4), 0, 0, 0, math.log(2), 0, 0, 0], 6: [0] * 7 + [math.log(3)]}
    assert found.keys() == want.keys()
    assert all(math.isclose(a, b, abs_tol=1e-12) for prev in want for a, b in zip(found[prev], want[prev], strict=True))


def test_logits_in_slices_equal_dense_logits(items, spark):
    rng = random.Random(2)
    rendered = cl.pad_choices(cl.render_choices(items, BYTES))
    at = shifted_positions(rendered)
    rows = [(r["item_id"], r["ending_idx"], r["pos"], r["target"], [rng.uniform(-900, 900) for _ in range(257)]) for r in at.collect()]
    dense = spark.createDataFrame(rows, "item_id bigint, ending_idx int, pos int, target int, logits array<double>")
    cut = F.explode(F.array(*(F.struct(F.lit(a).alias("first_id"), F.slice("logits", a + 1, n).alias("part")) for a, n in ((0, 5), (5, 250), (255, 2), (257, 3)))))
    slices = dense.select("item_id", "ending_idx", "pos", "target", cut.alias("c")).select("*", "c.first_id", F.col("c.part").alias("logits")).drop("c")
    key = ["item_id", "ending_idx", "pos"]
    both = cl.sliced_position_losses(slices, rendered).join(cl.position_losses(dense, rendered).withColumnRenamed("loss", "other"), key).collect()
    assert len(both) == len(rows) and all(math.isclose(r["loss"], r["other"], rel_tol=1e-9, abs_tol=1e-9) for r in both)
    with pytest.raises(Exception, match="no logit"):
        cl.sliced_position_losses(slices.where("first_id <> 5"), rendered).collect()
    with pytest.raises(Exception, match="several logits"):
        cl.sliced_position_losses(slices.union(slices), rendered).collect()


def test_slices_of_impossible_tokens(spark):
    inf = float("-inf")
    rows = [(0, 1, 0, [1.0, 2.0]), (0, 1, 2, [inf, inf]), (0, 1, 4, []), (1, 0, 0, [0.0])]
    slices = spark.createDataFrame(rows, "k int, target int, first_id int, logits array<double>")
    found = {r["k"]: r["loss"] for r in cl.sliced_losses(slices, ["k"]).collect()}
    assert math.isclose(found[0], math.log(math.e + math.e**2) - 2) and found[1] == 0
