import random

import pytest
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.plans.offsets import running_offset, slice_bounds
from tests import plain

BYTES = cl.TokenizerModel([], special_tokens={"<|endoftext|>": 256})


def stream_of(shards):
    rows = shards.orderBy("shard", "shard_pos").collect()
    out = {}
    for row in rows:
        ids = out.setdefault((row["split"], row["shard"]), [])
        assert len(ids) == row["shard_pos"]
        ids.extend(row["tokens"])
    return out


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_shards_are_the_stream_in_pieces(texts, size):
    rng = random.Random(size)
    values = ["".join(rng.choice("abé") for _ in range(rng.choice([0, 3, 40]))) for _ in range(25)]
    stream = [token for value in values for token in (256, *value.encode())]
    shards = cl.pack_shards(cl.tokenize_documents(texts(values), BYTES), size, slices=rng.randint(1, 9))
    expected = {
        ("train" if i else "valid", i): stream[i * size : (i + 1) * size] for i in range(-(-len(stream) // size))
    }
    assert stream_of(shards) == expected
    manifest = cl.shard_manifest(shards, "set").orderBy("shard").collect()
    assert [row["n_tokens"] for row in manifest] == [len(ids) for ids in expected.values()]
    assert manifest[0]["name"] == "set_valid_000000"
    plan = cl.plan_shards(cl.shard_manifest(shards), None, size).first()
    assert (plan["planned"], plan["found"]) == (len(stream) // size, len(expected))


@pytest.mark.parametrize("slices", [None, 1, 5, 60])
def test_running_offsets(spark, slices):
    rng = random.Random(4)
    keys = rng.sample(range(10**12), 200) + list(range(50))
    amounts = {key: rng.randint(0, 9) for key in keys}
    df = spark.createDataFrame(list(amounts.items()), "k bigint, a int").repartition(7)
    found = {r["k"]: r["offset"] for r in running_offset(df, "k", F.col("a"), slices=slices).collect()}
    total, expected = 0, {}
    for key in sorted(amounts):
        expected[key] = total
        total += amounts[key]
    assert found == expected


def test_bad_ids_and_null_texts_raise(texts, spark):
    tokens = spark.createDataFrame([(1, [0, 70_000, -1]), (2, [5])], "doc_id bigint, tokens array<int>")
    assert [(r["doc_id"], list(r["bad_ids"])) for r in cl.invalid_token_ids(tokens).collect()] == [(1, [70_000, -1])]
    with pytest.raises(Exception, match="outside"):
        cl.validate_token_ids(tokens).collect()
    assert cl.validate_token_ids(tokens, 1 << 20).where("doc_id = 2").count() == 1
    with pytest.raises(Exception, match="null text"):
        cl.tokenize_documents(texts(["a", None]), BYTES).collect()


def test_shards_on_disk(texts, spark, tmp_path):
    shards = cl.pack_shards(cl.tokenize_documents(texts(["abc", "defgh", "ij"]), BYTES), 5)
    cl.write_token_shards(shards, str(tmp_path / "s"))
    valid = cl.read_token_shards(spark, str(tmp_path / "s"), "valid")
    train = cl.read_token_shards(spark, str(tmp_path / "s"), "train")
    assert stream_of(valid.unionByName(train)) == stream_of(shards)
    assert [r["shard"] for r in cl.shard_list(train).collect()] == [1, 2]
    with pytest.raises(ValueError):
        cl.read_token_shards(spark, str(tmp_path / "s"), "test")
    cl.write_token_shards(cl.pack_shards(cl.tokenize_documents(texts(["abc"]), BYTES), 50), str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        cl.read_token_shards(spark, str(tmp_path / "t"), "train")


@pytest.mark.parametrize("seed", range(4))
def test_batches_follow_the_loader(spark, seed):
    rng = random.Random(seed)
    batch, length, world = rng.randint(1, 3), rng.randint(1, 6), rng.randint(1, 3)
    least = batch * length * world + 1
    sizes = [least + rng.choice([0, 1, batch * length, rng.randint(0, 200)]) for _ in range(4)]
    pieces, tokens = [], []
    for shard, size in enumerate(sizes):
        ids = [rng.randrange(1000) for _ in range(size)]
        tokens.append(ids)
        at = 0
        while at < size:
            step = rng.randint(1, 30)
            pieces.append((shard, at, ids[at : at + step]))
            at += step
    shards = spark.createDataFrame(pieces, "shard int, shard_pos bigint, tokens array<int>").repartition(3)
    manifest = spark.createDataFrame(list(enumerate(sizes)), "shard int, n_tokens bigint")
    plan = cl.batch_plan(manifest, batch, length, world)
    steps = 2 * plan.count() + 3
    runs = cl.epochs(plan, steps)
    found = {}
    for row in runs.orderBy("rank", "batch_index").collect():
        found.setdefault(row["rank"], []).append((row["shard"], row["start"]))
    assert found == {rank: plain.loader(sizes, batch, length, world, rank, steps) for rank in range(world)}
    rows = cl.materialize_batches(shards, runs, batch, length).collect()
    assert len(rows) == steps * world * batch
    for row in rows:
        shard, start = found[row["rank"]][row["batch_index"]]
        begin = start + row["row"] * length
        assert list(row["inputs"]) == tokens[shard][begin : begin + length]
        assert list(row["targets"]) == tokens[shard][begin + 1 : begin + length + 1]
    first = cl.validation_batches(plan, 2).collect()
    assert sorted((r["rank"], r["batch_index"]) for r in first) == [(r, i) for r in range(world) for i in range(2)]


def test_short_shards_and_uneven_steps_are_refused(spark):
    manifest = spark.createDataFrame([(0, 8)], "shard int, n_tokens bigint")
    with pytest.raises(Exception, match="shorter"):
        cl.batch_plan(manifest, 2, 4, 1).collect()
    longer = spark.createDataFrame([(0, 9)], "shard int, n_tokens bigint")
    assert [(r["batch_index"], r["start"]) for r in cl.batch_plan(longer, 2, 4, 1).collect()] == [(0, 0)]
    with pytest.raises(ValueError):
        cl.step_plan(cl.batch_plan(longer, 2, 4, 1), 20, 2, 4, 1)
    steps = cl.step_plan(cl.batch_plan(longer, 2, 4, 1), 16, 2, 4, 1).collect()
    assert [(r["step"], r["micro_batches"], r["full"]) for r in steps] == [(0, 1, False)]


@pytest.mark.parametrize("key", [None, 1])
def test_null_and_repeated_keys_are_refused(spark, key):
    rows = [(0, [1, 2]), (1, [3]), (key, [4, 5]), (2, [6])]
    tokens = spark.createDataFrame(rows, "doc_id bigint, tokens array<int>").repartition(3)
    for job in (lambda: cl.pack_shards(tokens, 3), lambda: cl.token_offsets(tokens)):
        with pytest.raises(Exception, match="null or repeated"):
            job().collect()


def test_crowded_keys_still_give_slices(spark):
    keys = [*range(3000), 10**15, 2 * 10**15]
    df = spark.createDataFrame([(k, 1) for k in keys], "k bigint, a int")
    bounds = slice_bounds(df, "k", 10)
    assert 8 <= len(bounds) <= 12
    found = {r["k"]: r["offset"] for r in running_offset(df, "k", F.col("a"), slices=10).collect()}
    assert found == {k: i for i, k in enumerate(keys)}


def test_rows_missing_from_the_shards_raise(spark):
    shards = spark.createDataFrame([(0, 0, list(range(9)))], "shard int, shard_pos bigint, tokens array<int>")
    plan = spark.createDataFrame([(0, 0, 0, 0), (0, 1, 0, 4)], "rank int, batch_index bigint, shard int, start bigint")
    assert cl.materialize_batches(shards, plan, 1, 4).count() == 2
    for start, shard in ((8, 0), (0, 1)):
        more = plan.union(spark.createDataFrame([(0, 2, shard, start)], plan.schema))
        with pytest.raises(Exception, match="not in the shards"):
            cl.materialize_batches(shards, more, 1, 4).collect()


@pytest.mark.parametrize("every,steps", [(1, 5), (3, 7), (20, 45), (9, 9), (50, 10)])
def test_restarts_go_back_to_the_first_batch(spark, every, steps):
    sizes = [20, 33, 17]
    plan = cl.batch_plan(spark.createDataFrame(list(enumerate(sizes)), "shard int, n_tokens bigint"), 2, 3, 2)
    found = {}
    for row in cl.epochs(plan, steps, every).orderBy("rank", "batch_index").collect():
        found.setdefault(row["rank"], []).append((row["shard"], row["start"]))
    want = {rank: (plain.loader(sizes, 2, 3, 2, rank, every) * steps)[:steps] for rank in range(2)}
    assert found == want
