"""The registered queries: one per operator, over the whole tables of a folder."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import corpusloom as cl
from corpusloom.functions.idstrings import byte_string, ids_of, string_array
from corpusloom.functions.packed import id_digest
from corpusloom.operators.choices import shifted_positions
from corpusloom.operators.packing import END_OF_TEXT, has_packed_tokens, shard_name, unpacked_tokens
from corpusloom.operators.pretokens import order_stride
from corpusloom.session import scratch_path, stage_table
from corpusloom.sources.corpus import dealt_by, spread

# Parameters shared with the SQL side.
TRAINED_ROUNDS = 12
TEXT_ROUNDS = 4
LONG_ROUNDS = 100
STOPPING_ROUNDS = 30
SPARSE_STEP, SPARSE_SHIFT = 1_000_000_007_000, 1 << 50
COMMON_PAIRS = 256
PAIRED_MERGES = 64
CUSTOM_PATTERN = r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+"
MERGED_PAIR = (116, 104, 256)
SHARD_SIZE = 100_000
SMALL_SHARD_SIZE = 20_000
BATCH, SEQ, WORLD = 2, 64, 3
STEPS_PER_RANK = 8_000
RESTART_EVERY, RESTARTED_STEPS = 700, 2_000
STEP_TOKENS = BATCH * SEQ * WORLD * 4
VALIDATION_BATCHES = 20
BYTE_EOT = 256
BYTE_VOCAB = 257
VOCAB_SLICE = 100
LITERALS = {END_OF_TEXT: 50_256, "License": 50_257, "http": 50_258, "the ": 50_259}
DIGITS = 6
# Ids below this have their codes in a constant array.
CODED_IDS = 4_096

Query = Callable[[SparkSession, str], DataFrame]


# Inputs


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = cl.read_corpus(spark, sf_dir, ["documents.parquet"], columns=["doc_id", "text", "lang"])
    return spread(docs)


def byte_model() -> cl.TokenizerModel:
    return cl.TokenizerModel(merges=[], special_tokens={END_OF_TEXT: BYTE_EOT})


_trained: dict[tuple, cl.TokenizerModel] = {}


def trained_model(spark: SparkSession, sf_dir: str) -> cl.TokenizerModel:
    """The tokenizer of this folder's documents, used by many queries: trained once for each version of the files."""
    files = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        "_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time"
    )
    key = (spark.sparkContext.applicationId, *sorted(map(tuple, files.distinct().collect())))
    if key not in _trained:
        model = cl.train_bpe(documents(spark, sf_dir), 256 + TRAINED_ROUNDS, cl.GPT4PAT)
        model.add_special_tokens({END_OF_TEXT: model.vocab_size})
        _trained[key] = model
    return _trained[key]


def large_model(
    spark: SparkSession, sf_dir: str, pattern: str | None, common: int = COMMON_PAIRS, paired: int = PAIRED_MERGES
) -> cl.TokenizerModel:
    """A long list of merges: the most frequent byte pairs, then each two neighbours among these merges."""
    pairs = cl.pair_counts(cl.byte_sequences(documents(spark, sf_dir)))
    first = pairs.orderBy(F.desc("cnt"), "first_key").limit(common).collect()
    merges = [(row["left"], row["right"], 256 + rank) for rank, row in enumerate(first)]
    merges += [(256 + i, 257 + i, 256 + len(first) + i) for i in range(min(paired, len(first) - 1))]
    return cl.TokenizerModel(merges, pattern)


def choice_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items from the benchmark texts: the first half of the words is the context, the true ending the second half."""
    texts = spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumn("words", F.split("text", " "))
    half = F.floor(F.size("words") / 2).cast("int")
    n = texts.count()
    halves = texts.select(
        "item_id",
        (F.col("item_id") % 4).cast("int").alias("label"),
        F.array_join(F.slice("words", 1, half), " ").alias("ctx"),
        F.array_join(F.slice("words", half + 1, F.size("words") - half), " ").alias("ending"),
    )
    asked = halves.select(
        "item_id", "label", "ctx", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("j")
    ).withColumn("from_id", (F.col("item_id") + (F.col("j") - F.col("label") + 4) % 4) % F.lit(n))
    given = halves.select(F.col("item_id").alias("from_id"), "ending")
    return (
        asked.join(given, "from_id")
        .groupBy("item_id", "label", "ctx")
        .agg(F.sort_array(F.collect_list(F.struct("j", "ending"))).alias("parts"))
        .select("item_id", "ctx", "label", F.transform("parts", lambda p: p["ending"]).alias("endings"))
    )


def byte_tokens_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged, as packing and counting read it more than once; packed, as no step before the digests looks at a token."""
    return stage_table(cl.tokenize_documents(documents(spark, sf_dir), byte_model(), packed=True), "tokens")


def byte_shards(spark: SparkSession, sf_dir: str, size: int = SHARD_SIZE) -> DataFrame:
    return cl.pack_shards(byte_tokens_of(spark, sf_dir), size)


def byte_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.shard_manifest(byte_shards(spark, sf_dir))


def plan_of(manifest: DataFrame, split: str) -> DataFrame:
    return cl.batch_plan(manifest.where(F.col("split") == split), BATCH, SEQ, WORLD)


def byte_plan(spark: SparkSession, sf_dir: str, split: str) -> DataFrame:
    return plan_of(byte_manifest(spark, sf_dir), split)


def byte_rendered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.pad_choices(cl.render_choices(choice_items(spark, sf_dir), byte_model()))


def train_bigrams(shards: DataFrame) -> DataFrame:
    return cl.stream_bigram_counts(unpacked_tokens(shards.where(F.col("split") == "train")))


def byte_bigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged, as losses use the counts twice; the corpus is packed once."""
    return stage_table(train_bigrams(stage_table(byte_shards(spark, sf_dir), "shards")), "bigrams")


def bigram_position_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cl.bigram_scores(byte_rendered(spark, sf_dir), byte_bigrams(spark, sf_dir), BYTE_VOCAB)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = cl.choice_scores(bigram_position_losses(spark, sf_dir))
    labels = choice_items(spark, sf_dir).select("item_id", "label")
    return cl.choice_predictions(scores).join(labels, "item_id")


# Output forms that compare well


def codes(ids: Column) -> Column:
    """Ids as fixed-width hexadecimal codes, the form the SQL side works in."""
    known = string_array(f"{t:04x}|" for t in range(CODED_IDS))

    def code(t: Column) -> Column:
        return F.coalesce(F.get(known, t), F.concat(F.lpad(F.lower(F.hex(t)), 4, "0"), F.lit("|")))

    return F.array_join(F.transform(ids, code), "")


def digest(df: DataFrame, *keys: str) -> DataFrame:
    """Number of ids and MD5 of their codes; packed ids are unpacked for it."""
    df = unpacked_tokens(df) if has_packed_tokens(df) else df
    found = df.select(*keys, id_digest(F.col("tokens")).alias("_digest"))
    return found.select(*keys, "_digest.n_tokens", "_digest.digest")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, DIGITS) for name in names})


# Queries


def q_read_corpus(spark, sf_dir):
    docs = cl.read_corpus(spark, sf_dir, ["documents.parquet"], columns=["doc_id", "text"])
    return docs.select("doc_id", F.octet_length("text").alias("n_bytes"))


def q_read_corpus_lang(spark, sf_dir):
    docs = cl.read_corpus(spark, sf_dir, ["documents.parquet"], lang=["fr", "es"], columns=["doc_id", "lang"])
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("last_doc"))


def q_read_corpus_lists(spark, sf_dir):
    """A dump with a list of part files for each language: three parts of the most frequent one, two of the others."""
    path = scratch_path(spark, "dump")
    docs = documents(spark, sf_dir)
    langs = [row["lang"] for row in docs.where("lang IS NOT NULL").groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()]
    lists = {}
    for rank, lang in enumerate(langs):
        n = 2 if rank else 3
        lists[lang] = [f"{part}.parquet" for part in range(n)]
        for part in range(n):
            chosen = docs.where((F.col("lang") == lang) & (F.pmod("doc_id", F.lit(n)) == part)).select("doc_id", "text")
            chosen.write.parquet(f"{path}/data/one/{lang}/{part}.parquet")
    read = cl.read_corpus(spark, path, lists, dump="one")
    return read.select("doc_id", "lang", F.octet_length("text").alias("n_bytes"))


def q_corpus_order(spark, sf_dir):
    docs = cl.with_corpus_order(cl.read_corpus(spark, sf_dir, ["documents.parquet"]))
    return docs.select("doc_id", "doc_ord")


def q_read_choice_items(spark, sf_dir):
    path = scratch_path(spark, "items")
    # Lines in item order, so that the line number is the item.
    (
        choice_items(spark, sf_dir)
        .orderBy("item_id")
        .select(F.to_json(F.struct("ctx", "label", "endings")).alias("value"))
        .write.text(path)
    )
    read = cl.read_choice_items(spark, path)
    return read.select("item_id", "ctx", "label", F.array_join("endings", " ## ").alias("endings"))


def q_byte_tokens(spark, sf_dir):
    docs = documents(spark, sf_dir)
    return digest(docs.select("doc_id", cl.byte_tokens(F.col("text")).alias("tokens")), "doc_id")


def _split_digest(spark, sf_dir, pattern):
    pieces = cl.pretokenize(F.col("text"), pattern)
    return documents(spark, sf_dir).select(
        "doc_id", F.size(pieces).alias("n_pieces"), F.md5(F.array_join(pieces, "␟")).alias("digest")
    )


def q_pretokenize_gpt2(spark, sf_dir):
    return _split_digest(spark, sf_dir, cl.GPT2PAT)


def q_pretokenize_gpt4(spark, sf_dir):
    return _split_digest(spark, sf_dir, cl.GPT4PAT)


def q_pretokenize_custom(spark, sf_dir):
    return _split_digest(spark, sf_dir, CUSTOM_PATTERN)


def q_split_pretokens(spark, sf_dir):
    docs = cl.read_corpus(spark, sf_dir, ["documents.parquet"], columns=["doc_id", "text"])
    rows = cl.split_pretokens(dealt_by(docs, "doc_id"), CUSTOM_PATTERN)
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("split_idx").alias("last_idx"),
        F.md5(
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split_idx", "pretoken"))), lambda r: r["pretoken"]), "␟")
        ).alias("digest"),
    )


def q_pretoken_counts(spark, sf_dir):
    docs = documents(spark, sf_dir)
    stride = F.lit(order_stride(docs, "doc_id"))
    return cl.pretoken_counts(docs, cl.GPT4PAT).select(
        "pretoken",
        "n",
        F.floor(F.col("first_key") / stride).alias("first_doc"),
        (F.col("first_key") % stride).alias("first_idx"),
    )


def _byte_pairs(spark, sf_dir):
    docs = documents(spark, sf_dir)
    stride = F.lit(order_stride(docs, "doc_id"))
    return cl.pair_counts(cl.byte_sequences(docs)), stride


def _placed(pairs, stride):
    return pairs.select(
        "left",
        "right",
        "cnt",
        F.floor(F.col("first_key") / stride).alias("first_doc"),
        (F.col("first_key") % stride).alias("first_pos"),
    )


def q_pair_counts(spark, sf_dir):
    return _placed(*_byte_pairs(spark, sf_dir))


def q_top_pair(spark, sf_dir):
    pairs, stride = _byte_pairs(spark, sf_dir)
    return _placed(cl.top_pair(pairs), stride)


def q_merge_pair(spark, sf_dir):
    merged = cl.merge_pair(byte_string(F.col("text")), *MERGED_PAIR)
    return digest(documents(spark, sf_dir).select("doc_id", ids_of(merged).alias("tokens")), "doc_id")


def q_train_bpe_text(spark, sf_dir):
    return cl.train_bpe(documents(spark, sf_dir), 256 + TEXT_ROUNDS).trace_table(spark)


def q_train_bpe_pretoken(spark, sf_dir):
    return cl.train_bpe(documents(spark, sf_dir), 256 + TRAINED_ROUNDS, cl.GPT4PAT).merges_table(spark)


def q_train_bpe_long(spark, sf_dir):
    """Enough merges for several rewrites of the sequences."""
    return cl.train_bpe(documents(spark, sf_dir), 256 + LONG_ROUNDS, cl.GPT4PAT).trace_table(spark)


def q_train_bpe_stops(spark, sf_dir):
    """Training over the sources of all documents ends when no pair occurs twice, long before the rounds asked for."""
    sources = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.col("source").alias("text"))
    return cl.train_bpe(sources, 256 + 2 * STOPPING_ROUNDS).trace_table(spark)


def q_train_bpe_sparse_ids(spark, sf_dir):
    """Order ids that are negative and far apart, as hashes are, give the same merges."""
    far = (F.col("doc_id") * SPARSE_STEP - SPARSE_SHIFT).alias("doc_id")
    docs = documents(spark, sf_dir).select(far, "text")
    return cl.train_bpe(docs, 256 + TRAINED_ROUNDS, cl.GPT4PAT).trace_table(spark)


def q_merge_trace(spark, sf_dir):
    return trained_model(spark, sf_dir).trace_table(spark)


def q_merges_pretty(spark, sf_dir):
    return cl.merges_pretty(spark, trained_model(spark, sf_dir))


def q_build_vocab(spark, sf_dir):
    vocab = trained_model(spark, sf_dir).vocab_table(spark)
    return vocab.select("token_id", F.lower(F.hex("bytes")).alias("bytes"))


def q_vocab_size(spark, sf_dir):
    return trained_model(spark, sf_dir).vocab_table(spark).agg(F.count(F.lit(1)).alias("vocab_size"))


def q_vocab_report(spark, sf_dir):
    return cl.vocab_report(spark, trained_model(spark, sf_dir))


def q_render_token(spark, sf_dir):
    """Rendering of every text: line breaks and other control characters become escapes."""
    shown = cl.render_token(F.col("text").cast("binary"))
    return documents(spark, sf_dir).select("doc_id", F.md5(shown).alias("digest"), F.length(shown).alias("n_chars"))


def q_special_tokens(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    langs = documents(spark, sf_dir).select("lang").distinct()
    ranked = langs.select(
        F.concat(F.lit("<|"), "lang", F.lit("|>")).alias("token"),
        (F.row_number().over(Window.orderBy("lang")) + F.lit(model.vocab_size)).alias("token_id"),
    )
    return cl.upsert_special_tokens(model.specials_table(spark), ranked)


def q_save_load_tokenizer(spark, sf_dir):
    """Merges, pattern and special tokens that both stored forms give back."""
    path = scratch_path(spark, "tokenizer")
    cl.save_tokenizer(spark, trained_model(spark, sf_dir), path)

    def contents(model):
        rows = [("merge", f"{left} {right}", token_id) for left, right, token_id in model.merges]
        rows += [("special", token, token_id) for token, token_id in model.special_tokens.items()]
        return spark.createDataFrame([*rows, ("pattern", model.pattern, None)], "kind string, value string, token_id int")

    from_text, from_tables = (contents(cl.load_tokenizer(spark, f"{path}.{form}")) for form in ("model", "tables"))
    return from_text.intersect(from_tables)


def q_encode_text(spark, sf_dir):
    encoded = cl.encode_corpus(documents(spark, sf_dir), trained_model(spark, sf_dir), mode="text")
    return digest(encoded, "doc_id")


def q_encode_text_dictionary(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    encoded = cl.encode_corpus(documents(spark, sf_dir), model, mode="text", strategy="dictionary")
    return digest(encoded, "doc_id")


def q_encode_pretoken(spark, sf_dir):
    return digest(cl.encode_corpus(documents(spark, sf_dir), trained_model(spark, sf_dir), strategy="fold"), "doc_id")


def q_encode_pretoken_dictionary(spark, sf_dir):
    encoded = cl.encode_corpus(documents(spark, sf_dir), trained_model(spark, sf_dir), strategy="dictionary")
    return digest(encoded, "doc_id")


def q_encode_text_large(spark, sf_dir):
    encoded = cl.encode_corpus(documents(spark, sf_dir), large_model(spark, sf_dir, None), mode="text")
    return digest(encoded, "doc_id")


def q_encode_pretoken_large(spark, sf_dir):
    return digest(cl.encode_corpus(documents(spark, sf_dir), large_model(spark, sf_dir, cl.GPT4PAT)), "doc_id")


def q_decode(spark, sf_dir):
    model = trained_model(spark, sf_dir)
    decoded = cl.decode_corpus(cl.encode_corpus(documents(spark, sf_dir), model), model)
    return decoded.select("doc_id", F.md5("decoded").alias("digest"), F.length("decoded").alias("n_chars"))


def q_round_trip_report(spark, sf_dir):
    report = cl.round_trip_report(documents(spark, sf_dir), trained_model(spark, sf_dir))
    return rounded(report, "tokens_per_byte")


def q_special_token_audit(spark, sf_dir):
    model = cl.TokenizerModel(merges=[], special_tokens=LITERALS)
    return cl.special_token_audit(documents(spark, sf_dir), model)


def q_special_token_audit_many(spark, sf_dir):
    """Every word of the benchmark as a literal: hundreds, many inside others."""
    texts = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    words = texts.select(F.explode(F.split("text", " ")).alias("word")).where("word <> ''").distinct().orderBy("word")
    model = cl.TokenizerModel(merges=[], special_tokens={row["word"]: 256 + i for i, row in enumerate(words.collect())})
    return cl.special_token_audit(documents(spark, sf_dir), model)


def q_tokenize_documents(spark, sf_dir):
    return digest(cl.tokenize_documents(documents(spark, sf_dir), trained_model(spark, sf_dir)), "doc_id")


def q_validate_token_ids(spark, sf_dir):
    """Text bytes under a 7-bit bound: how many ids each document has outside it, and the sizes of those that pass."""

    def ids(docs):
        return docs.select("doc_id", cl.byte_tokens(F.col("text")).alias("tokens"))

    docs = documents(spark, sf_dir)
    found = cl.invalid_token_ids(ids(docs), bound=128).select("doc_id", F.size("bad_ids").alias("n_bad"))
    bad = stage_table(found, "invalid")
    # The texts are joined and not their ids, which take several times the room.
    good = cl.validate_token_ids(ids(docs.join(bad, "doc_id", "left_anti")), bound=128)
    return bad.select("doc_id", "n_bad", F.lit(None).cast("int").alias("n_tokens")).unionByName(
        good.select("doc_id", F.lit(None).cast("int").alias("n_bad"), F.size("tokens").alias("n_tokens"))
    )


def q_token_offsets(spark, sf_dir):
    return cl.token_offsets(byte_tokens_of(spark, sf_dir))


def q_pack_shards(spark, sf_dir):
    return digest(byte_shards(spark, sf_dir), "split", "shard", "shard_pos", "doc_id")


def q_pack_small_shards(spark, sf_dir):
    return digest(byte_shards(spark, sf_dir, SMALL_SHARD_SIZE), "split", "shard", "shard_pos", "doc_id")


def q_assign_split(spark, sf_dir):
    return byte_shards(spark, sf_dir).groupBy("split").agg(
        F.min("shard").alias("first_shard"), F.max("shard").alias("last_shard"), F.count(F.lit(1)).alias("pieces")
    )


def q_shard_manifest(spark, sf_dir):
    return byte_manifest(spark, sf_dir)


def q_plan_shards(spark, sf_dir):
    return cl.plan_shards(byte_manifest(spark, sf_dir), None, SHARD_SIZE)


def q_write_read_shards(spark, sf_dir):
    path = scratch_path(spark, "shards")
    cl.write_token_shards(unpacked_tokens(byte_shards(spark, sf_dir)), path)
    read = cl.read_token_shards(spark, path, "train").unionByName(cl.read_token_shards(spark, path, "valid"))
    return digest(
        read.withColumn("name", shard_name("corpus")), "split", "shard", "shard_pos", "doc_id", "name"
    )


def q_batch_plan(spark, sf_dir):
    return byte_plan(spark, sf_dir, "train")


def q_rank_totals(spark, sf_dir):
    train = byte_manifest(spark, sf_dir).where(F.col("split") == "train")
    return cl.rank_totals(train, BATCH, SEQ, WORLD)


def q_epochs(spark, sf_dir):
    return cl.epochs(byte_plan(spark, sf_dir, "train"), STEPS_PER_RANK)


def q_epochs_restarted(spark, sf_dir):
    """The loader is reset every few batches and begins again at the first shard."""
    return cl.epochs(byte_plan(spark, sf_dir, "train"), RESTARTED_STEPS, RESTART_EVERY)


def q_materialize_batches(spark, sf_dir):
    shards = stage_table(byte_shards(spark, sf_dir), "shards")
    plan = plan_of(cl.shard_manifest(shards), "train")
    batches = cl.materialize_batches(shards.where(F.col("split") == "train"), plan, BATCH, SEQ)
    return batches.select(
        "rank",
        "batch_index",
        "row",
        "shard",
        id_digest(F.col("inputs"))["digest"].alias("inputs"),
        id_digest(F.col("targets"))["digest"].alias("targets"),
    )


def q_step_plan(spark, sf_dir):
    return cl.step_plan(byte_plan(spark, sf_dir, "train"), STEP_TOKENS, BATCH, SEQ, WORLD)


def q_validation_batches(spark, sf_dir):
    return cl.validation_batches(byte_plan(spark, sf_dir, "valid"), VALIDATION_BATCHES)


def q_render_choices(spark, sf_dir):
    rendered = cl.render_choices(choice_items(spark, sf_dir), byte_model())
    return rendered.select(
        "item_id",
        "ending_idx",
        codes(F.col("tokens")).alias("tokens"),
        F.array_join("mask", "").alias("mask"),
        "label",
    )


def q_render_choices_large(spark, sf_dir):
    rendered = cl.render_choices(choice_items(spark, sf_dir), large_model(spark, sf_dir, cl.GPT4PAT))
    return rendered.select(
        "item_id", "ending_idx", codes(F.col("tokens")).alias("tokens"), F.array_join("mask", "").alias("mask"), "label"
    )


def q_pad_choices(spark, sf_dir):
    return byte_rendered(spark, sf_dir).select(
        "item_id",
        "ending_idx",
        codes(F.col("tokens")).alias("tokens"),
        F.array_join("mask", "").alias("mask"),
        "max_len",
    )


def q_position_losses(spark, sf_dir):
    rendered = byte_rendered(spark, sf_dir)
    rows = cl.bigram_logits(byte_bigrams(spark, sf_dir), BYTE_VOCAB)
    at = rendered.select("item_id", "ending_idx", F.posexplode("tokens").alias("pos", "prev"))
    unseen = F.array_repeat(F.lit(0.0), BYTE_VOCAB)
    logits = at.join(rows, "prev", "left").select(
        "item_id", "ending_idx", "pos", F.coalesce("logits", unseen).alias("logits")
    )
    return rounded(cl.position_losses(logits, rendered), "loss")


def q_position_losses_sliced(spark, sf_dir):
    """The same losses from logits in slices of the vocabulary."""
    rendered = byte_rendered(spark, sf_dir)
    rows = cl.bigram_logits(byte_bigrams(spark, sf_dir), BYTE_VOCAB)
    at = shifted_positions(rendered).join(rows, "prev", "left")
    dense = F.coalesce("logits", F.array_repeat(F.lit(0.0), BYTE_VOCAB))
    firsts = at.withColumn("first_id", F.explode(F.sequence(F.lit(0), F.lit(BYTE_VOCAB - 1), F.lit(VOCAB_SLICE))))
    slices = firsts.withColumn("logits", F.slice(dense, F.col("first_id") + 1, F.lit(VOCAB_SLICE)))
    return rounded(cl.sliced_position_losses(slices, rendered), "loss")


def q_bigram_scores(spark, sf_dir):
    return rounded(bigram_position_losses(spark, sf_dir), "loss")


def q_bigram_counts(spark, sf_dir):
    return byte_bigrams(spark, sf_dir)


def q_choice_scores(spark, sf_dir):
    return rounded(cl.choice_scores(bigram_position_losses(spark, sf_dir)), "sum_loss", "avg_loss")


def q_choice_predictions(spark, sf_dir):
    return predictions(spark, sf_dir)


def q_choice_accuracy(spark, sf_dir):
    return rounded(cl.choice_accuracy(predictions(spark, sf_dir)), "acc", "acc_norm")


def q_choice_accuracy_by_rank(spark, sf_dir):
    return rounded(cl.choice_accuracy_by_rank(predictions(spark, sf_dir), WORLD), "acc", "acc_norm")


def q_choice_examples(spark, sf_dir):
    scores = cl.choice_scores(bigram_position_losses(spark, sf_dir))
    examples = cl.choice_examples(choice_items(spark, sf_dir), scores, cl.choice_predictions(scores))
    return examples.withColumn("endings", F.array_join("endings", " ## "))


def _validation(spark, sf_dir):
    """Staged shards and the materialised validation batches."""
    shards = stage_table(byte_shards(spark, sf_dir), "shards")
    plan = cl.validation_batches(plan_of(cl.shard_manifest(shards), "valid"), VALIDATION_BATCHES)
    return shards, cl.materialize_batches(shards.where(F.col("split") == "valid"), plan, BATCH, SEQ)


def q_validation_loss(spark, sf_dir):
    shards, batches = _validation(spark, sf_dir)
    losses = cl.batch_losses(batches, train_bigrams(shards), BYTE_VOCAB)
    return rounded(cl.validation_loss(losses), "val_loss")


def q_batch_position_losses(spark, sf_dir):
    """Losses of the validation batches under dense logits of a scorer, here the smoothed counts."""
    shards, batches = _validation(spark, sf_dir)
    rows = cl.bigram_logits(train_bigrams(shards), BYTE_VOCAB)
    unseen = F.array_repeat(F.lit(0.0), BYTE_VOCAB)
    logits = cl.batch_positions(batches).join(rows, "prev", "left").select(
        "rank", "batch_index", "row", "pos", F.coalesce("logits", unseen).alias("logits")
    )
    return rounded(cl.batch_position_losses(logits, batches), "loss")


def step_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A step log from the events: eight in a row make a step, an event ends when the next one begins."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "ts", "value")
    following = events.select((F.col("event_id") - 1).alias("event_id"), F.col("ts").alias("t1"))
    return events.join(following, "event_id", "left").select(
        F.floor(F.col("event_id") / 8).alias("step"),
        (F.col("event_id") % 2).alias("rank"),
        F.col("value").alias("loss"),
        F.col("ts").alias("t0"),
        "t1",
    )


def q_step_log_report(spark, sf_dir):
    report = cl.step_log_report(step_log(spark, sf_dir), BATCH, SEQ, 4, 2)
    return rounded(report, "loss", "elapsed_ms", "tokens_per_sec")


QUERIES: dict[str, Query] = {
    name.removeprefix("q_"): function for name, function in list(globals().items()) if name.startswith("q_")
}
