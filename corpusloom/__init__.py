"""Corpus preparation and evaluation for language models, as Spark DataFrame jobs."""

from corpusloom.functions.patterns import GPT2PAT, GPT4PAT, pretokenize
from corpusloom.functions.rendering import render_token
from corpusloom.model import TokenizerModel, merges_pretty, upsert_special_tokens, vocab_report
from corpusloom.operators.batching import (
    batch_plan,
    epochs,
    materialize_batches,
    rank_totals,
    step_plan,
    validation_batches,
    with_steps,
)
from corpusloom.operators.choices import (
    batch_position_losses,
    batch_positions,
    choice_accuracy,
    choice_accuracy_by_rank,
    choice_examples,
    choice_predictions,
    choice_scores,
    cross_entropy,
    pad_choices,
    position_losses,
    render_choices,
    sliced_losses,
    sliced_position_losses,
)
from corpusloom.operators.codec import decode_corpus, encode_corpus, round_trip_report, special_token_audit
from corpusloom.operators.packing import (
    assign_split,
    invalid_token_ids,
    pack_shards,
    plan_shards,
    shard_manifest,
    token_offsets,
    tokenize_documents,
    validate_token_ids,
)
from corpusloom.operators.pretokens import byte_tokens, dense_order, pretoken_counts, split_pretokens
from corpusloom.operators.scoring import (
    batch_losses,
    bigram_counts,
    bigram_logits,
    bigram_scores,
    step_log_report,
    stream_bigram_counts,
    validation_loss,
)
from corpusloom.operators.training import (
    byte_sequences,
    merge_pair,
    pair_counts,
    pretoken_sequences,
    top_pair,
    train_bpe,
)
from corpusloom.session import build_session, materialize, stage_table
from corpusloom.sources.corpus import read_corpus, with_corpus_order
from corpusloom.sources.items import read_choice_items
from corpusloom.sources.shards import read_token_shards, shard_list, write_token_shards
from corpusloom.sources.tokenizer_files import load_tokenizer, save_tokenizer
