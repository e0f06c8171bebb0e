"""Headline timings: prints one JSON line.

``BENCH_SF_DIR`` names the table folder, ``BENCH_CPUS`` the number of cores.  Every job reads its tables anew and its
whole result is computed (written to the no-op sink, or aggregated).
"""

from __future__ import annotations

import json
import os
import time

import corpusloom as cl
from corpusloom import queries as q
from corpusloom.session import build_session, scratch_path, stage_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
TRAIN_VOCAB = 320
LARGE = (1_024, 1_000)  # frequent pairs and pairs of these: a list of 2,024 merges


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = build_session(
        "bench",
        master=f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "12g"),
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    docs = q.documents(spark, SF_DIR)
    drain(docs)  # session start and first read are not part of any timing

    times: dict[str, float] = {}
    model: cl.TokenizerModel | None = None

    def timed(name, job):
        start = time.perf_counter()
        result = job()
        times[name] = round(time.perf_counter() - start, 3)
        return result

    timed("pretoken_counts", lambda: drain(cl.pretoken_counts(docs)))
    timed("pair_counts", lambda: drain(q.q_pair_counts(spark, SF_DIR)))
    model = timed("train_bpe_pretoken", lambda: cl.train_bpe(docs, TRAIN_VOCAB, cl.GPT4PAT))
    model.add_special_tokens({q.END_OF_TEXT: model.vocab_size})
    timed("train_bpe_text", lambda: q.q_train_bpe_text(spark, SF_DIR))
    timed("encode_text", lambda: drain(cl.encode_corpus(docs, model, mode="text")))
    timed("encode_pretoken", lambda: drain(cl.encode_corpus(docs, model, strategy="fold")))
    timed("encode_pretoken_dictionary", lambda: drain(cl.encode_corpus(docs, model, strategy="dictionary")))
    large = timed("pair_list_of_2024", lambda: q.large_model(spark, SF_DIR, cl.GPT4PAT, *LARGE))
    timed("encode_pretoken_2024", lambda: drain(cl.encode_corpus(docs, large)))
    timed("round_trip_report", lambda: drain(cl.round_trip_report(docs, model)))
    tokens = timed("tokenize_documents", lambda: stage_table(cl.tokenize_documents(docs, model), "tokens"))
    timed("decode_corpus", lambda: drain(cl.decode_corpus(tokens, model, render_special=True)))
    timed("pack_shards", lambda: drain(cl.pack_shards(tokens, q.SHARD_SIZE)))
    timed("shard_manifest", lambda: drain(cl.shard_manifest(cl.pack_shards(tokens, q.SHARD_SIZE))))

    folder = scratch_path(spark, "bench-shards")
    timed("write_token_shards", lambda: cl.write_token_shards(cl.pack_shards(tokens, q.SHARD_SIZE), folder))
    timed("read_token_shards", lambda: drain(cl.read_token_shards(spark, folder, "train")))

    def batches():
        shards = cl.read_token_shards(spark, folder, "train")
        plan = cl.batch_plan(cl.shard_manifest(shards), 8, 1024, 1)
        drain(cl.materialize_batches(shards, plan, 8, 1024))

    timed("materialize_batches", batches)
    timed("bigram_counts", lambda: drain(cl.bigram_counts(tokens)))
    timed("choice_accuracy", lambda: drain(q.q_choice_accuracy(spark, SF_DIR)))
    timed("validation_loss", lambda: drain(q.q_validation_loss(spark, SF_DIR)))
    timed("step_log_report", lambda: drain(q.q_step_log_report(spark, SF_DIR)))

    print(
        json.dumps(
            {
                "metric": "total wall time of the headline jobs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "merges": len(model.merges),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
