"""Storing tokenizers: Parquet tables as the true store, and the text format for exchange."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.model import VERSION, TokenizerModel, vocab_report
from corpusloom.plans.offsets import numbered_lines

TABLES = ("meta", "special_tokens", "merges")

# The line format of the exchange file.
MERGE_LINE = r"^\((\d+), (\d+)\)->(\d+)$"
COUNT_LINE = r"^num_special_tokens: (\d+)$"
HEADER_LINES = 4


def model_lines(model: TokenizerModel) -> list[str]:
    """The exchange file: version, pattern, special tokens, merges in rank order (bounded by the id range)."""
    spaced = [token for token in model.special_tokens if token.split() != [token]]
    if spaced:
        raise ValueError(f"special tokens with white space cannot be written as text: {spaced}")
    if "\n" in (model.pattern or "") or (model.pattern or "").strip() != (model.pattern or ""):
        raise ValueError("a pattern with line breaks or outer white space cannot be written as text")
    return [
        f"version: {VERSION}",
        "pattern:",
        str(model.pattern),
        f"num_special_tokens: {len(model.special_tokens)}",
        *(f"{token} {token_id}" for token, token_id in model.special_tokens.items()),
        *(f"({left}, {right})->{token_id}" for left, right, token_id in model.merges),
    ]


def _write_lines(spark: SparkSession, lines: DataFrame, path: str, mode: str) -> None:
    """A small ordered frame ``(at, value)`` as one text file in a directory."""
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.mode(mode).text(path)


def save_tokenizer(spark: SparkSession, model: TokenizerModel, path: str, mode: str = "errorifexists") -> None:
    """Write ``path.tables/{meta,special_tokens,merges}`` (Parquet), ``path.model`` and ``path.vocab`` (text)."""
    lines = model_lines(model)
    tables = (model.meta_table(spark), model.specials_table(spark), model.merges_table(spark))
    for name, table in zip(TABLES, tables):
        table.coalesce(1).write.mode(mode).parquet(f"{path}.tables/{name}")
    numbered = spark.createDataFrame(list(enumerate(lines)), "at INT, value STRING")
    _write_lines(spark, numbered, f"{path}.model", mode)
    report = vocab_report(spark, model).select(F.col("token_id").alias("at"), F.col("line").alias("value"))
    _write_lines(spark, report, f"{path}.vocab", mode)


def parse_model_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(meta, special_tokens, merges)`` tables of an exchange file."""
    lines = numbered_lines(spark.read.text(path), "at")
    # One line of the header; nothing to parse without it.
    header = lines.where(F.col("at") == HEADER_LINES - 1).select(F.regexp_extract("value", COUNT_LINE, 1)).first()
    if header is None or not header[0]:
        raise ValueError(f"{path} is not a tokenizer file")
    first_merge = HEADER_LINES + int(header[0])
    body = lines.where(F.col("at") >= HEADER_LINES)
    in_specials = F.col("at") < first_merge
    parts = F.split(F.trim("value"), r"\s+")
    specials = body.where(in_specials).select(
        "at", parts[0].alias("token"), parts[1].cast("int").alias("token_id")
    )
    merges = body.where(~in_specials & (F.trim("value") != "")).select(
        (F.col("at") - first_merge).cast("int").alias("rank"),
        *(
            F.regexp_extract("value", MERGE_LINE, group).cast("int").alias(name)
            for group, name in enumerate(("left", "right", "token_id"), start=1)
        ),
    )
    pattern = F.trim("value")
    meta = lines.where(F.col("at") == 2).select(
        F.lit(VERSION).alias("version"), F.when(pattern != "None", pattern).alias("pattern")
    )
    return meta, specials.orderBy("at").select("token", "token_id"), merges.orderBy("rank")


def load_tokenizer(spark: SparkSession, path: str) -> TokenizerModel:
    """Restore a tokenizer from ``….model`` (text) or ``….tables`` (Parquet)."""
    if path.endswith(".model"):
        meta, specials, merges = parse_model_lines(spark, path)
    elif path.endswith(".tables"):
        meta, specials, merges = (spark.read.parquet(f"{path}/{name}") for name in TABLES)
        merges = merges.orderBy("rank")
    else:
        raise ValueError("path must end with .model or .tables")
    # All three are bounded by the id range.
    return TokenizerModel(
        merges=[(row["left"], row["right"], row["token_id"]) for row in merges.collect()],
        pattern=meta.first()["pattern"],
        special_tokens={row["token"]: row["token_id"] for row in specials.collect()},
    )
