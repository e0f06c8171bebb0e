"""Reading corpora from Parquet part files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.plans.offsets import small_side

# Text in one partition of ``dealt_by``.
DEALT_BYTES = 4 << 20


def read_corpus(
    spark: SparkSession,
    base: str,
    files: Iterable[str] | Mapping[str, Iterable[str]] | None = None,
    lang: str | Iterable[str] | None = None,
    dump: str | None = None,
    columns: Iterable[str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """The chosen part files below ``base``.

    ``dump`` and ``lang`` pick ``data/<dump>/<lang>`` directories when a dump is given; without one, ``lang`` filters
    the ``lang`` column, which reaches the scan.  With a dump, ``files`` may be a list for each language; a column ``lang``
    then tells from which directory a row comes.  ``schema`` (DDL) avoids reading a footer for it; ``columns`` prunes.
    """
    base = base.rstrip("/")
    langs = [lang] if isinstance(lang, str) else list(lang or [])
    if isinstance(files, Mapping):
        if dump is None:
            raise ValueError("files for each language need a dump")
        langs = langs or list(files)
        wanted = {name: list(files.get(name, ())) for name in langs}
        if not all(wanted.values()):
            raise ValueError(f"no part files chosen for {[name for name, chosen in wanted.items() if not chosen]}")
        paths = [f"{base}/data/{dump}/{name}/{file}" for name, chosen in wanted.items() for file in chosen]
        reader = spark.read if schema is None else spark.read.schema(schema)
        place = F.regexp_extract("_metadata.file_path", rf"/data/\Q{dump}\E/([^/]+)/", 1)
        df = reader.parquet(*paths).withColumn("lang", place)
        return df if columns is None else df.select(*columns)
    roots = [base]
    if dump is not None:
        if not langs:
            raise ValueError("a dump needs a language")
        roots = [f"{base}/data/{dump}/{name}" for name in langs]
    chosen = None if files is None else list(files)
    if chosen is not None and not chosen:
        raise ValueError("no part files chosen")
    paths = roots if chosen is None else [f"{root}/{name}" for root in roots for name in chosen]
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    if langs and dump is None:
        df = df.where(F.col("lang").isin(*langs))
    return df if columns is None else df.select(*columns)


def spread(df: DataFrame) -> DataFrame:
    """Spread a scan over all cores if it has fewer partitions than that (few files with one row group each).

    A corpus of many files is left as it is scanned: nothing is shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def dealt_by(df: DataFrame, key_col: str, text_col: str = "text") -> DataFrame:
    """``df`` dealt by a key to partitions of about ``DEALT_BYTES`` of text, for work that takes many times the room of the
    text and is put together again by that key: then neither is shuffled.
    """
    size = df.agg(F.sum(F.octet_length(text_col).cast("bigint"))).first()[0] or 0
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // DEALT_BYTES)), key_col)


def with_corpus_order(df: DataFrame, out: str = "doc_ord") -> DataFrame:
    """Add a dense document number for Parquet without an id: files by path, rows by their place in the file.

    Only the path and row index are read for it; the number of rows per file is what is summed globally, and one row
    per file is broadcast if the files are few enough, so no text is shuffled.
    """
    at = df.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        at.groupBy("_file")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_file", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_base"))
    )
    return at.join(small_side(bases), "_file").withColumn(out, F.col("_base") + F.col("_row")).drop("_file", "_row", "_base")
