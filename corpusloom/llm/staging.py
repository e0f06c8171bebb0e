"""Written tables in the shared folder, compressed for size."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corpusloom.session import scratch_path


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as zstd-compressed Parquet in the folder of ``spark.checkpoint.dir`` and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
