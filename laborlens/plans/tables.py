"""Intermediate tables shared by several steps of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..session import scratch_path


def materialize(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write a result below the shared checkpoint folder and continue from there.

    For a small result of a large scan that several steps read: the scan runs once,
    and a lost executor costs a file read and not the scan again. A large result, of joins
    that many steps read, is written with the ``compression`` named.
    """
    spark = df.sparkSession
    path = scratch_path(spark, purpose)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
