"""Small tables inside larger plans."""

from __future__ import annotations

from pyspark.sql import DataFrame


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows for a join; whether they are broadcast is left to Spark's size check."""
    return df.limit(n)
