"""Unions and source merging."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames, matched by column name."""
    return reduce(DataFrame.unionByName, frames)


def historical_and_predicted(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """Tagged union; bounds stay NULL on the historical rows."""
    return history.withColumn("kind", F.lit("historical")).unionByName(
        predicted.withColumn("kind", F.lit("predicted")), allowMissingColumns=True
    )


def distinct_dates(frames: Sequence[DataFrame], date_col: str) -> DataFrame:
    """Sorted union of the dates; each frame is reduced before the union."""
    return union_all([f.select(date_col).distinct() for f in frames]).distinct().orderBy(date_col)


def dedupe_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row per key; later columns of ``order`` break ties.

    Written as an aggregate and not as a window, so copies of one posting collapse
    on the map side however many there are. Columns without an order of their own, such as
    maps, break ties by their JSON text; then rows are ranked, and each task passes one row a key on.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    if any(re.search(r"map<|variant", df.schema[c].dataType.simpleString()) for c in rest):
        ties = [F.desc(F.to_json(F.struct(*rest)))]
        first = F.row_number().over(W.partitionBy(*keys).orderBy(*[F.desc(c) for c in order], *ties))
        return df.withColumn("_rank", first).filter("_rank = 1").drop("_rank")
    latest = F.max(F.struct(*order, *rest)).alias("_row")
    return df.groupBy(*keys).agg(latest).select(*keys, "_row.*").select(*df.columns)


def merge_sources(
    frames: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Stream extract and delta load in one frame, the latest row per key winning."""
    return dedupe_latest(union_all(frames), keys, order)
