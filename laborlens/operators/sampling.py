"""Deterministic sampling and row expansion.

Rows are ordered by a seeded hash of their identity, so a rerun, or a task run
again after an executor is lost, draws the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

SLICE_BITS = 12


def _draw(identity: Sequence[str], seed: int) -> Column:
    """A uniform non-negative long."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *identity), 1)


def sample_per_partition(
    df: DataFrame, n: int, identity: Sequence[str], blocks: int, seed: int = 42, salts: int = 64
) -> DataFrame:
    """At most ``n`` rows from each of ``blocks`` hash blocks of the input.

    Blocks are cut by a hash of the row identity, so they are even by construction. Rows are counted by block and
    slice of their draw first; only those up to the slice that fills a block, ``n`` and one slice of a block, are ranked.
    """
    blocked = df.withColumn("_block", F.pmod(F.xxhash64(*identity), F.lit(blocks)))
    return _first_draws(blocked, "_block", F.lit(n), identity, seed, salts).drop("_block")


def _first_draws(
    rows: DataFrame, group: str, quota: Column, identity: Sequence[str], seed: int, salts: int, quotas: DataFrame | None = None
) -> DataFrame:
    """The rows of each group with the smallest draws, as many as its quota, which may come from ``quotas`` by group.

    The range of the draw is cut into 4096 slices. Counting rows per (group, slice) reads the identity columns only
    and reduces on the map side; it tells after which slice each quota is full. The cuts, one row a group, are joined
    back; Spark broadcasts them while they are small, so rows beyond their slice aren't shuffled then. The rest (quota
    plus one slice) is ranked in salted parts first, so that a group holding a third of all rows is not ranked by one task.
    """
    sliced = rows.withColumn("_draw", _draw(identity, seed)).withColumn("_slice", F.shiftrightunsigned("_draw", 63 - SLICE_BITS).cast("int"))
    counts = sliced.groupBy(group, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.join(quotas, group) if quotas is not None else counts
    upto = W.partitionBy(group).orderBy("_slice").rowsBetween(W.unboundedPreceding, W.currentRow)
    needed = counts.withColumns({"_before": F.sum("_n").over(upto) - F.col("_n"), "_quota": quota.cast("long")})
    cuts = needed.filter(F.col("_before") < F.col("_quota")).groupBy(group).agg(
        F.struct(F.max("_slice").alias("slice"), F.max("_quota").alias("quota")).alias("_cut"))
    near = (
        sliced.join(cuts, group)
        .filter(F.col("_slice") <= F.col("_cut.slice"))
        .withColumn("_salt", F.pmod(F.xxhash64(F.lit(seed + 1), *identity), F.lit(salts)))
    )
    order = [F.col("_draw"), *[F.col(c) for c in identity]]
    in_salt = F.row_number().over(W.partitionBy(group, "_salt").orderBy(*order))
    in_group = F.row_number().over(W.partitionBy(group).orderBy(*order))
    return (
        near.withColumn("_rn", in_salt)
        .filter(F.col("_rn") <= F.col("_cut.quota"))
        .withColumn("_rn", in_group)
        .filter(F.col("_rn") <= F.col("_cut.quota"))
        .drop("_draw", "_slice", "_cut", "_salt", "_rn")
    )


def stratum_quotas(df: DataFrame, stratum: str, total: int) -> DataFrame:
    """``total`` shared equally; the first strata in order take one of the remainder each."""
    strata = df.filter(F.col(stratum).isNotNull()).select(stratum).distinct()
    count = strata.agg(F.count(F.lit(1))).scalar()
    share = F.floor(F.lit(total) / count)
    # One row per stratum (a month), so the unpartitioned window stays small.
    numbered = strata.withColumn("_position", F.row_number().over(W.orderBy(stratum)))
    extra = F.when(F.col("_position") <= F.lit(total) - share * count, 1).otherwise(0)
    return numbered.select(stratum, (share + extra).cast("long").alias("quota"))


def stratified_sample(
    df: DataFrame, stratum: str, total: int, identity: Sequence[str], seed: int = 42, salts: int = 64
) -> DataFrame:
    """Quota per stratum, everything where a stratum has fewer rows."""
    drawn = df.filter(F.col(stratum).isNotNull())
    return _first_draws(drawn, stratum, F.col("quota"), identity, seed, salts, stratum_quotas(df, stratum, total))


def repeat_rows(df: DataFrame, copies: Column, index: str = "copy_index") -> DataFrame:
    """Each row ``copies`` times with a 0-based index; zero copies drop the row."""
    counted = df.withColumn("_copies", copies.cast("int")).filter(F.col("_copies") > 0)
    return counted.withColumn(index, F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))).drop("_copies")


def copies_per_fifty(count: Column) -> Column:
    """max(1, int(count / 50))"""
    return F.greatest(F.lit(1), (count / 50).cast("int"))


def copies_per_hundred(count: Column) -> Column:
    """int(count / 100) limited to 0..2"""
    return F.least(F.lit(2), F.greatest(F.lit(0), (count / 100).cast("int")))
