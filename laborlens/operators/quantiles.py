"""Exact percentiles of columns of any size.

The built-in ``percentile`` keeps every distinct value of a group in the memory of
one task. That is right for a monthly series and wrong for a raw column, so raw
columns go through ``exact_percentiles``: mergeable sketches of a fixed size narrow
the place of each wanted rank down, and exact counts beside them prove it.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Items that a sketch keeps for its lowest level; a sketch of so many values or fewer is exact.
KEPT = 4096
#: How far from a rank, as a part of all values, its neighbours are looked up; twice the sketch's error at this size.
MARGIN = 0.0015


@dataclass(frozen=True)
class Search:
    """What is known about one rank of a column: it lies among ``size`` values, which ``sketch`` summarises, and
    ``below`` values are smaller than these."""

    column: str
    rank: int
    below: int
    size: int
    sketch: bytes
    margin: float = MARGIN

    def ranks(self) -> tuple[float, float, float]:
        at = (self.rank - self.below + 0.5) / self.size
        return max(at - self.margin, 0.0), at, min(at + self.margin, 1.0)


def exact_percentiles(df: DataFrame, columns: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated percentiles as rows (column_name, percentiles).

    The first pass sketches all columns. Each further pass takes, for every wanted rank, two values that the sketch
    places a little below and above it, and counts exactly how many values lie before, at and between them, with a
    new sketch of those between; a rank that falls on one of the two is found, any other goes on among the fewer values
    between, until a sketch holds all of them. A pass divides the values by some 300, so 10^12 take five. It is one
    aggregate without a shuffle of rows, and brings a sketch of at most 100 KB for each rank to the driver.

    NaN counts as missing, infinities are values. A column without values gives no row.
    """
    spark = df.sparkSession
    rows = df.select(*[F.nullif(F.col(c).cast("double"), F.lit(math.nan)).alias(c) for c in columns])
    sizes = rows.agg(*[part for c in columns for part in (F.count(c).alias(f"n {c}"), _sketch(F.col(c)).alias(c))]).first()
    wanted, searches = {}, []
    for c in columns:
        if n := sizes[f"n {c}"]:
            wanted[c] = [p * (n - 1) for p in probabilities]
            ranks = sorted({r for p in wanted[c] for r in (math.floor(p), math.ceil(p))})
            searches += [Search(c, r, 0, n, bytes(sizes[c])) for r in ranks]
    found: dict[tuple[str, int], float] = {}
    while searches:
        searches = _narrowed(spark, rows, searches, found)
    out = []
    for c, positions in wanted.items():
        ends = [(found[c, math.floor(p)], found[c, math.ceil(p)], p - math.floor(p)) for p in positions]
        # between equal infinities there is nothing to interpolate
        out.append((c, [low if low == high else low + (high - low) * weight for low, high, weight in ends]))
    return spark.createDataFrame(out, "column_name string, percentiles array<double>")


def _sketch(value: Column) -> Column:
    return F.kll_sketch_agg_double(value, F.lit(KEPT))


def _looked_up(spark: SparkSession, searches: Sequence[Search]) -> list[tuple[bool, list[float]]]:
    """For each search whether its sketch holds all values, and the values just below, at and just above its rank."""
    held = spark.createDataFrame([[s.sketch for s in searches]], ", ".join(f"s{i} binary" for i in range(len(searches))))
    exact = [F.kll_sketch_to_string_double(f"s{i}").rlike(r"Estimation Mode\s*: false") for i in range(len(searches))]
    values = [F.kll_sketch_get_quantile_double(f"s{i}", F.array(*map(F.lit, s.ranks()))) for i, s in enumerate(searches)]
    row = held.select(F.array(*exact).alias("exact"), F.array(*values).alias("values")).collect()[0]
    return list(zip(row["exact"], row["values"]))


def _narrowed(spark: SparkSession, rows: DataFrame, searches: Sequence[Search], found: dict[tuple[str, int], float]) -> list[Search]:
    """One pass over the rows for all searches that their sketches don't answer."""
    asked: dict[tuple[str, float, float], list[Search]] = {}
    for search, (exact, (low, value, high)) in zip(searches, _looked_up(spark, searches)):
        if exact:
            found[search.column, search.rank] = value
        else:  # neighbouring ranks mostly share their two values
            asked.setdefault((search.column, low, high), []).append(search)
    if not asked:
        return []
    counts = []
    for i, (column, low, high) in enumerate(asked):
        v, between = F.col(column), (F.col(column) > low) & (F.col(column) < high)
        counts += [F.count_if(v < low).alias(f"before{i}"), F.count_if(v == low).alias(f"low{i}"), F.count_if(v == high).alias(f"high{i}"),
                   F.count_if(between).alias(f"between{i}"), _sketch(F.when(between, v)).alias(f"sketch{i}")]
    seen = rows.agg(*counts).first()
    left = []
    for i, ((column, low, high), group) in enumerate(asked.items()):
        start = seen[f"before{i}"]
        inside = start + seen[f"low{i}"]
        end = inside + seen[f"between{i}"]
        stop = end + seen[f"high{i}"] if high > low else inside
        for s in group:
            if start <= s.rank < inside:
                found[column, s.rank] = low
            elif inside <= s.rank < end:
                left.append(Search(column, s.rank, inside, end - inside, bytes(seen[f"sketch{i}"])))
            elif end <= s.rank < stop:
                found[column, s.rank] = high
            else:  # the sketch was further off than it usually is
                left.append(replace(s, margin=4 * s.margin))
    return left
