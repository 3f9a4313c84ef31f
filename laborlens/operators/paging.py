"""Sort orders, pages and top-k."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

#: Ranges of a stored table. Each is a task, a file, a sample of 300 rows for the bounds and a row of the directory,
#: so larger tables get larger ranges and not more of them; within its range a page is found by the places stored there.
MAX_RANGES = 1_000


# Newest or largest first with missing values leading, as the served tables sort.
def jobs_order(tie_break: str = "id") -> list[Column]:
    return [F.desc_nulls_first("posted_date"), F.asc(tie_break)]


def demand_order(tie_break: Sequence[str] = ("skill_name", "period_start")) -> list[Column]:
    return [F.desc_nulls_first("demand_count"), *[F.asc(c) for c in tie_break]]


def forecast_order() -> list[Column]:
    return [F.asc("skill_name"), F.asc("forecast_date")]


@dataclass(frozen=True)
class Key:
    """One column of a sort order."""

    column: str
    descending: bool = False
    nulls_first: bool = True

    def sort(self) -> Column:
        kind = ("desc" if self.descending else "asc") + ("_nulls_first" if self.nulls_first else "_nulls_last")
        return getattr(F.col(self.column), kind)()

    def after(self, value: Any) -> Column:
        """Whether a row stands behind this value."""
        column = F.col(self.column)
        if value is None:
            return column.isNotNull() if self.nulls_first else F.lit(False)
        behind = column < F.lit(value) if self.descending else column > F.lit(value)
        return F.coalesce(behind, F.lit(not self.nulls_first))


def _behind(order: Sequence[Key], values: Sequence[Any]) -> Column:
    """Whether a row stands behind the values of all keys."""
    found, equal = F.lit(False), F.lit(True)
    for key, value in zip(order, values, strict=True):
        found = found | (equal & key.after(value))
        equal = equal & F.col(key.column).eqNullSafe(F.lit(value))
    return found


JOBS_KEYS = (Key("posted_date", descending=True), Key("id"))


@dataclass(frozen=True)
class Pages:
    """A table stored in the ranges of a sort order: any page of it is read from its own range.

    Rows carry the number of their range and their place in it; the directory has a row for each range with its size
    and the number of rows before it.
    """

    rows: DataFrame
    directory: DataFrame
    order: tuple[Key, ...]

    def page(self, number: int = 0, size: int = 20) -> DataFrame:
        if number < 0 or size < 1:
            raise ValueError("page number must be >= 0 and size >= 1")
        return self._slice(number * size, size)

    def after(self, values: Sequence[Any], size: int = 20) -> DataFrame:
        """The rows that follow the one with these values of the order's columns, which need not be there any more."""
        heads = self.rows.filter("_place = 0").filter(~_behind(self.order, values)).select("_range")
        last = heads.agg(F.max("_range")).first()[0]
        if last is None:
            return self._slice(0, size)
        own = self.rows.filter((F.col("_range") == last) & ~_behind(self.order, values)).count()
        start = self.directory.filter(F.col("_range") == last).first()["_start"]
        return self._slice(start + own, size)

    def info(self, number: int = 0, size: int = 20) -> DataFrame:
        """The page envelope, from the directory alone."""
        total = F.coalesce(F.sum("_rows"), F.lit(0))
        return self.directory.agg(total.alias("totalElements")).select(
            "totalElements", F.ceil(F.col("totalElements") / size).alias("totalPages"), F.lit(number).alias("number"), F.lit(size).alias("size"))

    def _slice(self, offset: int, size: int) -> DataFrame:
        touched = self.directory.filter((F.col("_start") < offset + size) & (F.col("_start") + F.col("_rows") > offset)).collect()
        place = F.lit(False)
        for r in touched:  # one range, or the few that a page reaches over
            first = offset - r["_start"]
            place = place | ((F.col("_range") == r["_range"]) & (F.col("_place") >= max(first, 0)) & (F.col("_place") < first + size))
        return self.rows.filter(place).orderBy("_range", "_place").drop("_range", "_place")


def store_pages(df: DataFrame, order: Sequence[Key], path: str, rows_a_range: int = 100_000) -> Pages:
    """Store a table in the ranges of an order that ends in a unique column.

    One shuffle by range; each range is sorted in its own task, and a value that many rows share is divided by the
    columns behind it. Ranges have ``rows_a_range`` rows, or more where there would be over ``MAX_RANGES`` of them.
    """
    spark = df.sparkSession
    ranges = min(max(1, -(-df.count() // rows_a_range)), MAX_RANGES)
    columns = [k.sort() for k in order]
    placed = df.repartitionByRange(ranges, *columns).sortWithinPartitions(*columns)
    # numbered in sorted order; the upper bits are the partition
    placed = placed.withColumn("_id", F.monotonically_increasing_id())
    placed = placed.select("*", F.shiftright("_id", 33).cast("int").alias("_range"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")).drop("_id")
    placed.write.partitionBy("_range").parquet(f"{path}/rows")
    rows = _stored_rows(spark, path, placed)
    # one row a range: the unpartitioned window adds up the directory
    before = F.sum("_rows").over(W.orderBy("_range").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_rows")
    sizes = rows.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).withColumn("_start", before)
    sizes.coalesce(1).write.parquet(f"{path}/directory")
    return open_pages(spark, path, order, df)


def _stored_rows(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{path}/rows")


def open_pages(spark: SparkSession, path: str, order: Sequence[Key], like: DataFrame) -> Pages:
    """Stored pages of a table with the columns of ``like``."""
    schema = like.withColumns({"_place": F.lit(0).cast("long"), "_range": F.lit(0)})
    directory = spark.read.schema("_range int, _rows long, _start long").parquet(f"{path}/directory")
    return Pages(_stored_rows(spark, path, schema), directory, tuple(order))


def page(df: DataFrame, order: Sequence[Column], number: int = 0, size: int = 20) -> DataFrame:
    """One page of rows. The order must end in a unique column.

    For pages near the front; deep ones sort and skip all rows before them, ``store_pages`` reads them directly.
    """
    if number < 0 or size < 1:
        raise ValueError("page number must be >= 0 and size >= 1")
    return df.orderBy(*order).offset(number * size).limit(size)


def page_info(df: DataFrame, number: int = 0, size: int = 20) -> DataFrame:
    """The page envelope: totalElements, totalPages, number, size."""
    return df.agg(F.count(F.lit(1)).alias("totalElements")).select(
        "totalElements",
        F.ceil(F.col("totalElements") / size).alias("totalPages"),
        F.lit(number).alias("number"),
        F.lit(size).alias("size"),
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def last_k(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k largest values of the column, in ascending order."""
    return df.orderBy(F.desc(column)).limit(k).orderBy(F.asc(column))
