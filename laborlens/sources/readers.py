"""Batch sources."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import dates, text, values
from ..operators import aggregates, projections
from ..schemas import JOB_LISTINGS, RAW_POSTING_COLUMNS, TREND_DOCUMENT

# Quoted fields may hold doubled quotes and line breaks. A file with line breaks inside
# fields cannot be split, so it is read by one task. ``multi_line=None`` looks for such
# breaks first, in one scan that is split, and reads files without any by many tasks;
# True or False saves the scan where it is known.
QUOTED_CSV = {"header": "true", "quote": '"', "escape": '"'}


def has_breaks_in_fields(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may reach over the end of a line: a line with an odd number of quotes opens one."""
    lines = spark.read.text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not lines.filter(quotes % 2 == 1).isEmpty()


def _multi_line(spark: SparkSession, path: str, asked: bool | None) -> bool:
    return has_breaks_in_fields(spark, path) if asked is None else asked


def read_seed_tsv(
    spark: SparkSession, path: str, schema: T.StructType = JOB_LISTINGS, multi_line: bool | None = None
) -> DataFrame:
    """Tab-separated table with a header; an unquoted empty field is NULL.

    Quoted fields may hold tabs, quotes and line breaks. Flags come as t/f or True/False,
    so they are read as text and converted.
    """
    flags = {f.name for f in schema.fields if isinstance(f.dataType, T.BooleanType)}
    raw = T.StructType(
        [T.StructField(f.name, T.StringType() if f.name in flags else f.dataType) for f in schema.fields]
    )
    df = spark.read.schema(raw).csv(path, sep="\t", header=True, escape='"', multiLine=_multi_line(spark, path, multi_line))
    return df.withColumns({name: values.text_flag(name) for name in flags}) if flags else df


def read_postings_csv(
    spark: SparkSession, path: str, header: Sequence[str], columns: Sequence[str] = RAW_POSTING_COLUMNS,
    multi_line: bool | None = None,
) -> DataFrame:
    """The wanted columns of a postings CSV, everything as text.

    ``header`` lists the file's columns in order; a fixed schema avoids a pass over
    the data, and only the selected columns are parsed.
    """
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    reader = spark.read.options(**QUOTED_CSV).schema(schema)
    return reader.csv(path, multiLine=_multi_line(spark, path, multi_line)).select(*[f"`{c}`" for c in columns])


def read_inferred_csv(
    spark: SparkSession, path: str, encoding: str = "UTF-8", multi_line: bool | None = None
) -> DataFrame:
    """CSV with inferred types, for profiling. ``encoding='ISO-8859-1'`` reads Latin-1 files."""
    return spark.read.options(**QUOTED_CSV).csv(path, inferSchema=True, encoding=encoding, multiLine=_multi_line(spark, path, multi_line))


def read_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(
    spark: SparkSession, url: str, table: str, partition_column: str | None = None,
    bounds: tuple[int, int] | None = None, partitions: int = 1, **options: str,
) -> DataFrame:
    """A database table; filters and columns are pushed to the database.

    With a numeric partition column the read is split over ``partitions`` connections.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if partition_column and bounds:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def read_forecast_doc(spark: SparkSession, path: str) -> DataFrame:
    """A trend document as rows (kind, date, count, confidence_lower, confidence_upper)."""
    doc = spark.read.schema(TREND_DOCUMENT).json(path, multiLine=True)

    def tagged(kind: str):
        return F.transform(kind, lambda p: F.struct(F.lit(kind).alias("kind"), p.alias("p")))

    points = F.concat(tagged("historical"), tagged("predicted"))
    return doc.select(F.explode(points).alias("e")).select(
        "e.kind",
        F.to_date("e.p.date").alias("date"),
        F.col("e.p.count").alias("count"),
        F.col("e.p.confidenceLower").alias("confidence_lower"),
        F.col("e.p.confidenceUpper").alias("confidence_upper"),
    )


def external_table(
    spark: SparkSession, name: str, path: str, schema: str, array_columns: Sequence[str] = (), sep: str = ",",
    array_sep: str = "|",
) -> DataFrame:
    """Register delimited text as an unmanaged table; list columns are split into arrays.

    A table of that name which reads the same text is kept; any other registration is
    replaced, its files stay. A managed table of that name is an error.
    """
    if spark.catalog.tableExists(name):
        if spark.catalog.getTable(name).tableType == "MANAGED":
            raise ValueError(f"{name} is a managed table")
        spark.sql(f"DROP TABLE {name}")
    spark.sql(
        f"CREATE TABLE {name} ({schema}) USING csv "
        f"OPTIONS (header 'true', sep '{sep}') LOCATION '{path}'"
    )
    df = spark.table(name)
    return df.withColumns({c: text.split_list(c, array_sep) for c in array_columns}) if array_columns else df


def incremental_scan(df: DataFrame, column: str, last_value) -> DataFrame:
    """Rows beyond the high-water mark; the bound is typed like the column and reaches the scan."""
    if last_value is None:
        return df
    return df.filter(F.col(column) > dates.literal_like(df, column, last_value))


def high_water_mark(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("high_water_mark"))


# Name fragments that reveal the role of a column.
DATE_WORDS = ("date", "period", "time", "month", "year")
SKILL_WORDS = ("skill", "technology", "tool", "requirement", "description", "title")
DEMAND_WORDS = ("demand", "count", "frequency", "occurrences", "total")


@dataclass(frozen=True)
class Roles:
    date: str | None
    skill: str | None
    demand: str | None

    @property
    def complete(self) -> bool:
        return None not in (self.date, self.skill, self.demand)


def detect_roles(columns: Sequence[str]) -> Roles:
    """The first date-like column, and the last skill-like and demand-like ones."""

    def matching(words: Sequence[str]) -> list[str]:
        return [c for c in columns if any(w in c.lower() for w in words)]

    day, skill, demand = matching(DATE_WORDS), matching(SKILL_WORDS), matching(DEMAND_WORDS)
    return Roles(day[0] if day else None, skill[-1] if skill else None, demand[-1] if demand else None)


def detect_join_keys(left: Sequence[str], right: Sequence[str]) -> tuple[str | None, str, str]:
    """Skill key on both sides and the name column of the map, told by column names."""
    left_key = next(
        (c for c in left if "skill" in c.lower() and ("abr" in c.lower() or "id" in c.lower())), None
    )
    right_key = next((c for c in right if "abr" in c.lower() or c == left_key), right[0])
    name = next((c for c in right if "name" in c.lower()), None) or next(c for c in right if c != right_key)
    return left_key, right_key, name


def load_first_valid(
    spark: SparkSession, paths: Sequence[str], fallback: Callable[[], DataFrame], min_rows: int = 6,
    min_months: int = 12, multi_line: bool | None = None,
) -> tuple[DataFrame, str]:
    """Monthly demand from the first usable file in name order, else the fallback.

    Usable: date, skill and demand columns, at least ``min_rows`` dated and complete
    rows, and a span of ``min_months`` months. Each candidate is scanned once for that,
    and one aggregate row of it comes to the driver.
    """
    for path in sorted(paths):
        raw = spark.read.options(**QUOTED_CSV).csv(path, multiLine=_multi_line(spark, path, multi_line))
        roles = detect_roles(raw.columns)
        if not roles.complete:
            continue
        day = F.to_date(dates.parse_date(roles.date))
        complete = F.trim(F.col(roles.skill).cast("string")).isNotNull() & values.to_number(roles.demand).isNotNull()
        demand = projections.normalize_demand(raw, roles.date, roles.skill, roles.demand)
        check = raw.agg(
            F.count(day).alias("dated"), dates.month_gap(F.max(day), F.min(day)).alias("months"),
            F.count_if(day.isNotNull() & complete).alias("complete"),
        ).first()
        if check.dated < min_rows or check.months < min_months or check.complete < min_rows:
            continue
        monthly = aggregates.monthly_demand(demand)
        return projections.shape_skill_demand(monthly, "Global"), path
    return fallback(), "fallback"
