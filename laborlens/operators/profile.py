"""Profiling: column statistics, quality verdicts, seasonality and spikes.

Statistics over raw tables are plain aggregates or ``exact_percentiles``. The
built-in ``percentile`` is used only on demand tables (one row per series and month).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions import dates
from . import joins
from .quantiles import exact_percentiles
from .windows import beyond_sigma

KEY, DATE, VALUE = "skill_name", "period_start", "demand_count"


def series_stats(df: DataFrame, key: str = KEY, value: str = VALUE) -> DataFrame:
    """Mean, max, min, sample deviation and length per series, highest mean first."""
    return (
        df.groupBy(key)
        .agg(
            F.avg(value).alias("mean"),
            F.max(value).alias("max"),
            F.min(value).alias("min"),
            F.stddev_samp(value).alias("std"),
            F.count(value).alias("count"),
        )
        .orderBy(F.desc("mean"), key)
    )


def describe(df: DataFrame, column: str) -> DataFrame:
    """count, mean, std, min, quartiles and max of a column, as one row."""
    quartiles = exact_percentiles(df, [column], [0.25, 0.5, 0.75]).select("percentiles").scalar()
    return df.agg(
        F.count(column).alias("count"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
        F.min(column).cast("double").alias("min"),
        F.max(column).cast("double").alias("max"),
    ).withColumn("_q", quartiles).select(
        "count", "mean", "std", "min",
        *[F.col("_q")[i].alias(name) for i, name in enumerate(("p25", "p50", "p75"))],
        "max",
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Percent of NULLs per column, all columns in one pass."""
    shares = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns])
    return shares.unpivot([], df.columns, "column_name", "share").select(
        "column_name", F.round(F.coalesce("share", F.lit(0.0)) * 100, 2).alias("null_pct")
    )


def table_overview(df: DataFrame, order: Sequence[str], samples: int = 3, width: int = 60) -> DataFrame:
    """Per column: table size, share of NULLs and the values of the first rows in the given order."""
    columns = df.columns
    shape = df.agg(F.count(F.lit(1))).scalar()

    def shown(column: str) -> Column:
        text = F.coalesce(F.left(F.col(column).cast("string"), F.lit(width)), F.lit("NULL"))
        return _in_order(F.struct(*order, text.alias("_v")))

    heads = (
        df.orderBy(*order)
        .limit(samples)
        .agg(F.create_map(*[part for c in columns for part in (F.lit(c), shown(c))]))
        .scalar()
    )
    return null_profile(df).select(
        "column_name",
        shape.alias("row_count"),
        F.lit(len(columns)).alias("column_count"),
        "null_pct",
        F.element_at(heads, F.col("column_name")).alias("samples"),
    )


def _in_order(entry: Column) -> Column:
    """Aggregate over a few rows: the ``_v`` field of the entries, sorted by the fields before it."""
    return F.transform(F.array_sort(F.collect_list(entry)), lambda e: e["_v"])


def value_counts(df: DataFrame, column: str, with_null: bool = True) -> DataFrame:
    """Count per value and its percentage of all rows; NULL is a group of its own."""
    total = df.agg(F.count(F.lit(1))).scalar()
    rows = df if with_null else df.filter(F.col(column).isNotNull())
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("pct", F.col("n") / total * 100)


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill rate, min, max, mean, median and percentiles, one row per column.

    The simple statistics of all columns share one pass, and so do the percentiles.
    """
    stats = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(c).alias("filled"),
            (F.count(c) / F.count(F.lit(1)) * 100).alias("fill_pct"),
            F.min(c).cast("double").alias("min"),
            F.max(c).cast("double").alias("max"),
            F.avg(c).cast("double").alias("mean"),
        )
        for c in columns
    ]
    simple = df.agg(F.array(*stats).alias("_stats")).select(F.inline("_stats"))
    quartiles = exact_percentiles(df, columns, [0.25, 0.5, 0.75, 0.95])
    names = ("p25", "median", "p75", "p95")
    named = quartiles.select("column_name", *[F.col("percentiles")[i].alias(n) for i, n in enumerate(names)])
    # one row per profiled column on both sides
    return simple.join(F.broadcast(named), "column_name", "left")


def text_profile(df: DataFrame, column: str, order: Sequence[str], samples: int = 3, width: int = 200) -> DataFrame:
    """Present and non-blank counts and the first non-blank texts in the given order."""
    filled = F.trim(F.col(column)) != ""
    heads = (
        df.filter(filled)
        .orderBy(*order)
        .limit(samples)
        .agg(_in_order(F.struct(*order, F.left(column, F.lit(width)).alias("_v"))))
        .scalar()
    )
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.count(column).alias("non_null"), F.count_if(filled).alias("non_empty")
    ).select("rows", "non_null", "non_empty", heads.alias("samples"))


def parsed_timestamp(df: DataFrame, column: str) -> Column:
    """The column as a timestamp: epoch ms or s told by its largest value, else ISO text."""
    kind = df.schema[column].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        return F.col(column)
    if kind == "string":
        return dates.parse_date(column)
    in_ms = df.agg(F.max(column) > dates.EPOCH_MS_FLOOR).scalar()
    return F.when(in_ms, dates.parse_date(column, "epoch_ms")).otherwise(dates.parse_date(column, "epoch_s"))


def timestamp_profile(df: DataFrame, column: str) -> DataFrame:
    """Present rows, range and number of distinct months of a date-like column."""
    parsed = df.select(F.col(column).alias("_raw"), parsed_timestamp(df, column).alias("_ts"))
    return parsed.agg(
        F.count("_raw").alias("non_null"),
        F.min("_ts").alias("min_ts"),
        F.max("_ts").alias("max_ts"),
        F.count_distinct(dates.month_start("_ts")).alias("months"),
    )


def monthly_distribution(df: DataFrame, column: str, last: int = 15, width: int = 30) -> DataFrame:
    """Rows per month with a bar relative to the busiest month; the last months, ascending."""
    parsed = df.select(dates.month_start(parsed_timestamp(df, column)).alias("month"))
    counts = parsed.filter(F.col("month").isNotNull()).groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    peak = counts.agg(F.max("n")).scalar()
    bars = counts.withColumn("bar_length", F.greatest(F.lit(1), F.floor(F.col("n") / peak * width)).cast("int"))
    return bars.orderBy(F.desc("month")).limit(last).orderBy("month")


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column. Each column is reduced on its own, never expanded together."""
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return counted.unpivot([], list(columns), "column_name", "distinct_values")
    parts = [
        df.select(c).filter(F.col(c).isNotNull()).distinct()
        .agg(F.count(F.lit(1)).alias("distinct_values"))
        .select(F.lit(c).alias("column_name"), "distinct_values")
        for c in columns
    ]
    return reduce(DataFrame.unionByName, parts)


def counts_per_period(df: DataFrame, ts: str, grain: str = "day", by: Sequence[str] = ()) -> DataFrame:
    """Rows per day, week, month or year, also by further columns."""
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(dates.period_start(ts, grain).alias("period"), *by)
        .agg(F.count(F.lit(1)).alias("n"))
    )


def volume_stats(df: DataFrame, ts: str, grain: str = "day") -> DataFrame:
    """Mean, minimum and maximum of the counts per period."""
    return counts_per_period(df, ts, grain).agg(
        F.avg("n").alias("avg_n"), F.min("n").alias("min_n"), F.max("n").alias("max_n")
    )


def value_by_period(df: DataFrame, ts: str, value: str, grain: str = "day") -> DataFrame:
    """Mean and count of a value per period over the rows that have it."""
    return (
        df.filter(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .groupBy(dates.period_start(ts, grain).alias("period"))
        .agg(F.avg(value).cast("double").alias("mean"), F.count(F.lit(1)).alias("n"))
    )


def date_span(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts")).withColumn(
        "span_days", F.datediff("max_ts", "min_ts")
    )


def zero_filled(df: DataFrame, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """The pivot kept long: every series on every month of the table, mean of repeats, missing 0."""
    cells = df.groupBy(key, date_col).agg(F.avg(value).alias(value))
    return joins.align_on_dates(cells, key, date_col, value).fillna(0.0, subset=[value])


def pivot_series(
    df: DataFrame, series: Sequence[str], key: str = KEY, date_col: str = DATE, value: str = VALUE
) -> DataFrame:
    """Month by series matrix. The series are named by the caller, so no extra pass looks for them."""
    wide = df.groupBy(date_col).pivot(key, list(series)).agg(F.avg(value))
    return wide.fillna(0.0, subset=list(series))


def month_pattern(df: DataFrame, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Mean, sample deviation and count per month of the year."""
    return df.groupBy(F.month(date_col).alias("month")).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.count(value).alias("count")
    )


def month_seasonality(df: DataFrame, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Seasonal strength in percent, and the peak and trough month (the earlier one on ties)."""
    pattern = month_pattern(df, date_col, value)
    low, high = F.min("mean"), F.max("mean")
    return pattern.agg(
        ((high - low) / F.avg("mean") * 100).alias("strength_pct"),
        F.max_by("month", F.struct(F.col("mean"), -F.col("month"))).alias("peak_month"),
        F.min_by("month", F.struct("mean", "month")).alias("trough_month"),
    )


def completeness(df: DataFrame, key: str = KEY, date_col: str = DATE, sparse_below: int = 10) -> DataFrame:
    """Periods per series against all periods of the table."""
    expected = df.select(date_col).distinct().agg(F.count(F.lit(1))).scalar()
    sized = df.groupBy(key).agg(F.count(F.lit(1)).alias("periods"))
    return sized.select(
        key,
        "periods",
        expected.alias("expected"),
        (F.col("periods") == expected).alias("is_complete"),
        (F.col("periods") < sparse_below).alias("is_sparse"),
    )


def spike_periods(df: DataFrame, k: float = 3.0, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Months whose mean over all series exceeds k times the median of the monthly means."""
    means = df.groupBy(date_col).agg(F.avg(value).alias("avg_demand"))
    middle = means.agg(F.median("avg_demand")).scalar()
    return means.filter(F.col("avg_demand") > middle * k)


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width counts; the last bin is closed, empty bins are left out."""
    edges = df.agg(F.struct(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))).scalar()
    value = F.col(column).cast("double")
    width = (edges["hi"] - edges["lo"]) / bins
    # a constant column has no width and falls into the first bin
    position = F.coalesce(F.floor(F.try_divide(value - edges["lo"], width)) + 1, F.lit(1))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.least(position, F.lit(bins)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bin", (edges["lo"] + (F.col("bin") - 1) * width).alias("bin_start"), "n")
    )


def _verdict(score: Column, excellent: Column, moderate: Column, sparse: bool) -> Column:
    low, high = ("MODERATE - sparse", "POOR - very sparse") if sparse else ("MODERATE", "POOR")
    return F.when(excellent, "EXCELLENT").when(moderate, low).otherwise(high)


def dataset_scorecard(
    postings: DataFrame, job_skills: DataFrame, ts: str, salary: str, remote: str
) -> DataFrame:
    """Fitness of the data for four uses as rows (use_case, measure, months, verdict)."""
    filled = postings.agg(
        (F.count(ts) / F.count(F.lit(1)) * 100).alias("dated"),
        F.count_distinct(dates.month_start(parsed_timestamp(postings, ts))).alias("months"),
        (F.count(salary) / F.count(F.lit(1)) * 100).alias("salary"),
        (F.count(remote) / F.count(F.lit(1)) * 100).alias("remote"),
    )
    skill_rows = job_skills.agg(F.count(F.lit(1))).scalar().cast("double")
    none = F.lit(None).cast("bigint")
    months, dated, paid, flagged = (F.col(c) for c in ("months", "dated", "salary", "remote"))
    cards = F.array(
        F.struct(
            F.lit("monthly_listing_series").alias("use_case"), dated.alias("measure"), months.alias("months"),
            _verdict(dated, (months >= 12) & (dated > 80), months >= 6, False).alias("verdict"),
        ),
        F.struct(
            F.lit("skill_demand_series").alias("use_case"), skill_rows.alias("measure"), none.alias("months"),
            _verdict(skill_rows, skill_rows > 10_000, skill_rows > 1_000, False).alias("verdict"),
        ),
        F.struct(
            F.lit("salary_analysis").alias("use_case"), paid.alias("measure"), none.alias("months"),
            _verdict(paid, paid > 50, paid > 10, True).alias("verdict"),
        ),
        F.struct(
            F.lit("remote_analysis").alias("use_case"), flagged.alias("measure"), none.alias("months"),
            _verdict(flagged, flagged > 50, flagged > 20, True).alias("verdict"),
        ),
    )
    return filled.select(F.inline(cards))


def tier_counts(traits: DataFrame) -> DataFrame:
    """Series per volatility tier and per trend tier, from the output of ``characterize``."""
    volatility = (
        F.when(F.col("volatility") > 0.5, "high").when(F.col("volatility") > 0.3, "medium").otherwise("low")
    )
    trend = (
        F.when(F.col("trend_slope") > 0.05, "increasing")
        .when(F.col("trend_slope") < -0.05, "decreasing")
        .otherwise("stable")
    )
    tiers = F.array(
        F.struct(F.lit("volatility").alias("tier_kind"), volatility.alias("tier")),
        F.struct(F.lit("trend").alias("tier_kind"), trend.alias("tier")),
    )
    return traits.select(F.inline(tiers)).groupBy("tier_kind", "tier").agg(F.count(F.lit(1)).alias("n"))


def indexed(df: DataFrame, key: str = KEY, date_col: str = DATE) -> DataFrame:
    """The 0-based row index of each point within its series."""
    return df.withColumn("x", (F.row_number().over(W.partitionBy(key).orderBy(date_col)) - 1).cast("double"))


def characterize(df: DataFrame, top: int = 15, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Level, spread, trend and outliers of the top series by mean, on the zero-filled table.

    Series with fewer than three positive values are skipped.
    """
    # the ranking uses the recorded rows, the traits the zero-filled ones
    chosen = series_stats(df, key, value).select(key).limit(top)
    filled = indexed(joins.restrict_to_top(zero_filled(df, key, date_col, value), chosen, key, top), key, date_col)
    mean, std = F.avg(value), F.stddev_samp(value)
    return (
        filled.withColumn("_away", beyond_sigma(value, 3.0, key))
        .groupBy(key)
        .agg(
            mean.alias("mean"),
            std.alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.regr_slope(value, "x").alias("trend_slope"),
            F.regr_r2(value, "x").alias("trend_r2"),
            F.when(mean > 0, std / mean).otherwise(0.0).alias("volatility"),
            F.count_if("_away").alias("outliers_count"),
            F.count(F.lit(1)).alias("length"),
            F.count_if(F.col(value) > 0).alias("_positive"),
        )
        .filter(F.col("_positive") >= 3)
        .drop("_positive")
    )


def trend_line(df: DataFrame, top: int = 5, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Value and fitted straight line per month for the top series by mean."""
    chosen = series_stats(df, key, value).select(key).limit(top)
    filled = indexed(joins.restrict_to_top(zero_filled(df, key, date_col, value), chosen, key, top), key, date_col)
    whole = W.partitionBy(key)
    slope = F.regr_slope(value, "x").over(whole)
    intercept = F.regr_intercept(value, "x").over(whole)
    return filled.select(key, date_col, value, (intercept + slope * F.col("x")).alias("fitted"))


def spike_summary(
    df: DataFrame, months: Sequence[str], since: str, n: int = 5, key: str = KEY, date_col: str = DATE,
    value: str = VALUE,
) -> DataFrame:
    """Statistics of the n series of highest peak, and which spike months they have."""
    listed = F.col(date_col).isin([F.lit(m).cast("date") for m in months])
    recent = F.col(date_col) >= F.lit(since).cast("date")
    # at most one entry per listed month
    present = F.array_sort(F.collect_set(F.when(listed, F.date_format(date_col, "yyyy-MM"))))
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
            F.avg(value).alias("mean"),
            F.avg(F.when(recent, F.col(value))).alias("mean_since"),
            F.when(F.size(present) > 0, F.array_join(present, ",")).otherwise("none").alias("spike_months"),
        )
        .orderBy(F.desc("max"), key)
        .limit(n)
    )
