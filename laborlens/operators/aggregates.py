"""Counting and summing operators over listings, demand and forecasts.

Groups may be skewed: every aggregate here has a map-side partial step, so a hot
group reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T, Window as W

from ..functions import dates, text
from ..functions.vocab import TOTAL_SERIES
from . import filters
from .bounded import first_rows


def count_rows(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def count_if(df: DataFrame, predicate: Column, name: str = "n") -> DataFrame:
    return df.agg(F.count_if(predicate).alias(name))


def mid_salary(low: str = "salary_min", high: str = "salary_max") -> Column:
    """Middle of the range; NULL unless both bounds are present."""
    return (F.col(low) + F.col(high)) / 2


def mean_salary(low: str = "salary_min", high: str = "salary_max") -> Column:
    """Aggregate: mean of the range middles.

    The sum is exact (decimal), and halving and dividing happen once per group.
    """
    both = F.col(low) + F.col(high)
    return F.sum(both).cast("double") / 2 / F.count(both)


def avg_salary_value() -> Column:
    return F.coalesce(F.round(mean_salary(), 2), F.lit(0.0))


def avg_salary(df: DataFrame) -> DataFrame:
    return df.agg(avg_salary_value().alias("avg_salary"))


def top_by_count(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """Largest groups of a non-blank column; ties are ordered by name."""
    return (
        df.filter(filters.non_blank(column, trim=False))
        .groupBy(F.col(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "name")
        .limit(n)
    )


def listing_skill_counts(df: DataFrame, skills: str = "skills") -> DataFrame:
    """Count per token of the comma list; empty tokens are kept as ''."""
    tokens = df.filter(filters.non_blank(skills, trim=False)).select(F.explode(F.split(skills, ",")).alias("token"))
    return tokens.groupBy(F.trim("token").alias("name")).agg(F.count(F.lit(1)).alias("n"))


def top_skills_from_listings(df: DataFrame, n: int = 20, skills: str = "skills") -> DataFrame:
    return listing_skill_counts(df, skills).orderBy(F.desc("n"), "name").limit(n)


def dashboard_stats(df: DataFrame, top: int = 10, top_skill: int = 20) -> DataFrame:
    """Totals and three rankings as rows (section, name, value), counted in one pass.

    Each listing yields one cell for the totals, which alone carries the salaries, its industry, its location and its
    skills as they stand; the skill lists are split after they were counted.
    """
    both, remote = F.col("salary_min") + F.col("salary_max"), filters.is_true("is_remote").cast("int")

    def cell(section: str, name: Column, salaries: Column = F.lit(None), far: Column = F.lit(None)) -> Column:
        kind = df.select(both.alias("b")).schema["b"].dataType
        return F.struct(F.lit(section).alias("section"), name.cast("string").alias("name"), salaries.cast(kind).alias("both"), far.cast("int").alias("remote"))

    cells = [cell("totals", F.lit("all"), both, remote), *[cell(c, F.col(c)) for c in ("industry", "location", "skills")]]
    counted = (
        df.select(F.inline(F.array(*cells)))
        .filter((F.col("section") == "totals") | filters.non_blank("name", trim=False))
        .groupBy("section", "name")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("both").alias("salaries"), F.count("both").alias("paid"), F.sum("remote").alias("remote"))
    )
    is_list = F.col("section") == "skills"
    names = F.when(is_list, F.transform(F.split("name", ","), F.trim)).otherwise(F.array("name"))
    split = counted.select(F.when(is_list, "skill").otherwise(F.col("section")).alias("section"), F.explode(names).alias("name"), "n", "salaries", "paid", "remote").groupBy(
        "section", "name").agg(*[F.sum(c).alias(c) for c in ("n", "salaries", "paid", "remote")])
    average = F.coalesce(F.round(F.col("salaries").cast("double") / 2 / F.nullif("paid", F.lit(0)), 2), F.lit(0.0))
    known = split.select("section", "name", "n", average.alias("avg_salary"), F.coalesce("remote", F.lit(0)).alias("remote"))
    # without any listing the totals are zeros
    none = df.sparkSession.range(1).select(F.lit("totals"), F.lit("all"), F.lit(0).cast("bigint"), F.lit(0.0), F.lit(0).cast("bigint"))
    order = W.partitionBy("section").orderBy(F.desc("n"), "name")
    most = F.when(F.col("section") == "totals", 1).when(F.col("section") == "skill", top_skill).otherwise(top)
    ranked = known.union(none).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)

    def value(name: Column, number: Column) -> Column:
        return F.struct(name.alias("name"), number.cast("double").alias("value"))

    totals = F.array(*[value(F.lit(n), F.col(c)) for n, c in (("total_jobs", "n"), ("avg_salary", "avg_salary"), ("remote_jobs", "remote"))])
    return ranked.select("section", F.inline(F.when(F.col("section") == "totals", totals).otherwise(F.array(value(F.col("name"), F.col("n"))))))


def monthly_counts(df: DataFrame, ts: str, name: str = "n") -> DataFrame:
    return (
        df.filter(F.col(ts).isNotNull())
        .groupBy(dates.month_start(ts).alias("month"))
        .agg(F.count(F.lit(1)).alias(name))
    )


def skill_month_counts(df: DataFrame, ts: str, skills: str = "skills") -> DataFrame:
    """Postings per (month, skill); ``skills`` is an array whose repeats count once."""
    return (
        df.filter(F.col(ts).isNotNull())
        .select(dates.month_start(ts).alias("period_start"), F.explode(F.array_distinct(skills)).alias("skill_name"))
        .groupBy("period_start", "skill_name")
        .agg(F.count(F.lit(1)).alias("demand_count"))
    )


def skill_month_counts_with_total(df: DataFrame, ts: str, skills: str = "skills") -> DataFrame:
    """Skill counts and the monthly posting total in one pass over the postings.

    The total rides along as one more array element per posting.
    """
    tagged = df.withColumn(
        skills, F.concat(F.array_distinct(F.coalesce(skills, F.array().cast("array<string>"))), F.array(F.lit(TOTAL_SERIES)))
    )
    return skill_month_counts(tagged, ts, skills)


def monthly_demand(df: DataFrame, keys: Sequence[str] = ("skill_name",), value: str = "demand_count") -> DataFrame:
    """Demand summed per month and series; absent months stay absent."""
    return df.groupBy(dates.month_start("period_start").alias("period_start"), *keys).agg(
        F.sum(value).alias(value)
    )


def total_demand(df: DataFrame) -> DataFrame:
    """All series together per month, with the earliest period end."""
    return df.groupBy("period_start").agg(
        F.sum("demand_count").alias("count"), F.min("period_end").alias("period_end")
    )


def top_skills(df: DataFrame, n: int = 20) -> DataFrame:
    """Total demand per case-folded skill; missing demand counts as 0."""
    return (
        df.groupBy(F.lower("skill_name").alias("skill_name"))
        .agg(F.sum(F.coalesce("demand_count", F.lit(0))).alias("total_demand"))
        .orderBy(F.desc("total_demand"), "skill_name")
        .limit(n)
    )


FORECAST_POINT = ("forecast_date", "predicted_demand", "confidence_lower", "confidence_upper", "model_version")


def forecast_trends(df: DataFrame, n: int = 10) -> DataFrame:
    """The n skills of highest mean prediction with their points sorted by date.

    The ranking aggregates numbers only; points are collected afterwards for the
    n chosen skills (one entry per forecast date).
    """
    folded = df.withColumn("skill_name", F.lower("skill_name"))
    ranking = (
        folded.groupBy("skill_name")
        .agg(F.avg(F.coalesce("predicted_demand", F.lit(0.0))).alias("average_predicted_demand"))
        .orderBy(F.desc("average_predicted_demand"), "skill_name")
    )
    points = F.array_sort(F.collect_list(F.struct(*[c for c in FORECAST_POINT if c in df.columns])))
    return (
        folded.join(first_rows(ranking, n), "skill_name")
        .groupBy("skill_name", "average_predicted_demand")
        .agg(points.alias("forecasts"))
        .orderBy(F.desc("average_predicted_demand"), "skill_name")
    )


MAX_PREDICTIONS = 50  # fixed value: the serving limit


def predictions(df: DataFrame, n: int = 10, skill: str | None = None) -> DataFrame:
    """Mean of the predictions after each is rounded to 2 places; the total series is left out."""
    if not 1 <= n <= MAX_PREDICTIONS:
        raise ValueError(f"n must lie in 1..{MAX_PREDICTIONS}, got {n}")
    rows = filters.exclude_total(df)
    if skill is not None:
        rows = rows.filter(F.col("skill_name") == skill)
    # Summed as decimals: the values have two places, so the order cannot matter.
    cents = F.round("predicted_demand", 2).cast(T.DecimalType(18, 2))
    average = F.sum(cents).cast("double") / F.count(cents)
    return (
        rows.groupBy("skill_name")
        .agg(F.round(average, 2).alias("average_predicted_demand"))
        .orderBy(F.desc("average_predicted_demand"), "skill_name")
        .limit(n)
    )


def min_max_by_series(
    df: DataFrame, key: str = "skill_name", value: str = "predicted_demand", n: int = 10
) -> DataFrame:
    return (
        df.groupBy(key)
        .agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"))
        .orderBy(F.desc("max_value"), key)
        .limit(n)
    )


def top_pct(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """Largest groups of a column without NULL, with their share of all rows."""
    total = count_rows(df).scalar()
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("name"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "name")
        .limit(n)
        .withColumn("pct", F.round(F.col("n") / total * 100, 2))
    )


def latest_examples(df: DataFrame, month: str, n: int = 5) -> DataFrame:
    """Highest demand of one month."""
    return (
        df.filter(F.col("period_start") == F.lit(month).cast("date"))
        .orderBy(F.desc("demand_count"), "skill_name")
        .select("skill_name", "demand_count")
        .limit(n)
    )


def period_growth(df: DataFrame, start: str, n: int = 10) -> DataFrame:
    """Latest period and total demand per skill since a date, largest first."""
    return (
        filters.since(df, "period_start", start)
        .groupBy("skill_name")
        .agg(F.max("period_start").alias("latest_date"), F.sum("demand_count").alias("total_demand"))
        .orderBy(F.desc("total_demand"), "skill_name")
        .limit(n)
    )


def forecast_on(df: DataFrame, day: str, n: int = 5) -> DataFrame:
    """Largest predictions of one forecast date with their bounds."""
    return (
        df.filter(F.col("forecast_date") == F.lit(day).cast("date"))
        .orderBy(F.desc("predicted_demand"), "skill_name")
        .select("skill_name", "predicted_demand", "confidence_lower", "confidence_upper")
        .limit(n)
    )


def split_skills(df: DataFrame, skills: str = "skills") -> DataFrame:
    """The comma list as an array of distinct names, [] when blank."""
    items = F.coalesce(text.split_list(skills), F.array().cast("array<string>"))
    return df.withColumn(skills, F.array_distinct(items))
