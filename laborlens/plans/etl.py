"""Whole jobs composed of operators: raw postings to demand, forecasts and served tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates, text
from ..functions.vocab import DESCRIPTION_SKILLS, POSTING_SKILLS, SPIKE_MONTHS, TOTAL_SERIES
from ..operators import aggregates, joins, projections, sampling, setops
from . import forecast
from .tables import materialize


def posting_demand(
    raw: DataFrame, title: str = "job_title", body: str = "descriptions", listed: str = "listingDate",
    region: str = "Malaysia", vocabulary: Sequence[str] = POSTING_SKILLS,
) -> DataFrame:
    """Raw postings to the monthly demand table, skills taken from title and description."""
    tagged = raw.select(
        dates.parse_date(listed).alias("listed"),
        text.extract_skills(text.joined_text(title, body), vocabulary).alias("skills"),
    )
    return projections.shape_skill_demand(aggregates.skill_month_counts(tagged, "listed"), region)


def description_demand(
    raw: DataFrame, body: str = "Job Description", listed: str = "Job Posting Date",
    vocabulary: Sequence[str] = DESCRIPTION_SKILLS,
) -> DataFrame:
    """Monthly demand per skill and the monthly posting total, in one scan of the postings."""
    tagged = raw.filter(F.col(listed).isNotNull()).select(
        F.to_date(F.concat(text.month_key(listed), F.lit("-01"))).alias("listed"),
        text.extract_skills(body, vocabulary).alias("skills"),
    )
    return aggregates.skill_month_counts_with_total(tagged, "listed")


def sampled_listings(raw: DataFrame, total: int = 50_000, seed: int = 42) -> DataFrame:
    """A sample of listings, the same number from every month."""
    keyed = raw.withColumn("_month", text.month_key("Job Posting Date"))
    chosen = sampling.stratified_sample(keyed, "_month", total, ["Job Id"], seed)
    return projections.shape_job_listings(chosen.drop("_month"))


def mock_listings(demand: DataFrame, source: str) -> DataFrame:
    """One mock listing per fifty postings of a month, at least one."""
    months = aggregates.total_demand(demand)
    rows = sampling.repeat_rows(months, sampling.copies_per_fifty(F.col("count")))
    index = F.col("copy_index").cast("string")
    return rows.select(
        F.concat(F.lit("Job Title "), index).alias("title"),
        F.lit("Mock Company").alias("company"),
        F.lit("Remote").alias("location"),
        F.lit(50000).cast("decimal(10,2)").alias("salary_min"),
        F.lit(100000).cast("decimal(10,2)").alias("salary_max"),
        F.lit("USD").alias("salary_currency"),
        F.lit(source).alias("source"),
        F.concat(F.lit("job_"), F.date_format("period_start", "yyyyMMdd"), F.lit("_"), index).alias("source_id"),
        F.col("period_start").cast("timestamp").alias("posted_date"),
        F.lit("FT").alias("job_type"),
        F.lit("MI").alias("experience_level"),
        F.lit("General").alias("industry"),
        F.lit(True).alias("is_remote"),
        F.lit("Python,SQL").alias("skills"),
    )


def with_total_series(demand: DataFrame) -> DataFrame:
    """Demand rows plus the total of all series under its own key."""
    total = demand.groupBy("period_start").agg(F.sum("demand_count").alias("demand_count"))
    return setops.union_all([
        demand.select("skill_name", "period_start", "demand_count"),
        total.select(F.lit(TOTAL_SERIES).alias("skill_name"), "period_start", "demand_count"),
    ])


def forecast_table(
    demand: DataFrame, start: str | Column, end: str | Column, spike_months: Sequence[str] = SPIKE_MONTHS,
    region: str = "Global",
) -> DataFrame:
    """The stored forecast table: linear model, capped to five times the historical maximum.

    The demand table is written first, as the fit, its time origin and the cap all read it.
    """
    demand = materialize(demand, "skill-demand")
    predicted = forecast.linreg_forecast(demand, start, end, spike_months)
    capped = joins.cap_to_history(predicted, demand)
    return capped.withColumn("region", F.lit(region))


def clean_postings(postings: DataFrame, text_columns: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Clean text, drop incomplete rows and keep the latest row per key."""
    cleaned = projections.standardize_text(postings, text_columns, keys)
    return setops.dedupe_latest(cleaned, keys, order)
