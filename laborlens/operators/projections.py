"""Row mappings: each function takes a DataFrame and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import dates, text, values
from ..functions.vocab import DESCRIPTION_SKILLS, LISTING_SOURCE, WORK_TYPES
from ..schemas import LISTING_LENGTHS, MONEY


def normalize_demand(
    df: DataFrame, date_col: str, skill_col: str, demand_col: str,
    region: str = "Global", industry: str = "General",
) -> DataFrame:
    """Three role columns to the demand layout; rows with any part missing are dropped."""
    parts = F.struct(
        F.to_date(dates.parse_date(date_col)).alias("period_start"),
        F.trim(F.col(skill_col).cast("string")).alias("skill_name"),
        values.to_number(demand_col).alias("demand_count"),
    )
    return (
        # inline keeps the optimizer from parsing a date once more in the filter
        df.select(F.inline(F.array(parts)))
        .dropna()
        .withColumn("period_end", dates.month_end("period_start"))
        .withColumn("region", F.lit(region))
        .withColumn("industry", F.lit(industry))
    )


def shape_skill_demand(df: DataFrame, region: str, industry: str = "General") -> DataFrame:
    return df.select(
        "period_start",
        dates.month_end("period_start").alias("period_end"),
        "skill_name",
        "demand_count",
        F.lit(region).alias("region"),
        F.lit(industry).alias("industry"),
    )


def shape_job_listings(
    raw: DataFrame, vocabulary: Sequence[str] = DESCRIPTION_SKILLS, source: str = LISTING_SOURCE,
) -> DataFrame:
    """Raw posting text columns to the 14 listing columns; a salary too large for its column is NULL."""
    low, high = values.salary_bounds("Salary Range")

    def text_or_blank(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    return raw.select(
        text_or_blank("Job Title").alias("title"),
        text_or_blank("Company").alias("company"),
        text_or_blank("location").alias("location"),
        low.try_cast(MONEY).alias("salary_min"),
        high.try_cast(MONEY).alias("salary_max"),
        F.lit("USD").alias("salary_currency"),
        F.lit(source).alias("source"),
        F.col("Job Id").alias("source_id"),
        dates.parse_date("Job Posting Date").alias("posted_date"),
        values.map_values("Work Type", WORK_TYPES).alias("job_type"),
        values.experience_level("Experience").alias("experience_level"),
        F.lit("General").alias("industry"),
        values.is_remote("location").alias("is_remote"),
        text.join_list(text.extract_skills("Job Description", vocabulary)).alias("skills"),
    )


def listing_view(df: DataFrame) -> DataFrame:
    """Listing rows as served: the skill text becomes an array."""
    return df.select(
        "id", "title", "company", "location", "salary_min", "salary_max", "salary_currency",
        "source", "posted_date", "job_type", "experience_level", "industry", "is_remote",
        text.split_list("skills").alias("skills"),
    )


def demand_view(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.col("skill_name").alias("skillName"),
        F.col("demand_count").alias("demandCount"),
        F.col("period_start").alias("periodStart"),
        F.col("period_end").alias("periodEnd"),
        "region",
        "industry",
    )


def forecast_view(df: DataFrame) -> DataFrame:
    return df.select(
        "id",
        F.col("skill_name").alias("skillName"),
        F.col("forecast_date").alias("forecastDate"),
        F.col("predicted_demand").alias("predictedDemand"),
        F.col("confidence_lower").alias("confidenceLower"),
        F.col("confidence_upper").alias("confidenceUpper"),
        F.col("model_version").alias("modelVersion"),
        "region",
    )


def with_salary_label(
    df: DataFrame, low: str = "salary_min", high: str = "salary_max", currency: str = "salary_currency",
    name: str = "salary_label",
) -> DataFrame:
    return df.withColumn(name, values.format_salary(low, high, currency))


def with_month_label(df: DataFrame, date_col: str, name: str = "month_label") -> DataFrame:
    return df.withColumn(name, dates.month_label(date_col))


FORECAST_VALUES = ("predicted_demand", "confidence_lower", "confidence_upper")


def round_forecasts(df: DataFrame, scale: int = 2, columns: Sequence[str] = FORECAST_VALUES) -> DataFrame:
    """Half-up rounding: 2 places when served, 4 when stored."""
    return df.withColumns({name: F.round(name, scale) for name in columns})


def with_model_metadata(df: DataFrame, version: str, region: str = "Global") -> DataFrame:
    return df.withColumns({"model_version": F.lit(version), "region": F.lit(region)})


def unpivot_bounds(df: DataFrame, key: str = "skill_name", date_col: str = "forecast_date") -> DataFrame:
    """One row per (series, date, line) where line is upper, lower or predicted."""
    lines = df.select(
        key,
        date_col,
        F.col("confidence_upper").alias("upper"),
        F.col("confidence_lower").alias("lower"),
        F.col("predicted_demand").alias("predicted"),
    )
    return lines.unpivot([key, date_col], ["upper", "lower", "predicted"], "line", "value")


def standardize_text(df: DataFrame, columns: Sequence[str], required: Sequence[str] = ()) -> DataFrame:
    """Lower-case and trim the columns, drop incomplete rows and exact duplicates.

    Duplicates are found by a digest of the whole row, so long texts are no shuffle or sort keys.
    """
    cleaned = df.withColumns({name: text.clean_text(name) for name in columns}).dropna(subset=list(required or columns))
    digest = F.sha2(F.to_json(F.struct("*")), 256)
    return cleaned.withColumn("_digest", digest).dropDuplicates(["_digest"]).drop("_digest")


def mask_columns(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    """Replace values by a salted SHA-256; NULL stays NULL."""
    return df.withColumns(
        {name: F.sha2(F.concat(F.lit(salt), F.col(name).cast("string")), 256) for name in columns}
    )


def length_violations(df: DataFrame, limits: dict[str, int] = LISTING_LENGTHS) -> DataFrame:
    """Number of rows per column whose text is longer than the table allows."""
    present = [name for name in limits if name in df.columns]
    counted = df.agg(*[F.count_if(F.length(name) > limits[name]).alias(name) for name in present])
    return counted.unpivot([], present, "column_name", "violations")
