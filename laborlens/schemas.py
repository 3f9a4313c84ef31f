"""Explicit schemas of the tables at rest and of the raw inputs."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The column, file and message names and types below must match the data.
MONEY = T.DecimalType(10, 2)

JOB_LISTINGS = _struct(
    ("title", T.StringType()),
    ("company", T.StringType()),
    ("location", T.StringType()),
    ("salary_min", MONEY),
    ("salary_max", MONEY),
    ("salary_currency", T.StringType()),
    ("source", T.StringType()),
    ("source_id", T.StringType()),
    ("posted_date", T.TimestampType()),
    ("job_type", T.StringType()),
    ("experience_level", T.StringType()),
    ("industry", T.StringType()),
    ("is_remote", T.BooleanType()),
    ("skills", T.StringType()),
)

SKILL_DEMAND = _struct(
    ("skill_name", T.StringType()),
    ("demand_count", T.IntegerType()),
    ("period_start", T.DateType()),
    ("period_end", T.DateType()),
    ("region", T.StringType()),
    ("industry", T.StringType()),
)

FORECAST_RESULTS = _struct(
    ("skill_name", T.StringType()),
    ("forecast_date", T.DateType()),
    ("predicted_demand", T.DoubleType()),
    ("confidence_lower", T.DoubleType()),
    ("confidence_upper", T.DoubleType()),
    ("model_version", T.StringType()),
    ("region", T.StringType()),
)

# Every column of the raw postings CSV arrives as text.
RAW_POSTING_COLUMNS = (
    "Job Id",
    "Job Title",
    "Role",
    "Company",
    "location",
    "Country",
    "Salary Range",
    "Work Type",
    "Job Posting Date",
    "skills",
    "Job Description",
    "Experience",
)

TREND_POINT = _struct(
    ("date", T.StringType()),
    ("count", T.DoubleType()),
    ("confidenceLower", T.DoubleType()),
    ("confidenceUpper", T.DoubleType()),
)
TREND_DOCUMENT = _struct(
    ("historical", T.ArrayType(TREND_POINT)),
    ("predicted", T.ArrayType(TREND_POINT)),
)

# The message fields are read as text first: the coercion rules differ by field
# and need to see the original token (a JSON true is not the text "true").
POSTING_MESSAGE_FIELDS = (
    "jobId",
    "title",
    "company",
    "location",
    "salaryMin",
    "salaryMax",
    "salaryCurrency",
    "source",
    "sourceId",
    "postedDate",
    "jobType",
    "experienceLevel",
    "industry",
    "isRemote",
    "skills",
)

# Column limits of the listing table; overflow is a data-quality failure.
LISTING_LENGTHS = {
    "title": 500,
    "company": 255,
    "location": 255,
    "salary_currency": 3,
    "source": 100,
    "source_id": 255,
    "job_type": 50,
    "experience_level": 50,
    "industry": 100,
}
