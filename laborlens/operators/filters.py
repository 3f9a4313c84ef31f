"""Predicates and row filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions.dates import literal_like
from ..functions.vocab import TOTAL_SERIES

Day = str | dt.date | dt.datetime


def not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def non_blank(column: str, trim: bool = True) -> Column:
    """Present and not empty. The listing tables compare untrimmed text, the profiles trim."""
    value = F.col(column)
    return value.isNotNull() & ((F.trim(value) if trim else value) != "")


def contains_ci(column: str, needle: str) -> Column:
    """Case-insensitive substring test; the needle is taken literally."""
    return F.lower(F.col(column)).contains(needle.lower())


def equals_ci(column: str, value: str) -> Column:
    return F.lower(F.col(column)) == value.lower()


def is_true(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False))


def all_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, predicates, F.lit(True))


def search_jobs(
    df: DataFrame, title: str | None = None, location: str | None = None, industry: str | None = None,
    experience_level: str | None = None, is_remote: bool | None = None,
) -> DataFrame:
    """All given criteria together; a blank criterion counts as absent."""
    predicates = []
    if title and title.strip():
        predicates.append(contains_ci("title", title))
    exact = {"location": location, "industry": industry, "experience_level": experience_level}
    predicates += [equals_ci(name, value) for name, value in exact.items() if value and value.strip()]
    if is_remote:
        predicates.append(is_true("is_remote"))
    return df.filter(all_of(predicates))


def search_demand(df: DataFrame, skill: str | None = None, region: str | None = None) -> DataFrame:
    predicates = []
    if skill and skill.strip():
        predicates.append(contains_ci("skill_name", skill))
    if region and region.strip():
        predicates.append(equals_ci("region", region))
    return df.filter(all_of(predicates))


def by_id(df: DataFrame, value, column: str = "id") -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def date_between(df: DataFrame, column: str, start: Day, end: Day) -> DataFrame:
    """Both ends included; the bounds are typed like the column and reach the scan."""
    return df.filter(F.col(column).between(literal_like(df, column, start), literal_like(df, column, end)))


def since(df: DataFrame, column: str, start: Day) -> DataFrame:
    return df.filter(F.col(column) >= literal_like(df, column, start))


def exclude_total(df: DataFrame, key: str = "skill_name") -> DataFrame:
    return df.filter(F.col(key) != TOTAL_SERIES)


def only_total(df: DataFrame, key: str = "skill_name") -> DataFrame:
    return df.filter(F.col(key) == TOTAL_SERIES)


def in_months(column: str, months: Sequence[str]) -> Column:
    """Whether the date is one of the given month starts; never NULL for a set date."""
    return F.col(column).isin([F.lit(m).cast("date") for m in months]) if months else F.lit(False)


def exclude_periods(
    df: DataFrame, months: Sequence[str], key: str | Sequence[str] = "skill_name",
    date_col: str = "period_start", min_rows: int = 3,
) -> DataFrame:
    """Drop the listed months, unless a series would keep fewer than ``min_rows`` rows."""
    listed = in_months(date_col, months)
    kept = F.count_if(~listed).over(W.partitionBy(key))
    return df.withColumn("_kept", kept).filter((F.col("_kept") < min_rows) | ~listed).drop("_kept")


def min_series_length(df: DataFrame, n: int, key: str | Sequence[str] = "skill_name") -> DataFrame:
    size = F.count(F.lit(1)).over(W.partitionBy(key))
    return df.withColumn("_n", size).filter(F.col("_n") >= n).drop("_n")


def advanced_search(
    df: DataFrame, skills: Sequence[str] = (), regions: Sequence[str] = (), industries: Sequence[str] = (),
    companies: Sequence[str] = (), salary_min: float | None = None, salary_max: float | None = None,
    posted_after: Day | None = None,
) -> DataFrame:
    """Any-of lists, a salary range and a posting date, all that are given together.

    ``skills`` is matched against an array column of the same name.
    """
    predicates = []
    if skills:
        predicates.append(F.arrays_overlap("skills", F.array(*[F.lit(s) for s in skills])))
    lists = {"region": regions, "industry": industries, "company": companies}
    for name, wanted in lists.items():
        if wanted:
            predicates.append(F.col(name).isin(list(wanted)))
    if salary_min is not None:
        predicates.append(F.col("salary_min") >= salary_min)
    if salary_max is not None:
        predicates.append(F.col("salary_max") <= salary_max)
    if posted_after is not None:
        predicates.append(F.col("posted_date") > literal_like(df, "posted_date", posted_after))
    return df.filter(all_of(predicates))


def search_page(matched: DataFrame, order: Sequence[Column | str], limit: int, offset: int = 0) -> DataFrame:
    """One page of a search with ``total``, the number of all matches, in every row."""
    total = matched.agg(F.count(F.lit(1))).scalar()
    return matched.orderBy(*order).offset(offset).limit(limit).withColumn("total", total)


def salary_valid(low: str = "salary_min", high: str = "salary_max") -> Column:
    """A present bound is positive and the bounds are in order."""
    lower, upper = F.col(low), F.col(high)
    return (
        F.coalesce(lower > 0, F.lit(True))
        & F.coalesce(upper > 0, F.lit(True))
        & F.coalesce(lower <= upper, F.lit(True))
    )


def validate_salary(df: DataFrame, low: str = "salary_min", high: str = "salary_max") -> DataFrame:
    return df.filter(salary_valid(low, high))


def spam_score(rules: Sequence[tuple[Column, float]]) -> Column:
    """Sum of the weights of the rules that hold."""
    return reduce(
        lambda total, rule: total + F.when(rule[0], rule[1]).otherwise(0.0), rules, F.lit(0.0)
    )


def drop_spam(df: DataFrame, rules: Sequence[tuple[Column, float]], threshold: float) -> DataFrame:
    return df.filter(spam_score(rules) < threshold)


def search_skills(
    df: DataFrame, query: str, limit: int = 20, category: str | None = None, key: str = "skill_name",
    demand: str = "demand", offset: int = 0,
) -> DataFrame:
    """Names containing the query with an edit-distance score, most demanded first; ``total`` counts all of them."""
    name = F.lower(F.col(key))
    wanted = F.lit(query.lower())
    score = 1 - F.levenshtein(name, wanted) / F.greatest(F.length(name), F.length(wanted))
    matched = df.filter(contains_ci(key, query))
    if category is not None:
        matched = matched.filter(equals_ci("category", category))
    return search_page(matched.withColumn("match_score", F.round(score, 4)), [F.desc(demand), key], limit, offset)
