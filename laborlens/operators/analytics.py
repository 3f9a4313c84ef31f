"""Market reports over postings.

``postings`` has posted_date, title, company, location, region, industry, source,
salary_min, salary_max and ``skills`` as an array. Reports are aggregates with a
map-side step; ranked lists inside a group are cut to k before they are collected.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions import dates
from ..functions.values import pct_change
from ..plans.tables import materialize
from .aggregates import mean_salary, mid_salary
from .quantiles import exact_percentiles


def _count() -> Column:
    return F.count(F.lit(1))


def _as_of(value) -> Column:
    return F.lit(value).cast("date")


def _within(as_of: Column, newest: int, oldest: int, ts: str = "posted_date") -> Column:
    """Posted in (as_of − oldest, as_of − newest] days."""
    day = F.col(ts).cast("date")
    return (day <= F.date_sub(as_of, newest)) & (day > F.date_sub(as_of, oldest))


def growth_value(as_of: Column, days: int, ts: str = "posted_date") -> Column:
    """Aggregate: percent change of the last ``days`` days against the days before."""
    recent = F.count_if(_within(as_of, 0, days, ts)).cast("double")
    before = F.count_if(_within(as_of, days, 2 * days, ts)).cast("double")
    return pct_change(recent, before)


def direction(value: Column) -> Column:
    return F.when(value > 0, "up").when(value < 0, "down").otherwise("flat")


def exploded(postings: DataFrame, *keep: str) -> DataFrame:
    """One row per posting and distinct skill."""
    return postings.select(*keep, F.explode(F.array_distinct("skills")).alias("skill"))


def _lagged(value: str, period: str, grain: str, keys: Sequence[str] = ()) -> Column:
    """The value one period earlier, found by date so that a missing period gives NULL."""
    step = {
        "day": F.unix_date(F.col(period)),
        "week": F.floor((F.unix_date(F.col(period)) + 3) / 7),
        "month": dates.month_index(period),
    }[grain]
    return F.max(value).over(W.partitionBy(*keys).orderBy(step).rangeBetween(-1, -1))


def demand_trends(postings: DataFrame, grain: str = "day", skill: str | None = None, region: str | None = None,
                  industry: str | None = None) -> DataFrame:
    """Per period: postings, mean salary, growth against the period before, distinct sources."""
    rows = postings
    if skill is not None:
        rows = rows.filter(F.array_contains("skills", skill))
    for column, value in (("region", region), ("industry", industry)):
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    per_period = rows.groupBy(dates.period_start("posted_date", grain).alias("period")).agg(
        _count().alias("n"), mean_salary().alias("avg_salary"), F.count_distinct("source").alias("source_count")
    )
    # one row per period: the unpartitioned window is bounded by the calendar
    before = _lagged("n", "period", grain).cast("double")
    return per_period.withColumn("growth_rate", pct_change(F.col("n").cast("double"), before))


def trend_summary(postings: DataFrame, as_of) -> DataFrame:
    """Total, mean salary, 90-day growth and its direction, as one row."""
    day = _as_of(as_of)
    return postings.agg(
        _count().alias("total_postings"), mean_salary().alias("avg_salary"), growth_value(day, 90).alias("growth_90d")
    ).withColumn("trend_direction", direction(F.col("growth_90d")))


def _cells(postings: DataFrame, as_of, kinds: Sequence[str]) -> DataFrame:
    """One row per (kind, name) from one scan, written: every posting counts for ``all``, for each of its skills where
    ``skill`` is asked for, and for its value of each other kind. The rows are few; what a report needs is taken from
    them and not from the postings again."""
    day = _as_of(as_of)
    both = F.col("salary_min") + F.col("salary_max") if "salary_min" in postings.columns else F.lit(None).cast("decimal(12,2)")
    flags = {"today": _within(day, 0, 1), "r30": _within(day, 0, 30), "b30": _within(day, 30, 60), "r90": _within(day, 0, 90), "b90": _within(day, 90, 180)}

    def cell(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"))

    named = F.array(cell("all", F.lit(None)), *[cell(k, F.col(k)) for k in kinds if k != "skill"])
    if "skill" in kinds:
        skills = F.coalesce(F.array_distinct("skills"), F.array().cast("array<string>"))
        named = F.concat(named, F.transform(skills, lambda s: cell("skill", s)))
    counted = postings.select("posted_date", both.alias("both"), *[c.alias(n) for n, c in flags.items()], F.inline(named)).groupBy("kind", "name").agg(
        _count().alias("n"), F.sum("both").alias("salaries"), F.count("both").alias("paid"), F.max("posted_date").alias("last"),
        *[F.count_if(n).alias(n) for n in flags])
    return materialize(counted, "cells")


def _mean() -> Column:
    return F.try_divide(F.col("salaries").cast("double") / 2, F.col("paid"))


def _growth(days: int) -> Column:
    return pct_change(F.col(f"r{days}").cast("double"), F.col(f"b{days}").cast("double"))


def skill_ranking(
    postings: DataFrame, as_of, limit: int = 20, offset: int = 0, region: str | None = None, industry: str | None = None
) -> DataFrame:
    """Rank, postings, share, mean salary and 30/90-day growth per skill; ``total`` counts the skills. One scan."""
    for column, value in (("region", region), ("industry", industry)):
        if value is not None:
            postings = postings.filter(F.col(column) == value)
    cells = _cells(postings, as_of, ["skill"])
    skills = cells.filter("kind = 'skill'").select(
        F.col("name").alias("skill"), F.col("n").alias("postings_count"), _mean().alias("avg_salary"), _growth(30).alias("growth_30d"), _growth(90).alias("growth_90d"))
    total = cells.filter("kind = 'all'").agg(F.sum("n")).scalar()
    count = skills.agg(F.count("skill")).scalar()
    order = [F.desc("postings_count"), F.asc("skill")]
    ranked = skills.orderBy(*order).limit(offset + limit).withColumn("rank", F.row_number().over(W.orderBy(*order)))
    share = F.round(F.col("postings_count") / total * 100, 1)
    return ranked.filter(F.col("rank") > offset).withColumn("postings_pct", share).withColumn("total", count)


def skill_overview(postings: DataFrame, skill: str, as_of) -> DataFrame:
    """Demand now and on average over 30 and 90 days, and the salary spread of one skill."""
    day = _as_of(as_of)
    rows = postings.filter(F.array_contains("skills", skill)).select("posted_date", mid_salary().cast("double").alias("_salary"))
    rows = materialize(rows, "skill-salaries")  # two columns of one skill, read a few times
    quartiles = exact_percentiles(rows, ["_salary"], [0.25, 0.5, 0.75]).select("percentiles").scalar()
    averages = rows.agg(
        F.count_if(_within(day, 0, 1)).alias("current"),
        (F.count_if(_within(day, 0, 30)) / 30).alias("avg_30d"),
        (F.count_if(_within(day, 0, 90)) / 90).alias("avg_90d"),
        F.avg("_salary").alias("salary_avg"),
    )
    return averages.withColumn("_q", quartiles).select(
        F.lit(skill).alias("skill"),
        "current", "avg_30d", "avg_90d",
        direction(F.col("avg_30d") - F.col("avg_90d")).alias("trend"),
        "salary_avg",
        *[F.col("_q")[i].alias(n) for i, n in enumerate(("salary_p25", "salary_median", "salary_p75"))],
    )


def skill_breakdown(postings: DataFrame, skill: str, column: str) -> DataFrame:
    """Postings, share and salary premium of one skill per region or industry.

    The premium is the mean salary of the group over that of the whole skill.
    """
    rows = postings.filter(F.array_contains("skills", skill))
    both = F.col("salary_min") + F.col("salary_max")
    cells = materialize(rows.groupBy(column).agg(_count().alias("postings"), F.sum(both).alias("salaries"), F.count(both).alias("paid")), "breakdown")
    whole = cells.agg(F.struct(F.sum("postings").alias("n"), F.try_divide(F.sum("salaries").cast("double") / 2, F.sum("paid")).alias("salary"))).scalar()
    return (
        cells.select(column, "postings", _mean().alias("avg_salary"))
        .withColumn("postings_pct", F.col("postings") / whole["n"] * 100)
        .withColumn("salary_premium", F.try_divide("avg_salary", whole["salary"]))
    )


def top_within(counts: DataFrame, group: str, name: str, k: int, value: str = "n") -> DataFrame:
    """The k largest names of every group as an array of (name, value), largest first.

    ``counts`` is already one row per (group, name). The rank filter is applied on
    the map side as well, so no task holds all names of a large group.
    """
    order = W.partitionBy(group).orderBy(F.desc(value), F.asc(name))
    listed = F.collect_list(F.struct((-F.col(value)).alias("_o"), F.col(name).alias("name"), F.col(value).alias("n")))
    return (
        counts.withColumn("_rn", F.row_number().over(order))
        .filter(F.col("_rn") <= k)
        .groupBy(group)
        .agg(F.transform(F.array_sort(listed), lambda e: F.struct(e["name"].alias("name"), e["n"].alias("n"))).alias("top"))
    )


def location_summary(postings: DataFrame, as_of, k: int = 3) -> DataFrame:
    """Postings, share, mean salary, 90-day growth and top industries and skills per location.

    One pass counts (location, kind, name) cells, kind being industry or skill; totals
    follow from the industry cells, of which every posting is in one.
    """
    day = _as_of(as_of)
    both = F.col("salary_min") + F.col("salary_max")

    money = postings.select(both.alias("b")).schema["b"].dataType

    def cell(kind: str, name: Column, salaries: Column, recent: Column, before: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.alias("name"), salaries.cast(money).alias("both"), recent.cast("boolean").alias("recent"), before.cast("boolean").alias("before"))

    none = F.lit(None)
    skills = F.coalesce(F.array_distinct("skills"), F.array().cast("array<string>"))
    pairs = F.concat(F.array(cell("industry", F.col("industry"), both, _within(day, 0, 90), _within(day, 90, 180))), F.transform(skills, lambda s: cell("skill", s, none, none, none)))
    # the region is a key here: the smallest text of a group can't be kept by a hash aggregate
    cells = postings.select("location", "region", F.inline(pairs)).groupBy("location", "region", "kind", "name").agg(
        _count().alias("n"), F.sum("both").alias("salaries"), F.count("both").alias("paid"),
        F.count_if("recent").alias("recent"), F.count_if("before").alias("before"),
    )
    sums = ("n", "salaries", "paid", "recent", "before")
    cells = cells.groupBy("location", "kind", "name").agg(F.min("region").alias("region"), *[F.sum(c).alias(c) for c in sums])
    ranked = cells.withColumn("rank", F.row_number().over(W.partitionBy("location", "kind").orderBy(F.desc("n"), F.asc("name"))))

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("kind") == "industry", F.col(column)))

    def top(kind: str) -> Column:
        entry = F.struct((-F.col("n")).alias("_o"), "name", "n")
        listed = F.array_sort(F.collect_list(F.when((F.col("kind") == kind) & (F.col("rank") <= k), entry)))
        return F.nullif(F.transform(listed, lambda e: F.struct(e["name"].alias("name"), e["n"].alias("n"))), F.array())

    base = ranked.filter((F.col("kind") == "industry") | (F.col("rank") <= k)).groupBy("location").agg(
        F.min("region").alias("region"),
        total("n").alias("postings_count"),
        F.try_divide(total("salaries").cast("double") / 2, total("paid")).alias("avg_salary"),
        pct_change(total("recent").cast("double"), total("before").cast("double")).alias("growth_90d"),
        top("industry").alias("top_industries"), top("skill").alias("top_skills"),
    )
    # one row per location: the unpartitioned window adds up a small table
    every = F.sum("postings_count").over(W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    lists = ["top_industries", "top_skills"]
    return base.withColumn("postings_pct", F.col("postings_count") / every * 100).select(
        *[c for c in base.columns if c not in lists], "postings_pct", *lists)


def company_volume(postings: DataFrame, company: str) -> DataFrame:
    """Monthly volume of a company with its 3- and 12-month averages and direction."""
    monthly = (
        postings.filter(F.col("company") == company)
        .groupBy("company", dates.month_start("posted_date").alias("month"))
        .agg(_count().alias("n"))
    )
    order = W.partitionBy("company").orderBy(dates.month_index("month"))
    return monthly.withColumns({
        "avg_3m": F.avg("n").over(order.rangeBetween(-2, 0)),
        "avg_12m": F.avg("n").over(order.rangeBetween(-11, 0)),
    }).withColumn("trend", direction(F.col("avg_3m") - F.col("avg_12m")))


def company_profile(postings: DataFrame, company: str, k: int = 10) -> DataFrame:
    """Top skills and titles and all locations of a company as rows (section, name, n, avg_salary)."""
    rows = postings.filter(F.col("company") == company)

    def pair(section: str, name: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), name.alias("name"))

    skills = F.coalesce(F.array_distinct("skills"), F.array().cast("array<string>"))
    pairs = F.concat(F.array(pair("title", F.col("title")), pair("location", F.col("location"))), F.transform(skills, lambda s: pair("skill", s)))
    counted = rows.select("salary_min", "salary_max", F.inline(pairs)).groupBy("section", "name").agg(
        _count().alias("n"), mean_salary().alias("avg_salary"))
    rank = F.row_number().over(W.partitionBy("section").orderBy(F.desc("n"), F.asc("name")))
    return counted.withColumn("rank", rank).filter((F.col("section") == "location") | (F.col("rank") <= k)).drop("rank")


def company_ranking(
    postings: DataFrame, as_of, limit: int = 20, skill: str | None = None, region: str | None = None,
    days: int = 90,
) -> DataFrame:
    """Companies by number of postings, with mean salary and hiring growth."""
    day = _as_of(as_of)
    rows = postings if skill is None else postings.filter(F.array_contains("skills", skill))
    if region is not None:
        rows = rows.filter(F.col("region") == region)
    order = [F.desc("postings"), F.asc("company")]
    return (
        rows.groupBy("company")
        .agg(_count().alias("postings"), mean_salary().alias("avg_salary"), growth_value(day, days).alias("hiring_growth"))
        .orderBy(*order)
        .limit(limit)
        .withColumn("rank", F.row_number().over(W.orderBy(*order)))
    )


def analytics_summary(postings: DataFrame, as_of, k: int = 5) -> DataFrame:
    """Headline numbers, trending skills and active regions as rows (section, name, value)."""
    cells = _cells(postings, as_of, ["skill", "company", "region"])
    names = ["total_postings", "new_postings_today", "postings_growth_30d", "unique_skills", "unique_companies", "avg_salary"]
    every = F.col("kind") == "all"

    def total(value: Column) -> Column:
        return F.max(F.when(every, value.cast("double")))

    def distinct(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("name").isNotNull()).cast("double")

    values = [F.coalesce(total(F.col("n")), F.lit(0.0)), F.coalesce(total(F.col("today")), F.lit(0.0)), total(_growth(30)), distinct("skill"), distinct("company"), total(_mean())]
    headline = cells.agg(*[v.alias(n) for v, n in zip(values, names)]).unpivot([], names, "name", "value").select(F.lit("totals").alias("section"), "name", "value")
    trending = (
        cells.filter("kind = 'skill'")
        .select(F.lit("trending_skill").alias("section"), "name", _growth(30).alias("value"))
        .filter(F.col("value").isNotNull())
        .orderBy(F.desc("value"), "name")
        .limit(k)
    )
    active = (
        cells.filter("kind = 'region'")
        .select(F.lit("active_region").alias("section"), "name", F.col("n").cast("double").alias("value"))
        .orderBy(F.desc("value"), "name")
        .limit(k)
    )
    return reduce(DataFrame.unionByName, [headline, trending, active])


CUBE_KEYS = ("region", "skill", "industry")


def demand_cube(postings: DataFrame, grain: str = "month") -> DataFrame:
    """Postings, mean salary and growth per (period, region, skill, industry)."""
    cells = (
        exploded(postings, "posted_date", "region", "industry", "salary_min", "salary_max")
        .groupBy(dates.period_start("posted_date", grain).alias("period"), *CUBE_KEYS)
        .agg(_count().alias("n"), mean_salary().alias("avg_salary"))
    )
    before = _lagged("n", "period", grain, CUBE_KEYS).cast("double")
    return cells.withColumn("growth_rate", pct_change(F.col("n").cast("double"), before))


def freshness(postings: DataFrame) -> DataFrame:
    """Last update, rows, and distinct regions, skills and companies as one row, from one scan."""
    cells = _cells(postings, "1970-01-01", ["region", "skill", "company"])

    def distinct(kind: str) -> Column:
        return F.count_if((F.col("kind") == kind) & F.col("name").isNotNull())

    return cells.agg(
        F.max("last").alias("last_update"), F.coalesce(F.sum(F.when(F.col("kind") == "all", F.col("n"))), F.lit(0)).alias("records_processed"),
        distinct("region").alias("regions"), distinct("skill").alias("skills"), distinct("company").alias("companies"))


def share_over_time(postings: DataFrame, column: str, grain: str = "month") -> DataFrame:
    """Share of each value of a column within its period."""
    counted = postings.groupBy(dates.period_start("posted_date", grain).alias("period"), column).agg(_count().alias("n"))
    # the values of a period are counted before the window sees them
    return counted.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("period")))


def salary_trend(postings: DataFrame, by: str, grain: str = "month") -> DataFrame:
    """Mean salary and number of paid postings per period and category."""
    return (
        postings.filter(mid_salary().isNotNull())
        .groupBy(dates.period_start("posted_date", grain).alias("period"), by)
        .agg(mean_salary().alias("avg_salary"), _count().alias("n"))
    )


def salary_demand_corr(postings: DataFrame) -> DataFrame:
    """Correlation of monthly mean salary and monthly postings per skill."""
    monthly = (
        exploded(postings, "posted_date", "salary_min", "salary_max")
        .groupBy("skill", dates.month_start("posted_date").alias("month"))
        .agg(_count().cast("double").alias("n"), mean_salary().alias("avg_salary"))
    )
    return monthly.groupBy("skill").agg(
        F.corr("avg_salary", "n").alias("correlation"), F.count("avg_salary").alias("months")
    )


def facet_counts(rows: DataFrame, facets: Sequence[str], k: int | None = None) -> DataFrame:
    """Values per facet of a search result as rows (facet, value, n); the ``k`` most frequent ones if given.

    All facets are counted in one pass: each row yields one (facet, value) pair per
    facet, list columns one per distinct item.
    """

    def values(name: str) -> Column:
        if rows.schema[name].dataType.typeName() == "array":
            items = F.array_distinct(name)
        else:
            items = F.array(F.col(name).cast("string"))
        return F.transform(items, lambda v: F.struct(F.lit(name).alias("facet"), v.alias("value")))

    pairs = rows.select(F.inline(F.concat(*[F.coalesce(values(f), F.array().cast("array<struct<facet:string,value:string>>")) for f in facets])))
    counted = pairs.filter(F.col("value").isNotNull()).groupBy("facet", "value").agg(_count().alias("n"))
    if k is None:
        return counted
    order = W.partitionBy("facet").orderBy(F.desc("n"), F.asc("value"))
    return counted.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= k).drop("_rn")


