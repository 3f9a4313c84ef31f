"""Joins and calendar alignment.

No join carries an unconditional broadcast hint: Spark broadcasts a side when its
size estimate is below the session threshold (and re-checks at run time), and
otherwise splits skewed partitions of the shuffle join. The hint appears only for
sides that a literal row limit or a single-row aggregate bounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates
from ..plans.tables import materialize
from .bounded import first_rows

def lookup_join(fact: DataFrame, dim: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Left equi-join to a lookup table."""
    return fact.join(dim, key, "left")


def skills_with_dates(
    job_skills: DataFrame, postings: DataFrame, skill_map: DataFrame, job_key: str = "job_id",
    skill_key: str = "skill_abr", date_col: str = "listed_date", name_col: str = "skill_name",
) -> DataFrame:
    """Each job-skill row with its posting date and skill name; a missing match stays NULL.

    The small map is joined first so that its columns ride along with the one
    shuffle on the posting key.
    """
    named = lookup_join(job_skills, skill_map.select(skill_key, name_col), skill_key)
    return named.join(postings.select(job_key, date_col), job_key, "left")


def cap_to_history(
    forecast: DataFrame, history: DataFrame, factor: float = 5.0, key: str = "skill_name",
    value: str = "demand_count", predicted: str = "predicted_demand",
) -> DataFrame:
    """Limit predictions to ``factor`` times the series' historical maximum.

    Bounds stay as they are; a series without history is left alone.
    """
    peaks = history.groupBy(key).agg(F.max(value).cast("double").alias("_peak"))
    ceiling = F.col("_peak") * factor
    capped = F.when(ceiling.isNotNull(), F.least(predicted, ceiling)).otherwise(F.col(predicted))
    return forecast.join(peaks, key, "left").withColumn(predicted, capped).drop("_peak")


def restrict_to_top(
    df: DataFrame, top: DataFrame, key: str, n: int, ignore_case: bool = False
) -> DataFrame:
    """Keep the rows whose key is among the first ``n`` keys of ``top``."""
    keys = first_rows(top.select(key), n)
    if not ignore_case:
        return df.join(keys, key, "left_semi")
    folded = keys.select(F.lower(key).alias("_key"))
    return df.join(folded, F.lower(df[key]) == folded["_key"], "left_semi")


def densify(
    df: DataFrame, key: str | Sequence[str], date_col: str = "period_start", value: str = "demand_count",
    end: Column | None = None,
) -> DataFrame:
    """One row per series and month from its first to its last month; gaps become 0.

    Repeated months are summed. The calendar is generated from the summed months
    of the series themselves, so the only shuffles are on the series key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    monthly = (
        df.filter(F.col(date_col).isNotNull())
        .groupBy(*keys, dates.month_start(date_col).alias(date_col))
        .agg(F.sum(value).alias(value))
    )
    # At most one entry per month: the collected map is bounded by the calendar.
    series = monthly.groupBy(*keys).agg(
        F.min(date_col).alias("_first"),
        F.max(date_col).alias("_last"),
        F.map_from_entries(F.collect_list(F.struct(date_col, value))).alias("_values"),
    )
    last = F.col("_last") if end is None else F.greatest("_last", end)
    grid = series.select(*keys, "_values", F.explode(dates.month_grid(F.col("_first"), last)).alias(date_col))
    zero = F.lit(0).cast(monthly.schema[value].dataType)
    return grid.select(
        *keys, date_col, F.coalesce(F.try_element_at("_values", F.col(date_col)), zero).alias(value)
    )


def horizon_grid(
    df: DataFrame, start: Column | str, end: Column | str, date_col: str = "forecast_date"
) -> DataFrame:
    """Every row of ``df`` repeated for each month of the horizon, with its 0-based step."""
    return df.select("*", F.posexplode(dates.month_grid(start, end)).alias("step", date_col))


def step_grid(
    df: DataFrame, start: Column | str, steps: int, step: str = "1 month", date_col: str = "forecast_date"
) -> DataFrame:
    """Like ``horizon_grid`` for a number of steps of one month or of 30 days."""
    base = start.cast("date") if isinstance(start, Column) else F.lit(start).cast("date")
    numbered = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(steps - 1))).alias("step"))
    return numbered.withColumn(date_col, dates.add_period(base, F.col("step"), step))


def align_on_dates(
    df: DataFrame, key: str = "skill_name", date_col: str = "forecast_date", value: str = "predicted_demand"
) -> DataFrame:
    """Every series on the union of all dates; NULL where the series has no point.

    The input has one row per series and date.

    The dates come from a one-value subquery bounded by the calendar, so no
    cross join is formed.
    """
    calendar = df.agg(F.array_sort(F.collect_set(date_col))).scalar()
    series = df.groupBy(key).agg(
        F.map_from_entries(F.collect_list(F.struct(date_col, value))).alias("_values")
    )
    grid = series.select(key, "_values", F.explode(calendar).alias(date_col))
    return grid.select(key, date_col, F.try_element_at("_values", F.col(date_col)).alias(value))


def trend_timeline(
    history: DataFrame, predicted: DataFrame, date_col: str = "date"
) -> DataFrame:
    """Historical count and predicted band side by side on the union of their dates."""
    past = history.select(date_col, F.col("count").alias("historical"))
    future = predicted.select(
        date_col,
        F.col("count").alias("predicted"),
        F.col("confidence_lower").alias("lower"),
        F.col("confidence_upper").alias("upper"),
    )
    return past.join(future, date_col, "full_outer")


def year_over_year(
    df: DataFrame, key: str | Sequence[str] = "skill_name", date_col: str = "period_start",
    value: str = "demand_count",
) -> DataFrame:
    """Each month next to the same month a year earlier, found by date and not by position."""
    keys = [key] if isinstance(key, str) else list(key)
    earlier = df.select(
        *keys, F.add_months(date_col, 12).alias(date_col), F.col(value).alias("previous")
    )
    now = df.select(*keys, date_col, F.col(value).alias("current"))
    growth = F.round(F.try_divide(100.0 * (F.col("current") - F.col("previous")), F.col("previous")), 1)
    return now.join(earlier, [*keys, date_col], "left").withColumn("yoy_growth_pct", growth)


def related_skills(
    df: DataFrame, targets: Sequence[str], skills: str = "skills"
) -> DataFrame:
    """Co-occurrence rate and phi correlation of every skill with each target skill.

    ``skills`` is an array of distinct names per posting. One scan: each posting is
    exploded once and the targets are counted as columns, so no pairs are formed
    and the map side already reduces to one row per skill.
    """
    flags = {f"_t{i}": F.coalesce(F.array_contains(skills, name), F.lit(False)) for i, name in enumerate(targets)}
    flagged = df.select(F.array_distinct(skills).alias("_skills"), *[c.alias(n) for n, c in flags.items()])
    # every posting counts once for no skill in particular; the counts are few and written, as they are read twice
    kinds = F.concat(F.array(F.struct(F.lit(True).alias("every"), F.lit(None).cast("string").alias("skill"))),
                     F.transform(F.coalesce("_skills", F.array().cast("array<string>")), lambda s: F.struct(F.lit(False).alias("every"), s.alias("skill"))))
    cells = materialize(
        flagged.select(F.inline(kinds), *flags).groupBy("every", "skill")
        .agg(F.count(F.lit(1)).alias("skill_count"), *[F.count_if(n).alias(n) for n in flags]), "skill-cells")
    totals = cells.filter("every").agg(F.struct(F.sum("skill_count").alias("n"), *[F.sum(n).alias(n) for n in flags])).scalar()
    counted = cells.filter("NOT every").drop("every")
    pairs = F.explode(
        F.array(*[
            F.struct(
                F.lit(name).alias("target"),
                F.col(n).alias("both"),
                totals[n].alias("target_count"),
                totals["n"].alias("n"),
            )
            for n, name in zip(flags, targets)
        ])
    )
    long = counted.select("skill", "skill_count", pairs.alias("p")).select("skill", "skill_count", "p.*")
    n, a, b, both = (F.col(c).cast("double") for c in ("n", "skill_count", "target_count", "both"))
    phi = F.try_divide(n * both - a * b, F.sqrt(a * b * (n - a) * (n - b)))
    return long.filter((F.col("skill") != F.col("target")) & (F.col("both") > 0)).select(
        "target",
        "skill",
        F.col("both").alias("co_count"),
        F.try_divide(both, b).alias("co_occurrence"),
        phi.alias("correlation"),
    )
