"""Checks, blends and drift of stored forecasts."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .forecast import linreg_forecast
from .regression import Series
from .tables import materialize


def forecast_sanity(df: DataFrame, n: int = 10, key: str = "skill_name") -> DataFrame:
    """The n series of highest mean prediction."""
    return (
        df.groupBy(key)
        .agg(F.avg("predicted_demand").alias("avg_predicted"))
        .orderBy(F.desc("avg_predicted"), key)
        .limit(n)
    )


def negative_forecasts(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if(F.col("predicted_demand") < 0).alias("negatives"), F.count(F.lit(1)).alias("rows"))


#: A model as a function of the rows, the first month and the number of months to predict, and the series' columns.
Model = Callable[[DataFrame, Column, int, Series], DataFrame]


def rolling_origins(df: DataFrame, folds: int, horizon: int, series: Series = Series()) -> DataFrame:
    """Each row once for every fold whose first predicted month lies after it, with that month as ``origin``.

    The folds end at the table's last month and lie one behind the other, ``horizon`` months each. A fold is a series
    of its own under the series' keys and ``origin``, so a model that takes its series by key sees all folds at once.
    """
    last = F.trunc(df.agg(F.max(series.date)).scalar().cast("date"), "month")
    origins = F.array(*[F.add_months(last, 1 - horizon * (folds - j)) for j in range(folds)])
    return df.withColumn("origin", F.explode(origins)).filter(F.col(series.date) < F.col("origin"))


def backtest(
    df: DataFrame, models: Mapping[str, Model], folds: int = 3, horizon: int = 3, series: Series = Series(),
) -> DataFrame:
    """``model_version, n, rmse, mae, bias`` of every model and series over all predicted months of all folds.

    Every model runs once, over all folds of all series together. Months without an actual value aren't counted, and
    a series that a model doesn't predict has no row for it.
    """
    keyed = Series((*series.keys, "origin"), series.date, series.value)
    frame = materialize(rolling_origins(df, folds, horizon, series), "folds")
    parts = [
        model(frame, F.col("origin"), horizon, keyed).select(*keyed.keys, "forecast_date", "predicted_demand").withColumn("model_version", F.lit(name))
        for name, model in models.items()
    ]
    predicted = parts[0]
    for part in parts[1:]:
        predicted = predicted.unionByName(part)
    actual = df.select(*series.keys, F.col(series.date).alias("forecast_date"), F.col(series.value).cast("double").alias("_actual"))
    error = F.col("predicted_demand") - F.col("_actual")
    return predicted.join(actual, [*series.keys, "forecast_date"]).groupBy(*series.keys, "model_version").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"), F.avg(F.abs(error)).alias("mae"), F.avg(error).alias("bias"))


def validated_blend(
    df: DataFrame, models: Mapping[str, Model], start: str | Column, months: int, folds: int = 3, horizon: int = 3,
    series: Series = Series(), version: str = "Blend",
) -> DataFrame:
    """The models' forecasts from ``start``, weighted for each series by their own errors in a backtest on ``df``."""
    first = start.cast("date") if isinstance(start, Column) else F.lit(start).cast("date")
    weights = blend_weights(backtest(df, models, folds, horizon, series), series.keys)
    parts = [model(df, first, months, series).withColumn("model_version", F.lit(name)) for name, model in models.items()]
    forecasts = parts[0]
    for part in parts[1:]:
        forecasts = forecasts.unionByName(part)
    return blend_models(forecasts, weights, series.keys, version)


def blend_weights(errors: DataFrame, keys: Sequence[str] = ("skill_name",), error: str = "rmse") -> DataFrame:
    """Weights from cross-validation errors: the inverse error of each (series, model)."""
    return errors.select(*keys, "model_version", (1 / (F.col(error) + 1e-6)).alias("weight"))


def blend_models(
    forecasts: DataFrame, weights: DataFrame, keys: Sequence[str] = ("skill_name",), version: str = "Blend"
) -> DataFrame:
    """Weighted mean of several models' predictions and bounds per series and date.

    ``weights`` has (model_version, weight), optionally also the series keys.
    """
    on = [c for c in (*keys, "model_version") if c in weights.columns]
    joined = forecasts.join(weights, on)

    def weighted(name: str) -> Column:
        return F.try_divide(F.sum(F.col(name) * F.col("weight")), F.sum("weight")).alias(name)

    return joined.groupBy(*keys, "forecast_date").agg(
        *[weighted(c) for c in ("predicted_demand", "confidence_lower", "confidence_upper")]
    ).withColumn("model_version", F.lit(version))


def forecast_drift(
    forecast: DataFrame, actual: DataFrame, keys: Sequence[str] = ("skill_name",), date_col: str = "period_start",
    value: str = "demand_count",
) -> DataFrame:
    """Error of stored forecasts on the months whose actual values are known."""
    known = actual.select(*keys, F.col(date_col).alias("forecast_date"), F.col(value).cast("double").alias("_actual"))
    error = F.col("predicted_demand") - F.col("_actual")
    inside = F.col("_actual").between(F.col("confidence_lower"), F.col("confidence_upper"))
    return forecast.join(known, [*keys, "forecast_date"]).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error).alias("bias"),
        F.avg(inside.cast("double")).alias("coverage"),
    )


# Two-sided normal quantiles of the offered confidence levels.
Z_VALUES = {0.80: 1.2816, 0.90: 1.6449, 0.95: 1.96, 0.99: 2.5758}


def region_forecast(
    df: DataFrame, start: str | Column, horizon_days: int = 30, confidence: float = 0.95,
    skills: Sequence[str] = (), region: str | None = None,
) -> DataFrame:
    """Forecast per (region, skill) with the change against the last known month.

    ``df`` has (skill_name, region, period_start, demand_count). The horizon is
    rounded up to whole months; the trend is told by the last step's change.
    """
    if confidence not in Z_VALUES:
        raise ValueError(f"confidence must be one of {sorted(Z_VALUES)}")
    series = Series(("skill_name", "region"), "period_start", "demand_count")
    chosen = df.filter(F.col("skill_name").isin(list(skills))) if skills else df
    if region is not None:
        chosen = chosen.filter(F.col("region") == region)
    chosen = materialize(chosen, "regional-demand")
    months = -(-horizon_days // 30)
    first = start.cast("date") if isinstance(start, Column) else F.lit(start).cast("date")
    predicted = linreg_forecast(
        chosen, first, F.add_months(first, months - 1), (), series, "LinReg", Z_VALUES[confidence]
    )
    last = chosen.groupBy("skill_name", "region").agg(
        F.max_by(F.col("demand_count").cast("double"), "period_start").alias("last_known")
    )
    change = F.round(F.try_divide(100.0 * (F.col("predicted_demand") - F.col("last_known")), F.col("last_known")), 1)
    trend = F.when(F.col("change_pct") > 0, "up").when(F.col("change_pct") < 0, "down").otherwise("flat")
    return (
        predicted.join(last, ["skill_name", "region"])
        .withColumn("change_pct", change)
        .withColumn("trend", trend)
        .drop("last_known")
    )
