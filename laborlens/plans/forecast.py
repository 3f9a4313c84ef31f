"""Forecast models over long demand tables (series keys, month, value).

Input rows are unique per series and month. Every model reduces a series to one
row (statistics and, where the maths needs the points, an array no longer than the
calendar) in a single shuffle on the series key, and then expands that row into
its horizon with column expressions. Models return the series keys, forecast_date,
predicted_demand, confidence_lower, confidence_upper and model_version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions import dates
from ..functions.values import clip, safe_ratio
from ..functions.vocab import FORECAST_END, FORECAST_START, SPIKE_MONTHS
from ..operators import filters, joins, windows
from .regression import FEATURES, Series, fitted, ols_statistics, pair_statistics, season_features, season_values, solve_ols, solve_pairs

Z95 = 1.96
HORIZON = 32
COLUMNS = ("forecast_date", "predicted_demand", "confidence_lower", "confidence_upper", "model_version")

Band = tuple[Column, Column]


def residual_sqrt_step(predicted: Column, resid_std: Column, step: Column, z: float = Z95) -> Band:
    """Width grows with the square root of the 1-based step."""
    half = z * resid_std * F.sqrt(step)
    return F.greatest(predicted - half, F.lit(0.0)), predicted + half


def residual_floor(predicted: Column, resid_std: Column, level: Column, share: float, z: float | Column = Z95) -> Band:
    """Constant width, at least a share of the recent level."""
    half = z * F.greatest(resid_std, level * share)
    return F.greatest(predicted - half, F.lit(0.0)), predicted + half


def multiplicative(predicted: Column, low: float, high: float) -> Band:
    return F.greatest(predicted * low, F.lit(0.0)), predicted * high


def volatility_band(predicted: Column, volatility: Column, floor: float = 0.0) -> Band:
    return F.greatest(predicted * (1 - volatility), F.lit(floor)), predicted * (1 + volatility)


def model_band(predicted: Column, low: Column, high: Column) -> Band:
    """Bounds given by the model, kept non-negative and around the prediction."""
    return F.greatest(low, F.lit(0.0)), F.greatest(high, predicted)


BANDS = {
    "residual_sqrt_step": residual_sqrt_step,
    "residual_floor": residual_floor,
    "multiplicative": multiplicative,
    "volatility": volatility_band,
    "model": model_band,
}


def confidence_band(df: DataFrame, method: str, *args, predicted: str = "predicted_demand") -> DataFrame:
    """Add confidence bounds by one of the five rules; ``args`` as the rule's function takes them."""
    if method not in BANDS:
        raise ValueError(f"unknown band {method!r}; choose from {sorted(BANDS)}")
    lower, upper = BANDS[method](F.col(predicted), *args)
    return df.withColumns({"confidence_lower": lower, "confidence_upper": upper})


def _output(
    df: DataFrame, series: Series, predicted: Column, band: Band, version: str | Column, scale: int | None
) -> DataFrame:
    def stored(value: Column) -> Column:
        return F.round(value, scale) if scale is not None else value

    return df.select(
        *series.keys,
        "forecast_date",
        stored(predicted).alias("predicted_demand"),
        stored(band[0]).alias("confidence_lower"),
        stored(band[1]).alias("confidence_upper"),
        (F.lit(version) if isinstance(version, str) else version).alias("model_version"),
    )


def _mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)
    return F.try_divide(total, F.size(values))


def _deviation(values: Column) -> Column:
    """Population standard deviation of an array, from the distances to its mean."""
    mean = _mean(values)
    return F.sqrt(_mean(F.transform(values, lambda x: (x - mean) * (x - mean))))


# ---------------------------------------------------------------- linear model


def linreg_fits(
    df: DataFrame, spike_months: Sequence[str] = SPIKE_MONTHS, series: Series = Series(), min_rows: int = 3,
    origin: Column | None = None,
) -> DataFrame:
    """One row per series: coefficients, recent mean, anchor offset and residual deviation."""
    start = df.agg(F.min(series.date)).scalar() if origin is None else origin
    keys = list(series.keys)
    usable = filters.min_series_length(df, min_rows, keys)
    clean = filters.exclude_periods(usable, spike_months, keys, series.date, min_rows)
    newest = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc(series.date)))
    featured = season_features(clean, series.date, start).withColumns({
        "_y": F.col(series.value).cast("double"),
        "_recent": newest <= 3,
    })
    # the fit at the recent rows is the fit at their mean features, so no rows are kept
    recent = {f"_r_{c}": F.avg(F.when(F.col("_recent"), F.col(c))) for c in ("_y", *FEATURES)}
    sums = featured.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_clean"),
        *[mean.alias(name) for name, mean in recent.items()],
        # the points of a series, one a month, ride along for its residuals
        F.collect_list(F.struct(*FEATURES, "_y")).alias("_points"),
        *ols_statistics(FEATURES, "_y"),
    )
    residuals = F.transform("_points", lambda p: p["_y"] - fitted([p[f] for f in FEATURES]))
    at_recent = fitted([F.col(f"_r_{f}") for f in FEATURES])
    return solve_ols(sums).select(
        *keys,
        "n_clean",
        F.col("_r__y").alias("recent_mean"),
        "intercept",
        *[f"coef_{f}" for f in FEATURES],
        (F.col("_r__y") - at_recent).alias("anchor"),
        _deviation(residuals).alias("resid_std"),
    )


def linreg_forecast(
    df: DataFrame, start: str | Column = FORECAST_START, end: str | Column = FORECAST_END,
    spike_months: Sequence[str] = SPIKE_MONTHS, series: Series = Series(), version: str = "LinReg_NoSpike_v3",
    z: float = Z95,
) -> DataFrame:
    """Trend and season regression without spike months, anchored at the recent mean.

    Predictions are limited to 0.5–2.0 times the recent mean.
    """
    origin = df.agg(F.min(series.date)).scalar()
    fits = linreg_fits(df, spike_months, series, origin=origin)
    grid = joins.horizon_grid(fits, start, end)
    at = season_values(F.col("forecast_date"), origin)
    level = F.col("recent_mean")
    predicted = clip(fitted([at[f] for f in FEATURES]) + F.col("anchor"), level * 0.5, level * 2.0)
    predicted = F.greatest(predicted, F.lit(0.0))
    band = residual_floor(predicted, F.col("resid_std"), level, 0.10, z)
    return _output(grid, series, predicted, band, version, 4)


# ---------------------------------------------------------------- level models


def stable_mean_forecast(
    df: DataFrame, since: str = "2025-01-01", start: str | Column = FORECAST_START,
    end: str | Column = FORECAST_END, series: Series = Series((), "date", "count"),
    version: str = "StableMean",
) -> DataFrame:
    """Mean of the rows since a date (else the last three) with a gentle trend per month."""
    whole = W.partitionBy(*series.keys)
    marked = df.withColumns({
        "_recent": F.col(series.date) >= F.lit(since).cast("date"),
        "_rn": F.row_number().over(whole.orderBy(F.desc(series.date))),
        "_y": F.col(series.value).cast("double"),
    })
    enough = F.count_if("_recent").over(whole) >= 2
    chosen = marked.withColumn("_enough", enough).filter(
        F.when(F.col("_enough"), F.col("_recent")).otherwise(F.col("_rn") <= 3)
    )
    # the newest row has _rn = 1, so -_rn rises by one per row like the row index
    level = chosen.withColumn("_x", -F.col("_rn").cast("double")).groupBy(*series.keys).agg(
        F.avg("_y").alias("mean"),
        F.coalesce(F.stddev_samp("_y"), F.avg("_y") * 0.3).alias("std"),
        F.coalesce(F.regr_slope("_y", "_x"), F.lit(0.0)).alias("slope"),
    )
    grid = joins.horizon_grid(level, start, end)
    slope = clip(F.col("slope"), -1.0, 1.0)
    predicted = F.greatest(F.lit(1.0), F.col("mean") + slope * F.col("step"))
    band = residual_floor(predicted, F.col("std"), F.col("mean"), 0.20)
    return _output(grid, series, predicted, band, version, 2)


def _endpoints(series: Series) -> dict[str, Column]:
    day, value = series.date, series.value
    return {
        "slope": windows.endpoint_slope_value(day, value),
        "last_date": F.max(day),
        "last_value": F.max_by(F.col(value).cast("double"), day),
    }


def trend_following(
    df: DataFrame, base: str | Column = FORECAST_START, steps: int = HORIZON, step: str = "1 month",
    series: Series = Series(), version: str = "TrendFollowing",
) -> DataFrame:
    """The last value continued along the slope of the trailing 180 days, at most 1.2 times its peak."""
    keys = list(series.keys)
    recent = windows.trailing_window(filters.min_series_length(df, 2, keys), key=keys, date_col=series.date)
    fits = recent.groupBy(*keys).agg(
        *[c.alias(n) for n, c in _endpoints(series).items()],
        F.max(series.value).cast("double").alias("peak"),
    )
    grid = joins.step_grid(fits, base, steps, step)
    ahead = F.datediff("forecast_date", "last_date")
    predicted = F.greatest(F.lit(0.0), F.col("last_value") + F.col("slope") * ahead)
    predicted = F.least(predicted, F.col("peak") * 1.2)
    return _output(grid, series, predicted, multiplicative(predicted, 0.7, 1.3), version, None)


def stable_baseline(
    df: DataFrame, base: str | Column = FORECAST_START, steps: int = HORIZON, step: str = "1 month",
    series: Series = Series(), noise: float = 0.0, seed: int = 42, version: str = "StableBaseline",
) -> DataFrame:
    """The last value, or in a steep decline the mean without the top fifth.

    ``noise`` (0.05 for ±5 %) is off by default so that results repeat.
    """
    keys = list(series.keys)
    value = F.col(series.value).cast("double")
    fits = (
        filters.min_series_length(df, 2, keys)
        .groupBy(*keys)
        .agg(
            *[c.alias(n) for n, c in _endpoints(series).items()],
            F.collect_list(value).alias("_values"),
            windows.positional_quantile_value(value, 0.8).alias("threshold"),
        )
        .withColumn("baseline", _mean(F.filter("_values", lambda v: v <= F.col("threshold"))))
        .drop("_values")
    )
    grid = joins.step_grid(fits, base, steps, step)
    level = F.when(F.col("slope") < -0.1, F.col("baseline")).otherwise(F.col("last_value"))
    change = 1 + F.randn(seed) * noise if noise else F.lit(1.0)
    predicted = F.greatest(level * change, F.lit(0.0))
    predicted = clip(predicted, F.col("baseline") * 0.5, F.col("baseline") * 1.5)
    return _output(grid, series, predicted, multiplicative(predicted, 0.8, 1.2), version, None)


def median_blend(
    df: DataFrame, base: str | Column = FORECAST_START, steps: int = HORIZON, step: str = "1 month",
    series: Series = Series(), version: str = "MedianBaseline",
) -> DataFrame:
    """60 % trimmed median and 40 % recent median, with a season and a damped trend."""
    keys = list(series.keys)
    whole = W.partitionBy(*keys)
    value = F.col(series.value).cast("double")
    marked = filters.min_series_length(df, 2, keys).withColumns({
        "_y": value,
        "_rn": F.row_number().over(whole.orderBy(F.desc(series.date))),
        "_q": F.percentile(value, [0.25, 0.75]).over(whole),
    })
    q1, q3 = F.col("_q")[0], F.col("_q")[1]
    inside = F.col("_y").between(q1 - 3 * (q3 - q1), q3 + 3 * (q3 - q1))
    fits = marked.groupBy(*keys).agg(
        *[c.alias(n) for n, c in _endpoints(series).items()],
        F.coalesce(F.median(F.when(inside, F.col("_y"))), F.median("_y")).alias("trimmed"),
        F.median(F.when(F.col("_rn") <= 5, F.col("_y"))).alias("recent"),
    )
    grid = joins.step_grid(fits, base, steps, step)
    i = F.col("step")
    level = F.col("trimmed") * 0.6 + F.col("recent") * 0.4
    season = level * (0.9 + 0.2 * F.sin(2 * F.pi() * i / 12))
    predicted = F.greatest(season + F.col("slope") * (i * 30) * 0.1, F.lit(0.0))
    predicted = clip(predicted, level * 0.7, level * 1.3)
    return _output(grid, series, predicted, multiplicative(predicted, 0.85, 1.15), version, None)


# ------------------------------------------------------- recursive models
#
# These fold an ordered array of one series' months with higher-order functions;
# the array is as long as the calendar.


def _monthly_arrays(df: DataFrame, series: Series, min_rows: int) -> DataFrame:
    """One row per series with its gap-free monthly values as an array.

    The rows are small but the folds over them are not: as many tasks as the cluster's
    shuffles are configured for keep the adaptive planner from packing all series into a few.
    """
    keys = list(series.keys)
    spread = df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)
    usable = filters.min_series_length(spread, min_rows, keys)
    dense = joins.densify(usable, keys, series.date, series.value)
    points = F.array_sort(F.collect_list(F.struct(F.col(series.date).alias("d"), F.col(series.value).cast("double").alias("y"))))
    return (
        dense.groupBy(*keys)
        .agg(points.alias("_points"))
        .select(
            *keys,
            F.transform("_points", lambda p: p["y"]).alias("y"),
            F.element_at("_points", -1)["d"].alias("last_date"),
        )
        .withColumn("n", F.size("y"))
    )


SMOOTHING_GRID = tuple(
    (a, b, g) for a in (0.1, 0.3, 0.5, 0.7, 0.9) for b in (0.01, 0.1, 0.3) for g in (0.05, 0.2, 0.4)
)


def holt_winters(
    df: DataFrame, end: str | Column = FORECAST_END, season: int = 4, series: Series = Series(),
    grid: Sequence[tuple[float, float, float]] = SMOOTHING_GRID, version: str = "Holt-Winters", min_rows: int = 3,
) -> DataFrame:
    """Additive trend, and an additive season once two seasons are known.

    The smoothing weights are those of the grid with the least squared one-step
    error of the series. (A numeric optimiser would find slightly other weights.)
    """
    keys = list(series.keys)
    arrays = _monthly_arrays(df, series, min_rows)
    seasonal = F.col("n") >= 2 * season
    y = F.col("y")
    first = _mean(F.slice(y, 1, season))
    second = _mean(F.slice(y, season + 1, season))
    slope = F.when(seasonal, (second - first) / season).otherwise(F.try_element_at(y, F.lit(2)) - F.element_at(y, 1))
    # the line at month 0: the first season is centred half a season after it
    line = F.when(seasonal, first - slope * ((season + 1) / 2)).otherwise(F.element_at(y, 1) - slope)
    # the season is kept as plain fields s0 … with s0 due next; arrays would be copied at every step
    slots = [f"s{i}" for i in range(season)]
    begin = [
        F.when(seasonal, F.try_element_at(y, F.lit(i + 1)) - (line + slope * (i + 1))).otherwise(0.0).alias(slots[i])
        for i in range(season)
    ]
    start = F.struct(
        line.alias("level"), slope.alias("trend"), *begin, F.lit(0.0).alias("sum_r"), F.lit(0.0).alias("sum_rr")
    )

    def advance(s: Column, value: Column, a: Column, b: Column, g: Column) -> Column:
        """One observation, in error-correction form; the season moves on by one slot."""
        error = value - s["level"] - s["trend"] - s["s0"]
        return F.struct(
            (s["level"] + s["trend"] + a * error).alias("level"),
            (s["trend"] + b * a * error).alias("trend"),
            *[s[later].alias(slot) for slot, later in zip(slots, slots[1:])],
            (s["s0"] + g * error).alias(slots[-1]),
            (s["sum_r"] + error).alias("sum_r"),
            (s["sum_rr"] + error * error).alias("sum_rr"),
        )

    weights = F.array(*[
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(g).alias("g")) for a, b, g in grid
    ])
    tried = arrays.withColumn("_start", start).withColumn("w", F.explode(weights))
    tried = tried.select(
        *keys, "y", "n", "last_date", "_start", "w", F.col("w.a").alias("a"), F.col("w.b").alias("b"),
        F.when(seasonal, F.col("w.g")).otherwise(0.0).alias("g"),
    )
    state = F.aggregate(y, F.col("_start"), lambda s, v: advance(s, v, F.col("a"), F.col("b"), F.col("g")))
    best = (
        tried.withColumn("state", state)
        .groupBy(*keys)
        .agg(
            F.min_by(F.struct("state", "n", "last_date"), F.struct(F.col("state.sum_rr"), F.col("w"))).alias("fit")
        )
        .select(*keys, "fit.*")
    )
    mean_r = F.col("state.sum_r") / F.col("n")
    resid_std = F.sqrt(F.greatest(F.col("state.sum_rr") / F.col("n") - mean_r * mean_r, F.lit(0.0)))
    horizon = joins.horizon_grid(best, F.add_months("last_date", 1), end)
    h = F.col("step") + 1
    due = F.element_at(F.array(*[F.col(f"state.{slot}") for slot in slots]), (F.col("step") % season + 1).cast("int"))
    predicted = F.col("state.level") + F.col("state.trend") * h + due
    return _output(horizon, series, predicted, residual_sqrt_step(predicted, resid_std, h), version, 2)


LONG_LAGS, SEASON_LAGS = (1, 2, 3), (0, 1)  # of the first stage: these, and these after one season


def seasonal_ar(
    df: DataFrame, end: str | Column = FORECAST_END, season: int = 12, series: Series = Series(),
    min_rows: int = 6, z: float = Z95, moving_average: bool = True,
) -> DataFrame:
    """Autoregression with moving-average terms on the seasonal and first difference.

    Stands in for a seasonal ARIMA (1,1,1)(1,1,1) by two least-squares stages: the residuals of a long autoregression
    are the shocks, then the series is regressed on its own lags 1, 12 and 13 and on the shocks at the same lags.
    Future shocks are 0. Series of less than four seasons and a half have no moving-average terms; those too short
    for seasonal lags use lag 1 of the first difference, with the last shock from ten points on.
    """
    keys = list(series.keys)
    arrays = _monthly_arrays(df, series, min_rows)
    n, y = F.col("n"), F.col("y")
    seasonal = n >= 2 * season + 6
    shocks = F.when(seasonal, n >= 4 * season + 6).otherwise(n >= 10) if moving_average else F.lit(False)

    def at(values: Column, i: Column | int) -> Column:
        return F.try_element_at(values, (F.lit(i) if isinstance(i, int) else i).cast("int"))

    def change(i: Column) -> Column:
        """The differenced value at 1-based position i."""
        return F.when(F.col("seasonal"), at(y, i) - at(y, i - 1) - at(y, i - season) + at(y, i - season - 1)).otherwise(at(y, i) - at(y, i - 1))

    def lagged(values: Column, i: Column, lags: Sequence[int]) -> list[Column]:
        """The values so many places before i; seasonal ones only where the series has a season."""
        return [at(values, i - lag) if lag < season else F.when(F.col("seasonal"), at(values, F.greatest(i - lag, F.lit(1)))).otherwise(0.0) for lag in lags]

    flagged = arrays.withColumns({"seasonal": seasonal, "shocks": shocks})
    first = F.when(F.col("seasonal"), season + 2).otherwise(2)
    changes = flagged.withColumns({
        "w": F.transform(F.sequence(first, n), change),
        "deep": F.when(F.col("seasonal"), season + 1).otherwise(F.when(F.col("shocks"), max(LONG_LAGS)).otherwise(1)),
    }).select(*keys, "y", "last_date", "seasonal", "shocks", "deep", "w", F.size("w").alias("size"))
    w, size, i = F.col("w"), F.col("size"), F.col("i")

    # first stage: the shocks
    long = (*LONG_LAGS, *(season + lag for lag in SEASON_LAGS))
    names = [f"l{lag}" for lag in long]
    rows = changes.filter("shocks").select(*keys, "seasonal", "w", F.explode(F.sequence(F.col("deep") + 1, size)).alias("i"))
    rows = rows.select(*keys, at(w, i).alias("now"), *[v.alias(name) for v, name in zip(lagged(w, i, long), names)])
    stage = solve_pairs(rows.groupBy(*keys).agg(*pair_statistics(names, "now")), names).select(*keys, F.struct("intercept", *[f"coef_{c}" for c in names]).alias("long"))

    def shock(i: Column) -> Column:
        explained = F.col("long.intercept")
        for name, value in zip(names, lagged(w, i, long)):
            explained = explained + F.col(f"long.coef_{name}") * value
        return F.when(F.col("long").isNull() | (i <= F.col("deep")), 0.0).otherwise(at(w, i) - explained)

    known = changes.join(stage, keys, "left").withColumn("e", F.transform(F.sequence(F.lit(1), size), shock)).drop("long")

    # second stage: own lags and shocks
    lags = (1, season, season + 1)
    terms = [*(f"l{lag}" for lag in lags), *(f"e{lag}" for lag in lags)]
    e = F.col("e")

    def values(i: Column) -> list[Column]:
        past = [*lagged(w, i, lags), *lagged(e, i, lags)]
        return [F.coalesce(v, F.lit(0.0)) for v in past]

    start = F.col("deep") * F.when(F.col("shocks"), 2).otherwise(1) + 1
    positions = F.when(start <= size, F.sequence(F.least(start, size), size)).otherwise(F.array().cast("array<int>"))
    rows = known.select(*keys, "seasonal", "w", "e", F.explode(positions).alias("i"))
    rows = rows.select(*keys, at(w, i).alias("now"), *[v.alias(name) for v, name in zip(values(i), terms)])
    solved = solve_pairs(rows.groupBy(*keys).agg(*pair_statistics(terms, "now")), terms)
    fit = known.join(solved, keys)
    residuals = F.transform(positions, lambda i: at(w, i) - fitted(values(i), terms))
    square = F.aggregate(residuals, F.lit(0.0), lambda total, r: total + r * r)
    fit = fit.withColumn("sigma", F.sqrt(F.try_divide(square, F.size(positions))))

    # the recursion on the tails: months, changes and shocks
    keep = season + 1
    ahead = F.greatest(dates.month_gap(_day(end), F.col("last_date")), F.lit(0))

    def extend(s: Column, _: Column) -> Column:
        after = F.size(s["w"]) + 1
        past = [*lagged(s["w"], after, lags), *lagged(s["e"], after, lags)]
        step = fitted([F.coalesce(v, F.lit(0.0)) for v in past], terms)
        before = F.when(F.col("seasonal"), at(s["y"], -season) - at(s["y"], -season - 1)).otherwise(0.0)
        return F.struct(
            F.concat(s["y"], F.array(step + at(s["y"], -1) + before)).alias("y"),
            F.concat(s["w"], F.array(step)).alias("w"), F.concat(s["e"], F.array(F.lit(0.0))).alias("e"))

    tail = lambda values: F.slice(values, F.greatest(F.size(values) - keep + 1, F.lit(1)), keep)
    begin = F.struct(tail(y).alias("y"), tail(w).alias("w"), tail(e).alias("e"))
    rolled = (
        fit.filter(ahead > 0)
        .withColumn("path", F.aggregate(F.sequence(F.lit(1), ahead), begin, extend)["y"])
        .withColumn("path", F.slice("path", F.size("path") - ahead + 1, ahead))
        .select(*keys, "seasonal", "shocks", "sigma", "last_date", F.posexplode("path").alias("step", "value"))
        .withColumn("forecast_date", F.add_months("last_date", F.col("step") + 1))
    )
    half = z * F.col("sigma") * F.sqrt(F.col("step") + 1)
    predicted = F.greatest(F.col("value"), F.lit(0.0))
    band = model_band(predicted, F.col("value") - half, F.col("value") + half)
    version = F.when(F.col("seasonal"), F.when(F.col("shocks"), f"SeasonalARMA(1,{season},{season + 1})").otherwise(f"SeasonalAR(1,{season},{season + 1})")).otherwise(
        F.when(F.col("shocks"), "ARMA(1,1)").otherwise("AR(1)"))
    return _output(rolled, series, predicted, band, version, 2)


def _day(value: str | Column) -> Column:
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def lag_rollout(
    df: DataFrame, k: int = 6, steps: int = HORIZON, step: str = "1 month", series: Series = Series(),
    min_rows: int | None = None,
) -> DataFrame:
    """Next-value regression on the last k scaled values, applied to its own output.

    One linear model (``pyspark.ml``) is trained on the windows of all series; only
    its k + 1 numbers come to the driver. Returns the series keys, step (0-based),
    forecast_date, base (unscaled prediction), hist_mean and volatility.
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    keys = list(series.keys)
    usable = filters.min_series_length(df, min_rows or k + 2, keys)
    scaled = windows.minmax_scale(usable, keys, series.value)
    lagged = _lag_rows(scaled, k, series)
    names = [f"lag_{i}" for i in range(k, 0, -1)]
    model = LinearRegression(featuresCol="x", labelCol="target", regParam=0.0, solver="normal").fit(
        VectorAssembler(inputCols=names, outputCol="x").transform(lagged)
    )
    weights, intercept = [float(c) for c in model.coefficients], float(model.intercept)

    value = F.col(series.value).cast("double")
    newest = F.slice(
        F.transform(
            F.array_sort(F.collect_list(F.struct(F.col(series.date).alias("d"), F.col("scaled").alias("s")))),
            lambda p: p["s"],
        ),
        -k,
        k,
    )
    state = scaled.groupBy(*keys).agg(
        newest.alias("buffer"),
        F.max(series.date).alias("last_date"),
        F.min("series_min").cast("double").alias("lo"),
        F.max("series_max").cast("double").alias("hi"),
        F.avg(value).alias("hist_mean"),
        safe_ratio(F.stddev_pop(value), F.avg(value)).alias("volatility"),
    )

    def extend(path: Column, _: Column) -> Column:
        recent = F.slice(path, -k, k)
        following = F.lit(intercept)
        for i, weight in enumerate(weights):
            following = following + F.lit(weight) * F.element_at(recent, i + 1)
        return F.concat(path, F.array(following))

    rolled = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), F.col("buffer"), extend)
    return (
        state.withColumn("path", F.slice(rolled, k + 1, steps))
        .select(*keys, "last_date", "lo", "hi", "hist_mean", "volatility", F.posexplode("path").alias("step", "s"))
        .withColumns({
            "forecast_date": dates.add_period("last_date", F.col("step") + 1, step),
            "base": F.col("s") * (F.col("hi") - F.col("lo")) + F.col("lo"),
        })
        .drop("s", "lo", "hi", "last_date")
    )


def _lag_rows(scaled: DataFrame, k: int, series: Series) -> DataFrame:
    order = W.partitionBy(*series.keys).orderBy(series.date)
    lags = {f"lag_{i}": F.lag("scaled", i).over(order) for i in range(k, 0, -1)}
    return scaled.withColumns(lags).filter(F.col(f"lag_{k}").isNotNull()).select(
        *lags, F.col("scaled").alias("target")
    )


def lag_regression(
    df: DataFrame, k: int = 6, steps: int = HORIZON, step: str = "1 month", series: Series = Series(),
    version: str = "LagRegression",
) -> DataFrame:
    """``lag_rollout`` as a forecast with bounds from the series' volatility (at least 8 rows)."""
    rolled = lag_rollout(df, k, steps, step, series)
    predicted = F.greatest(F.col("base"), F.lit(0.0))
    return _output(rolled, series, predicted, volatility_band(predicted, F.col("volatility")), version, None)


def growth_blend(
    rollout: DataFrame, series: Series = Series(), growth: float = 0.015, version: str = "GrowthBlend"
) -> DataFrame:
    """70 % of a rollout and 30 % of the compounded historical mean, with a season; at least 5."""
    i = F.col("step")
    grown = F.col("hist_mean") * F.pow(F.lit(1.0 + growth), i + 1)
    season = 1 + 0.15 * F.sin(2 * F.pi() * (i % 12) / 12)
    predicted = F.greatest((0.7 * F.col("base") + 0.3 * grown) * season, F.lit(5.0))
    return _output(rollout, series, predicted, volatility_band(predicted, F.col("volatility"), 2.0), version, None)
