"""Ordered operators over demand series.

Series operators expect one row per (series, month), as the aggregates deliver it.
A window partition then holds at most as many rows as the calendar has months,
however many raw postings stand behind it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, Window as W

from ..functions import dates

KEY, DATE, VALUE = "skill_name", "period_start", "demand_count"


def ranked(df: DataFrame, order: Sequence[Column], limit: int, name: str = "rank") -> DataFrame:
    """The first ``limit`` rows with their 1-based rank.

    The limit comes first, so the single-partition window sees ``limit`` rows only.
    """
    return df.orderBy(*order).limit(limit).withColumn(name, F.row_number().over(W.orderBy(*order)))


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salt_on: Sequence[str],
    salts: int = 64,
) -> DataFrame:
    """The first ``n`` rows of every group, also when one group holds most of the rows.

    A group is first reduced within ``salts`` slices and then once more as a whole:
    the first n of a group are among the first n of its slices, so the result is exact.
    """
    sliced = df.withColumn("_salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)))
    first = W.partitionBy(*keys, "_salt").orderBy(*order)
    second = W.partitionBy(*keys).orderBy(*order)
    return (
        sliced.withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") <= n)
        .withColumn("_rn", F.row_number().over(second))
        .filter(F.col("_rn") <= n)
        .drop("_salt", "_rn")
    )


def last_n(df: DataFrame, n: int, key: str = KEY, order: str = DATE) -> DataFrame:
    """The latest ``n`` rows of each series."""
    newest = W.partitionBy(key).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= n).drop("_rn")


def first_n(df: DataFrame, n: int, key: str = KEY, order: str = DATE) -> DataFrame:
    oldest = W.partitionBy(key).orderBy(F.asc(order))
    return df.withColumn("_rn", F.row_number().over(oldest)).filter(F.col("_rn") <= n).drop("_rn")


def gaps(df: DataFrame, max_gap: int = 2, key: str = KEY, date_col: str = DATE) -> DataFrame:
    """Neighbouring rows of a series that lie more than ``max_gap`` months apart."""
    before = F.lag(date_col).over(W.partitionBy(key).orderBy(date_col))
    return (
        df.select(key, before.alias("gap_start"), F.col(date_col).alias("gap_end"))
        .withColumn("gap_months", dates.month_gap("gap_end", "gap_start"))
        .filter(F.col("gap_months") > max_gap)
    )


def endpoint_slope_value(date_col: str = DATE, value: str = VALUE) -> Column:
    """Aggregate: change per day between the first and the last point; 0 on one day."""
    rise = F.max_by(value, date_col) - F.min_by(value, date_col)
    run = F.datediff(F.max(date_col), F.min(date_col))
    return F.coalesce(F.try_divide(rise.cast("double"), run), F.lit(0.0))


def endpoint_slope(df: DataFrame, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    return df.groupBy(key).agg(endpoint_slope_value(date_col, value).alias("slope_per_day"))


def trailing_window(
    df: DataFrame, days: int = 180, min_rows: int = 2, fallback: int = 3, key: str = KEY, date_col: str = DATE
) -> DataFrame:
    """Rows within ``days`` of the series' last date; the last rows when those are too few."""
    series = W.partitionBy(key)
    cutoff = F.date_sub(F.max(date_col).over(series), days)
    marked = df.withColumns({
        "_recent": F.col(date_col) >= cutoff,
        "_rn": F.row_number().over(series.orderBy(F.desc(date_col))),
    })
    enough = F.count_if("_recent").over(series) >= min_rows
    return (
        marked.withColumn("_enough", enough)
        .filter(F.when(F.col("_enough"), F.col("_recent")).otherwise(F.col("_rn") <= fallback))
        .drop("_recent", "_rn", "_enough")
    )


def lag_windows(df: DataFrame, k: int, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Each run of k values (``lag_k`` oldest … ``lag_1`` newest) with the next value as target."""
    order = W.partitionBy(key).orderBy(date_col)
    lags = {f"lag_{i}": F.lag(value, i).over(order) for i in range(k, 0, -1)}
    numbered = df.withColumns({**lags, "_rn": F.row_number().over(order)})
    return numbered.filter(F.col("_rn") > k).select(
        key, date_col, *lags, F.col(value).alias("target")
    )


def minmax_scale(df: DataFrame, key: str = KEY, value: str = VALUE, name: str = "scaled") -> DataFrame:
    """Each series mapped to [0, 1]; a constant series maps to 0. Keeps the range for the inverse."""
    series = W.partitionBy(key)
    ranged = df.withColumns({"series_min": F.min(value).over(series), "series_max": F.max(value).over(series)})
    span = (F.col("series_max") - F.col("series_min")).cast("double")
    return ranged.withColumn(name, F.coalesce(F.try_divide(F.col(value) - F.col("series_min"), span), F.lit(0.0)))


def minmax_inverse(df: DataFrame, scaled: str = "scaled", name: str = "value") -> DataFrame:
    span = F.col("series_max") - F.col("series_min")
    return df.withColumn(name, F.col(scaled) * span + F.col("series_min"))


def iqr_flags(
    df: DataFrame, k: float = 1.5, key: str | None = KEY, value: str = VALUE
) -> DataFrame:
    """Quartile fences per series, or over all rows of the demand table when ``key`` is None."""
    quartiles = F.percentile(value, [0.25, 0.75])
    if key is None:
        fences = df.agg(quartiles).scalar()
        placed = df.withColumn("_q", fences)
    else:
        placed = df.withColumn("_q", quartiles.over(W.partitionBy(key)))
    low, high = F.col("_q")[0], F.col("_q")[1]
    return (
        placed.withColumns({"lower_fence": low - k * (high - low), "upper_fence": high + k * (high - low)})
        .withColumn("is_outlier", (F.col(value) < F.col("lower_fence")) | (F.col(value) > F.col("upper_fence")))
        .drop("_q")
    )


def beyond_sigma(value: str, k: float, key: str | Sequence[str]) -> Column:
    """Whether a point lies more than k sample deviations from the mean of its series.

    The comparison |x − mean| > k·std is squared and multiplied out, so that for
    whole numbers every term is exact and a point that lies on the limit is judged
    the same in every run, whatever order the rows arrive in.
    """
    series = W.partitionBy(key)
    x = F.col(value).cast("double")
    n = F.count(value).over(series)
    total, squares = F.sum(x).over(series), F.sum(x * x).over(series)
    away = n * x - total
    return F.coalesce(away * away * (n - 1) > k * k * n * (n * squares - total * total), F.lit(False))


def sigma_flags(df: DataFrame, k: float = 3.0, key: str = KEY, value: str = VALUE) -> DataFrame:
    """Points beyond mean ± k sample deviations of their series."""
    return df.withColumn("is_outlier", beyond_sigma(value, k, key))


def share_of_peak(df: DataFrame, value: str, width: int = 30) -> DataFrame:
    """Value over the maximum of the column, and a whole bar length of at least 1."""
    share = F.try_divide(F.col(value).cast("double"), df.agg(F.max(value)).scalar())
    return df.withColumns({
        "share": share,
        "bar_length": F.greatest(F.lit(1), F.floor(share * width)).cast("int"),
    })


def positional_quantile_value(value: str | Column = VALUE, q: float = 0.8) -> Column:
    """Aggregate over one series: the sorted value at 0-based position int(n·q)."""
    sorted_values = F.sort_array(F.collect_list(value))
    position = F.floor(F.size(sorted_values) * F.lit(q)).cast("int")
    return F.element_at(sorted_values, F.least(position + 1, F.size(sorted_values)))


def positional_quantile(df: DataFrame, q: float = 0.8, key: str = KEY, value: str = VALUE) -> DataFrame:
    return df.groupBy(key).agg(positional_quantile_value(value, q).alias("threshold"))


def time_series_folds(
    df: DataFrame, k: int = 3, key: str | Sequence[str] = KEY, date_col: str = DATE
) -> DataFrame:
    """Expanding-window folds: each row once per fold it trains or is tested in.

    The test blocks are the last k runs of n // (k+1) rows; series with n < k+1
    have no fold.
    """
    keys = [key] if isinstance(key, str) else list(key)
    series = W.partitionBy(*keys)
    numbered = df.withColumns({
        "_i": F.row_number().over(series.orderBy(date_col)) - 1,
        "_n": F.count(F.lit(1)).over(series),
    }).filter(F.col("_n") >= k + 1)
    block = F.floor(F.col("_n") / (k + 1))
    folds = numbered.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(k)])))
    start = F.col("_n") - (k - F.col("fold")) * block
    return (
        folds.withColumns({"_start": start, "_stop": start + block})
        .filter(F.col("_i") < F.col("_stop"))
        .withColumn("is_test", F.col("_i") >= F.col("_start"))
        .drop("_i", "_n", "_start", "_stop")
    )


def lag_features(
    df: DataFrame, lags: Sequence[int] = (1, 7, 30), key: str = KEY, date_col: str = "day", value: str = VALUE
) -> DataFrame:
    """Values a number of calendar days back; a day without a row gives NULL."""
    day = F.unix_date(F.col(date_col).cast("date"))
    ordered = W.partitionBy(key).orderBy(day)
    return df.withColumns({
        f"lag_{n}d": F.max(value).over(ordered.rangeBetween(-n, -n)) for n in lags
    })


def ema(df: DataFrame, alpha: float, key: str = KEY, date_col: str = DATE, value: str = VALUE) -> DataFrame:
    """Exponential moving average, started at the first value of the series."""
    points = F.array_sort(F.collect_list(F.struct(F.col(date_col).alias("d"), F.col(value).cast("double").alias("y"))))
    series = df.groupBy(key).agg(points.alias("_points"))
    step = F.struct(F.col("d"), F.col("y"), F.col("y").alias("ema"))
    empty = F.array().cast("array<struct<d:date,y:double,ema:double>>")

    def fold(done: Column, point: Column) -> Column:
        last = F.element_at(done, -1)["ema"]
        smoothed = F.when(F.size(done) == 0, point["y"]).otherwise(alpha * point["y"] + (1 - alpha) * last)
        return F.concat(done, F.array(F.struct(point["d"].alias("d"), point["y"].alias("y"), smoothed.alias("ema"))))

    folded = series.select(key, F.explode(F.aggregate("_points", empty, fold)).alias("p"))
    return folded.select(key, F.col("p.d").alias(date_col), F.col("p.y").alias(value), F.col("p.ema").alias("ema"))


def moving_average(
    df: DataFrame, days: int, key: str = KEY, date_col: str = "day", value: str = VALUE, name: str | None = None
) -> DataFrame:
    """Mean over the last ``days`` calendar days, the current day included."""
    day = F.unix_date(F.col(date_col).cast("date"))
    recent = W.partitionBy(key).orderBy(day).rangeBetween(-(days - 1), 0)
    return df.withColumn(name or f"avg_{days}d", F.avg(value).over(recent))


def moving_average_months(
    df: DataFrame, months: int, key: str = KEY, date_col: str = DATE, value: str = VALUE, name: str | None = None
) -> DataFrame:
    """Mean over the last ``months`` calendar months, the current month included."""
    recent = W.partitionBy(key).orderBy(dates.month_index(date_col)).rangeBetween(-(months - 1), 0)
    return df.withColumn(name or f"avg_{months}m", F.avg(value).over(recent))


def fill_gaps(
    df: DataFrame, method: str = "forward", max_missing: float = 0.3, key: str = KEY, date_col: str = DATE,
    value: str = VALUE,
) -> DataFrame:
    """Complete the months of each series and impute them; sparse series are dropped.

    ``forward`` repeats the last known value, ``mean`` uses the series mean.
    """
    # One entry per month, bounded by the calendar.
    series = df.groupBy(key).agg(
        F.min(date_col).alias("_first"),
        F.max(date_col).alias("_last"),
        F.map_from_entries(F.collect_list(F.struct(date_col, value))).alias("_values"),
    )
    grid = series.select(
        key, "_values", F.explode(dates.month_grid(F.col("_first"), F.col("_last"))).alias(date_col)
    ).select(key, date_col, F.try_element_at("_values", F.col(date_col)).cast("double").alias("_raw"))
    whole = W.partitionBy(key)
    missing = F.avg(F.col("_raw").isNull().cast("double")).over(whole)
    if method == "forward":
        filled = F.last("_raw", ignorenulls=True).over(whole.orderBy(date_col))
    elif method == "mean":
        filled = F.coalesce("_raw", F.avg("_raw").over(whole))
    else:
        raise ValueError(f"unknown method {method!r}")
    return (
        grid.withColumns({"_missing": missing, value: filled, "imputed": F.col("_raw").isNull()})
        .filter(F.col("_missing") <= max_missing)
        .drop("_raw", "_missing")
    )
