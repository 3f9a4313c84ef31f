"""Per-series least squares as Spark aggregates.

Every fit needs one shuffle on the series key: the covariances of the features and
the label are ordinary aggregates (updated in centred form, hence well conditioned),
and the 3×3 system is solved by column expressions on one row per series.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import dates
from ..operators.windows import time_series_folds

FEATURES = ("t", "sin_m", "cos_m")
SINGULAR = 1e-12  # eigenvalue ratio below which a direction counts as absent


def season_values(day: Column, origin: Column) -> dict[str, Column]:
    angle = 2 * F.pi() * F.month(day) / 12
    return {"t": dates.months_since(day, origin), "sin_m": F.sin(angle), "cos_m": F.cos(angle)}


def season_features(df: DataFrame, date_col: str, origin: Column | None = None) -> DataFrame:
    """Trend on the 30.44-day axis and the annual sine and cosine.

    The origin defaults to the earliest date of the whole table, not of the series.
    """
    start = df.agg(F.min(date_col)).scalar() if origin is None else origin
    return df.withColumns(season_values(F.col(date_col), start))


def ols_statistics(features: Sequence[str], label: str, where: str | None = None) -> list[Column]:
    """Aggregates that determine a least-squares fit with intercept on three features.

    ``where`` names a boolean column; rows where it does not hold are left out.
    """

    def kept(name: str) -> str:
        value = f"cast({name} as double)"
        return value if where is None else f"if({where}, {value}, null)"

    xs, y = [kept(f) for f in features], kept(label)
    stats = [f"avg({x}) as _m{i}" for i, x in enumerate(xs)] + [f"avg({y}) as _my", f"var_pop({y}) as _vy"]
    stats += [f"covar_pop({x}, {y}) as _b{i}" for i, x in enumerate(xs)]
    stats += [f"covar_pop({xs[i]}, {xs[j]}) as _a{i}{j}" for i in range(3) for j in range(i, 3)]
    return [F.expr(s) for s in stats]


def _determinant(m: Sequence[Sequence[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def solve_ols(sums: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """Replace ``ols_statistics`` by intercept, three slopes and the residual variance.

    A singular fit is the one of minimum norm.

    Full rank: Cramer's rule. With fewer independent directions the pseudo-inverse
    of the symmetric covariance matrix A follows from its characteristic polynomial:
    with trace p and sum of principal 2×2 minors q, rank 2 gives
    ((p² − q)·A·b − p·A²·b) / q², and rank 1 gives A·b / p².
    """
    three = range(3)
    a = [[f"_a{min(i, j)}{max(i, j)}" for j in three] for i in three]
    swapped = [[[f"_b{i}" if j == k else a[i][j] for j in three] for i in three] for k in three]

    def product(row: Sequence[str], vector: str) -> str:
        return " + ".join(f"{row[j]} * {vector}{j}" for j in three)

    given = [c for c in sums.columns if not re.fullmatch(r"_(m[012y]|vy|b[012]|a[012]{2})", c)]
    minors = [f"({a[i][i]} * {a[j][j]} - {a[i][j]} * {a[i][j]})" for i, j in ((0, 1), (0, 2), (1, 2))]
    first = sums.selectExpr(
        "*",
        "_a00 + _a11 + _a22 as _p",
        f"{' + '.join(minors)} as _q",
        f"{_determinant(a)} as _det",
        *[f"{_determinant(swapped[k])} as _det{k}" for k in three],
        *[f"{product(a[k], '_b')} as _ab{k}" for k in three],
    )
    second = first.selectExpr("*", *[f"{product(a[k], '_ab')} as _aab{k}" for k in three])
    slopes = second.selectExpr("*", *[
        f"""case when _q > {SINGULAR} * _p * _p and _det > {SINGULAR} * _p * _q then _det{k} / _det
                 when _q > {SINGULAR} * _p * _p then ((_p * _p - _q) * _ab{k} - _p * _aab{k}) / (_q * _q)
                 else coalesce(try_divide(_ab{k}, _p * _p), 0D) end as coef_{features[k]}"""
        for k in three
    ])
    intercept = "_my - " + " - ".join(f"coef_{features[k]} * _m{k}" for k in three)
    # the explained part of the variance is coef·b, as the fit solves the normal equations
    explained = " + ".join(f"coef_{features[k]} * _b{k}" for k in three)
    return slopes.selectExpr(
        *given, f"{intercept} as intercept", *[f"coef_{f}" for f in features],
        f"greatest(_vy - ({explained}), 0D) as resid_var",
    )


def pair_statistics(features: Sequence[str], label: str) -> list[Column]:
    """Aggregates that determine a least-squares fit with intercept on any number of features."""
    xs, y = [f"cast({f} as double)" for f in features], f"cast({label} as double)"
    k = range(len(xs))
    stats = [f"avg({x}) as _m{i}" for i, x in enumerate(xs)] + [f"avg({y}) as _my"]
    stats += [f"covar_pop({xs[i]}, {y}) as _b{i}" for i in k]
    stats += [f"covar_pop({xs[i]}, {xs[j]}) as _a{i}_{j}" for i in k for j in k if i <= j]
    return [F.expr(s) for s in stats]


def solve_pairs(sums: DataFrame, features: Sequence[str], keep: float = 1e-10) -> DataFrame:
    """Replace ``pair_statistics`` by intercept and slopes.

    The covariance matrix is eliminated feature by feature, one projection each. A feature of which less than
    ``keep`` of its variance is left by the ones before it gets the slope 0.
    """
    k = range(len(features))
    given = [c for c in sums.columns if not re.fullmatch(r"_(m(\d+|y)|b\d+|a\d+_\d+)", c)]
    cell = [[f"_a{min(i, j)}_{max(i, j)}" for j in k] for i in k]
    at = sums.selectExpr(*given, "_my", *[f"_m{i}" for i in k], *[f"{cell[i][i]} as _v{i}" for i in k],
                         *[f"_b{i} as _y{i}" for i in k], *[f"{cell[i][j]} as _c{i}_{j}" for i in k for j in k])
    for p in k:
        used = f"_c{p}_{p} > {keep} * _v{p}"
        factor = {i: f"if({used}, _c{i}_{p} / _c{p}_{p}, 0D)" for i in k if i != p}
        at = at.selectExpr(
            *given, "_my", *[f"_m{i}" for i in k], *[f"_v{i}" for i in k],
            *[f"_y{i} - {factor[i]} * _y{p} as _y{i}" if i != p else f"if({used}, _y{p}, 0D) as _y{p}" for i in k],
            *[f"_c{i}_{j} - {factor[i]} * _c{p}_{j} as _c{i}_{j}" if i != p else f"if({used}, _c{p}_{j}, {float(p == j)}D) as _c{p}_{j}"
              for i in k for j in k])
    slopes = [f"coalesce(try_divide(_y{i}, _c{i}_{i}), 0D) as coef_{f}" for i, f in enumerate(features)]
    solved = at.selectExpr(*given, "_my", *[f"_m{i}" for i in k], *slopes)
    intercept = " - ".join(["_my", *[f"coef_{f} * _m{i}" for i, f in enumerate(features)]])
    return solved.selectExpr(*given, f"{intercept} as intercept", *[f"coef_{f}" for f in features])


def fitted(features: Sequence[Column], names: Sequence[str] = FEATURES) -> Column:
    """Prediction from the solution columns for the given feature values."""
    value = F.col("intercept")
    for name, x in zip(names, features):
        value = value + F.col(f"coef_{name}") * x
    return value


def grouped_ols(
    df: DataFrame, key: str | Sequence[str], features: Sequence[str] = FEATURES, label: str = "demand_count"
) -> DataFrame:
    """One row of coefficients per key: intercept and a slope for each of three features."""
    keys = [key] if isinstance(key, str) else list(key)
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *ols_statistics(features, label))
    return solve_ols(sums, features).drop("resid_var")


@dataclass(frozen=True)
class Series:
    """Column names of a demand table. ``keys`` identify a series."""

    keys: tuple[str, ...] = ("skill_name",)
    date: str = "period_start"
    value: str = "demand_count"


def cross_validate(df: DataFrame, series: Series = Series(), k: int = 3, origin: Column | None = None) -> DataFrame:
    """RMSE, MAE and R² per series, averaged over expanding-window folds.

    R² is undefined for a one-row test block and left out of the mean. All folds of
    all series are fitted by one aggregate; the test rows ride along as an array of
    at most n // (k+1) points per fold, so fit and test need no join.
    """
    featured = season_features(df, series.date, origin)
    folds = time_series_folds(featured, k, series.keys, series.date)
    test_point = F.struct(*FEATURES, F.col(series.value).cast("double").alias("y"))
    fits = (
        folds.withColumn("_train", ~F.col("is_test"))
        .groupBy(*series.keys, "fold")
        .agg(
            F.count_if("_train").alias("_size"),
            F.collect_list(F.when(F.col("is_test"), test_point)).alias("_test"),
            *ols_statistics(FEATURES, series.value, "_train"),
        )
        .filter(F.col("_size") >= 2)
    )
    # unfolded before predicting, so that the coefficients are computed once per fold
    tests = solve_ols(fits).withColumn("p", F.explode("_test"))
    yhat = fitted([F.col(f"p.{f}") for f in FEATURES])
    points = tests.select(*series.keys, "fold", F.col("p.y").alias("y"), (F.col("p.y") - yhat).alias("error"))
    y, error = F.col("y"), F.col("error")
    per_fold = points.groupBy(*series.keys, "fold").agg(
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        r_squared(F.sum(error * error), F.var_pop(y) * F.count(y), F.count(y)).alias("r2"),
    )
    return per_fold.groupBy(*series.keys).agg(
        F.avg("rmse").alias("rmse"), F.avg("mae").alias("mae"), F.avg("r2").alias("r2"),
        F.count(F.lit(1)).alias("n_folds"),
    )


def r_squared(squared_error: Column, total: Column, n: Column) -> Column:
    """Undefined for one point; a constant target scores 1 when exact and 0 otherwise."""
    return F.when(n < 2, F.lit(None)).otherwise(
        F.when(total > 0, 1 - F.try_divide(squared_error, total)).when(squared_error == 0, 1.0).otherwise(0.0)
    )
