"""Models against brute force, the golden pair and invariants."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from laborlens.operators import profile
from laborlens.plans import etl, evaluate, forecast, ml
from laborlens.plans import regression as reg
from laborlens.sources import sinks

# Eight monthly posting counts and the forecast they lead to.
GOLDEN_COUNTS = {"2024-01": 1, "2024-02": 22, "2024-03": 46, "2024-04": 19, "2024-05": 19, "2024-06": 10, "2025-03": 7, "2025-04": 11}


@pytest.fixture
def golden(spark):
    rows = [(dt.date.fromisoformat(f"{m}-01"), n) for m, n in GOLDEN_COUNTS.items()]
    return spark.createDataFrame(rows, "date date, count int")


def test_golden_forecast(golden):
    got = forecast.stable_mean_forecast(golden).orderBy("forecast_date").collect()
    assert len(got) == 32 and got[0].forecast_date == dt.date(2025, 5, 1) and got[-1].forecast_date == dt.date(2027, 12, 1)
    for i, r in enumerate(got):
        assert (r.predicted_demand, r.confidence_lower, r.confidence_upper) == (9.0 + i, round(3.46 + i, 2), round(14.54 + i, 2))


def test_golden_document(spark, golden, tmp_path):
    predicted = forecast.stable_mean_forecast(golden).select(
        F.col("forecast_date").alias("date"), F.col("predicted_demand").alias("count"), "confidence_lower", "confidence_upper"
    )
    doc = sinks.trend_document(golden, predicted).first()
    assert [p.date[:7] for p in doc.historical] == list(GOLDEN_COUNTS) and doc.historical[0].confidenceLower is None
    assert (doc.predicted[-1]["count"], doc.predicted[-1].confidenceLower, doc.predicted[-1].confidenceUpper) == (40.0, 34.46, 45.54)


def design(days, origin):
    t = np.array([(d - origin).days / 30.44 for d in days])
    m = np.array([d.month for d in days])
    return np.column_stack([t, np.sin(2 * np.pi * m / 12), np.cos(2 * np.pi * m / 12)])


def least_squares(x, y):
    """Coefficients of the minimum-norm fit with intercept."""
    center = x.mean(axis=0)
    slopes = np.linalg.lstsq(x - center, y - y.mean(), rcond=None)[0]
    return slopes, y.mean() - center @ slopes


@pytest.mark.parametrize("n", [2, 3, 4, 5, 24, 60])
def test_grouped_ols(series, n):
    y = np.random.default_rng(n).integers(0, 50, n).astype(float)
    df = reg.season_features(series({"a": list(y)}), "period_start")
    got = reg.grouped_ols(df, "skill_name").first()
    days = [r.period_start for r in df.orderBy("period_start").collect()]
    slopes, intercept = least_squares(design(days, days[0]), y)
    assert (got.coef_t, got.coef_sin_m, got.coef_cos_m, got.intercept) == pytest.approx((*slopes, intercept), rel=1e-6, abs=1e-7)


def test_ols_with_one_month_of_the_year(series):
    points = [None] * 37
    for i in (0, 12, 24, 36):
        points[i] = i * 2.0 + (i % 24)
    df = reg.season_features(series({"a": points}), "period_start")
    got = reg.grouped_ols(df, "skill_name").first()
    rows = df.orderBy("period_start").collect()
    slopes, intercept = least_squares(design([r.period_start for r in rows], rows[0].period_start), np.array([r.demand_count for r in rows]))
    assert (got.coef_t, got.coef_sin_m, got.intercept) == pytest.approx((slopes[0], slopes[1], intercept), abs=1e-6)


def test_cross_validation(series):
    y = {"a": np.random.default_rng(5).integers(5, 60, 31).astype(float), "b": np.array([3.0, 5, 4, 8]), "c": np.array([1.0, 2, 3])}
    df = series({k: list(v) for k, v in y.items()})
    got = {r.skill_name: r for r in reg.cross_validate(df).collect()}
    assert "c" not in got
    days = sorted(r.period_start for r in df.filter("skill_name = 'a'").collect())
    for name in "ab":
        v = y[name]
        n, x = len(v), design(days[: len(v)], days[0])
        size, scores = n // 4, []
        for k in (3, 2, 1):
            train, test = slice(0, n - k * size), slice(n - k * size, n - k * size + size)
            if train.stop < 2:
                continue
            slopes, intercept = least_squares(x[train], v[train])
            e = v[test] - x[test] @ slopes - intercept
            spread = ((v[test] - v[test].mean()) ** 2).sum()
            scores.append((math.sqrt((e**2).mean()), abs(e).mean(), 1 - (e**2).sum() / spread if size > 1 else np.nan))
        want = np.nanmean(np.array(scores), axis=0) if name == "a" else np.array(scores).mean(axis=0)
        assert (got[name].rmse, got[name].mae) == pytest.approx(want[:2], rel=1e-6)
        assert got[name].n_folds == len(scores)
        assert got[name].r2 == pytest.approx(want[2], rel=1e-6) if name == "a" else got[name].r2 is None


def test_linear_forecast(series):
    rng = np.random.default_rng(9)
    data = {"long": rng.integers(10, 90, 40).astype(float), "spiky": np.array([5.0, 90, 80, 6, 7]), "tiny": np.array([4.0, 6, 9]), "two": np.array([1.0, 2])}
    df = series({k: list(v) for k, v in data.items()})
    spikes = ["2000-02-01", "2000-03-01"]
    got = forecast.linreg_forecast(df, "2004-01-01", "2004-12-01", spikes).orderBy("skill_name", "forecast_date").collect()
    assert len(got) == 36 and {r.skill_name for r in got} == {"long", "spiky", "tiny"}
    origin = dt.date(2000, 1, 1)
    months = [dt.date(2000 + i // 12, i % 12 + 1, 1) for i in range(40)]
    ahead = [dt.date(2004, m, 1) for m in range(1, 13)]
    for name, y in data.items():
        if len(y) < 3:
            continue
        kept = [i for i in range(len(y)) if i not in (1, 2)]
        kept = kept if len(kept) >= 3 else list(range(len(y)))
        x, v = design([months[i] for i in kept], origin), y[kept]
        slopes, intercept = least_squares(x, v)
        level = v[-3:].mean()
        line = design(ahead, origin) @ slopes + intercept + level - (x[-3:] @ slopes + intercept).mean()
        p = np.maximum(np.clip(line, level * 0.5, level * 2), 0)
        half = 1.96 * max((v - x @ slopes - intercept).std(), level * 0.1)
        rows = [r for r in got if r.skill_name == name]
        assert [r.predicted_demand for r in rows] == pytest.approx(list(p), abs=1e-4)
        assert [r.confidence_lower for r in rows] == pytest.approx(list(np.maximum(p - half, 0)), abs=1e-4)
        assert [r.confidence_upper for r in rows] == pytest.approx(list(p + half), abs=1e-4)


def smooth(y, a, b, g, season):
    """Additive smoothing of one series, step by step: errors and the state at its end."""
    first, second = np.mean(y[:season]), np.mean(y[season : 2 * season])
    trend = (second - first) / season
    level = first - trend * (season + 1) / 2
    due = list(y[:season] - level - trend * np.arange(1, season + 1))
    errors = []
    for value in y:
        base, s = level + trend, due.pop(0)
        errors.append(value - base - s)
        new = a * (value - s) + (1 - a) * base
        trend = b * (new - level) + (1 - b) * trend
        level = new
        due.append(g * (value - base) + (1 - g) * s)
    return np.array(errors), level, trend, due


def test_holt_winters(series):
    y = 40 + 0.5 * np.arange(30) + np.tile([0, 6, -4, -2], 8)[:30] + np.random.default_rng(2).normal(size=30)
    got = forecast.holt_winters(series({"a": list(y)}), "2003-06-01").orderBy("forecast_date").collect()
    fits = [smooth(y, *w, 4) for w in forecast.SMOOTHING_GRID]
    errors, level, trend, due = min(fits, key=lambda f: (f[0] ** 2).sum())
    assert len(got) == 12
    for i, r in enumerate(got):
        p = level + trend * (i + 1) + due[i % 4]
        half = 1.96 * errors.std() * math.sqrt(i + 1)
        assert (r.predicted_demand, r.confidence_upper) == pytest.approx((p, p + half), abs=0.006)
        assert r.confidence_lower == pytest.approx(max(0, p - half), abs=0.006)


def test_holt_winters_continues_a_line(series):
    got = forecast.holt_winters(series({"a": [3, 5, 7, 9, 11], "old": [1, 2]}), "2000-08-01").orderBy("forecast_date").collect()
    assert [r.predicted_demand for r in got] == [13.0, 15.0, 17.0]


def test_seasonal_ar(series):
    rng = np.random.default_rng(4)
    y = np.maximum(20 + 0.3 * np.arange(60) + 5 * np.sin(np.arange(60) * np.pi / 6) + rng.normal(size=60), 0)
    got = forecast.seasonal_ar(series({"a": list(y)}), "2005-12-01", moving_average=False).orderBy("forecast_date").collect()

    def w(v, i):
        return v[i] - v[i - 1] - v[i - 12] + v[i - 13]

    at = range(26, 60)
    x = np.array([[w(y, i - 1), w(y, i - 12), w(y, i - 13)] for i in at])
    slopes, intercept = least_squares(x, np.array([w(y, i) for i in at]))
    path = list(y)
    for _ in got:
        i = len(path)
        step = intercept + slopes @ [w(path, i - 1), w(path, i - 12), w(path, i - 13)]
        path.append(step + path[-1] + path[-12] - path[-13])
    assert len(got) == 12 and got[0].model_version == "SeasonalAR(1,12,13)"
    assert [r.predicted_demand for r in got] == pytest.approx([max(v, 0) for v in path[60:]], abs=0.006)


def test_short_series_use_the_simple_ar(series):
    got = forecast.seasonal_ar(series({"a": [2, 4, 6, 8, 10, 12], "b": [1, 2]}), "2000-09-01").orderBy("forecast_date").collect()
    assert [r.predicted_demand for r in got] == [14.0, 16.0, 18.0] and got[0].model_version == "AR(1)"


def test_lag_regression(series):
    data = {k: np.random.default_rng(i).integers(5, 40, 30).astype(float) for i, k in enumerate("abc")}
    got = forecast.lag_regression(series({k: list(v) for k, v in data.items()}), k=3, steps=6).orderBy("skill_name", "forecast_date").collect()
    scaled = {k: (v - v.min()) / (v.max() - v.min()) for k, v in data.items()}
    x = np.array([s[i : i + 3] for s in scaled.values() for i in range(27)])
    slopes, intercept = least_squares(x, np.array([s[i + 3] for s in scaled.values() for i in range(27)]))
    for name, v in data.items():
        path = list(scaled[name])
        for _ in range(6):
            path.append(intercept + slopes @ path[-3:])
        want = [max(p * (v.max() - v.min()) + v.min(), 0) for p in path[30:]]
        rows = [r for r in got if r.skill_name == name]
        assert [r.predicted_demand for r in rows] == pytest.approx(want, rel=1e-6)
        swing = v.std() / (v.mean() + 1e-6)
        assert [r.confidence_upper for r in rows] == pytest.approx([p * (1 + swing) for p in want], rel=1e-6)
        assert rows[0].forecast_date == dt.date(2002, 7, 1)


def test_growth_blend_floor(series):
    rolled = forecast.lag_rollout(series({"a": [1, 0, 0, 0, 0, 0, 0, 9]}), k=3, steps=12)
    got = forecast.growth_blend(rolled)
    assert got.agg(F.min("predicted_demand"), F.min("confidence_lower")).first() == (5.0, 2.0)


@pytest.mark.parametrize("model", [forecast.trend_following, forecast.stable_baseline, forecast.median_blend])
def test_level_models_hold_their_bounds(series, model):
    df = series({"a": [3, 9, 4, 8, 100, 2, 5], "b": [7, 7], "c": [1]})
    got = model(df, "2001-01-01").collect()
    assert len(got) == 64
    assert all(0 <= r.confidence_lower <= r.predicted_demand <= r.confidence_upper for r in got)
    assert sorted(map(tuple, got)) == sorted(map(tuple, model(df, "2001-01-01").collect()))
    stepped = model(df, "2001-01-01", steps=3, step="30 days").filter("skill_name = 'a'").orderBy("forecast_date").collect()
    assert [r.forecast_date for r in stepped] == [dt.date(2001, 1, 1), dt.date(2001, 1, 31), dt.date(2001, 3, 2)]


def test_noise_stays_in_range(series):
    got = forecast.stable_baseline(series({"a": [10, 12, 11, 13]}), noise=0.05).collect()
    assert len({r.predicted_demand for r in got}) > 20
    assert all(0.5 * 11 <= r.predicted_demand <= 1.5 * 11.5 for r in got)


def test_characterize_skips_thin_series(series):
    got = profile.characterize(series({"a": [1, 2, 3, 4], "b": [1, None, 2, None]}))
    assert [(r.skill_name, r.trend_slope, r.length) for r in got.collect()] == [("a", 1.0, 4)]


def test_unknown_options(series):
    df = series({"a": [1, 2, 3]})
    with pytest.raises(ValueError):
        forecast.confidence_band(df, "guess")
    with pytest.raises(ValueError):
        evaluate.region_forecast(df, "2001-01-01", confidence=0.5)


def test_region_forecast_selects(series):
    df = series({"a": [10, 12, 14, 16], "b": [5, 5, 5, 5]}).withColumn("region", F.lit("EU"))
    got = evaluate.region_forecast(df, "2000-05-01", 90, 0.95, skills=["b"], region="EU").collect()
    assert len(got) == 3 and {r.trend for r in got} == {"flat"}


def test_blend_weights_prefer_the_better_model(spark):
    errors = spark.createDataFrame([("a", "m", 1.0), ("a", "n", 3.0)], "skill_name string, model_version string, rmse double")
    day = dt.date(2001, 1, 1)
    rows = [("a", day, 10.0, 9.0, 11.0, "m"), ("a", day, 20.0, 18.0, 22.0, "n")]
    columns = "skill_name string, forecast_date date, predicted_demand double, confidence_lower double, confidence_upper double, model_version string"
    got = evaluate.blend_models(spark.createDataFrame(rows, columns), evaluate.blend_weights(errors)).first()
    assert got.predicted_demand == pytest.approx(12.5, abs=1e-4)


def test_forecast_table_is_capped(series):
    got = etl.forecast_table(series({"a": [1, 1, 1, 30, 30, 30]}), "2000-07-01", "2000-09-01", ())
    assert got.filter("predicted_demand > 150").count() == 0 and got.count() == 3


def arma_path(y, steps):
    """Two-stage regression on the seasonal and first difference, and its continuation."""
    w = [y[i] - y[i - 1] - y[i - 12] + y[i - 13] for i in range(13, len(y))]
    long = [1, 2, 3, 12, 13]
    slopes, intercept = least_squares(np.array([[w[i - k] for k in long] for i in range(13, len(w))]), np.array(w[13:]))
    e = [0.0] * 13 + [w[i] - intercept - slopes @ [w[i - k] for k in long] for i in range(13, len(w))]
    own = [1, 12, 13]
    x = np.array([[w[i - k] for k in own] + [e[i - k] for k in own] for i in range(26, len(w))])
    slopes, intercept = least_squares(x, np.array(w[26:]))
    sigma = np.sqrt(np.mean((np.array(w[26:]) - intercept - x @ slopes) ** 2))
    path = list(y)
    for _ in range(steps):
        step = intercept + slopes @ ([w[-k] for k in own] + [e[-k] for k in own])
        path.append(step + path[-1] + path[-12] - path[-13])
        w.append(step)
        e.append(0.0)
    return path[len(y):], sigma


def test_moving_average_terms(series):
    rng = np.random.default_rng(6)
    shocks = rng.normal(size=90)
    noise = shocks + 0.6 * np.concatenate([[0], shocks[:-1]])
    y = np.round(60 + 0.3 * np.arange(90) + 8 * np.sin(np.arange(90) * np.pi / 6) + 3 * noise, 3)
    data = {"a": list(y), "b": list(y[::-1]), "mid": list(y[:40]), "ten": list(y[:12])}
    got = forecast.seasonal_ar(series(data), "2008-12-01").orderBy("skill_name", "forecast_date").collect()
    for name, values in (("a", y), ("b", y[::-1])):
        rows = [r for r in got if r.skill_name == name]
        path, sigma = arma_path(list(values), len(rows))
        assert len(rows) == 18 and {r.model_version for r in rows} == {"SeasonalARMA(1,12,13)"}
        assert [r.predicted_demand for r in rows] == pytest.approx([max(v, 0) for v in path], abs=0.006)
        assert [r.confidence_upper for r in rows] == pytest.approx([v + 1.96 * sigma * math.sqrt(i + 1) for i, v in enumerate(path)], abs=0.006)
    assert {r.model_version for r in got if r.skill_name == "mid"} == {"SeasonalAR(1,12,13)"}
    assert {r.model_version for r in got if r.skill_name == "ten"} == {"ARMA(1,1)"}


def test_elimination_leaves_out_dependent_features(spark):
    from laborlens.plans.regression import pair_statistics, solve_pairs

    rng = np.random.default_rng(3)
    x = rng.normal(size=(40, 5))
    x[:, 3] = 2 * x[:, 0] - x[:, 1]  # no direction of its own
    y = x @ [1.0, -2.0, 0.5, 0.0, 3.0] + 4 + rng.normal(size=40) * 0.1
    names = ["a", "b", "c", "d", "e"]
    rows = spark.createDataFrame([(i % 1, *map(float, r), float(v), 7.0) for i, (r, v) in enumerate(zip(x, y))], f"k int, {', '.join(f'{n} double' for n in names)}, y double, same double")
    got = solve_pairs(rows.groupBy("k").agg(*pair_statistics([*names, "same"], "y")), [*names, "same"]).first()
    slopes, intercept = least_squares(np.delete(x, 3, 1), y)
    assert (got.coef_d, got.coef_same) == (0.0, 0.0)
    assert [got.intercept, got.coef_a, got.coef_b, got.coef_c, got.coef_e] == pytest.approx([intercept, *slopes], abs=1e-9)


def test_backtest_runs_each_model_once_over_all_folds(series):
    calls = []

    def last_value(df, start, months, s):
        calls.append(s.keys)
        newest = df.groupBy(*s.keys).agg(F.max_by(F.col(s.value).cast("double"), s.date).alias("predicted_demand"))
        days = F.explode(F.sequence(start, F.add_months(start, months - 1), F.expr("interval 1 month")))
        return newest.select(*s.keys, "predicted_demand", days.alias("forecast_date")).withColumns(
            {c: F.col("predicted_demand") for c in ("confidence_lower", "confidence_upper")})

    def double(df, start, months, s):
        return last_value(df, start, months, s).withColumn("predicted_demand", F.col("predicted_demand") * 2)

    values = {"a": [5, 7, 6, 9, 8, 10, None, 12], "b": [3, 3, 3, 3, 3, 3, 3, 3], "late": [None] * 7 + [1]}
    df = series(values)
    models = {"last": last_value, "double": double}
    got = {(r.skill_name, r.model_version): r for r in evaluate.backtest(df, models, folds=2, horizon=2).collect()}
    assert calls == [("skill_name", "origin")] * 2
    # folds begin with months 4 and 6 (from 0); the last values before them are 9 and 10
    for name, scale in (("last", 1), ("double", 2)):
        errors = [9 * scale - 8, 9 * scale - 10, 10 * scale - 12]
        r = got["a", name]
        assert (r.n, r.rmse, r.bias) == (3, pytest.approx(math.sqrt(sum(e * e for e in errors) / 3)), pytest.approx(sum(errors) / 3))
    assert got["b", "last"].rmse == 0 and ("late", "last") not in got
    blend = evaluate.validated_blend(df, models, "2000-09-01", 2, folds=2, horizon=2).collect()
    weights = {m: 1 / (got["a", m].rmse + 1e-6) for m in models}
    for r in blend:
        if r.skill_name == "a":
            assert r.predicted_demand == pytest.approx((12 * weights["last"] + 24 * weights["double"]) / sum(weights.values()))
        else:
            assert r.skill_name == "b" and r.predicted_demand == pytest.approx(3, abs=1e-4)
    assert len(blend) == 4


def test_quality_fit_orders_no_texts(spark, monkeypatch):
    """Texts are measured where they are read; hashes and numbers are ordered."""
    rows = [(f"word {'x' * (i % 7)} {i}", i % 2) for i in range(40)]
    kept = []
    monkeypatch.setattr(ml, "materialize", lambda df, purpose: kept.append(df) or df)
    model = ml.fit_quality_model(spark.createDataFrame(rows, "text string, label int"), max_rows=10)
    plan = kept[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [_hash#" in plan and "Sort [xxhash64(text" not in plan
    assert kept[0].count() == 10 and "text" not in kept[0].columns and model.stages[-1].numFeatures == 7


def test_quality_fit_takes_every_labelled_row(spark):
    """No row is cut from the fit, and rows measured before give the same model."""
    n = 200_400
    text = F.concat(F.lit("word "), F.repeat(F.lit("x1 "), F.expr("cast(id % 9 as int)")), F.col("id").cast("string"))
    rows = spark.range(n + 2).select(
        F.when(F.col("id") != n, text).alias("text"), F.when(F.col("id") != n + 1, (F.col("id") % 9 > 4).cast("int")).alias("label"))
    model = ml.fit_quality_model(rows)
    whole = [F.avg(c).alias(name) for name, c in ml.text_features("text").items()]
    assert list(model.stages[1].mean) == pytest.approx(list(rows.dropna().agg(*whole).first()), rel=1e-12)
    assert model.stages[-1].summary.predictions.count() == n
    again = ml.fit_quality_model(ml.measure_texts(rows, ["label"]), text=None)
    assert list(again.stages[-1].coefficients) == pytest.approx(list(model.stages[-1].coefficients), rel=1e-6, abs=1e-9)
    few = rows.limit(50)
    scores = [ml.posting_quality_score(few, model, ["text"]), ml.posting_quality_score(ml.measure_texts(few, ["text"]), model, ["text"], text=None)]
    assert sorted(scores[0].collect()) == sorted(scores[1].collect())
