"""Forecast models, their checks and the learned models."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vocab import TOTAL_SERIES
from ..operators import joins
from ..plans import domain, etl, evaluate, forecast, ml
from ..plans.tables import materialize
from .core import CLOSED, FORECASTS, REGIONAL, VOLUME, query
from .profiling import sparse_rows
from .relational import SPIKES, SPIKES_SQL
from .series import TRAILING, ols_sql, pairs_sql

START, END = "2001-11-01", "2004-06-01"  # the 32 months after the last closed month
BOUNDS = ("predicted_demand", "confidence_lower", "confidence_upper")
GRID = f"grid AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 MONTH)) AS DATE) AS forecast_date)"
STEPS = f"steps AS (SELECT step, CAST(DATE '{START}' + INTERVAL (step) MONTH AS DATE) AS forecast_date FROM (SELECT unnest(range(0, 32)) AS step))"


def linreg_sql(source: str, keys: str, spikes: str = SPIKES_SQL, z: str = "1.96", grid: str = GRID) -> str:
    """The anchored linear forecast as common table expressions ending in ``linreg``."""
    on = " AND ".join(f"{{a}}.{k} = {{b}}.{k}" for k in keys.split(", "))
    prefixed = ", ".join(f"f.{k}" for k in keys.split(", "))
    return f"""base AS (SELECT *, count(*) FILTER (period_start NOT IN ({spikes})) OVER (PARTITION BY {keys}) AS k,
                  count(*) OVER (PARTITION BY {keys}) AS size FROM {source}),
    clean AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY period_start DESC) <= 3 AS recent FROM base
              WHERE size >= 3 AND (k < 3 OR period_start NOT IN ({spikes}))),
    season AS (SELECT *, date_diff('day', (SELECT min(period_start) FROM {source}), period_start) / 30.44 AS t,
                      sin(2 * pi() * month(period_start) / 12) AS sin_m, cos(2 * pi() * month(period_start) / 12) AS cos_m FROM clean),
    {ols_sql('season', 'fit', keys)},
    at_rows AS (SELECT s.*, intercept + coef_t * t + coef_sin_m * sin_m + coef_cos_m * cos_m AS yhat FROM season s JOIN fit f ON {on.format(a='s', b='f')}),
    levels AS (SELECT {keys}, avg(demand_count) FILTER (recent) AS rm, avg(yhat) FILTER (recent) AS at_recent, stddev_pop(demand_count - yhat) AS sd FROM at_rows GROUP BY {keys}),
    {grid},
    ahead AS (SELECT {prefixed}, forecast_date, rm, sd, intercept
                     + coef_t * (date_diff('day', (SELECT min(period_start) FROM {source}), forecast_date) / 30.44)
                     + coef_sin_m * sin(2 * pi() * month(forecast_date) / 12) + coef_cos_m * cos(2 * pi() * month(forecast_date) / 12) + rm - at_recent AS raw
              FROM fit f JOIN levels l ON {on.format(a='f', b='l')} CROSS JOIN grid),
    clamped AS (SELECT *, greatest(least(greatest(raw, rm * 0.5), rm * 2.0), 0) AS p, {z} * greatest(sd, rm * 0.10) AS ci FROM ahead),
    linreg AS (SELECT {keys}, forecast_date, round(p, 4) AS predicted_demand, round(greatest(p - ci, 0), 4) AS confidence_lower,
                      round(p + ci, 4) AS confidence_upper FROM clamped)"""


@query(
    "m04_linreg_forecast",
    f"WITH {CLOSED}, {linreg_sql('closed', 'skill_name')} SELECT *, 'LinReg_NoSpike_v3' AS model_version FROM linreg",
    doubles=BOUNDS, places=4,
)
def m04(spark, sf):
    return forecast.linreg_forecast(domain.demand_table(spark, sf), START, END, SPIKES)


@query(
    "m04_forecast_table_capped",
    f"""WITH {CLOSED}, {linreg_sql('closed', 'skill_name')}, peak AS (SELECT skill_name, max(demand_count) * 5.0 AS cap FROM closed GROUP BY 1)
        SELECT l.skill_name, forecast_date, least(predicted_demand, cap) AS predicted_demand, confidence_lower, confidence_upper,
               'LinReg_NoSpike_v3' AS model_version, 'Global' AS region FROM linreg l JOIN peak p ON l.skill_name = p.skill_name""",
    doubles=BOUNDS, places=4,
)
def m04c(spark, sf):
    return etl.forecast_table(domain.closed_skill_demand(spark, sf), START, END, SPIKES)


@query(
    "m05_stable_mean_forecast",
    f"""WITH {VOLUME}, r AS (SELECT *, row_number() OVER (ORDER BY date) - 1 AS x FROM volume WHERE date >= DATE '2001-01-01'),
        s AS (SELECT avg(count) AS m, stddev_samp(count) AS sd, greatest(-1, least(1, regr_slope(count, x))) AS b FROM r),
        {GRID}, p AS (SELECT forecast_date, greatest(1, m + b * (row_number() OVER (ORDER BY forecast_date) - 1)) AS p, 1.96 * greatest(sd, m * 0.2) AS ci FROM grid CROSS JOIN s)
        SELECT forecast_date, round(p, 2) AS predicted_demand, round(greatest(p - ci, 0), 2) AS confidence_lower, round(p + ci, 2) AS confidence_upper, 'StableMean' AS model_version FROM p""",
    doubles=BOUNDS, places=2,
)
def m05(spark, sf):
    return forecast.stable_mean_forecast(domain.order_volume(spark, sf), "2001-01-01", START, END)


ENDPOINTS = """coalesce((arg_max(demand_count, period_start) - arg_min(demand_count, period_start)) /
  nullif(CAST(date_diff('day', min(period_start), max(period_start)) AS DOUBLE), 0), 0) AS slope,
  max(period_start) AS last_date, arg_max(CAST(demand_count AS DOUBLE), period_start) AS last_value"""
SPARSE2 = f"""{REGIONAL}, sparse AS (SELECT * FROM (SELECT skill_name || '/' || region AS skill_name, period_start, demand_count FROM regional)
  QUALIFY count(*) OVER (PARTITION BY skill_name) >= 2)"""


@query(
    "m06_trend_following",
    f"""WITH {SPARSE2}, {TRAILING.format(src='sparse')}, s AS (SELECT skill_name, {ENDPOINTS}, max(demand_count) AS peak FROM recent GROUP BY 1), {STEPS},
        p AS (SELECT skill_name, forecast_date, least(greatest(0, last_value + slope * date_diff('day', last_date, forecast_date)), peak * 1.2) AS p FROM s CROSS JOIN steps)
        SELECT skill_name, forecast_date, p AS predicted_demand, p * 0.7 AS confidence_lower, p * 1.3 AS confidence_upper, 'TrendFollowing' AS model_version FROM p""",
    doubles=BOUNDS,
)
def m06(spark, sf):
    return forecast.trend_following(sparse_rows(spark, sf), START)


@query(
    "m07_stable_baseline",
    f"""WITH {SPARSE2}, n AS (SELECT *, row_number() OVER (PARTITION BY skill_name ORDER BY demand_count) AS i, count(*) OVER (PARTITION BY skill_name) AS k FROM sparse),
        h AS (SELECT skill_name, demand_count AS threshold FROM n WHERE i = CAST(floor(k * 0.8) AS BIGINT) + 1),
        b AS (SELECT s.skill_name, avg(demand_count) AS baseline FROM sparse s JOIN h ON s.skill_name = h.skill_name WHERE demand_count <= threshold GROUP BY 1),
        e AS (SELECT skill_name, {ENDPOINTS} FROM sparse GROUP BY 1), {STEPS},
        p AS (SELECT e.skill_name, forecast_date, least(greatest(CASE WHEN slope < -0.1 THEN baseline ELSE last_value END, baseline * 0.5), baseline * 1.5) AS p
              FROM e JOIN b ON e.skill_name = b.skill_name CROSS JOIN steps)
        SELECT skill_name, forecast_date, p AS predicted_demand, p * 0.8 AS confidence_lower, p * 1.2 AS confidence_upper, 'StableBaseline' AS model_version FROM p""",
    doubles=BOUNDS,
)
def m07(spark, sf):
    return forecast.stable_baseline(sparse_rows(spark, sf), START)


@query(
    "m08_median_blend",
    f"""WITH {SPARSE2}, q AS (SELECT skill_name, quantile_cont(demand_count, 0.25) AS q1, quantile_cont(demand_count, 0.75) AS q3 FROM sparse GROUP BY 1),
        r AS (SELECT s.*, demand_count BETWEEN q1 - 3 * (q3 - q1) AND q3 + 3 * (q3 - q1) AS inside, row_number() OVER (PARTITION BY s.skill_name ORDER BY period_start DESC) AS rn
              FROM sparse s JOIN q ON s.skill_name = q.skill_name),
        e AS (SELECT skill_name, {ENDPOINTS}, median(demand_count) FILTER (inside) * 0.6 + median(demand_count) FILTER (rn <= 5) * 0.4 AS b FROM r GROUP BY 1), {STEPS},
        p AS (SELECT skill_name, forecast_date, least(greatest(greatest(b * (0.9 + 0.2 * sin(2 * pi() * step / 12)) + slope * (step * 30) * 0.1, 0), b * 0.7), b * 1.3) AS p FROM e CROSS JOIN steps)
        SELECT skill_name, forecast_date, p AS predicted_demand, p * 0.85 AS confidence_lower, p * 1.15 AS confidence_upper, 'MedianBaseline' AS model_version FROM p""",
    doubles=BOUNDS,
)
def m08(spark, sf):
    return forecast.median_blend(sparse_rows(spark, sf), START)


HOLT = """grid(a, b, g) AS (SELECT a, b, g FROM (SELECT unnest([0.1, 0.3, 0.5, 0.7, 0.9]) AS a), (SELECT unnest([0.01, 0.1, 0.3]) AS b), (SELECT unnest([0.05, 0.2, 0.4]) AS g)),
  state AS (
    SELECT skill_name, n, last_date, ys, a, b, CASE WHEN n >= 8 THEN g ELSE 0 END AS g, g AS own_g, 0 AS i,
           CASE WHEN n >= 8 THEN f - slope * 2.5 ELSE ys[1] - slope END AS level, slope AS trend,
           CASE WHEN n >= 8 THEN [ys[1] - (f - slope * 2.5 + slope), ys[2] - (f - slope * 2.5 + slope * 2), ys[3] - (f - slope * 2.5 + slope * 3), ys[4] - (f - slope * 2.5 + slope * 4)]
                ELSE [0.0, 0.0, 0.0, 0.0]::DOUBLE[] END AS due, 0.0::DOUBLE AS sum_r, 0.0::DOUBLE AS sum_rr
    FROM (SELECT *, CASE WHEN n >= 8 THEN (list_avg(ys[5:8]) - f) / 4 ELSE ys[2] - ys[1] END AS slope FROM (SELECT *, list_avg(ys[1:4]) AS f FROM arrays)) CROSS JOIN grid
    UNION ALL
    SELECT skill_name, n, last_date, ys, a, b, g, own_g, i + 1, level + trend + a * r, trend + b * a * r, list_append(due[2:4], due[1] + g * r), sum_r + r, sum_rr + r * r
    FROM (SELECT *, ys[i + 1] - level - trend - due[1] AS r FROM state WHERE i < n)),
  best AS (SELECT * FROM state WHERE i = n QUALIFY row_number() OVER (PARTITION BY skill_name ORDER BY sum_rr, a, b, own_g) = 1),
  ahead AS (SELECT *, level + trend * h + due[(h - 1) % 4 + 1] AS p, 1.96 * sqrt(greatest(sum_rr / n - (sum_r / n) * (sum_r / n), 0)) * sqrt(h) AS half
            FROM best CROSS JOIN (SELECT unnest(range(1, 33)) AS h))"""
DENSE = f"""{CLOSED}, span AS (SELECT skill_name, min(period_start) AS f, max(period_start) AS l FROM closed GROUP BY 1 HAVING count(*) >= {{least}}),
  months AS (SELECT skill_name, CAST(unnest(generate_series(f, l, INTERVAL 1 MONTH)) AS DATE) AS period_start FROM span),
  dense AS (SELECT m.skill_name, m.period_start, CAST(coalesce(demand_count, 0) AS DOUBLE) AS y FROM months m LEFT JOIN closed c ON m.skill_name = c.skill_name AND m.period_start = c.period_start),
  arrays AS (SELECT skill_name, list(y ORDER BY period_start) AS ys, count(*) AS n, max(period_start) AS last_date FROM dense GROUP BY 1)"""


@query(
    "m09_holt_winters",
    f"""WITH RECURSIVE {DENSE.format(least=3)}, {HOLT}
        SELECT skill_name, CAST(last_date + INTERVAL (h) MONTH AS DATE) AS forecast_date, round(p, 2) AS predicted_demand, round(greatest(p - half, 0), 2) AS confidence_lower,
               round(p + half, 2) AS confidence_upper, 'Holt-Winters' AS model_version FROM ahead WHERE last_date + INTERVAL (h) MONTH <= DATE '{END}'""",
    doubles=BOUNDS, places=2,
)
def m09(spark, sf):
    return forecast.holt_winters(domain.closed_skill_demand(spark, sf), END)


def _lags(value: str, lags: list[int], prefix: str) -> str:
    return ", ".join(f"coalesce(CASE WHEN {lag} < 12 OR seasonal THEN lag({value}, {lag}) OVER o END, 0) AS {prefix}{lag}" for lag in lags)


LONG, OWN = [1, 2, 3, 12, 13], [1, 12, 13]
TERMS = [*(f"l{i}" for i in OWN), *(f"e{i}" for i in OWN)]
ARMA = f"""flagged AS (SELECT *, n >= 30 AS seasonal, CASE WHEN n >= 30 THEN n >= 54 ELSE n >= 10 END AS shocks FROM arrays),
  place AS (SELECT *, unnest(range(CASE WHEN seasonal THEN 14 ELSE 2 END, n + 1)) AS p FROM flagged),
  change AS (SELECT skill_name, seasonal, shocks, CASE WHEN seasonal THEN 13 WHEN shocks THEN 3 ELSE 1 END AS deep, row_number() OVER (PARTITION BY skill_name ORDER BY p) AS i,
                    CASE WHEN seasonal THEN ys[p] - ys[p - 1] - ys[p - 12] + ys[p - 13] ELSE ys[p] - ys[p - 1] END AS now FROM place),
  long AS (SELECT *, {_lags('now', LONG, 'l')} FROM change WINDOW o AS (PARTITION BY skill_name ORDER BY i)),
  long_rows AS (SELECT * FROM long WHERE shocks AND i > deep),
  {pairs_sql('long_rows', 'first_fit', 'skill_name', [f'l{i}' for i in LONG])},
  shocked AS (SELECT c.skill_name, seasonal, shocks, deep, i, now,
                     CASE WHEN f.skill_name IS NULL OR i <= deep THEN 0 ELSE now - (f.intercept + {' + '.join(f'coef_l{i} * l{i}' for i in LONG)}) END AS e
              FROM long c LEFT JOIN first_fit f ON c.skill_name = f.skill_name),
  own AS (SELECT *, {_lags('now', OWN, 'l')}, {_lags('e', OWN, 'e')} FROM shocked WINDOW o AS (PARTITION BY skill_name ORDER BY i)),
  own_rows AS (SELECT * FROM own WHERE i > deep * CASE WHEN shocks THEN 2 ELSE 1 END),
  {pairs_sql('own_rows', 'second_fit', 'skill_name', TERMS)},
  spread AS (SELECT r.skill_name, sqrt(avg(pow(now - (intercept + {' + '.join(f'coef_{t} * {t}' for t in TERMS)}), 2))) AS sigma
             FROM own_rows r JOIN second_fit f ON r.skill_name = f.skill_name GROUP BY 1),
  tails AS (SELECT skill_name, list(now ORDER BY i) AS ws, list(e ORDER BY i) AS es FROM shocked GROUP BY 1),
  path AS (
    SELECT f.skill_name, seasonal, shocks, last_date, sigma, 0 AS h, ys, ws, es, intercept, {', '.join(f'coef_{t}' for t in TERMS)}
    FROM flagged f JOIN second_fit s ON f.skill_name = s.skill_name JOIN spread d ON f.skill_name = d.skill_name JOIN tails t ON f.skill_name = t.skill_name
    UNION ALL
    SELECT skill_name, seasonal, shocks, last_date, sigma, h + 1, list_append(ys, step + ys[-1] + CASE WHEN seasonal THEN ys[-12] - ys[-13] ELSE 0 END),
           list_append(ws, step), list_append(es, CAST(0 AS DOUBLE)), intercept, {', '.join(f'coef_{t}' for t in TERMS)}
    FROM (SELECT *, intercept + coef_l1 * coalesce(ws[-1], 0) + coef_e1 * coalesce(es[-1], 0)
                 + CASE WHEN seasonal THEN coef_l12 * ws[-12] + coef_l13 * ws[-13] + coef_e12 * es[-12] + coef_e13 * es[-13] ELSE 0 END AS step FROM path WHERE h < 32))"""


@query(
    "m10_seasonal_ar",
    f"""WITH RECURSIVE {DENSE.format(least=6)}, {ARMA}
        SELECT skill_name, CAST(last_date + INTERVAL (h) MONTH AS DATE) AS forecast_date, round(greatest(ys[-1], 0), 2) AS predicted_demand,
               round(greatest(ys[-1] - 1.96 * sigma * sqrt(h), 0), 2) AS confidence_lower, round(greatest(ys[-1] + 1.96 * sigma * sqrt(h), greatest(ys[-1], 0)), 2) AS confidence_upper,
               CASE WHEN seasonal AND shocks THEN 'SeasonalARMA(1,12,13)' WHEN seasonal THEN 'SeasonalAR(1,12,13)' WHEN shocks THEN 'ARMA(1,1)' ELSE 'AR(1)' END AS model_version
        FROM path WHERE h > 0 AND last_date + INTERVAL (h) MONTH <= DATE '{END}'""",
    doubles=BOUNDS, places=2,
)
def m10(spark, sf):
    return forecast.seasonal_ar(domain.closed_skill_demand(spark, sf), END)


def lag_rollout_sql(source: str, k: int) -> str:
    """The common regression on k scaled lags and its own continuation, as common table expressions ending in ``rollout``."""
    lags = [f"l{i}" for i in range(k, 0, -1)]
    return f"""usable AS (SELECT *, min(demand_count) OVER s AS lo, max(demand_count) OVER s AS hi FROM {source} WINDOW s AS (PARTITION BY skill_name) QUALIFY count(*) OVER s >= {k + 2}),
  scaled AS (SELECT *, coalesce((demand_count - lo) / nullif(CAST(hi - lo AS DOUBLE), 0), 0) AS now FROM usable),
  lagged AS (SELECT 1 AS one, now, {', '.join(f'lag(now, {i}) OVER o AS l{i}' for i in range(k, 0, -1))} FROM scaled WINDOW o AS (PARTITION BY skill_name ORDER BY period_start)
             QUALIFY row_number() OVER o > {k}),
  {pairs_sql('lagged', 'model', 'one', lags)},
  rolled AS (
    SELECT skill_name, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, last_date, hist_mean, volatility, 0 AS step, buffer FROM (
      SELECT skill_name, min(lo) AS lo, max(hi) AS hi, max(period_start) AS last_date, avg(demand_count) AS hist_mean,
             stddev_pop(demand_count) / (avg(demand_count) + 1e-6) AS volatility, list(now ORDER BY period_start) AS buffer FROM scaled GROUP BY 1)
    UNION ALL
    SELECT skill_name, lo, hi, last_date, hist_mean, volatility, step + 1, list_append(buffer, intercept + {' + '.join(f'coef_l{i} * buffer[-{i}]' for i in range(k, 0, -1))})
    FROM rolled JOIN model ON one = 1 WHERE step < 32),
  rollout AS (SELECT skill_name, step - 1 AS step, CAST(last_date + INTERVAL (step) MONTH AS DATE) AS forecast_date, buffer[-1] * (hi - lo) + lo AS base, hist_mean, volatility
              FROM rolled WHERE step > 0)"""


@query(
    "m11_lag_regression",
    f"""WITH RECURSIVE {CLOSED}, {lag_rollout_sql('closed', 6)}, p AS (SELECT *, greatest(base, 0) AS p FROM rollout)
        SELECT skill_name, forecast_date, p AS predicted_demand, greatest(p * (1 - volatility), 0) AS confidence_lower, p * (1 + volatility) AS confidence_upper,
               'LagRegression' AS model_version FROM p""",
    doubles=BOUNDS, places=4,
)
def m11(spark, sf):
    return forecast.lag_regression(domain.demand_table(spark, sf))


@query(
    "m12_growth_blend",
    f"""WITH RECURSIVE {VOLUME}, source AS (SELECT '{TOTAL_SERIES}' AS skill_name, date AS period_start, count AS demand_count FROM volume), {lag_rollout_sql('source', 3)},
        p AS (SELECT *, greatest((0.7 * base + 0.3 * hist_mean * pow(1.015, step + 1)) * (1 + 0.15 * sin(2 * pi() * (step % 12) / 12)), 5) AS p FROM rollout)
        SELECT skill_name, forecast_date, p AS predicted_demand, greatest(p * (1 - volatility), 2) AS confidence_lower, p * (1 + volatility) AS confidence_upper,
               'GrowthBlend' AS model_version FROM p""",
    doubles=BOUNDS, places=4,
)
def m12(spark, sf):
    volume = domain.order_volume(spark, sf).select(
        F.lit(TOTAL_SERIES).alias("skill_name"), F.col("date").alias("period_start"), F.col("count").alias("demand_count")
    )
    return forecast.growth_blend(forecast.lag_rollout(volume, k=3))


@query(
    "m13_confidence_band",
    f"""WITH {FORECASTS}, f AS (SELECT skill_name, forecast_date, predicted_demand AS p, row_number() OVER (PARTITION BY skill_name ORDER BY forecast_date) AS step FROM forecasts)
        SELECT 'residual_sqrt_step' AS method, skill_name, forecast_date, greatest(p - 1.96 * 2 * sqrt(step), 0) AS confidence_lower, p + 1.96 * 2 * sqrt(step) AS confidence_upper FROM f
        UNION ALL SELECT 'residual_floor', skill_name, forecast_date, greatest(p - 1.96 * greatest(2, p * 0.1), 0), p + 1.96 * greatest(2, p * 0.1) FROM f
        UNION ALL SELECT 'multiplicative', skill_name, forecast_date, p * 0.7, p * 1.3 FROM f
        UNION ALL SELECT 'volatility', skill_name, forecast_date, greatest(p * (1 - 1.2), 0), p * (1 + 1.2) FROM f
        UNION ALL SELECT 'model', skill_name, forecast_date, greatest(p - 30, 0), greatest(p - 1, p) FROM f""",
    doubles=("confidence_lower", "confidence_upper"),
)
def m13(spark, sf):
    stored = domain.stored_forecasts(spark, sf).select("skill_name", "forecast_date", "predicted_demand")
    numbered = stored.withColumn("step", _step_number())
    p = F.col("predicted_demand")
    rules = {
        "residual_sqrt_step": (F.lit(2.0), F.col("step")),
        "residual_floor": (F.lit(2.0), p, 0.1),
        "multiplicative": (0.7, 1.3),
        "volatility": (F.lit(1.2),),
        "model": (p - 30, p - 1),
    }
    parts = [
        forecast.confidence_band(numbered, method, *args).select(
            F.lit(method).alias("method"), "skill_name", "forecast_date", "confidence_lower", "confidence_upper"
        )
        for method, args in rules.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]).unionByName(parts[4])


def _step_number():
    from pyspark.sql import Window

    return F.row_number().over(Window.partitionBy("skill_name").orderBy("forecast_date"))


@query(
    "m14_cap_to_history",
    f"""WITH {FORECASTS}, peak AS (SELECT skill_name, max(demand_count) * 5.0 AS cap FROM closed GROUP BY 1)
        SELECT f.skill_name, forecast_date, CASE WHEN cap IS NULL THEN predicted_demand * 10 ELSE least(predicted_demand * 10, cap) END AS predicted_demand
        FROM forecasts f LEFT JOIN peak p ON f.skill_name = p.skill_name""",
    doubles=("predicted_demand",),
)
def m14(spark, sf):
    inflated = domain.stored_forecasts(spark, sf).withColumn("predicted_demand", F.col("predicted_demand") * 10)
    return joins.cap_to_history(inflated, domain.closed_skill_demand(spark, sf)).select("skill_name", "forecast_date", "predicted_demand")


@query(
    "m16_forecast_sanity",
    f"WITH {FORECASTS} SELECT skill_name, avg(predicted_demand) AS avg_predicted FROM forecasts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10",
    doubles=("avg_predicted",),
)
def m16(spark, sf):
    return evaluate.forecast_sanity(domain.stored_forecasts(spark, sf))


@query(
    "m16_negative_forecasts",
    f"WITH {FORECASTS} SELECT count(*) FILTER (predicted_demand - 200 < 0) AS negatives, count(*) AS rows FROM forecasts",
)
def m16n(spark, sf):
    stored = domain.stored_forecasts(spark, sf)
    return evaluate.negative_forecasts(stored.withColumn("predicted_demand", F.col("predicted_demand") - 200))


THREE_MONTHS = f"grid AS (SELECT CAST(unnest(generate_series(DATE '{START}', DATE '2002-01-01', INTERVAL 1 MONTH)) AS DATE) AS forecast_date)"


@query(
    "m17_region_forecast",
    f"""WITH {CLOSED}, regions AS (
          SELECT p_brand AS skill_name, r_name AS region, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start, count(*) AS demand_count
          FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
          JOIN region ON n_regionkey = r_regionkey WHERE l_shipdate < (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem) GROUP BY ALL),
        {linreg_sql('regions', 'skill_name, region', spikes="DATE '1900-01-01'", z='1.6449', grid=THREE_MONTHS)},
        last AS (SELECT skill_name, region, arg_max(CAST(demand_count AS DOUBLE), period_start) AS v FROM regions GROUP BY 1, 2)
        SELECT l.skill_name, l.region, forecast_date, predicted_demand, confidence_lower, confidence_upper, 'LinReg' AS model_version,
               round(100.0 * (predicted_demand - v) / v, 1) AS change_pct,
               CASE WHEN round(100.0 * (predicted_demand - v) / v, 1) > 0 THEN 'up' WHEN round(100.0 * (predicted_demand - v) / v, 1) < 0 THEN 'down' ELSE 'flat' END AS trend
        FROM linreg l JOIN last ON l.skill_name = last.skill_name AND l.region = last.region""",
    doubles=(*BOUNDS, "change_pct"), places=4,
)
def m17(spark, sf):
    lineitem = domain.table(spark, sf, "lineitem")
    first_open = lineitem.agg(F.max("l_shipdate")).scalar()
    nations = domain.table(spark, sf, "nation").select(F.col("n_name").alias("region"), "n_regionkey")
    regions = domain.table(spark, sf, "region").select("r_regionkey", "r_name")
    named = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select("region", "r_name")
    demand = (
        domain.regional_demand(spark, sf)
        .join(named, "region")
        .groupBy("skill_name", F.col("r_name").alias("region"), "period_start")
        .agg(F.sum("demand_count").alias("demand_count"))
        .filter(F.col("period_start") < F.trunc(first_open.cast("date"), "month"))
    )
    return evaluate.region_forecast(demand, START, 90, 0.90)


@query(
    "m18_trend_clusters",
    f"WITH {CLOSED} SELECT skill_name, true AS in_range, least(5, count(*) OVER ()) AS clusters FROM (SELECT DISTINCT skill_name FROM closed)",
)
def m18(spark, sf):
    """The number of a cluster is arbitrary: what can be checked is that all skills and all clusters are there."""
    found = ml.trend_clusters(domain.demand_table(spark, sf), k=5)
    clusters = found.agg(F.count_distinct("cluster")).scalar()
    return found.select("skill_name", F.col("cluster").between(0, 4).alias("in_range"), clusters.alias("clusters"))


SHAPE = "coalesce(len(regexp_extract_all(text, '{}')) / nullif(CAST(length(text) AS DOUBLE), 0), 0) AS {}"


@query(
    "m19_text_features",
    f"""SELECT doc_id, ln(1 + length(text)) AS f_log_length,
               coalesce(length(text) / nullif(CAST(len(regexp_split_to_array(trim(text), '[ \t\n\v\f\r]+')) AS DOUBLE), 0), 0) AS f_word_length,
               {SHAPE.format('[0-9]', 'f_digits')}, {SHAPE.format('\\p{Lu}', 'f_upper')}, {SHAPE.format('[^\\p{L}\\p{N} \t\n\v\f\r]', 'f_symbols')},
               {SHAPE.format('\n', 'f_lines')}, {SHAPE.format('https?://', 'f_links')}
        FROM documents""",
    doubles=("f_log_length", "f_word_length", "f_digits", "f_upper", "f_symbols", "f_lines", "f_links"),
)
def m19f(spark, sf):
    """What the quality model looks at."""
    return domain.table(spark, sf, "documents").select("doc_id", *[c.alias(n) for n, c in ml.text_features("text").items()])


@query("m19_posting_quality_score", "SELECT doc_id, true AS in_range, true AS flag_fits, true AS separates FROM documents")
def m19(spark, sf):
    docs, labels = domain.table(spark, sf, "documents"), domain.table(spark, sf, "labels")
    # texts are read once; the join with the labels, the fit and the scores take their measures
    measured = materialize(ml.measure_texts(docs, ["doc_id"]), "quality-texts")
    labelled = measured.join(labels, "doc_id").withColumn("label", 1 - F.col("quality"))
    held_out = F.col("doc_id") % 4 == 2
    model = ml.fit_quality_model(labelled.filter(~held_out), text=None)
    # scored once, read for the result and for the judgement
    scored = materialize(ml.posting_quality_score(measured, model, ["doc_id"], text=None), "quality-scores")
    # junk that the fit didn't see gets higher scores than the rest
    judged = scored.join(labels, "doc_id").filter(held_out)
    means = [F.avg(F.when(F.col("quality") == q, F.col("spam_probability"))) for q in (0, 1)]
    return scored.select(
        "doc_id", F.col("spam_probability").between(0, 1).alias("in_range"),
        (F.col("is_spam") == (F.col("spam_probability") >= ml.SPAM_THRESHOLD)).alias("flag_fits"),
        judged.agg(means[0] > means[1]).scalar().alias("separates"),
    )


@query(
    "m20_classify_text",
    "SELECT lang, count(*) AS documents, true AS mostly_right, true AS probabilities_valid FROM documents GROUP BY lang",
)
def m20(spark, sf):
    docs = domain.table(spark, sf, "documents")
    held_out = F.col("doc_id") % 4 == 2
    model = ml.fit_text_classifier(docs.filter(~held_out), "text", "lang", 1 << 14)
    scored = ml.classify_text(docs, model, ["doc_id", "lang"])
    right = F.when(held_out, (F.col("category") == F.col("lang")).cast("double"))
    overall = scored.agg(F.avg(right) >= 0.9).scalar()
    return scored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"),
        F.any_value(overall).alias("mostly_right"),
        F.bool_and(F.col("probability").between(0.25, 1.0)).alias("probabilities_valid"),
    )


BACKTEST = f"""{CLOSED}, past AS (SELECT * FROM closed WHERE period_start < DATE '2001-01-01'),
  {linreg_sql('past', 'skill_name', grid="grid AS (SELECT CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-10-01', INTERVAL 1 MONTH)) AS DATE) AS forecast_date)")}"""


def _backtest(spark, sf):
    closed = domain.demand_table(spark, sf)
    past = closed.filter(F.col("period_start") < F.lit("2001-01-01").cast("date"))
    return past, closed, forecast.linreg_forecast(past, "2001-01-01", "2001-10-01", SPIKES)


@query(
    "m22_blend_models",
    f"""WITH {BACKTEST},
        flat AS (SELECT l.skill_name, forecast_date, m AS predicted_demand, m * 0.8 AS confidence_lower, m * 1.2 AS confidence_upper
                 FROM linreg l JOIN (SELECT skill_name, avg(demand_count) AS m FROM past GROUP BY 1) a ON l.skill_name = a.skill_name)
        SELECT l.skill_name, l.forecast_date, (l.predicted_demand * 3 + f.predicted_demand) / 4 AS predicted_demand,
               (l.confidence_lower * 3 + f.confidence_lower) / 4 AS confidence_lower, (l.confidence_upper * 3 + f.confidence_upper) / 4 AS confidence_upper,
               'Blend' AS model_version FROM linreg l JOIN flat f ON l.skill_name = f.skill_name AND l.forecast_date = f.forecast_date""",
    doubles=BOUNDS,
)
def m22(spark, sf):
    past, _, linear = _backtest(spark, sf)
    mean = past.groupBy("skill_name").agg(F.avg("demand_count").alias("m"))
    flat = linear.select("skill_name", "forecast_date").join(mean, "skill_name").select(
        "skill_name", "forecast_date", F.col("m").alias("predicted_demand"), (F.col("m") * 0.8).alias("confidence_lower"),
        (F.col("m") * 1.2).alias("confidence_upper"), F.lit("Mean").alias("model_version"),
    )
    weights = spark.createDataFrame([("LinReg_NoSpike_v3", 3.0), ("Mean", 1.0)], "model_version string, weight double")
    return evaluate.blend_models(linear.unionByName(flat), weights)


FOLD_GRID = """grid AS (SELECT CAST(unnest(generate_series(DATE '2000-04-01', DATE '2000-12-01', INTERVAL 1 MONTH)) AS DATE) AS forecast_date)"""
AHEAD_GRID = """grid AS (SELECT CAST(unnest(generate_series(DATE '2001-01-01', DATE '2001-10-01', INTERVAL 1 MONTH)) AS DATE) AS forecast_date)"""


def trend_sql(source: str, base: str, steps: int) -> str:
    """Trend following as a query; ``base`` is the first month as an expression on the series."""
    return f"""WITH {TRAILING.format(src=source)}, s AS (SELECT skill_name, {ENDPOINTS}, max(demand_count) AS peak FROM recent GROUP BY 1),
        steps AS (SELECT unnest(range(0, {steps})) AS step), d AS (SELECT *, CAST({base} + INTERVAL (step) MONTH AS DATE) AS forecast_date FROM s CROSS JOIN steps)
        SELECT skill_name, forecast_date, least(greatest(0, last_value + slope * date_diff('day', last_date, forecast_date)), peak * 1.2) AS p FROM d"""


# a fold is a series of its own, its first predicted month is part of its name
VALIDATED = f"""{CLOSED}, past AS (SELECT * FROM closed WHERE period_start < DATE '2001-01-01'),
  origins AS (SELECT CAST(max(period_start) + INTERVAL 1 MONTH - INTERVAL (3 * j) MONTH AS DATE) AS origin FROM past CROSS JOIN (SELECT unnest([1, 2, 3]) AS j) GROUP BY j),
  folds AS (SELECT skill_name || '@' || origin AS skill_name, period_start, demand_count FROM past JOIN origins ON period_start < origin),
  fold_linreg AS (WITH {linreg_sql('folds', 'skill_name', grid=FOLD_GRID)} SELECT skill_name, forecast_date, predicted_demand AS p FROM linreg),
  fold_trend AS ({trend_sql('folds', "CAST(split_part(skill_name, '@', 2) AS DATE)", 3)}),
  tested AS (
    SELECT split_part(skill_name, '@', 1) AS skill_name, CAST(split_part(skill_name, '@', 2) AS DATE) AS origin, forecast_date, p, 'LinReg' AS model_version FROM fold_linreg
    UNION ALL SELECT split_part(skill_name, '@', 1), CAST(split_part(skill_name, '@', 2) AS DATE), forecast_date, p, 'TrendFollowing' FROM fold_trend),
  errors AS (SELECT t.skill_name, model_version, count(*) AS n, sqrt(avg(pow(p - demand_count, 2))) AS rmse, avg(abs(p - demand_count)) AS mae, avg(p - demand_count) AS bias
             FROM tested t JOIN past a ON t.skill_name = a.skill_name AND t.forecast_date = a.period_start
             WHERE t.forecast_date BETWEEN origin AND origin + INTERVAL 2 MONTH GROUP BY 1, 2)"""


def _models():
    def linear(df, start, months, series):
        return forecast.linreg_forecast(df, start, F.add_months(start, months - 1), SPIKES, series)

    def trend(df, start, months, series):
        return forecast.trend_following(df, start, months, series=series)

    return {"LinReg": linear, "TrendFollowing": trend}


def _past(spark, sf):
    return domain.demand_table(spark, sf).filter(F.col("period_start") < F.lit("2001-01-01").cast("date"))


@query("m22_backtest", f"WITH {VALIDATED} SELECT * FROM errors", doubles=("rmse", "mae", "bias"), places=4)
def m22b(spark, sf):
    return evaluate.backtest(_past(spark, sf), _models())


@query(
    "m22_blend_by_validation_error",
    f"""WITH {VALIDATED}, ahead_linreg AS (WITH {linreg_sql('past', 'skill_name', grid=AHEAD_GRID)} SELECT *, 'LinReg' AS model_version FROM linreg),
        ahead_trend AS (SELECT skill_name, forecast_date, p AS predicted_demand, p * 0.7 AS confidence_lower, p * 1.3 AS confidence_upper, 'TrendFollowing' AS model_version
                        FROM ({trend_sql('past', "DATE '2001-01-01'", 10)})),
        f AS (SELECT * FROM ahead_linreg UNION ALL SELECT * FROM ahead_trend)
        SELECT f.skill_name, forecast_date, sum(predicted_demand / (rmse + 1e-6)) / sum(1 / (rmse + 1e-6)) AS predicted_demand,
               sum(confidence_lower / (rmse + 1e-6)) / sum(1 / (rmse + 1e-6)) AS confidence_lower, sum(confidence_upper / (rmse + 1e-6)) / sum(1 / (rmse + 1e-6)) AS confidence_upper,
               'Blend' AS model_version FROM f JOIN errors e ON f.skill_name = e.skill_name AND f.model_version = e.model_version GROUP BY f.skill_name, forecast_date""",
    doubles=BOUNDS, places=4,
)
def m22v(spark, sf):
    return evaluate.validated_blend(_past(spark, sf), _models(), "2001-01-01", 10)


@query(
    "m23_forecast_drift",
    f"""WITH {BACKTEST}, e AS (SELECT l.skill_name, predicted_demand - demand_count AS r, demand_count BETWEEN confidence_lower AND confidence_upper AS hit
          FROM linreg l JOIN closed c ON l.skill_name = c.skill_name AND l.forecast_date = c.period_start)
        SELECT skill_name, count(*) AS n, sqrt(avg(r * r)) AS rmse, avg(abs(r)) AS mae, avg(r) AS bias, avg(CASE WHEN hit THEN 1.0 ELSE 0 END) AS coverage FROM e GROUP BY 1""",
    doubles=("rmse", "mae", "bias", "coverage"),
)
def m23(spark, sf):
    _, closed, linear = _backtest(spark, sf)
    return evaluate.forecast_drift(linear, closed)
