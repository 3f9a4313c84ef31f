"""Calendar alignment, windows, folds, features and regressions over demand series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import joins, profile, sampling, windows
from ..plans import domain
from ..plans import regression as reg
from ..plans.tables import materialize
from .core import CLOSED, DEMAND, REGIONAL, VOLUME, query
from .profiling import ZERO_FILLED, sparse_demand, sparse_rows

SPARSE = f"""{REGIONAL}, sparse AS (SELECT skill_name || '/' || region AS skill_name, period_start, demand_count FROM regional)"""


@query(
    "j05_densify",
    f"""WITH {REGIONAL}, span AS (SELECT skill_name, region, min(period_start) AS a, max(period_start) AS b FROM regional GROUP BY 1, 2),
        grid AS (SELECT skill_name, region, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS period_start FROM span)
        SELECT g.skill_name, g.region, g.period_start, coalesce(r.demand_count, 0) AS demand_count FROM grid g
        LEFT JOIN regional r ON r.skill_name = g.skill_name AND r.region = g.region AND r.period_start = g.period_start""",
)
def j05(spark, sf):
    return joins.densify(domain.regional_demand(spark, sf), ["skill_name", "region"])


@query(
    "j06_horizon_grid",
    f"""WITH {DEMAND}, k AS (SELECT skill_name, max(period_start) AS last FROM demand GROUP BY 1),
        g AS (SELECT skill_name, last, CAST(unnest(generate_series(last + INTERVAL 1 MONTH, last + INTERVAL 32 MONTH, INTERVAL 1 MONTH)) AS DATE) AS forecast_date FROM k)
        SELECT skill_name, row_number() OVER (PARTITION BY skill_name ORDER BY forecast_date) - 1 AS step, forecast_date FROM g""",
    longs=("step",),
)
def j06(spark, sf):
    keys = domain.skill_demand(spark, sf).groupBy("skill_name").agg(F.max("period_start").alias("last"))
    return joins.horizon_grid(keys, F.add_months("last", 1), F.add_months("last", 32)).drop("last")


@query(
    "j06_thirty_day_grid",
    f"""WITH {DEMAND}, k AS (SELECT DISTINCT skill_name FROM demand)
        SELECT skill_name, step, DATE '2001-11-01' + CAST(30 * step AS INTEGER) AS forecast_date FROM k CROSS JOIN (SELECT unnest(range(0, 32)) AS step)""",
    longs=("step",),
)
def j06d(spark, sf):
    keys = domain.skill_demand(spark, sf).select("skill_name").distinct()
    return joins.step_grid(keys, "2001-11-01", 32, "30 days")


@query(
    "w02_last_n",
    f"WITH {SPARSE} SELECT * FROM sparse QUALIFY row_number() OVER (PARTITION BY skill_name ORDER BY period_start DESC) <= 3",
)
def w02(spark, sf):
    return windows.last_n(sparse_rows(spark, sf), 3)


@query(
    "w02_first_n",
    f"WITH {SPARSE} SELECT * FROM sparse QUALIFY row_number() OVER (PARTITION BY skill_name ORDER BY period_start) <= 3",
)
def w02f(spark, sf):
    return windows.first_n(sparse_rows(spark, sf), 3)


@query(
    "w02_latest_postings_per_location",
    """WITH p AS (SELECT n_name AS location, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id, l_shipdate AS posted_date
                  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey)
       SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY location ORDER BY posted_date DESC, id) <= 10""",
)
def w02p(spark, sf):
    p = domain.postings(spark, sf, "location", "id", "posted_date")
    return windows.top_n_per_key(p, ["location"], [F.desc("posted_date"), F.asc("id")], 10, ["id"])


@query(
    "w03_gaps",
    f"""WITH {SPARSE}, l AS (SELECT skill_name, lag(period_start) OVER (PARTITION BY skill_name ORDER BY period_start) AS gap_start, period_start AS gap_end FROM sparse)
        SELECT *, (year(gap_end) - year(gap_start)) * 12 + month(gap_end) - month(gap_start) AS gap_months FROM l
        WHERE (year(gap_end) - year(gap_start)) * 12 + month(gap_end) - month(gap_start) > 1""",
    longs=("gap_months",),
)
def w03(spark, sf):
    return windows.gaps(sparse_rows(spark, sf), max_gap=1)


@query(
    "w04_endpoint_slope",
    f"""WITH {CLOSED} SELECT skill_name, (arg_max(demand_count, period_start) - arg_min(demand_count, period_start)) / CAST(date_diff('day', min(period_start), max(period_start)) AS DOUBLE) AS slope_per_day
        FROM closed GROUP BY 1""",
    doubles=("slope_per_day",), places=9,
)
def w04(spark, sf):
    return windows.endpoint_slope(domain.closed_skill_demand(spark, sf))


TRAILING = """cut AS (SELECT *, max(period_start) OVER (PARTITION BY skill_name) - 180 AS c,
    row_number() OVER (PARTITION BY skill_name ORDER BY period_start DESC) AS rn FROM {src}),
  enough AS (SELECT *, count(*) FILTER (period_start >= c) OVER (PARTITION BY skill_name) AS k FROM cut),
  recent AS (SELECT skill_name, period_start, demand_count FROM enough WHERE CASE WHEN k >= 2 THEN period_start >= c ELSE rn <= 3 END)"""


@query("w05_trailing_window", f"WITH {SPARSE}, {TRAILING.format(src='sparse')} SELECT * FROM recent")
def w05(spark, sf):
    return windows.trailing_window(sparse_rows(spark, sf))


@query(
    "w06_lag_windows",
    f"""WITH {CLOSED} SELECT skill_name, period_start, {", ".join(f"lag(demand_count, {i}) OVER w AS lag_{i}" for i in range(6, 0, -1))}, demand_count AS target
        FROM closed WINDOW w AS (PARTITION BY skill_name ORDER BY period_start) QUALIFY row_number() OVER w > 6""",
)
def w06(spark, sf):
    return windows.lag_windows(domain.closed_skill_demand(spark, sf), 6)


@query(
    "w07_minmax_scale",
    f"""WITH {CLOSED}, r AS (SELECT *, min(demand_count) OVER (PARTITION BY skill_name) AS series_min, max(demand_count) OVER (PARTITION BY skill_name) AS series_max FROM closed)
        SELECT skill_name, period_start, CASE WHEN series_max > series_min THEN (demand_count - series_min) / CAST(series_max - series_min AS DOUBLE) ELSE 0 END AS scaled,
               CAST(demand_count AS DOUBLE) AS value FROM r""",
    doubles=("scaled", "value"),
)
def w07(spark, sf):
    scaled = windows.minmax_scale(domain.closed_skill_demand(spark, sf))
    return windows.minmax_inverse(scaled).select("skill_name", "period_start", "scaled", "value")


FENCES = """SELECT {keys} quantile_cont(demand_count, 0.25) AS q1, quantile_cont(demand_count, 0.75) AS q3 FROM {src} {group}"""


@query(
    "w08_iqr_flags",
    f"""WITH {CLOSED}, q AS ({FENCES.format(keys='skill_name,', src='closed', group='GROUP BY 1')})
        SELECT c.skill_name, period_start, demand_count, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence,
               demand_count < q1 - 1.5 * (q3 - q1) OR demand_count > q3 + 1.5 * (q3 - q1) AS is_outlier
        FROM closed c JOIN q ON c.skill_name = q.skill_name""",
    doubles=("lower_fence", "upper_fence"),
)
def w08(spark, sf):
    flagged = windows.iqr_flags(domain.closed_skill_demand(spark, sf))
    return flagged.select("skill_name", "period_start", "demand_count", "lower_fence", "upper_fence", "is_outlier")


def _fenced(k: float) -> str:
    return f"""WITH {ZERO_FILLED}, q AS ({FENCES.format(keys='skill_name,', src='filled', group='GROUP BY 1')})
        SELECT f.skill_name, period_start, demand_count, q1 - {k} * (q3 - q1) AS lower_fence, q3 + {k} * (q3 - q1) AS upper_fence,
               demand_count < q1 - {k} * (q3 - q1) OR demand_count > q3 + {k} * (q3 - q1) AS is_outlier
        FROM filled f JOIN q ON f.skill_name = q.skill_name"""


@query("w08_zero_filled_flags", _fenced(1.5), doubles=("demand_count", "lower_fence", "upper_fence"))
def w08z(spark, sf):
    flagged = windows.iqr_flags(profile.zero_filled(sparse_demand(spark, sf)))
    return flagged.select("skill_name", "period_start", "demand_count", "lower_fence", "upper_fence", "is_outlier")


@query("w08_triple_fence", _fenced(3.0), doubles=("demand_count", "lower_fence", "upper_fence"))
def w08t(spark, sf):
    flagged = windows.iqr_flags(profile.zero_filled(sparse_demand(spark, sf)), k=3.0)
    return flagged.select("skill_name", "period_start", "demand_count", "lower_fence", "upper_fence", "is_outlier")


@query(
    "w08_global_upper_fence",
    f"""WITH {SPARSE}, q AS ({FENCES.format(keys='', src='sparse', group='')})
        SELECT skill_name, period_start, demand_count FROM sparse CROSS JOIN q WHERE demand_count > q3 + 0.5 * (q3 - q1)""",
)
def w08g(spark, sf):
    flagged = windows.iqr_flags(sparse_demand(spark, sf), k=0.5, key=None)
    return flagged.filter(F.col("demand_count") > F.col("upper_fence")).select("skill_name", "period_start", "demand_count")


@query(
    "w09_sigma_flags",
    f"""WITH {SPARSE}, s AS (SELECT *, count(*) OVER w AS n, sum(demand_count) OVER w AS t, sum(demand_count * demand_count) OVER w AS q
          FROM sparse WINDOW w AS (PARTITION BY skill_name))
        SELECT skill_name, period_start, demand_count,
               (n * demand_count - t) * (n * demand_count - t) * (n - 1) > 9 * n * (n * q - t * t) AS is_outlier FROM s""",
)
def w09(spark, sf):
    return windows.sigma_flags(sparse_rows(spark, sf))


@query(
    "w10_share_of_peak",
    f"""WITH {VOLUME} SELECT date, count, count / CAST((SELECT max(count) FROM volume) AS DOUBLE) AS share,
        CAST(greatest(1, floor(count / CAST((SELECT max(count) FROM volume) AS DOUBLE) * 30)) AS INTEGER) AS bar_length FROM volume""",
    doubles=("share",),
)
def w10(spark, sf):
    return windows.share_of_peak(domain.order_volume(spark, sf), "count")


@query(
    "w11_positional_quantile",
    f"""WITH {SPARSE}, n AS (SELECT *, row_number() OVER (PARTITION BY skill_name ORDER BY demand_count) AS i, count(*) OVER (PARTITION BY skill_name) AS k FROM sparse)
        SELECT skill_name, demand_count AS threshold FROM n WHERE i = CAST(floor(k * 0.8) AS BIGINT) + 1""",
)
def w11(spark, sf):
    return windows.positional_quantile(sparse_rows(spark, sf))


FOLDS = """numbered AS (SELECT *, row_number() OVER (PARTITION BY skill_name ORDER BY period_start) - 1 AS i, count(*) OVER (PARTITION BY skill_name) AS n FROM {src}),
  folds AS (SELECT skill_name, period_start, demand_count, fold, i >= n - (3 - fold) * (n // 4) AS is_test
            FROM numbered CROSS JOIN (SELECT unnest(range(0, 3)) AS fold) WHERE n >= 4 AND i < n - (3 - fold) * (n // 4) + n // 4)"""


@query(
    "w12_time_series_folds",
    f"WITH {SPARSE}, {FOLDS.format(src='sparse')} SELECT * FROM folds",
    longs=("fold",),
)
def w12(spark, sf):
    return windows.time_series_folds(sparse_rows(spark, sf))


SEASON = """season AS (SELECT *, date_diff('day', (SELECT min(period_start) FROM {src}), period_start) / 30.44 AS t,
    sin(2 * pi() * month(period_start) / 12) AS sin_m, cos(2 * pi() * month(period_start) / 12) AS cos_m FROM {src})"""


@query(
    "m01_season_features",
    f"WITH {CLOSED}, {SEASON.format(src='closed')} SELECT * FROM season",
    doubles=("t", "sin_m", "cos_m"),
)
def m01(spark, sf):
    df = domain.closed_skill_demand(spark, sf).select("skill_name", "period_start", "demand_count")
    return reg.season_features(df, "period_start")


def ols_sql(source: str, name: str, keys: str, label: str = "demand_count", where: str = "true", extra: str = "") -> str:
    """Least squares on (t, sin_m, cos_m) by Cramer's rule, as two common table expressions."""
    f = ("t", "sin_m", "cos_m")
    sums = [f"avg({x}) FILTER ({where}) AS m{i}" for i, x in enumerate(f)]
    sums += [f"avg({label}) FILTER ({where}) AS my"]
    sums += [f"covar_pop({f[i]}, {f[j]}) FILTER ({where}) AS a{i}{j}" for i in range(3) for j in range(i, 3)]
    sums += [f"covar_pop({x}, {label}) FILTER ({where}) AS b{i}" for i, x in enumerate(f)]

    def det(c) -> str:
        return (
            f"({c[0][0]} * ({c[1][1]} * {c[2][2]} - {c[1][2]} * {c[2][1]}) - {c[0][1]} * ({c[1][0]} * {c[2][2]} - {c[1][2]} * {c[2][0]})"
            f" + {c[0][2]} * ({c[1][0]} * {c[2][1]} - {c[1][1]} * {c[2][0]}))"
        )

    m = [[f"a{min(i, j)}{max(i, j)}" for j in range(3)] for i in range(3)]
    coefs = []
    for k, x in enumerate(f):
        swapped = [[f"b{i}" if j == k else m[i][j] for j in range(3)] for i in range(3)]
        coefs.append(f"{det(swapped)} / {det(m)} AS coef_{x}")
    return f"""{name}_sums AS (SELECT {keys}, count(*) FILTER ({where}) AS n, {extra} {', '.join(sums)} FROM {source} GROUP BY {keys}),
  {name}_coefs AS (SELECT *, {', '.join(coefs)} FROM {name}_sums),
  {name} AS (SELECT *, my - coef_t * m0 - coef_sin_m * m1 - coef_cos_m * m2 AS intercept FROM {name}_coefs)"""


def pairs_sql(source: str, name: str, keys: str, features: list[str], label: str = "now") -> str:
    """Least squares on any features by elimination, as common table expressions: ``keys, n, intercept, coef_…``."""
    k = range(len(features))
    sums = [f"avg({x}) AS m{i}, covar_pop({x}, {label}) AS y{i}, var_pop({x}) AS v{i}" for i, x in enumerate(features)]
    sums += [f"covar_pop({features[i]}, {features[j]}) AS c{i}_{j}" for i in k for j in k]
    kept = f"{keys}, n, my, " + ", ".join(f"m{i}, v{i}" for i in k)
    steps = [f"{name}_0 AS (SELECT {keys}, count(*) AS n, avg({label}) AS my, {', '.join(sums)} FROM {source} GROUP BY {keys})"]
    for p in k:
        used = f"c{p}_{p} > 1e-10 * v{p}"
        cells = []
        for i in k:
            by = f"CASE WHEN {used} THEN c{i}_{p} / c{p}_{p} ELSE 0 END"
            cells.append(f"CASE WHEN {used} THEN y{p} ELSE 0 END AS y{p}" if i == p else f"y{i} - {by} * y{p} AS y{i}")
            cells += [f"CASE WHEN {used} THEN c{i}_{j} ELSE {int(i == j)} END AS c{i}_{j}" if i == p else f"c{i}_{j} - {by} * c{p}_{j} AS c{i}_{j}" for j in k]
        steps.append(f"{name}_{p + 1} AS (SELECT {kept}, {', '.join(cells)} FROM {name}_{p})")
    slopes = ", ".join(f"coalesce(y{i} / nullif(c{i}_{i}, 0), 0) AS coef_{f}" for i, f in enumerate(features))
    intercept = " - ".join(["my", *[f"coef_{f} * m{i}" for i, f in enumerate(features)]])
    steps.append(f"{name} AS (SELECT *, {intercept} AS intercept FROM (SELECT {kept}, {slopes} FROM {name}_{len(features)}))")
    return ",\n  ".join(steps)


@query(
    "m02_grouped_ols",
    f"""WITH {CLOSED}, {SEASON.format(src='closed')}, {ols_sql('season', 'fit', 'skill_name')}
        SELECT skill_name, n, intercept, coef_t, coef_sin_m, coef_cos_m FROM fit""",
    doubles=("intercept", "coef_t", "coef_sin_m", "coef_cos_m"),
)
def m02(spark, sf):
    featured = reg.season_features(domain.closed_skill_demand(spark, sf), "period_start")
    return reg.grouped_ols(featured, "skill_name")


M03_FOLDS = FOLDS.format(src="season").replace("demand_count, fold", "demand_count, t, sin_m, cos_m, fold")


@query(
    "m03_cross_validate",
    f"""WITH {CLOSED}, {SEASON.format(src='closed')}, {M03_FOLDS}, {ols_sql('folds', 'fit', 'skill_name, fold', where='NOT is_test')},
        e AS (SELECT f.skill_name, f.fold, f.demand_count AS y, f.demand_count - (intercept + coef_t * f.t + coef_sin_m * f.sin_m + coef_cos_m * f.cos_m) AS r
              FROM folds f JOIN fit c ON f.skill_name = c.skill_name AND f.fold = c.fold WHERE is_test),
        s AS (SELECT skill_name, fold, sqrt(avg(r * r)) AS rmse, avg(abs(r)) AS mae, 1 - sum(r * r) / (var_pop(y) * count(*)) AS r2 FROM e GROUP BY 1, 2)
        SELECT skill_name, avg(rmse) AS rmse, avg(mae) AS mae, avg(r2) AS r2, count(*) AS n_folds FROM s GROUP BY 1""",
    doubles=("rmse", "mae", "r2"),
)
def m03(spark, sf):
    return reg.cross_validate(domain.demand_table(spark, sf))


@query(
    "l06_sample_per_partition",
    "SELECT l_orderkey, count(*) AS n, true AS known, true AS blocks_full FROM lineitem GROUP BY 1",
)
def l06(spark, sf):
    """Per order: whether its drawn lines are lines of the table, each as often at most, and whether each block is full."""
    p = domain.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    drawn = materialize(sampling.sample_per_partition(p, 2_000, p.columns, blocks=8), "drawn")
    block = F.pmod(F.xxhash64(*p.columns), F.lit(8)).alias("block")
    sizes = p.groupBy(block).agg(F.least(F.count(F.lit(1)), F.lit(2_000)).alias("due"))
    full = sizes.join(drawn.groupBy(block).agg(F.count(F.lit(1)).alias("got")), "block", "left")
    full = full.agg(F.bool_and(F.coalesce(F.col("got"), F.lit(0)) == F.col("due"))).scalar()
    # only the drawn lines are looked up: no table of all lines is grouped
    taken = drawn.groupBy(*p.columns).agg(F.count(F.lit(1)).alias("got"))
    held = p.join(taken.select(*p.columns), p.columns, "left_semi").groupBy(*p.columns).agg(F.count(F.lit(1)).alias("held"))
    looked = taken.join(held, p.columns, "left").select("l_orderkey", F.lit(0).alias("n"), (F.col("got") <= F.coalesce("held", F.lit(0))).alias("known"))
    counted = p.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).withColumn("known", F.lit(True))
    return counted.unionByName(looked).groupBy("l_orderkey").agg(
        F.sum("n").alias("n"), F.bool_and("known").alias("known"),
    ).withColumn("blocks_full", full)


@query(
    "l07_stratum_sizes",
    """WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n FROM lineitem GROUP BY 1),
       q AS (SELECT *, 5000 // (SELECT count(*) FROM m) + CASE WHEN row_number() OVER (ORDER BY month) <= 5000 % (SELECT count(*) FROM m) THEN 1 ELSE 0 END AS quota FROM m)
       SELECT month, CAST(least(n, quota) AS BIGINT) AS n FROM q""",
)
def l07(spark, sf):
    p = domain.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", dates.month_start("l_shipdate").alias("month")
    )
    chosen = sampling.stratified_sample(p, "month", 5000, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return chosen.groupBy("month").agg(F.count(F.lit(1)).alias("n"))


@query(
    "l08_repeat_rows",
    f"""WITH {DEMAND}, t AS (SELECT period_start, sum(demand_count) AS count FROM demand GROUP BY 1)
        SELECT period_start, unnest(range(0, greatest(1, CAST(floor(count / 50.0) AS BIGINT)))) AS copy_index FROM t""",
    longs=("copy_index",),
)
def l08(spark, sf):
    months = domain.skill_demand(spark, sf).groupBy("period_start").agg(F.sum("demand_count").alias("count"))
    return sampling.repeat_rows(months, sampling.copies_per_fifty(F.col("count"))).drop("count")
