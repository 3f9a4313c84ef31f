"""Profiles, quality verdicts and series traits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
from ..plans import domain
from ..plans.tables import materialize
from .core import CLOSED, DEMAND, POSTINGS, REGIONAL, VOLUME, query
from .relational import SPIKES, SPIKES_SQL

ZERO_FILLED = f"""{REGIONAL}, cells AS (
  SELECT skill_name || '/' || region AS skill_name, period_start, avg(demand_count) AS demand_count FROM regional GROUP BY 1, 2),
filled AS (
  SELECT s.skill_name, d.period_start, coalesce(c.demand_count, 0.0) AS demand_count
  FROM (SELECT DISTINCT skill_name FROM cells) s CROSS JOIN (SELECT DISTINCT period_start FROM cells) d
  LEFT JOIN cells c ON c.skill_name = s.skill_name AND c.period_start = d.period_start),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY skill_name ORDER BY period_start) - 1 AS x FROM filled)"""


def sparse_rows(spark, sf):
    """Demand per brand and nation under one key; many months are missing."""
    df = domain.regional_demand(spark, sf)
    keyed = F.concat_ws("/", "skill_name", "region").alias("skill_name")
    return df.select(keyed, "period_start", "demand_count")


def sparse_demand(spark, sf):
    """``sparse_rows`` as a written table, for plans that read it more than once."""
    return materialize(sparse_rows(spark, sf), "sparse-demand")


@query(
    "a14_series_stats",
    f"""WITH {DEMAND} SELECT skill_name, avg(demand_count) AS mean, max(demand_count) AS max, min(demand_count) AS min,
        stddev_samp(demand_count) AS std, count(demand_count) AS count FROM demand GROUP BY 1""",
    doubles=("mean", "std"),
)
def a14(spark, sf):
    return profile.series_stats(domain.skill_demand(spark, sf))


@query(
    "a15_describe",
    """SELECT count(l_extendedprice) AS count, avg(l_extendedprice) AS mean, stddev_samp(l_extendedprice) AS std, min(l_extendedprice) AS min,
       quantile_cont(l_extendedprice, 0.25) AS p25, quantile_cont(l_extendedprice, 0.5) AS p50,
       quantile_cont(l_extendedprice, 0.75) AS p75, max(l_extendedprice) AS max FROM lineitem""",
    doubles=("mean", "std", "min", "p25", "p50", "p75", "max"), places=4,
)
def a15(spark, sf):
    return profile.describe(domain.table(spark, sf, "lineitem"), "l_extendedprice")


DOC_COLUMNS = ("doc_id", "lang", "n_chars", "quality", "toxic")


def _labelled(spark, sf):
    docs = domain.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(domain.table(spark, sf, "labels"), "doc_id", "left").select(*DOC_COLUMNS)


@query(
    "a16_table_overview",
    "WITH t AS (SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
    + " UNION ALL ".join(
        f""" SELECT '{c}' AS column_name, (SELECT count(*) FROM t) AS row_count, 5 AS column_count,
        (SELECT round(avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0 END), 2) FROM t) AS null_pct,
        (SELECT string_agg(coalesce(left(CAST({c} AS VARCHAR), 60), 'NULL'), '|' ORDER BY doc_id) FROM (SELECT * FROM t ORDER BY doc_id LIMIT 3)) AS samples"""
        for c in DOC_COLUMNS
    ),
    doubles=("null_pct",), longs=("column_count",), places=2,
)
def a16(spark, sf):
    overview = profile.table_overview(_labelled(spark, sf), ["doc_id"])
    return overview.withColumn("samples", F.array_join("samples", "|"))


@query(
    "a17_value_counts",
    """SELECT quality AS value, count(*) AS n, count(*) * 100.0 / (SELECT count(*) FROM documents) AS pct
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
    doubles=("pct",),
)
def a17(spark, sf):
    return profile.value_counts(_labelled(spark, sf), "quality")


@query(
    "a18_numeric_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count({c}) AS filled, count({c}) * 100.0 / count(*) AS fill_pct, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,
        avg({c}) AS mean, quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS p75,
        quantile_cont({c}, 0.95) AS p95 FROM lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
    ),
    doubles=("fill_pct", "min", "max", "mean", "p25", "median", "p75", "p95"), places=4,
)
def a18(spark, sf):
    return profile.numeric_profile(domain.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query(
    "a19_text_profile",
    """SELECT count(*) AS rows, count(text) AS non_null, count(*) FILTER (trim(text, ' ') <> '') AS non_empty,
       (SELECT string_agg(left(text, 200), '||' ORDER BY doc_id) FROM (SELECT * FROM documents WHERE trim(text, ' ') <> '' ORDER BY doc_id LIMIT 3)) AS samples
       FROM documents""",
)
def a19(spark, sf):
    found = profile.text_profile(domain.table(spark, sf, "documents"), "text", ["doc_id"])
    return found.withColumn("samples", F.array_join("samples", "||"))


@query(
    "a20_timestamp_profile",
    """SELECT count(ts) AS non_null, CAST(min(date_trunc('second', ts)) AS TIMESTAMP) AS min_ts, CAST(max(date_trunc('second', ts)) AS TIMESTAMP) AS max_ts,
       count(DISTINCT date_trunc('month', ts)) AS months FROM events""",
)
def a20(spark, sf):
    seconds = F.unix_seconds(F.col("ts").cast("timestamp"))
    events = domain.table(spark, sf, "events").select((seconds * 1000).cast("double").alias("listed_time"))
    return profile.timestamp_profile(events, "listed_time")


@query(
    "a20_monthly_distribution",
    """WITH m AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS n FROM lineitem GROUP BY 1)
       SELECT month, n, CAST(greatest(1, floor(n * 1.0 / (SELECT max(n) FROM m) * 30)) AS INTEGER) AS bar_length FROM m ORDER BY month DESC LIMIT 15""",
)
def a20m(spark, sf):
    return profile.monthly_distribution(domain.table(spark, sf, "lineitem"), "l_shipdate")


@query(
    "a21_distinct_counts",
    """SELECT 'l_suppkey' AS column_name, count(DISTINCT l_suppkey) AS distinct_values FROM lineitem
       UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey) FROM lineitem
       UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate) FROM lineitem""",
)
def a21(spark, sf):
    return profile.distinct_counts(domain.table(spark, sf, "lineitem"), ["l_suppkey", "l_partkey", "l_shipdate"])


@query(
    "a22_volume_stats",
    "SELECT avg(n) AS avg_n, min(n) AS min_n, max(n) AS max_n FROM (SELECT CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY 1)",
    doubles=("avg_n",),
)
def a22(spark, sf):
    return profile.volume_stats(domain.table(spark, sf, "events"), "ts")


@query(
    "a22_weekly_by_category",
    "SELECT CAST(date_trunc('week', ts) AS DATE) AS period, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def a22w(spark, sf):
    return profile.counts_per_period(domain.table(spark, sf, "events"), "ts", "week", ["event_type"])


@query(
    "a22_value_by_day",
    "SELECT CAST(ts AS DATE) AS period, avg(value) AS mean, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1",
    doubles=("mean",),
)
def a22v(spark, sf):
    return profile.value_by_period(domain.table(spark, sf, "events"), "ts", "value")


@query(
    "a23_date_span",
    "SELECT min(l_shipdate) AS min_ts, max(l_shipdate) AS max_ts, CAST(date_diff('day', min(l_shipdate), max(l_shipdate)) AS BIGINT) AS span_days FROM lineitem",
    longs=("span_days",),
)
def a23(spark, sf):
    return profile.date_span(domain.table(spark, sf, "lineitem"), "l_shipdate")


BRANDS = tuple(f"Brand#{i}" for i in range(1, 26))  # all of them


@query(
    "a24_pivot_series",
    f"WITH {DEMAND} SELECT period_start, "
    + ", ".join(f"coalesce(avg(demand_count) FILTER (skill_name = '{b}'), 0.0) AS \"{b.lower().replace('#', '_')}\"" for b in BRANDS)
    + " FROM demand GROUP BY 1",
    doubles=tuple(b.lower().replace("#", "_") for b in BRANDS),
)
def a24(spark, sf):
    wide = profile.pivot_series(domain.skill_demand(spark, sf), BRANDS)
    return wide.toDF("period_start", *[b.lower().replace("#", "_") for b in BRANDS])


@query(
    "a24_zero_filled",
    f"WITH {ZERO_FILLED} SELECT * FROM filled",
    doubles=("demand_count",),
)
def a24z(spark, sf):
    return profile.zero_filled(sparse_demand(spark, sf))


@query(
    "a25_month_pattern",
    f"WITH {CLOSED} SELECT month(period_start) AS month, avg(demand_count) AS mean, stddev_samp(demand_count) AS std, count(demand_count) AS count FROM closed GROUP BY 1",
    doubles=("mean", "std"), longs=("month",),
)
def a25p(spark, sf):
    return profile.month_pattern(domain.closed_skill_demand(spark, sf))


@query(
    "a25_month_seasonality",
    f"""WITH {CLOSED}, p AS (SELECT month(period_start) AS month, avg(demand_count) AS mean FROM closed GROUP BY 1)
        SELECT (max(mean) - min(mean)) / avg(mean) * 100 AS strength_pct, (SELECT month FROM p ORDER BY mean DESC, month LIMIT 1) AS peak_month,
               (SELECT month FROM p ORDER BY mean, month LIMIT 1) AS trough_month FROM p""",
    doubles=("strength_pct",), longs=("peak_month", "trough_month"),
)
def a25(spark, sf):
    return profile.month_seasonality(domain.closed_skill_demand(spark, sf))


@query(
    "a26_completeness",
    f"""WITH {ZERO_FILLED}, e AS (SELECT count(DISTINCT period_start) AS expected FROM cells)
        SELECT skill_name, count(*) AS periods, any_value(expected) AS expected, count(*) = any_value(expected) AS is_complete, count(*) < 10 AS is_sparse
        FROM cells CROSS JOIN e GROUP BY 1""",
)
def a26(spark, sf):
    return profile.completeness(sparse_demand(spark, sf))


@query(
    "a27_spike_periods",
    f"""WITH {DEMAND}, m AS (SELECT period_start, avg(demand_count) AS avg_demand FROM demand GROUP BY 1)
        SELECT * FROM m WHERE avg_demand > (SELECT median(avg_demand) FROM m) * 1.02""",
    doubles=("avg_demand",),
)
def a27(spark, sf):
    return profile.spike_periods(domain.skill_demand(spark, sf), k=1.02)


@query(
    "a28_histogram",
    """WITH e AS (SELECT min(o_totalprice) AS lo, (max(o_totalprice) - min(o_totalprice)) / 30 AS w FROM orders)
       SELECT least(CAST(floor((o_totalprice - lo) / w) AS INTEGER) + 1, 30) AS bin, any_value(lo + (least(CAST(floor((o_totalprice - lo) / w) AS INTEGER) + 1, 30) - 1) * w) AS bin_start,
              count(*) AS n FROM orders CROSS JOIN e GROUP BY 1""",
    doubles=("bin_start",), longs=("bin",), places=4,
)
def a28(spark, sf):
    return profile.histogram(domain.table(spark, sf, "orders"), "o_totalprice")


@query(
    "a29_dataset_scorecard",
    f"""WITH {POSTINGS}, t AS (SELECT count(posted_date) * 100.0 / count(*) AS dated, count(DISTINCT date_trunc('month', posted_date)) AS months,
          count(salary_max) * 100.0 / count(*) AS paid, count(CASE WHEN is_remote THEN 1 END) * 100.0 / count(*) AS remote FROM postings),
        s AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM lineitem)
        SELECT 'monthly_listing_series' AS use_case, dated AS measure, months, CASE WHEN months >= 12 AND dated > 80 THEN 'EXCELLENT' WHEN months >= 6 THEN 'MODERATE' ELSE 'POOR' END AS verdict FROM t
        UNION ALL SELECT 'skill_demand_series', n, NULL, CASE WHEN n > 10000 THEN 'EXCELLENT' WHEN n > 1000 THEN 'MODERATE' ELSE 'POOR' END FROM s
        UNION ALL SELECT 'salary_analysis', paid, NULL, CASE WHEN paid > 50 THEN 'EXCELLENT' WHEN paid > 10 THEN 'MODERATE - sparse' ELSE 'POOR - very sparse' END FROM t
        UNION ALL SELECT 'remote_analysis', remote, NULL, CASE WHEN remote > 50 THEN 'EXCELLENT' WHEN remote > 20 THEN 'MODERATE - sparse' ELSE 'POOR - very sparse' END FROM t""",
    doubles=("measure",),
)
def a29(spark, sf):
    p = domain.postings(spark, sf, "posted_date", "salary_max", "is_remote")
    p = p.withColumn("remote_allowed", F.when(F.col("is_remote"), 1.0))
    job_skills = domain.table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    return profile.dataset_scorecard(p, job_skills, "posted_date", "salary_max", "remote_allowed")


TRAITS = """top AS (SELECT skill_name FROM cells GROUP BY 1 ORDER BY avg(demand_count) DESC, skill_name LIMIT {n}),
bounds AS (SELECT skill_name, count(*) AS k, sum(demand_count) AS s, sum(demand_count * demand_count) AS q FROM filled GROUP BY 1),
traits AS (
  SELECT n.skill_name, avg(demand_count) AS mean, stddev_samp(demand_count) AS std, min(demand_count) AS min, max(demand_count) AS max,
         regr_slope(demand_count, x) AS trend_slope, regr_r2(demand_count, x) AS trend_r2,
         CASE WHEN avg(demand_count) > 0 THEN stddev_samp(demand_count) / avg(demand_count) ELSE 0 END AS volatility,
         count(*) FILTER ((k * demand_count - s) * (k * demand_count - s) * (k - 1) > 9 * k * (k * q - s * s)) AS outliers_count, count(*) AS length
  FROM numbered n JOIN bounds b ON n.skill_name = b.skill_name
  WHERE n.skill_name IN (SELECT skill_name FROM top) GROUP BY 1 HAVING count(*) FILTER (demand_count > 0) >= 3)"""


@query(
    "a30_tier_counts",
    f"""WITH {ZERO_FILLED}, {TRAITS.format(n=100)}
        SELECT 'volatility' AS tier_kind, CASE WHEN volatility > 0.5 THEN 'high' WHEN volatility > 0.3 THEN 'medium' ELSE 'low' END AS tier, count(*) AS n FROM traits GROUP BY 1, 2
        UNION ALL SELECT 'trend', CASE WHEN trend_slope > 0.05 THEN 'increasing' WHEN trend_slope < -0.05 THEN 'decreasing' ELSE 'stable' END, count(*) FROM traits GROUP BY 1, 2""",
)
def a30(spark, sf):
    return profile.tier_counts(profile.characterize(sparse_demand(spark, sf), top=100))


@query(
    "a41_spike_summary",
    f"""WITH {CLOSED} SELECT skill_name, count(*) AS n, min(demand_count) AS min, max(demand_count) AS max, avg(demand_count) AS mean,
        avg(demand_count) FILTER (period_start >= DATE '1999-07-01') AS mean_since,
        coalesce(string_agg(strftime(period_start, '%Y-%m'), ',' ORDER BY period_start) FILTER (period_start IN ({SPIKES_SQL})), 'none') AS spike_months
        FROM closed GROUP BY 1 ORDER BY max DESC, skill_name LIMIT 5""",
    doubles=("mean", "mean_since"),
)
def a41(spark, sf):
    return profile.spike_summary(domain.closed_skill_demand(spark, sf), SPIKES, "1999-07-01")


@query(
    "m15_characterize",
    f"WITH {ZERO_FILLED}, {TRAITS.format(n=15)} SELECT * FROM traits",
    doubles=("mean", "std", "min", "max", "trend_slope", "trend_r2", "volatility"),
)
def m15(spark, sf):
    return profile.characterize(sparse_demand(spark, sf))


@query(
    "m21_trend_line",
    f"""WITH {ZERO_FILLED}, top AS (SELECT skill_name FROM cells GROUP BY 1 ORDER BY avg(demand_count) DESC, skill_name LIMIT 5),
        f AS (SELECT skill_name, regr_slope(demand_count, x) AS b, regr_intercept(demand_count, x) AS a FROM numbered GROUP BY 1)
        SELECT n.skill_name, period_start, demand_count, a + b * x AS fitted FROM numbered n JOIN f ON n.skill_name = f.skill_name
        WHERE n.skill_name IN (SELECT skill_name FROM top)""",
    doubles=("demand_count", "fitted"),
)
def m21(spark, sf):
    return profile.trend_line(sparse_demand(spark, sf))


@query(
    "a06_order_volume",
    f"WITH {VOLUME} SELECT date, count FROM volume",
)
def a06v(spark, sf):
    return domain.order_volume(spark, sf)
