"""Registration of queries with their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Runner
    sql: str | None


QUERIES: dict[str, Query] = {}
PLACES = 6


def query(
    name: str, sql: str | None = None, doubles: Sequence[str] = (), longs: Sequence[str] = (),
    places: int = PLACES,
) -> Callable[[Runner], Runner]:
    """Register a query.

    ``doubles`` are delivered as doubles rounded to six places and ``longs`` as 64-bit
    integers, in Spark and in SQL alike, so that both engines print equal values.
    """

    def register(run: Runner) -> Runner:
        def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = run(spark, sf_dir)
            return df.withColumns({
                **{c: F.round(F.col(c).cast("double"), places) + 0.0 for c in doubles},
                **{c: F.col(c).cast("bigint") for c in longs},
            }) if doubles or longs else df

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        delivered.__doc__ = run.__doc__
        QUERIES[name] = Query(name, delivered, _wrapped(sql, doubles, longs, places))
        return run

    return register


def _wrapped(sql: str | None, doubles: Sequence[str], longs: Sequence[str], places: int) -> str | None:
    if sql is None or not (doubles or longs):
        return sql
    parts = [f"round(CAST({c} AS DOUBLE), {places}) + 0.0 AS {c}" for c in doubles]
    parts += [f"CAST({c} AS BIGINT) AS {c}" for c in longs]
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM ({sql})"


# The domain views in SQL, to be put in front of a query with WITH.
POSTINGS = """postings AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
         l_shipdate AS posted_date,
         CAST(l_extendedprice AS DECIMAL(10,2)) AS salary_max,
         CAST(p_retailprice AS DECIMAL(10,2)) AS salary_min,
         l_returnflag = 'R' AS is_remote, 'USD' AS salary_currency, l_linestatus AS source,
         l_orderkey AS order_id, p_name AS title, replace(p_name, ' ', ',') AS skills, p_brand AS brand,
         p_type AS job_type, s_name AS company, n_name AS location, r_name AS region,
         o_orderpriority AS experience_level, c_mktsegment AS industry
  FROM lineitem
  LEFT JOIN part ON l_partkey = p_partkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN nation ON s_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey)"""

POSTING_SKILLS = POSTINGS + """, posting_skills AS (
  SELECT *, unnest(list_distinct(string_split(skills, ','))) AS skill FROM postings)"""

DEMAND = """demand AS (
  SELECT p_brand AS skill_name, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start,
         count(*) AS demand_count
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

CLOSED = DEMAND + """, closed AS (
  SELECT * FROM demand
  WHERE period_start < (SELECT date_trunc('month', max(l_shipdate)) FROM lineitem))"""

REGIONAL = """regional AS (
  SELECT p_brand AS skill_name, n_name AS region, CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start,
         count(*) AS demand_count
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL)"""

VOLUME = """volume AS (
  SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS date, count(*) AS count FROM orders
  WHERE date_trunc('month', o_orderdate) < (SELECT date_trunc('month', max(o_orderdate)) FROM orders)
  GROUP BY ALL)"""

FORECASTS = CLOSED + """, forecast_source AS (
  SELECT skill_name, period_start, demand_count FROM closed
  UNION ALL
  SELECT '(job_listings_total)', period_start, sum(demand_count) FROM closed GROUP BY period_start),
forecasts AS (
  SELECT concat_ws('@', skill_name, period_start) AS id, skill_name,
         CAST(period_start + INTERVAL 84 MONTH AS DATE) AS forecast_date,
         CAST(demand_count AS DOUBLE) * 1.1 AS predicted_demand,
         CAST(demand_count AS DOUBLE) * 0.875 AS confidence_lower,
         CAST(demand_count AS DOUBLE) * 1.3125 AS confidence_upper,
         'Projection' AS model_version, 'Global' AS region
  FROM forecast_source)"""
