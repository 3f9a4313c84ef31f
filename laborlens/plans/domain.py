"""Domain views built from the given tables.

Each view names the columns it needs, and only the joins behind those columns are
planned. All views are lazy.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import dates
from ..functions.vocab import TOTAL_SERIES
from ..operators import aggregates
from ..schemas import MONEY
from .tables import materialize

# column -> (table it comes from, expression)
POSTING_COLUMNS = {
    "id": ("lineitem", "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"),
    "posted_date": ("lineitem", "l_shipdate"),
    "salary_max": ("lineitem", f"cast(l_extendedprice as {MONEY.simpleString()})"),
    "is_remote": ("lineitem", "l_returnflag = 'R'"),
    "salary_currency": ("lineitem", "'USD'"),
    "source": ("lineitem", "l_linestatus"),
    "order_id": ("lineitem", "l_orderkey"),
    "title": ("part", "p_name"),
    "skills": ("part", "replace(p_name, ' ', ',')"),
    "brand": ("part", "p_brand"),
    "job_type": ("part", "p_type"),
    "salary_min": ("part", f"cast(p_retailprice as {MONEY.simpleString()})"),
    "company": ("supplier", "s_name"),
    "location": ("nation", "n_name"),
    "region": ("region", "r_name"),
    "experience_level": ("orders", "o_orderpriority"),
    "industry": ("customer", "c_mktsegment"),
}

# table -> (tables it needs first, join key on the posting side, join key on the table); joined in this order, so that a
# posting crosses the large shuffles while it is narrow and gets its longer texts last
JOINS = {
    "orders": ((), "l_orderkey", "o_orderkey"),
    "customer": (("orders",), "o_custkey", "c_custkey"),
    "part": ((), "l_partkey", "p_partkey"),
    "supplier": ((), "l_suppkey", "s_suppkey"),
    "nation": (("supplier",), "s_nationkey", "n_nationkey"),
    "region": (("supplier", "nation"), "n_regionkey", "r_regionkey"),
}
# table -> the table that takes it along, so that postings are not shuffled for it
BRANCHES = {"customer": "orders", "nation": "supplier", "region": "supplier"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Job postings: one row per line item. Without columns, all of them."""
    columns = columns or tuple(POSTING_COLUMNS)
    needed = {t for name in columns for home in [POSTING_COLUMNS[name][0]] if home != "lineitem" for t in (*JOINS[home][0], home)}
    df = table(spark, sf_dir, "lineitem")
    for name in (t for t in JOINS if t in needed and t not in BRANCHES):
        _, left, right = JOINS[name]
        other = table(spark, sf_dir, name)
        for branch in (t for t, root in BRANCHES.items() if root == name and t in needed):
            other = other.join(table(spark, sf_dir, branch), F.col(JOINS[branch][1]) == F.col(JOINS[branch][2]), "left")
        df = df.join(other, F.col(left) == F.col(right), "left")
    return df.select(*[F.expr(POSTING_COLUMNS[name][1]).alias(name) for name in columns])


def skill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly postings per brand, as (skill_name, period_start, demand_count).

    Two columns of the fact table are read. The part table is broadcast while it is
    small; beyond that the join is shuffled on the part key, and a hot part is split
    by the adaptive skew join. Counting starts on the map side.
    """
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("skill_name"))
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("skill_name", dates.month_start("l_shipdate").alias("period_start"))
        .agg(F.count(F.lit(1)).alias("demand_count"))
    )


def closed_skill_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the last month, which holds only a few days."""
    demand = skill_demand(spark, sf_dir)
    last = table(spark, sf_dir, "lineitem").agg(F.max("l_shipdate")).scalar()
    return demand.filter(F.col("period_start") < F.trunc(last.cast("date"), "month"))


def demand_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``closed_skill_demand`` as a written table, for plans that read it more than once.

    The last month is taken from the table, not from the facts again.
    """
    demand = materialize(skill_demand(spark, sf_dir), "skill-demand")
    return demand.filter(F.col("period_start") < demand.agg(F.max("period_start")).scalar())


def regional_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly postings per brand and supplier nation; some months of a series are empty."""
    items = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_shipdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("skill_name"))
    nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("region"))
    suppliers = (
        table(spark, sf_dir, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", "region")
    )
    return (
        items.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("skill_name", "region", dates.month_start("l_shipdate").alias("period_start"))
        .agg(F.count(F.lit(1)).alias("demand_count"))
    )


def order_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly number of orders as (date, count), without the unfinished last month."""
    orders = table(spark, sf_dir, "orders")
    counts = aggregates.monthly_counts(orders, "o_orderdate", "count").withColumnRenamed("month", "date")
    last = orders.agg(F.max("o_orderdate")).scalar()
    return counts.filter(F.col("date") < F.trunc(last.cast("date"), "month"))


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON text messages with their event time."""
    events = table(spark, sf_dir, "events")
    return events.select(F.to_json(F.struct("*")).alias("value"), F.col("ts").cast("timestamp").alias("ts"))


def stored_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast table to serve from: each known month projected seven years ahead.

    Holds every brand and the total series.
    """
    # every month counts for its series and for the total, in one pass
    both = F.explode(F.array("skill_name", F.lit(TOTAL_SERIES))).alias("skill_name")
    rows = closed_skill_demand(spark, sf_dir).select(both, "period_start", "demand_count").groupBy("skill_name", "period_start").agg(
        F.sum("demand_count").alias("demand_count"))
    value = F.col("demand_count").cast("double")
    return rows.select(
        F.concat_ws("@", "skill_name", "period_start").alias("id"),
        "skill_name",
        F.add_months("period_start", 84).alias("forecast_date"),
        (value * 1.1).alias("predicted_demand"),
        (value * 0.875).alias("confidence_lower"),
        (value * 1.3125).alias("confidence_upper"),
        F.lit("Projection").alias("model_version"),
        F.lit("Global").alias("region"),
    )
