"""Sources and sinks: data derived from the given tables is written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import projections
from ..plans import domain, etl
from ..schemas import JOB_LISTINGS
from ..session import scratch_path
from ..sources import readers, sinks
from .core import CLOSED, DEMAND, POSTINGS, VOLUME, query
from .relational import HISTORY_AND_FORECAST, LISTING_WORDS, _history_and_forecast, _raw_listings

LISTING_SQL = f"""WITH {POSTINGS} SELECT CASE WHEN is_remote THEN title || chr(10) || '"quoted"' || chr(9) || 'end' ELSE title END AS title, company, location, CAST(salary_min AS DOUBLE) AS salary_min, CAST(salary_max AS DOUBLE) AS salary_max,
  'USD' AS salary_currency, source, id AS source_id, CAST(posted_date AS DATE) AS posted_date, job_type, experience_level, industry, is_remote,
  CASE WHEN is_remote THEN NULL ELSE skills END AS skills FROM postings"""


def _listings(spark, sf):
    p = domain.postings(spark, sf).withColumns({
        "source_id": F.col("id"),
        # a line break, quotes and a tab
        "title": F.when(F.col("is_remote"), F.concat("title", F.lit('\n"quoted"\tend'))).otherwise(F.col("title")),
        "posted_date": F.col("posted_date").cast("timestamp"),
        "skills": F.when(~F.col("is_remote"), F.col("skills")),
    })
    return p.select(*JOB_LISTINGS.fieldNames())


def _as_served(df):
    return df.withColumn("posted_date", F.to_date("posted_date"))


@query("s01_read_seed_tsv", LISTING_SQL, doubles=("salary_min", "salary_max"))
def s01(spark, sf):
    path = scratch_path(spark, "seed")
    flagged = _listings(spark, sf).withColumn("is_remote", F.when(F.col("is_remote"), "t").otherwise("False"))
    sinks.write_tsv(flagged, path)
    return _as_served(readers.read_seed_tsv(spark, path))


@query("k01_write_tsv", LISTING_SQL, doubles=("salary_min", "salary_max"))
def k01(spark, sf):
    path = scratch_path(spark, "tsv")
    sinks.write_tsv(_listings(spark, sf), path, JOB_LISTINGS.fieldNames())
    return _as_served(readers.read_seed_tsv(spark, path))


@query(
    "s02_read_postings_csv",
    f"""WITH {POSTINGS} SELECT id AS "Job Id", title AS "Job Title", company AS "Company",
        strftime(posted_date, '%Y-%m-%d') AS "Job Posting Date" FROM postings""",
)
def s02(spark, sf):
    path = scratch_path(spark, "postings-csv")
    raw = _raw_listings(spark, sf)
    sinks.write_csv(raw, path)
    wanted = ("Job Id", "Job Title", "Company", "Job Posting Date")
    return readers.read_postings_csv(spark, path, raw.columns, wanted)


@query(
    "s03_read_inferred_csv",
    "SELECT o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders",
    longs=("o_orderkey",), doubles=("o_totalprice",),
)
def s03(spark, sf):
    path = scratch_path(spark, "inferred")
    orders = domain.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderpriority"
    )
    sinks.write_csv(orders, path)
    return readers.read_inferred_csv(spark, path, "ISO-8859-1")


DEMAND_CSV = f"WITH {DEMAND} SELECT period_start, last_day(period_start) AS period_end, skill_name, CAST(demand_count AS DOUBLE) AS demand_count, 'Global' AS region, 'General' AS industry FROM demand"


@query("s04_load_first_valid", DEMAND_CSV)
def s04(spark, sf):
    base = scratch_path(spark, "candidates")
    demand = domain.skill_demand(spark, sf)
    # without a date column, too short a span, and valid
    sinks.write_csv(demand.select("skill_name", "demand_count"), f"{base}/a_no_dates")
    sinks.write_csv(demand.filter(F.year("period_start") == 1996), f"{base}/b_short")
    sinks.write_csv(demand.select("skill_name", "period_start", "demand_count"), f"{base}/c_valid")
    paths = [f"{base}/{name}" for name in ("c_valid", "b_short", "a_no_dates")]
    found, _ = readers.load_first_valid(spark, paths, lambda: demand)
    return found


@query(
    "s06_read_table",
    f"WITH {DEMAND} SELECT skill_name, period_start, demand_count FROM demand WHERE period_start >= DATE '2000-01-01'",
)
def s06(spark, sf):
    path = scratch_path(spark, "demand-table")
    domain.skill_demand(spark, sf).write.parquet(path)
    spark.read.parquet(path).createOrReplaceTempView("skill_demand_table")
    wanted = readers.read_table(spark, "skill_demand_table", ["skill_name", "period_start", "demand_count"])
    return wanted.filter(F.col("period_start") >= F.lit("2000-01-01").cast("date"))


@query(
    "s08_read_forecast_doc",
    f"""WITH {HISTORY_AND_FORECAST} SELECT 'historical' AS kind, date, count, NULL AS confidence_lower, NULL AS confidence_upper FROM history
        UNION ALL SELECT 'predicted', date, count, confidence_lower, confidence_upper FROM predicted""",
    doubles=("count", "confidence_lower", "confidence_upper"), places=1,
)
def s08(spark, sf):
    path = scratch_path(spark, "trend-document")
    sinks.write_trend_document(*_history_and_forecast(spark, sf), path)
    return readers.read_forecast_doc(spark, path)


@query(
    "s10_external_table",
    f"""WITH {POSTINGS} SELECT title, len(string_split(skills, ',')) AS skill_count, count(*) AS n FROM postings GROUP BY 1, 2""",
    longs=("skill_count",),
)
def s10(spark, sf):
    path = scratch_path(spark, "external")
    listed = domain.postings(spark, sf, "id", "title", "skills")
    sinks.write_csv(listed.withColumn("skills", F.translate("skills", ",", "|")), path)
    name = "external_" + path.rsplit("-", 1)[1]
    other = scratch_path(spark, "external-before")
    sinks.write_csv(listed.limit(1).withColumn("skills", F.lit("old")), other)
    readers.external_table(spark, name, other, "id STRING, title STRING, skills STRING", ["skills"])
    table = readers.external_table(spark, name, path, "id STRING, title STRING, skills STRING", ["skills"])
    return table.groupBy("title", F.size("skills").alias("skill_count")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "k02_write_csv",
    f"WITH {DEMAND} SELECT period_start, last_day(period_start) AS period_end, skill_name, demand_count, 'Malaysia' AS region, 'General' AS industry FROM demand",
    longs=("demand_count",),
)
def k02(spark, sf):
    path = scratch_path(spark, "csv")
    shaped = projections.shape_skill_demand(domain.skill_demand(spark, sf), "Malaysia")
    sinks.write_csv(shaped, path)
    return spark.read.schema(shaped.schema).csv(path, header=True)


@query(
    "k03_write_trend_document",
    f"""WITH {HISTORY_AND_FORECAST} SELECT (SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM history) AS historical_dates,
        (SELECT string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) FROM predicted) AS predicted_dates,
        (SELECT sum(count) FROM history) AS historical_sum, (SELECT sum(confidence_upper) FROM predicted) AS upper_sum""",
    doubles=("historical_sum", "upper_sum"), places=0,
)
def k03(spark, sf):
    doc = sinks.trend_document(*_history_and_forecast(spark, sf))

    def total(points):
        return F.aggregate(points, F.lit(0.0), lambda acc, x: acc + x)

    return doc.select(
        F.array_join("historical.date", ",").alias("historical_dates"),
        F.array_join("predicted.date", ",").alias("predicted_dates"),
        total(F.col("historical.count")).alias("historical_sum"),
        total(F.col("predicted.confidenceUpper")).alias("upper_sum"),
    )


@query("k04_replace_table", f"WITH {CLOSED} SELECT skill_name, period_start, demand_count FROM closed")
def k04(spark, sf):
    name = "replaced_" + scratch_path(spark, "t").rsplit("-", 1)[1]
    demand = domain.skill_demand(spark, sf)
    location = scratch_path(spark, "replace-table")
    spark.sql(f"CREATE TABLE {name} (skill_name STRING, period_start DATE, demand_count BIGINT) USING parquet LOCATION '{location}'")
    sinks.replace_table(demand.select("skill_name", "period_start", "demand_count"), name)
    closed = domain.closed_skill_demand(spark, sf).select("skill_name", "period_start", "demand_count")
    sinks.replace_table(closed, name)
    return readers.read_table(spark, name)


@query(
    "k05_append_table",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority AS title, o_orderkey % 2 AS batch_id FROM orders WHERE o_orderpriority <> '5-LOW'",
    longs=("batch_id",),
)
def k05(spark, sf):
    path = scratch_path(spark, "append")
    orders = domain.table(spark, sf, "orders").withColumn("title", F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")))
    halves = [orders.filter(F.col("o_orderkey") % 2 == i) for i in (0, 1)]
    for batch, part in enumerate(halves):
        sinks.append_table(part, path, batch)
    sinks.append_table(halves[1], path, 1)  # a replay must not duplicate rows
    return spark.read.parquet(path).select("o_orderkey", "o_orderstatus", "title", "batch_id")


@query(
    "k06_export",
    f"WITH {VOLUME} SELECT fmt, date, count FROM volume CROSS JOIN (SELECT unnest(['csv', 'json', 'parquet']) AS fmt)",
)
def k06(spark, sf):
    base = scratch_path(spark, "export")
    volume = domain.order_volume(spark, sf)
    frames = []
    for fmt, options in sinks.EXPORT_FORMATS.items():
        sinks.export(volume, f"{base}/{fmt}", fmt)
        back = spark.read.format(fmt).options(**options).schema(volume.schema).load(f"{base}/{fmt}")
        frames.append(back.select(F.lit(fmt).alias("fmt"), "date", "count"))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "k07_write_partitioned",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, CAST(sum(length(props)) AS BIGINT) AS props_length
       FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20' GROUP BY 1""",
)
def k07(spark, sf):
    path = scratch_path(spark, "partitioned")
    events = domain.table(spark, sf, "events")
    odd = F.dayofmonth("ts") % 2 == 1
    for part in (odd, ~odd, odd):  # a later call keeps the other days and replaces its own
        sinks.write_partitioned(events.filter(part), path, "ts")
    stored = spark.read.parquet(path).filter((F.col("day") >= 10) & (F.col("day") < 20))
    return stored.groupBy(F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"), F.sum(F.length("props")).alias("props_length"))


@query(
    "etl_description_demand",
    f"""WITH {POSTINGS}, s AS (SELECT posted_date, unnest(list_filter(list_distinct(string_split(title, ' ')), lambda w: w IN ({", ".join(f"'{w}'" for w in LISTING_WORDS)}))) AS skill FROM postings)
        SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period_start, skill AS skill_name, count(*) AS demand_count FROM s GROUP BY 1, 2
        UNION ALL SELECT CAST(date_trunc('month', posted_date) AS DATE), '(job_listings_total)', count(*) FROM postings GROUP BY 1""",
)
def etl_demand(spark, sf):
    return etl.description_demand(_raw_listings(spark, sf), vocabulary=LISTING_WORDS)


@query(
    "etl_mock_listings",
    f"""WITH {DEMAND}, t AS (SELECT period_start, greatest(1, CAST(floor(sum(demand_count) / 50.0) AS BIGINT)) AS n FROM demand GROUP BY 1)
        SELECT period_start AS posted, n FROM t""",
)
def etl_mock(spark, sf):
    shaped = projections.shape_skill_demand(domain.skill_demand(spark, sf), "Global")
    mock = etl.mock_listings(shaped, "fallback")
    return mock.groupBy(F.to_date("posted_date").alias("posted")).agg(F.count(F.lit(1)).alias("n"))
