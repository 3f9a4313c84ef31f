"""Streaming queries: each drains the given files through a checkpointed stream.

Results are written to Parquet below the shared checkpoint folder and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..plans import domain
from ..session import scratch_path
from ..streaming import live, postings as messages
from .core import query

DELAY = "30 seconds"


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events file as a stream with a TIMESTAMP event time (watermarks need one)."""
    schema = domain.table(spark, sf, "events").schema
    stream = messages.file_ingest(spark, sf, schema, "parquet", pathGlobFilter="events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def message_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as posting messages in JSON, some of them broken on purpose."""
    schema = domain.table(spark, sf, "lineitem").schema
    stream = messages.file_ingest(spark, sf, schema, "parquet", pathGlobFilter="lineitem.parquet")
    return _spread(stream).select(message_json().alias("value"))


def _spread(items: DataFrame) -> DataFrame:
    """Line items over as many tasks as shuffles have: a message takes so long to parse that the few splits of a file don't keep all cores busy."""
    return items.repartition("l_orderkey", "l_linenumber", "l_partkey")


def message_json():
    """One JSON text per line item; the return flag and line number select the special cases."""
    flag, line = F.col("l_returnflag"), F.col("l_linenumber")

    def text(column):
        return F.concat(F.lit('"'), column.cast("string"), F.lit('"'))

    parts = {
        "jobId": F.col("l_orderkey").cast("string"),
        "title": F.when(line == 7, F.lit("null")).when((line == 4) & (flag == "A"), F.lit("41")).otherwise(F.concat(F.lit('"Job '), F.col("l_partkey"), F.lit('"'))),
        "salaryMin": F.when(flag == "R", text(F.col("l_quantity").cast("int"))).otherwise(F.col("l_quantity").cast("int").cast("string")),
        "salaryMax": F.when((line == 4) & (flag == "R"), F.lit("1000000000000")).otherwise(F.lit("99000.5")),
        "postedDate": F.when(line == 6, text(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm"))).otherwise(
            text(F.date_format("l_shipdate", "yyyy-MM-dd"))
        ),
        "isRemote": F.when(flag == "R", F.lit("true")).when(flag == "A", F.lit('"true"')).otherwise(F.lit("false")),
        "skills": F.when(flag == "N", F.lit("[]")).otherwise(F.concat(F.lit('["a","'), flag, F.lit('"]'))),
    }
    fields = [F.concat(F.lit(f'"{name}":'), value) for name, value in parts.items()]
    currency = F.when(flag == "A", F.lit(',"salaryCurrency":null')).when(flag == "R", F.lit(',"salaryCurrency":"EUR"')).otherwise("")
    whole = F.concat(F.lit("{"), F.concat_ws(",", *fields), currency, F.lit("}"))
    return F.when(line == 5, F.lit("{broken")).otherwise(whole)


def drained(query_writer) -> None:
    """Process everything that is there and stop."""
    query_writer.trigger(availableNow=True).start().awaitTermination()


def stored(stream: DataFrame, spark: SparkSession, purpose: str) -> DataFrame:
    """The appended rows of a stream as a table."""
    base = scratch_path(spark, purpose)
    drained(
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", f"{base}/rows").option("checkpointLocation", f"{base}/checkpoint")
    )
    return spark.read.schema(stream.schema).parquet(f"{base}/rows")


def _newest(windows: DataFrame, spark: SparkSession, purpose: str, keys: list[str]) -> DataFrame:
    """All windows of a stream, open ones too, in their newest version."""
    base = scratch_path(spark, purpose)
    drained(live.upsert(windows, f"{base}/versions", f"{base}/checkpoint"))
    return live.current(live.stored_versions(spark, f"{base}/versions", windows), keys)


MESSAGES = """messages AS (
  SELECT l_orderkey AS job_id, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'Job ' || l_partkey END AS title,
         CAST(CAST(l_quantity AS INT) AS DOUBLE) AS salary_min, 99000.5 AS salary_max,
         CASE l_returnflag WHEN 'A' THEN NULL WHEN 'R' THEN 'EUR' ELSE 'USD' END AS salary_currency,
         CAST(l_shipdate AS DATE) AS posted_day, l_returnflag = 'R' AS is_remote,
         CASE WHEN l_returnflag = 'N' THEN NULL ELSE 'a,' || l_returnflag END AS skills, l_linenumber, l_returnflag
  FROM lineitem)"""
VALID = "l_linenumber NOT IN (5, 6, 7) AND NOT (l_linenumber = 4 AND l_returnflag IN ('A', 'R'))"


def _parsed_columns(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("job_id").cast("bigint").alias("job_id"), "title", "salary_min", "salary_max", "salary_currency",
        F.to_date("posted_date").alias("posted_day"), "is_remote", "skills",
    )


@query(
    "t01_parse_postings",
    f"WITH {MESSAGES} SELECT * EXCLUDE (l_linenumber, l_returnflag) FROM messages WHERE {VALID}",
    doubles=("salary_min", "salary_max"),
)
def t01(spark, sf):
    parsed = messages.valid_postings(messages.parse_postings(message_stream(spark, sf)))
    return _parsed_columns(stored(parsed, spark, "parse-postings"))


@query(
    "p14_posting_from_json",
    f"WITH {MESSAGES} SELECT * EXCLUDE (l_linenumber, l_returnflag) FROM messages WHERE {VALID}",
    doubles=("salary_min", "salary_max"),
)
def p14(spark, sf):
    batch = _spread(domain.table(spark, sf, "lineitem")).select(message_json().alias("value"))
    return _parsed_columns(messages.valid_postings(messages.parse_postings(batch)))


def _ingested(spark, sf, purpose):
    base = scratch_path(spark, purpose)
    drained(messages.sink_postings(message_stream(spark, sf), f"{base}/table", f"{base}/rejects", f"{base}/checkpoint"))
    return spark.read.parquet(f"{base}/table"), spark.read.parquet(f"{base}/rejects")


@query(
    "t02_route_invalid",
    """SELECT CASE WHEN l_linenumber = 5 THEN 'malformed' WHEN l_linenumber = 4 AND l_returnflag = 'R' THEN 'salaryMax'
                   WHEN l_linenumber = 6 THEN 'postedDate' ELSE 'title' END AS reject_reason, count(*) AS n
       FROM lineitem WHERE l_linenumber IN (5, 6, 7) OR l_linenumber = 4 AND l_returnflag IN ('A', 'R') GROUP BY 1""",
)
def t02(spark, sf):
    _, rejects = _ingested(spark, sf, "route-invalid")
    return rejects.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "t03_sink_postings",
    f"WITH {MESSAGES} SELECT * EXCLUDE (l_linenumber, l_returnflag) FROM messages WHERE {VALID}",
    doubles=("salary_min", "salary_max"),
)
def t03(spark, sf):
    table, _ = _ingested(spark, sf, "sink-postings")
    return _parsed_columns(table)


@query(
    "t04_live_counts",
    "SELECT time_bucket(INTERVAL 30 SECOND, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
)
def t04(spark, sf):
    counted = live.live_counts(event_stream(spark, sf), "ts", ["event_type"], "30 seconds", DELAY)
    rows = _newest(counted, spark, "live-counts", ["window_start", "window_end", "event_type"])
    return rows.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n")


@query("t05_dedupe_stream", "SELECT event_id, user_id, event_type FROM events")
def t05(spark, sf):
    stream = event_stream(spark, sf)
    doubled = stream.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    first = live.dedupe_stream(doubled, "ts", ["event_id", "user_id"], "31 days")
    return stored(first.select("event_id", "user_id", "event_type"), spark, "dedupe")


@query(
    "t06_upsert_demand_index",
    "SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, sum(value) AS total FROM events GROUP BY 1, 2",
    doubles=("total",), places=4,
)
def t06(spark, sf):
    # four files in no order of time: days are open until the last one
    events = scratch_path(spark, "unordered-events")
    table = domain.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    table.repartition(4, "user_id").write.parquet(events)
    stream = messages.file_ingest(spark, events, table.schema, "parquet", files_per_trigger=1)
    index = live.demand_index(stream, "ts", ["event_type"], "value", "40 days")
    base = scratch_path(spark, "demand-index")
    drained(live.upsert_index(index, f"{base}/index", f"{base}/checkpoint", ["event_type"]))
    return live.read_index(spark, f"{base}/index").select("day", "event_type", "n", "total")


@query(
    "t07_trending_alerts",
    """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2
              ),
            b AS (SELECT event_type, count(*) / (31.0 * 24) AS expected FROM events GROUP BY 1)
       SELECT 'skill_trending' AS event, window_start, w.event_type, n, expected, n / expected AS ratio FROM w JOIN b ON w.event_type = b.event_type
       WHERE n >= 2 * expected""",
    doubles=("expected", "ratio"),
)
def t07(spark, sf):
    usual = domain.table(spark, sf, "events").groupBy("event_type").agg((F.count(F.lit(1)) / (31.0 * 24)).alias("expected"))
    alerts = live.trending_alerts(event_stream(spark, sf), usual, "ts", "event_type", 2.0, "1 hour", DELAY)
    return _newest(alerts, spark, "alerts", ["event", "window_start", "event_type"]).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("s07_posting_stream", "SELECT CASE WHEN l_linenumber <> 5 THEN CAST(l_orderkey AS VARCHAR) END AS job_id, count(*) AS n FROM lineitem GROUP BY 1")
def s07(spark, sf):
    """Messages per job, as they went through the stream; broken ones have none."""
    messages = stored(message_stream(spark, sf), spark, "posting-stream")
    return messages.groupBy(F.get_json_object("value", "$.jobId").alias("job_id")).agg(F.count(F.lit(1)).alias("n"))


@query("s12_file_ingest", "SELECT event_id, user_id, event_type, value FROM events", doubles=("value",))
def s12(spark, sf):
    return stored(event_stream(spark, sf).select("event_id", "user_id", "event_type", "value"), spark, "file-ingest")
