"""Live counts, de-duplication, the demand index and trending alerts.

State is bounded by a watermark: rows later than ``delay`` behind the newest event
are dropped, and ``late_rows`` counts them. In update mode a window is delivered as it
grows, so the open windows at the end are there too; ``upsert`` stores these versions
and ``current`` serves the newest one, ``upsert_index`` keeps a table of days in place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..sources import files

WATERMARK = "30 seconds"
# The index holds whole days; rows may come as late as this.
INDEX_DELAY = "2 days"


def live_counts(
    stream: DataFrame, ts: str, keys: Sequence[str] = (), width: str = "30 seconds", delay: str = WATERMARK
) -> DataFrame:
    """Rows per tumbling window and key. Counting starts on the map side, so a hot key is no burden."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, width).alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")
    )


def dedupe_stream(stream: DataFrame, ts: str, keys: Sequence[str], delay: str = WATERMARK) -> DataFrame:
    """The first row of each key; a copy later than the watermark delay may pass again."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def demand_index(
    stream: DataFrame, ts: str, keys: Sequence[str], value: str, delay: str = INDEX_DELAY
) -> DataFrame:
    """Running count and sum of a value per day and key, for the update output mode."""
    return (
        stream.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 day").alias("window"), *keys)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
        .select(F.to_date(F.col("window.start")).alias("day"), *keys, "n", "total")
    )


def upsert(windows: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep a table of windows current.

    Each update row carries the whole new state of its window and key. A batch is
    stored as its own partition, which a replay overwrites, and ``current`` serves
    the newest state. Nothing is read back and rewritten in place, so losing an
    executor in the middle of a batch cannot damage earlier windows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(path)
        )

    return (
        windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    )


def current(versions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest version of each window and key."""
    measures = [c for c in versions.columns if c not in ("batch_id", *keys)]
    newest = F.max_by(F.struct(*measures), "batch_id").alias("_state")
    return versions.groupBy(*keys).agg(newest).select(*keys, "_state.*")


def stored_versions(spark: SparkSession, path: str, windows: DataFrame) -> DataFrame:
    """All versions that ``upsert`` has stored of these windows; a table without any can be read too."""
    return spark.read.schema(windows.withColumn("batch_id", F.lit(0).cast("long")).schema).parquet(path)


def compact(versions: DataFrame, keys: Sequence[str], path: str) -> None:
    """The newest versions of a stopped stream as a table of their own, numbered as the last batch.

    A stream that goes on into ``path`` with its old checkpoint adds later batches there.
    """
    last = versions.agg(F.max("batch_id")).scalar()
    current(versions, keys).withColumn("batch_id", last).write.partitionBy("batch_id").parquet(path)


def merge_batch(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], day: str = "day") -> None:
    """Put the rows of a batch, whole new states of their keys, into the table of ``read_index``.

    Only the days that the batch has are read and written, each as a new version beside the old one. The batch's mark
    makes all its versions current in one step, then the versions they replace are deleted. A batch that is run again,
    after its mark or after a loss in the middle, leaves the same table; the number of files follows the number of
    days and not that of the batches.
    """
    spark = batch.sparkSession
    marked = _mark(spark, path)
    if marked is not None and batch_id <= marked:
        return
    rows = batch.persist()
    try:
        days = [r[0] for r in rows.select(day).distinct().collect()]  # those still open under the watermark
        if days:
            held = _versions(spark, path, marked, {str(d) for d in days})
            if held is not None:
                rows = held.join(batch.select(day, *keys), [day, *keys], "left_anti").select(*batch.columns).unionByName(batch)
            (
                rows.withColumn("version", F.lit(batch_id).cast("long")).hint("rebalance", day)
                .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day, "version").parquet(f"{path}/days")
            )
        files.touch(spark, f"{path}/marks/{batch_id}")
    finally:
        batch.unpersist()
    for d in days:
        folder = f"{path}/days/{day}={d}"
        for name in files.children(spark, folder):
            if int(name.partition("=")[2]) < batch_id:
                files.remove(spark, f"{folder}/{name}")
    for name in files.children(spark, f"{path}/marks"):
        if int(name) < batch_id:
            files.remove(spark, f"{path}/marks/{name}")


def _mark(spark: SparkSession, path: str) -> int | None:
    """The last batch that is whole."""
    return max(map(int, files.children(spark, f"{path}/marks")), default=None)


def _versions(spark: SparkSession, path: str, marked: int | None, only: set[str] | None = None) -> DataFrame | None:
    """The current version of each day, of the named days only if given."""
    if marked is None:
        return None
    paths = []
    for folder in files.children(spark, f"{path}/days"):
        if "=" in folder and (only is None or folder.partition("=")[2] in only):
            whole = [v for v in (int(n.partition("=")[2]) for n in files.children(spark, f"{path}/days/{folder}")) if v <= marked]
            if whole:
                paths.append(f"{path}/days/{folder}/version={max(whole)}")
    return spark.read.option("basePath", f"{path}/days").parquet(*paths).drop("version") if paths else None


def read_index(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as of its last whole batch, one version of every day; None before the first one."""
    return _versions(spark, path, _mark(spark, path))


def upsert_index(windows: DataFrame, path: str, checkpoint: str, keys: Sequence[str], day: str = "day") -> DataStreamWriter:
    """Keep a table of daily states current in place: ``merge_batch`` for every batch of a stream in update mode."""
    def write(batch: DataFrame, batch_id: int) -> None:
        merge_batch(batch, batch_id, path, keys, day)

    return windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)


def late_rows(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over the progress that the query remembers."""
    return sum(op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators)


def trending_alerts(
    stream: DataFrame, baseline: DataFrame, ts: str, key: str, threshold: float, width: str = "30 seconds",
    delay: str = WATERMARK,
) -> DataFrame:
    """Windows whose count reaches ``threshold`` times the key's usual count per window.

    ``baseline`` is a static table (key, expected). One row per window and key is joined:
    in append mode when the window closes, in update mode each time it grows.
    """
    counted = live_counts(stream, ts, [key], width, delay)
    return (
        counted.join(baseline.select(key, "expected"), key)
        .filter(F.col("n") >= threshold * F.col("expected"))
        .select(
            F.lit("skill_trending").alias("event"), "window_start", key, "n", "expected",
            (F.col("n") / F.col("expected")).alias("ratio"),
        )
    )
