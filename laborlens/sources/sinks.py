"""Batch sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def write_tsv(df: DataFrame, path: str, columns: Sequence[str] | None = None, header: bool = True) -> None:
    """Tab-separated text in a fixed column order; NULL is an unquoted empty field."""
    ordered = df.select(*columns) if columns else df
    ordered.write.mode("overwrite").csv(path, sep="\t", header=header, escape='"', emptyValue='""', nullValue="")


def write_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    ordered = df.select(*columns) if columns else df
    ordered.write.mode("overwrite").csv(path, header=True, escape='"')


def trend_document(history: DataFrame, predicted: DataFrame) -> DataFrame:
    """One row ``{historical: [...], predicted: [...]}`` with points sorted by date.

    Inputs have (date, count) and (date, count, confidence_lower, confidence_upper),
    one row per month of a single series.
    """

    def points(df: DataFrame, bounded: bool):
        def bound(name: str):
            value = F.round(F.col(name), 2) if bounded else F.lit(None)
            return value.cast("double")

        point = F.struct(
            F.date_format("date", "yyyy-MM-dd").alias("date"),
            F.round(F.col("count").cast("double"), 2).alias("count"),
            bound("confidence_lower").alias("confidenceLower"),
            bound("confidence_upper").alias("confidenceUpper"),
        )
        return df.agg(F.array_sort(F.collect_list(point)))

    past = points(history, False).toDF("historical")
    return past.withColumn("predicted", points(predicted, True).scalar())


def write_trend_document(history: DataFrame, predicted: DataFrame, path: str) -> None:
    trend_document(history, predicted).coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def replace_table(df: DataFrame, name: str) -> None:
    """Replace the content of a table."""
    df.write.mode("overwrite").saveAsTable(name)


def replace_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Empty a database table and load it again, keeping its definition."""
    df.write.format("jdbc").options(url=url, dbtable=table, truncate="true", **options).mode("overwrite").save()


def append_table(df: DataFrame, path: str, batch_id: int | None = None, required: Sequence[str] = ("title",)) -> None:
    """Append rows that have the required columns; a replayed batch replaces itself.

    The batch id is a partition of the table. Only that partition is overwritten,
    so running a batch a second time cannot duplicate rows.
    """
    complete = df.dropna(subset=list(required))
    if batch_id is None:
        complete.write.mode("append").parquet(path)
        return
    (
        complete.withColumn("batch_id", F.lit(batch_id).cast("long"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(path)
    )


EXPORT_FORMATS = {"csv": {"header": "true"}, "json": {}, "parquet": {}}


def export(df: DataFrame, path: str, fmt: str) -> None:
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}; choose from {sorted(EXPORT_FORMATS)}")
    df.write.mode("overwrite").format(fmt).options(**EXPORT_FORMATS[fmt]).save(path)


def write_partitioned(df: DataFrame, path: str, ts: str) -> None:
    """Parquet under year/month/day folders; days of earlier writes stay, a day written again is replaced.

    The rebalance lets Spark give a busy day to several tasks and pack quiet days together.
    """
    dated = df.withColumns({
        "year": F.year(ts),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    })
    (
        dated.hint("rebalance", "year", "month", "day")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("year", "month", "day")
        .parquet(path)
    )
