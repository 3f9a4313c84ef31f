"""Posting messages: JSON text to typed rows, with a table of rejects."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions import dates
from ..schemas import MONEY, POSTING_MESSAGE_FIELDS
from ..sources.files import exists
from ..sources.sinks import append_table

TOPIC = "job-postings"


def read_posting_stream(
    spark: SparkSession, servers: str, topic: str = TOPIC, min_partitions: int | None = None
) -> DataFrame:
    """The posting topic from its earliest offset as text messages (needs the Kafka connector).

    ``min_partitions`` splits large topic partitions over more tasks.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return (
        reader.load()
        .select(F.col("value").cast("string").alias("value"), "timestamp")
    )


def file_ingest(
    spark: SparkSession, path: str, schema, fmt: str = "json", files_per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Files landing in a folder as a stream; run it with ``availableNow`` to drain what is there."""
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


# Fields that must be JSON text where they are present.
TEXT_FIELDS = tuple(f for f in POSTING_MESSAGE_FIELDS if f not in ("jobId", "salaryMin", "salaryMax", "postedDate", "isRemote", "skills"))
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def parse_postings(messages: DataFrame) -> DataFrame:
    """Typed posting columns next to the message and a ``reject_reason`` (NULL when valid).

    Works on a batch or a stream with a text column ``value``. A missing currency
    becomes USD while an explicit null stays NULL; salaries may be numbers or text;
    the date must be exactly ``yyyy-MM-dd``. A salary that is no number or too large
    for its column, and a field of the wrong JSON type, reject the message and
    never fail the batch; the reason names the first such field.
    """
    def staged(df: DataFrame, kept: Sequence[str], **columns: Column) -> DataFrame:
        """Columns computed once for each row: inline keeps the optimizer from repeating them where they are used."""
        return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))

    given = messages.columns
    parsed = staged(messages, given, _v=F.try_parse_json("value"))
    # two passes over the object take the fields out: as the type that their column wants, and as they are where the kind counts
    wanted = {"isRemote": "boolean", "skills": "array<string>"}
    told = (*TEXT_FIELDS, *wanted)
    kinds = ", ".join(f"{f}: variant" for f in told)
    types = ", ".join(f"{f}: {wanted.get(f, 'string')}" for f in POSTING_MESSAGE_FIELDS)
    parts = staged(
        parsed, given, _raw=F.try_variant_get("_v", "$", f"struct<{kinds}>"), _read=F.try_variant_get("_v", "$", f"struct<{types}>"))
    read = {f"{f}_kind": F.schema_of_variant(f"_raw.{f}") for f in told}
    read |= {f"{f}_text": F.col(f"_read.{f}") for f in POSTING_MESSAGE_FIELDS if f not in wanted}
    read |= {"_object": F.col("_raw").isNotNull(), "_remote": F.col("_read.isRemote"), "_listed": F.col("_read.skills")}
    fields = staged(parts, given, **read)

    def kind(name: str) -> Column:
        return F.col(f"{name}_kind")

    def text(name: str) -> Column:
        return F.col(f"{name}_text")

    def present(name: str) -> Column:
        if name not in told:
            return text(name).isNotNull()  # any value but null has a text
        return kind(name) != "VOID"  # and not null, where the message has no such field

    def money(name: str) -> Column:
        number = F.when(text(name).rlike(NUMBER_TEXT), text(name))
        return number.try_cast("double").try_cast(MONEY)

    typed = staged(
        fields, [*given, *read], _low=money("salaryMin"), _high=money("salaryMax"), _posted=dates.parse_date(text("postedDate"), "iso_date"))
    listed = kind("skills").isin("ARRAY<STRING>", "ARRAY<VOID>")
    reason = (
        F.when(~F.col("_object"), "malformed")
        .when(present("salaryMin") & F.col("_low").isNull(), "salaryMin")
        .when(present("salaryMax") & F.col("_high").isNull(), "salaryMax")
        .when(present("postedDate") & F.col("_posted").isNull(), "postedDate")
        .when(present("skills") & ~listed, "skills")
    )
    for name in TEXT_FIELDS:
        reason = reason.when(present(name) & (kind(name) != "STRING"), name)
    reason = reason.when(text("title").isNull(), "title")
    return typed.select(
        *given,
        text("jobId").alias("job_id"),
        text("title").alias("title"),
        text("company").alias("company"),
        text("location").alias("location"),
        F.col("_low").alias("salary_min"),
        F.col("_high").alias("salary_max"),
        F.when(kind("salaryCurrency").isNotNull(), text("salaryCurrency")).otherwise("USD").alias("salary_currency"),
        text("source").alias("source"),
        text("sourceId").alias("source_id"),
        F.col("_posted").alias("posted_date"),
        text("jobType").alias("job_type"),
        text("experienceLevel").alias("experience_level"),
        text("industry").alias("industry"),
        F.coalesce(F.when(kind("isRemote") == "BOOLEAN", F.col("_remote")), F.lit(False)).alias("is_remote"),
        F.when(F.size("_listed") > 0, F.array_join("_listed", ",")).alias("skills"),
        reason.alias("reject_reason"),
    )


def valid_postings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected_postings(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject_reason").isNotNull()).select("value", "reject_reason")


def route_invalid(table_path: str, rejects_path: str) -> Callable[[DataFrame, int], None]:
    """A batch writer: valid rows to the table, the others with their reason to the rejects."""

    def write(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_postings(batch)
        # the text is only kept of what is rejected
        kept = F.when(F.col("reject_reason").isNotNull(), F.col("value")).alias("value")
        parsed = parsed.select(kept, *[c for c in parsed.columns if c != "value"]).persist()
        try:
            append_table(valid_postings(parsed).drop("value"), table_path, batch_id)
            rejected = rejected_postings(parsed)
            if not rejected.isEmpty() or not exists(batch.sparkSession, rejects_path):  # a table without rows can be read too
                append_table(rejected, rejects_path, batch_id, required=("reject_reason",))
        finally:
            parsed.unpersist()

    return write


def sink_postings(messages: DataFrame, table_path: str, rejects_path: str, checkpoint: str) -> DataStreamWriter:
    """Messages to the listing table. Offsets live in the checkpoint; a replayed batch
    overwrites its own partition, so each message is stored once."""
    return (
        messages.writeStream.foreachBatch(route_invalid(table_path, rejects_path))
        .option("checkpointLocation", checkpoint)
    )
