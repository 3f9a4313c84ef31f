"""Byte-limited shards by extendible hashing, on Spark expressions alone.

The directory is indexed by the first bits of a 60-bit hash of id and text. A bucket that is over the limit splits
on one more bit, others stay; a row's shard is the shortest prefix of its hash whose rows fit. The sizes of all
prefixes up to a depth come from one aggregate over a histogram of as many cells as the limit needs, deeper bits
are only looked at for the rows of cells that are still over. Rows that no bit can part (equal id and text) are
laid out in pages by running sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import stored

HASH_BITS = 60
#: Bits looked at beyond those that even shards would need, and in every later round.
SPARE_BITS, MORE_BITS = 3, 8
MOST_CELL_BITS = 20
LIMIT_BYTES = 16 << 20


def key_hash(doc_id: Column, text: Column) -> Column:
    """The first 60 bits of an MD5 of the id and the text's MD5; nulls count as empty."""
    name = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(name), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _prefix(depth: Column | int) -> Column:
    """The first ``depth`` bits of the hash."""
    return F.shiftright("hash", F.lit(HASH_BITS) - depth) if isinstance(depth, Column) else F.shiftright("hash", HASH_BITS - depth)


def _split(rows: DataFrame, above: int, depth: int, limit: int) -> DataFrame:
    """depth, prefix and bytes of the buckets that fit, looking at prefixes of more than ``above`` bits up to ``depth``."""
    cells = rows.groupBy(_prefix(depth).alias("cell")).agg(F.sum("n_bytes").alias("n"))
    tree = cells.select("cell", "n", F.explode(F.sequence(F.lit(above + 1), F.lit(depth))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(cell, {depth} - depth)"))
    sums = tree.groupBy("depth", "prefix").agg(F.sum("n").alias("bytes"))
    fits = sums.filter(F.col("bytes") <= limit)
    parents = sums.filter(F.col("bytes") > limit).select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent"))
    top = fits.filter(F.col("depth") == above + 1)
    below = fits.withColumn("parent", F.expr("shiftright(prefix, 1)")).join(parents, ["depth", "parent"], "left_semi").select(*top.columns)
    return top.union(below)


def assign(docs: DataFrame, limit_bytes: int = LIMIT_BYTES, doc_id: str = "doc_id", text: str = "text", whole: bool = False) -> DataFrame:
    """A row for every row of ``docs``: ``doc_id, n_bytes, shard, depth, shard_bytes``.

    ``shard`` is the bucket's hash prefix as text of ``depth`` bits (empty: all rows), for pages of equal rows
    followed by ``#`` and the page. No shard is larger than ``limit_bytes`` unless it is a single row that is. Null
    ids and texts count as empty; further columns are left out, or with ``whole`` carried along as a struct ``row``.
    """
    kept = [doc_id, "n_bytes", *["row"] * whole]
    sized = docs.select(
        *[F.struct("*").alias("row")] * whole, F.col(doc_id), key_hash(F.col(doc_id), F.col(text)).alias("hash"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    rows = left = stored(sized, "sized")
    total = rows.agg(F.sum("n_bytes")).first()[0] or 0
    if total <= limit_bytes:
        return rows.select(*kept, F.lit("").alias("shard"), F.lit(0).alias("depth"), F.lit(total).cast("bigint").alias("shard_bytes"))
    done, above = None, 0
    depth = min(MOST_CELL_BITS, math.ceil(math.log2(total / limit_bytes)) + SPARE_BITS)
    while above < HASH_BITS:
        buckets = stored(_split(left, above, depth, limit_bytes), "buckets")
        cell = _prefix(depth)
        cells = buckets.select("depth", "prefix", "bytes")
        used = [r.depth for r in cells.select("depth").distinct().collect()]
        choices = F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in sorted(used)]) if used else None
        if choices is not None:
            spread = left.withColumn("at", F.explode(choices)).select("*", "at.depth", "at.prefix").drop("at")
            found = spread.join(cells, ["depth", "prefix"]).select(
                *kept, F.lpad(F.bin("prefix"), F.col("depth"), F.lit("0")).alias("shard"), "depth", F.col("bytes").alias("shard_bytes"))
            done = found if done is None else done.union(found)
        over = left.groupBy(cell.alias("cell")).agg(F.sum("n_bytes").alias("n")).filter(F.col("n") > limit_bytes).select("cell")
        over = stored(over, "over")
        if over.isEmpty():
            return done
        left = stored(left.join(over, cell == F.col("cell"), "left_semi"), "left")
        above, depth = depth, min(HASH_BITS, depth + MORE_BITS)
    pages = _pages(left, limit_bytes, kept)
    return pages if done is None else done.union(pages)


def _pages(rows: DataFrame, limit: int, kept: list[str]) -> DataFrame:
    """Rows that share their whole hash, in pages of half the limit by running sums; a larger row has a page of its own.

    The sums run within each written part, on top of the sums of the parts before, so no task holds a whole hash.
    """
    half = limit // 2
    rows = rows.withColumns({"part": F.spark_partition_id(), "place": F.monotonically_increasing_id()})
    small = rows.filter(F.col("n_bytes") <= half)
    parts = small.groupBy("hash", "part").agg(F.sum("n_bytes").alias("n"))
    before = F.sum("n").over(Window.partitionBy("hash").orderBy("part")) - F.col("n")
    small = small.join(parts.withColumn("before", before).select("hash", "part", "before"), ["hash", "part"])
    start = F.col("before") + F.sum("n_bytes").over(Window.partitionBy("hash", "part").orderBy("place")) - F.col("n_bytes")
    paged = small.withColumn("page", F.concat(F.lit("#"), F.floor(start / half).cast("string")))
    large = rows.filter(F.col("n_bytes") > half).withColumn("page", F.concat(F.lit("#+"), F.col("place").cast("string")))
    every = paged.select(*kept, "hash", "page").union(large.select(*kept, "hash", "page"))
    sums = every.groupBy("hash", "page").agg(F.sum("n_bytes").alias("shard_bytes"))
    return every.join(sums, ["hash", "page"]).select(
        *kept, F.concat(F.lpad(F.bin("hash"), HASH_BITS, "0"), F.col("page")).alias("shard"),
        F.lit(HASH_BITS).alias("depth"), "shard_bytes")


def write(docs: DataFrame, path: str, limit_bytes: int = LIMIT_BYTES, doc_id: str = "doc_id", text: str = "text") -> None:
    """The documents as Parquet, one folder a shard.

    Rows take their shard along, so those without id and repeated ones are written each once; a column ``shard`` of
    the documents gives way to the shard.
    """
    rows = assign(docs, limit_bytes, doc_id, text, whole=True)
    columns = [F.col("row")[c].alias(c) for c in docs.columns if c.lower() != "shard"]
    rows.select(*columns, "shard").repartition("shard").write.partitionBy("shard").parquet(path)
