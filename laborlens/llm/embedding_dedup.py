"""Near copies among embeddings by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash is the signed axis that
it is nearest to. Several hashes make a bucket, several tables make misses rare, and each vector also looks into
the buckets of its next-nearest axes. Candidate pairs are verified by their cosine in double precision. Equal
vectors are one node; large buckets are cut into blocks, and each pair of blocks is one bounded piece of work that
yields link counts and spanning links, never single pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import rows_a_batch, stored
from .components import components

#: Tables at least; more hashes need more tables.
TABLES, PROBES = 14, 5
#: The share of pairs at the least cosine that meet in a bucket, at every size of the table.
RECALL = 0.995
#: From so many tables on, buckets of fewer hashes cost less; large ones are cut into blocks.
MANY_TABLES = 64
#: Drawn pairs that the tables are counted from.
TRIAL_PAIRS = 500
BLOCK = 1024
#: Rows with vectors in an Arrow batch.
WIDE_ROWS = 2000
SEED = 20_240_601


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the width is a power of two."""
    n, width = x.shape
    step = 1
    while step < width:
        pair = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], 2).reshape(n, width)
        step *= 2
    return x / math.sqrt(width)


def axes(x: np.ndarray, signs: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest signed axes of each rotated row, and how much farther they are than the nearest one."""
    for s in signs:
        x = hadamard(x * s)
    size = np.abs(x)
    near = np.argpartition(-size, count - 1, axis=1)[:, :count]
    near = np.take_along_axis(near, np.argsort(-np.take_along_axis(size, near, 1), axis=1, kind="stable"), 1)
    value = np.take_along_axis(x, near, 1)
    return 2 * near + (value < 0), np.abs(value[:, :1]) - np.abs(value)


def buckets(x: np.ndarray, hashes: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """rows x tables x probes: the own bucket first, then those of the next-nearest axes, the nearest first."""
    n, dim = x.shape
    width = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, width))
    padded[:, :dim] = x
    random = np.random.default_rng(SEED)
    choices = min(width, 3)
    out = np.zeros((n, tables, probes), np.int64)
    for t in range(tables):
        found = [axes(padded, random.choice([-1.0, 1.0], (3, width)), choices) for _ in range(hashes)]
        # all ways to move away from the nearest axis in one or two of the hashes, by the added distance
        ways = [()] + [((h, c),) for h in range(hashes) for c in range(1, choices)]
        ways += [((g, 1), (h, 1)) for g in range(hashes) for h in range(g + 1, hashes)]
        cost, code = np.zeros((n, len(ways))), np.zeros((n, len(ways)), np.int64)
        for w, way in enumerate(ways):
            moved = dict(way)
            for h, (axis, gap) in enumerate(found):
                code[:, w] = code[:, w] * (2 * width) + axis[:, moved.get(h, 0)]
                cost[:, w] += gap[:, moved.get(h, 0)] ** 2
        cost[:, 0] = -1.0
        order = np.argsort(cost, axis=1, kind="stable")[:, np.arange(probes) % len(ways)]
        out[:, t] = np.take_along_axis(code, order, 1)
    return out


def pairs_at(cosine: float, dim: int, count: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Random unit vectors and their partners at a cosine; with one dimension each is its own partner."""
    x, y = np.random.default_rng(seed).normal(size=(2, count, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if dim == 1:
        return x, x
    y -= (x * y).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    cosine = min(1.0, max(-1.0, cosine))
    return x, cosine * x + math.sqrt(1 - cosine * cosine) * y


def meetings(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """pairs x tables: whether one row's own bucket is one that the other looks into."""
    return (own[:, :, :1] == other).any(2) | (other[:, :, :1] == own).any(2)


def hashes_for(rows: int, dim: int) -> int:
    """So many that vectors that are unlike rarely share a bucket: about a bucket for 1/dim of a vector."""
    return max(1, math.ceil(math.log(max(rows, 2)) / math.log(2 * max(dim, 2)) + 0.75))


def scheme(dim: int, hashes: int, least: float) -> tuple[int, int]:
    """Hashes a bucket and tables, so that pairs at cosine ``least`` meet with a chance of ``RECALL``.

    The chance that a pair meets in a table is counted on drawn pairs, less two standard errors. Where too many
    tables would be needed a bucket takes fewer hashes; without any, all vectors share one bucket.
    """
    x, y = pairs_at(least, dim, TRIAL_PAIRS)
    for h in range(hashes, 0, -1):
        met = meetings(buckets(x, h), buckets(y, h))
        chance = met.mean() - 2 * math.sqrt(met.mean() * (1 - met.mean()) / met.size)
        if chance >= RECALL:
            return h, TABLES
        tables = math.ceil(math.log(1 - RECALL) / math.log1p(-chance)) if chance > 0 else MANY_TABLES + 1
        if tables <= MANY_TABLES:
            return h, max(TABLES, tables)
    return 0, 1


def units(rows: list) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(1, keepdims=True)  # no overflow of the squares
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def met_before(own: np.ndarray, other: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether pairs of rows (tables x probes) meet in an earlier table, or in a smaller bucket of this one."""
    mine = (own[:, :, :1] == other).any(2)  # the first row's own bucket is one that the second looks into
    theirs = (other[:, :, :1] == own).any(2)
    earlier = (mine | theirs)[:, :table].any(1)
    here = np.minimum(np.where(mine[:, table], own[:, table, 0], np.iinfo(np.int64).max),
                      np.where(theirs[:, table], other[:, table, 0], np.iinfo(np.int64).max))
    return earlier | (here != code)


def block_links(table: int, code: int, blocks: tuple[int, int], block: np.ndarray, node: np.ndarray, copies: np.ndarray,
                found: np.ndarray, x: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(node, a node of its component here, linked rows) of one pair of blocks; each pair of nodes counts in one place."""
    linked = x @ x.T >= least
    resident = found[:, table, 0] == code
    linked &= resident[:, None] | resident[None, :]
    if blocks[0] == blocks[1]:
        np.fill_diagonal(linked, False)
    else:
        linked &= block[:, None] != block[None, :]
    i, j = np.nonzero(np.triu(linked))
    if not len(i):
        return []
    step = max(1, (1 << 22) // found[0].size)
    again = np.concatenate([met_before(found[i[lo:lo + step]], found[j[lo:lo + step]], table, code) for lo in range(0, len(i), step)])
    weight = np.zeros(len(node), np.int64)
    np.add.at(weight, i[~again], copies[j[~again]])
    np.add.at(weight, j[~again], copies[i[~again]])
    out, left = [], linked.any(1)
    while left.any():
        member = np.zeros(len(node), bool)
        frontier = member.copy()
        root = int(np.argmax(left))
        frontier[root] = True
        while frontier.any():
            member |= frontier
            frontier = linked[frontier].any(0) & ~member
        out += [(int(node[m]), int(node[root]), int(weight[m])) for m in np.flatnonzero(member)]
        left &= ~member
    return out


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", least: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows link when found with a cosine of at least ``least``; ``n_links`` counts other rows, ``component_id`` is the
    smallest id reachable, ``kept`` says whether it is the row's own. Null, empty and zero vectors and those with
    null or non-finite components link with nothing, nor do vectors of different length. A row without id is left
    unlinked, its ``component_id`` is null and it is kept. Rows with equal ids are rows like others; further columns
    are left out.
    """
    kind = vectors.schema[vec_id].dataType.simpleString()

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, nodes, kept = batch.column(0), [], []
            for v in batch.column(1).to_pylist():
                x = np.zeros(0) if not v or None in v else np.array(v, np.float64) + 0.0
                good = len(x) and np.isfinite(x).all() and x.any()
                nodes.append(int.from_bytes(hashlib.blake2b(x.tobytes(), digest_size=8).digest(), "little", signed=True) if good else None)
                kept.append(x.tolist() if good else None)
            yield pa.RecordBatch.from_arrays([ids, pa.array(nodes, pa.int64()), pa.array(kept, pa.list_(pa.float64()))], names=["id", "node", "x"])

    rows = stored(vectors.select(F.col(vec_id), F.col(embedding)).mapInArrow(check, f"id {kind}, node long, x array<double>"), "vectors")
    nodes = stored(rows.filter("node IS NOT NULL AND id IS NOT NULL").groupBy("node").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("x").alias("x")), "nodes")
    sizes = nodes.groupBy(F.size("x").alias("dim")).count().collect()  # one row a vector length
    schemes = {r.dim: scheme(r.dim, hashes_for(r["count"], r.dim), least) for r in sizes}
    kept = vectors.schema[embedding].dataType.elementType.simpleString()
    kept = kept if kept == "float" else "double"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x_type = pa.list_(pa.float32() if kept == "float" else pa.float64())
        schema = pa.schema([("dim", pa.int32()), ("node", pa.int64()), ("copies", pa.int64()), ("found", pa.list_(pa.int64())), ("x", x_type)])
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                node, copies, xs = (batch.slice(lo, 1024).column(c).to_pylist() for c in ("node", "copies", "x"))
                for dim in sorted(set(map(len, xs))):
                    chosen = [i for i, x in enumerate(xs) if len(x) == dim]
                    found = buckets(units([xs[i] for i in chosen]), *schemes[dim])
                    out = [(dim, node[i], copies[i], f.ravel().tolist(), xs[i]) for i, f in zip(chosen, found)]
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k.type) for c, k in zip(zip(*out), schema)], names=schema.names)

    if not sizes:
        opened = nodes.select(F.col("node").alias("src"), F.col("node").alias("dst"), F.lit(0).cast("bigint").alias("links"))
    else:
        coded = stored(nodes.mapInArrow(place, f"dim int, node long, copies long, found array<long>, x array<{kept}>"), "codes")
        bucket = ["dim", "at", "code"]
        seen = F.transform("found", lambda code, i: F.struct(F.floor(i / PROBES).cast("int").alias("at"), code.alias("code")))
        placed = coded.select("dim", "node", "found", F.inline(F.array_distinct(seen))).select(
            *bucket, "node", (F.get("found", F.col("at") * PROBES) == F.col("code")).alias("own"))
        counts = placed.groupBy(*bucket).agg(F.count("*").alias("rows"), F.bool_or("own").alias("own")).filter("rows > 1 AND own")
        counts = counts.select(*bucket, F.ceil(F.col("rows") / BLOCK).cast("int").alias("parts"))
        block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
        work = placed.join(counts, bucket).withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        work = work.select(*bucket, F.least("block", "other").alias("a"), F.greatest("block", "other").alias("b"), "block", "node")
        work = work.join(coded.select("node", "copies", "found", "x"), "node").select(*bucket, "a", "b", "block", "node", "copies", "found", "x")
        with rows_a_batch(vectors.sparkSession, WIDE_ROWS):
            opened = stored(_opened(work, least), "links")

    linked = components(opened.select("src", "dst")).join(nodes.select("node", "first_id"), "node")
    least_id = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(least_id, "component").select("node", "component_id")
    links = opened.groupBy(F.col("src").alias("node")).agg(F.sum("links").alias("links"))
    known = nodes.select("node", "first_id", "copies").join(linked, "node", "left").join(links, "node", "left").select(
        "node", F.coalesce("component_id", "first_id").alias("component_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = F.col("id").isNotNull()
    return rows.select("id", "node").join(known, "node", "left").select(
        F.col("id").alias(vec_id), F.when(named, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"),
        F.when(named, F.coalesce("component_id", "id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col(vec_id) == F.col("component_id"), F.lit(True)))


def _opened(work: DataFrame, least: float) -> DataFrame:
    key = ["dim", "at", "code", "a", "b"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> list[tuple]:
            if at is None or len(held) < 2:
                return []
            block, node, copies, found, x = zip(*held)
            return block_links(at[1], at[2], at[3:], np.array(block), np.array(node), np.array(copies),
                               np.array(found).reshape(len(held), -1, PROBES), units(list(x)), least)

        for batch in batches:
            out = []
            keys = list(zip(*[batch.column(c).to_pylist() for c in key]))
            rest = [batch.column(c).to_pylist() for c in ("block", "node", "copies")]
            mixed = len(set(k[0] for k in keys)) > 1
            found, x = (batch.column(c).to_pylist() if mixed else batch.column(c).flatten().to_numpy().reshape(len(keys), -1) for c in ("found", "x"))
            for i, k in enumerate(keys):
                if k != at:
                    out += done()
                    at, held = k, []
                held.append((rest[0][i], rest[1][i], rest[2][i], found[i], x[i]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["src", "dst", "links"])
        if out := done():
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["src", "dst", "links"])

    return work.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "src long, dst long, links long")
