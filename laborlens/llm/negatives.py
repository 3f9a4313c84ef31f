"""Hard negatives of anchor vectors from exact integer inner products.

Rows are packed into tiles of whole numbers. Every anchor tile meets every candidate tile once a pass, their scores
come from Strassen's recursive multiplication on int64 with zero padding, and bounded heaps keep what counts: first the
best rows of the anchor's label, then, for each of these, the best rows of other labels inside its score window. Heaps
of different tasks are merged by a ranking on the anchor. Sums and products are exact modulo 2**64, so scores are exact
wherever they fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from .common import rows_a_batch, stored

#: Rows of a tile at most, and bytes of its numbers.
ANCHOR_ROWS, CANDIDATE_ROWS, TILE_BYTES = 512, 2048, 1 << 20
#: Bytes of anchor tiles that are broadcast for one pass over the candidates, as counted before; more take more passes.
BLOCK_BYTES = 32 << 20
#: Pairs of tiles that a task should have, and pairs in one Arrow batch.
TASK_PAIRS, BATCH_PAIRS = 256, 8
#: A side of this length or less ends the recursion.
LEAF = 32
LEAST, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

TILE = StructType([
    StructField("tile", LongType()), StructField("width", IntegerType()), StructField("kind", StringType()),
    StructField("ids", BinaryType()), StructField("labels", BinaryType()), StructField("numbers", BinaryType()),
])
FOUND = StructType([StructField(n, LongType()) for n in ("tile", "row", "slot", "anchor_id", "positive_id", "positive_score", "id", "score")])


def leaf_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two small int64 matrices; doubles serve where every sum is a whole number below 2**53."""
    high = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
    if high[0] * high[1] * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def _padded(x: np.ndarray, rows: int, columns: int) -> np.ndarray:
    if x.shape == (rows, columns):
        return x
    out = np.zeros((rows, columns), np.int64)
    out[:x.shape[0], :x.shape[1]] = x
    return out


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """``a @ b`` on int64 by seven half-size products a level; sides are padded with zeros so that every level halves them."""
    rows, inner, columns = a.shape[0], a.shape[1], b.shape[1]
    levels, side = 0, min(rows, inner, columns)
    while side > leaf:
        side, levels = (side + 1) // 2, levels + 1
    if not levels:
        return leaf_product(a, b)
    m, k, n = (-(-x >> levels) << levels for x in (rows, inner, columns))
    return _multiply(_padded(a, m, k), _padded(b, k, n), levels)[:rows, :columns]


def _multiply(a: np.ndarray, b: np.ndarray, levels: int) -> np.ndarray:
    if not levels:
        return leaf_product(a, b)
    m, k, n = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:m, :k], a[:m, k:], a[m:, :k], a[m:, k:]
    b11, b12, b21, b22 = b[:k, :n], b[:k, n:], b[k:, :n], b[k:, n:]
    low = levels - 1
    both = _multiply(a11 + a22, b11 + b22, low)
    left = _multiply(a21 + a22, b11, low)
    right = _multiply(a11, b12 - b22, low)
    down = _multiply(a22, b21 - b11, low)
    over = _multiply(a11 + a12, b22, low)
    out = np.empty((2 * m, 2 * n), np.int64)
    out[:m, :n] = both + down - over + _multiply(a12 - a22, b21 + b22, low)
    out[:m, n:] = right + over
    out[m:, :n] = left + down
    out[m:, n:] = both - left + right + _multiply(a21 - a11, b11 + b12, low)
    return out


class Heaps:
    """The best ``size`` entries of every slot by score, then by smaller id; two of them merge into one of the same kind."""

    def __init__(self, slots: int, size: int):
        self.slots, self.size = slots, size
        self.slot = self.score = self.id = np.zeros(0, np.int64)
        self.least = np.full(slots, LEAST)  # a full slot takes only what comes before this entry
        self.last = np.full(slots, MOST)

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        slot, score, ids = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.id, ids)))
        # ~score turns the order around without overflow
        order = np.lexsort((ids, ~score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, np.arange(self.slots))
        rank = np.arange(len(slot)) - first[slot]
        kept = rank < self.size
        self.slot, self.score, self.id = slot[kept], score[kept], ids[kept]
        full = kept & (rank == self.size - 1)
        self.least[slot[full]], self.last[slot[full]] = score[full], ids[full]

    def merge(self, other: "Heaps") -> None:
        self.add(other.slot, other.score, other.id)

    def offer(self, slots: np.ndarray, scores: np.ndarray, allowed: np.ndarray, ids: np.ndarray) -> None:
        """Take a matrix of scores, one row a slot and one column an id, where it is allowed."""
        least, last = self.least[slots][:, None], self.last[slots][:, None]
        better = allowed & ((scores > least) | ((scores == least) & (ids[None, :] < last)))
        if np.count_nonzero(better) > 8 * self.size * len(slots) and scores.shape[1] > self.size:
            part = np.partition(np.where(better, scores, LEAST), -self.size, axis=1)
            better &= scores >= part[:, -self.size][:, None]
        row, column = np.nonzero(better)
        self.add(slots[row], scores[row, column], ids[column])


def _dense(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The vectors that are whole and finite as rows padded with zeros, and their places."""
    lists = column.cast(pa.list_(pa.float64()))
    sizes = np.asarray(lists.value_lengths().fill_null(0))
    flat = lists.flatten()
    values = np.asarray(flat.fill_null(np.nan))
    row = np.repeat(np.arange(len(sizes)), sizes)
    good = np.asarray(lists.is_valid())
    good[row[~np.isfinite(values)]] = False
    out = np.zeros((len(sizes), int(sizes.max(initial=0))))
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out[good], np.flatnonzero(good)


def _tiles(rows: DataFrame, scale: int, most: int) -> DataFrame:
    """Tiles of the rows ``id, label, vector``, packed inside each partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << 32, 0
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            nonlocal made
            width = max(n.shape[1] for _, _, n in held)
            numbers = np.concatenate([_padded(n, len(n), width) for _, _, n in held])
            high = max(int(numbers.max(initial=0)), -int(numbers.min(initial=0)))
            kind = next(k for k in ("<i2", "<i4", "<i8") if high <= np.iinfo(k).max or k == "<i8")
            ids, labels = (np.concatenate([h[i] for h in held]) for i in (0, 1))
            row = [[base + made], [width], [kind], [ids.tobytes()], [labels.tobytes()], [numbers.astype(kind).tobytes()]]
            made += 1
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary()))], names=TILE.names)

        for batch in batches:
            dense, places = _dense(batch.column(2))
            ids, labels = (np.asarray(batch.column(i).cast(pa.int64()), "<i8")[places] for i in (0, 1))
            numbers = np.clip(np.floor(dense * scale), float(LEAST), float(MOST - 1023)).astype(np.int64)
            step = max(1, min(most, TILE_BYTES // (8 * max(1, dense.shape[1]))))
            at = 0
            while at < len(ids):
                room = step - sum(len(h[0]) for h in held)
                if room <= 0:
                    yield out()
                    continue
                held.append((ids[at:at + room], labels[at:at + room], numbers[at:at + room]))
                at += room
        if held:
            yield out()

    return rows.mapInArrow(run, TILE)


class _Tile:
    def __init__(self, row: dict, side: str):
        self.ids, self.labels = (np.frombuffer(row[f"{side}_{n}"], "<i8").astype(np.int64) for n in ("ids", "labels"))
        self.numbers = np.frombuffer(row[f"{side}_numbers"], row[f"{side}_kind"]).reshape(len(self.ids), row[f"{side}_width"]).astype(np.int64)


def _scores(a: _Tile, c: _Tile) -> np.ndarray:
    width = max(a.numbers.shape[1], c.numbers.shape[1])
    return strassen(_padded(a.numbers, len(a.ids), width), np.ascontiguousarray(_padded(c.numbers, len(c.ids), width).T))


class Positives:
    """For one anchor tile, the best other rows of each anchor's label."""

    def __init__(self, anchors: _Tile, size: int):
        self.anchors, self.heaps = anchors, Heaps(len(anchors.ids), size)

    def take(self, candidates: _Tile) -> None:
        a, c = self.anchors, candidates
        other = (a.labels[:, None] == c.labels[None, :]) & (a.ids[:, None] != c.ids[None, :])
        if other.any():
            self.heaps.offer(np.arange(len(a.ids)), _scores(a, c), other, c.ids)

    def rows(self) -> tuple[np.ndarray, ...]:
        h, none = self.heaps, np.zeros(len(self.heaps.slot), np.int64)
        return h.slot, none, self.anchors.ids[h.slot], none, none, h.id, h.score


class Negatives:
    """For one anchor tile and its positives ``row, slot, id, score``, the best rows of other labels in each one's window."""

    def __init__(self, anchors: _Tile, positives: list[dict], size: int, low: int, high: int):
        self.anchors, self.positives = anchors, positives
        self.heaps = Heaps(len(positives), size)
        bound = lambda x: min(max(x, int(LEAST)), int(MOST))
        windows = [(p["row"], bound(-(-low * p["score"] // 100)), bound(high * p["score"] // 100)) for p in positives]
        self.row, self.low, self.high = np.array(windows, np.int64).reshape(-1, 3).T
        # the n-th positive of every anchor together: each group looks at an anchor's scores once
        nth = np.array([p["slot"] for p in positives], np.int64)
        self.groups = [np.flatnonzero((nth == n) & (self.low <= self.high)) for n in np.unique(nth)]

    def take(self, candidates: _Tile) -> None:
        a, c = self.anchors, candidates
        other = a.labels[:, None] != c.labels[None, :]
        if not other.any():
            return
        scores = _scores(a, c)
        for slots in self.groups:
            rows = self.row[slots]
            s = scores[rows]
            self.heaps.offer(slots, s, other[rows] & (s >= self.low[slots][:, None]) & (s <= self.high[slots][:, None]), c.ids)

    def rows(self) -> tuple[np.ndarray, ...]:
        h = self.heaps
        slot, ids, scores = (np.array([p[k] for p in self.positives], np.int64)[h.slot] for k in ("slot", "id", "score"))
        return self.row[h.slot], slot, self.anchors.ids[self.row[h.slot]], ids, scores, h.id, h.score


def _searched(candidates: DataFrame, anchors: DataFrame, block: int, make) -> DataFrame:
    """What the searches that ``make(anchor tile, its row)`` begins find in all candidate tiles, by task."""
    left = candidates.select(F.explode(F.array(F.lit(block))).alias("block"), *(F.col(c).alias(f"c_{c}") for c in TILE.names))
    right = anchors.filter(F.col("block") == block).withColumnsRenamed({c: f"a_{c}" for c in TILE.names})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = {}
        for batch in batches:
            last = None
            for row in batch.to_pylist():
                if row["a_tile"] not in searches:
                    searches[row["a_tile"]] = make(_Tile(row, "a"), row)
                if last is None or last[0] != row["c_tile"]:
                    last = row["c_tile"], _Tile(row, "c")
                searches[row["a_tile"]].take(last[1])
        for tile, search in searches.items():
            columns = search.rows()
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(c, len(columns[0])), pa.int64()) for c in (np.int64(tile), *columns)], names=FOUND.names)

    # bounded by BLOCK_BYTES, as counted in hard_negatives
    return left.join(F.broadcast(right), "block").drop("block").mapInArrow(run, FOUND)


def _best(found: DataFrame, size: int) -> DataFrame:
    """The heaps of all tasks merged; a task has ``size`` entries a slot at most."""
    one = Window.partitionBy("tile", "row", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(one)).filter(F.col("rank") <= size)


def _blocks(tiles: DataFrame, parts: int, limit: int) -> tuple[DataFrame, int]:
    """The tiles numbered by block, each of ``limit`` bytes or of one partition's tiles; the number of blocks."""
    part, size = F.shiftright("tile", 32), F.sum(F.octet_length("numbers") + F.octet_length("ids") + F.octet_length("labels"))
    together = parts
    while True:
        block = F.floor(part / F.lit(together)).cast("int")
        if together == 1 or (tiles.groupBy(block).agg(size.alias("s")).agg(F.max("s")).first()[0] or 0) <= limit:
            return tiles.withColumn("block", block), -(-parts // together)
        together = -(-together // 2)


def hard_negatives(rows: DataFrame, anchors: Column, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding",
                   positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchors`` holds for.

    A component counts as ``floor(scale * x)`` with x in double precision, a score is the inner product. An anchor's
    positives are its first other rows of the same label, a positive's negatives the first rows of other labels whose
    score lies between ``low`` and ``high`` hundredths of the positive's; higher scores come first, ties by smaller id.

    Rows with a null id, label or vector and those with a null or non-finite component take no part. The shorter of
    two vectors counts as filled up with zeros. Repeated rows count as often as they stand; a row with the anchor's id
    is no positive of it, and a repeated anchor has its results as often. Labels are whole numbers. Components beyond
    2**63 after scaling stand at that limit and scores are taken modulo 2**64. Further columns aren't looked at; an
    empty table, one without anchors and one of a single label give no rows.
    """
    spark = rows.sparkSession
    narrow = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), F.col(vector).alias("vector"), anchors.alias("anchor")).dropna(subset=["id", "label", "vector"])
    asked = narrow.filter("anchor").drop("anchor")
    parts = max(1, -(-asked.count() // ANCHOR_ROWS))
    with rows_a_batch(spark, CANDIDATE_ROWS):
        packed, blocks = _blocks(stored(_tiles(asked.repartition(parts), scale, ANCHOR_ROWS), "anchor-tiles"), parts, block_bytes)
        candidates = stored(_tiles(narrow.drop("anchor"), scale, CANDIDATE_ROWS), "candidate-tiles")
    n_candidates, n_anchors = candidates.count(), -(-packed.count() // blocks)
    tasks = max(-(-n_candidates * n_anchors // TASK_PAIRS), 2 * spark.sparkContext.defaultParallelism)
    candidates = candidates.repartition(max(1, min(n_candidates, tasks)))
    found = []
    with rows_a_batch(spark, BATCH_PAIRS):
        for block in range(blocks):
            first = _searched(candidates, packed, block, lambda tile, row: Positives(tile, positives))
            first = stored(_best(first, positives), f"positives-{block}")
            wanted = first.groupBy("tile").agg(F.collect_list(F.struct("row", (F.col("rank") - 1).cast("bigint").alias("slot"), "id", "score")).alias("positives"))
            second = _searched(candidates, packed.join(wanted, "tile"), block, lambda tile, row: Negatives(tile, row["positives"], negatives, low, high))
            found.append(stored(_best(second, negatives), f"negatives-{block}"))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
