"""Links between the tokens of two vocabularies by interval coalescing.

Both tokenizations cover the same bytes. All tokens of both are sorted by their start, the ends are accumulated to a
running maximum, and a group breaks where a start reaches it: there, tokens of both sides end. Inside a group every
token of one side is linked with every token of the other; single links are never written, a document carries its
distinct pairs of ids with their number. How many documents hold a pair is counted over the whole table, and a
document's links are then weighed by these counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StringType, StructField, StructType

from .common import pieces_by_bytes, rows_a_batch, share, stored, utf8
from .tokens import ByteEncoder, PieceEncoder

#: Bytes of text whose tokens are aligned together, rows with whole texts in an Arrow batch.
CHUNK_BYTES, WIDE_ROWS = 1 << 20, 1000
#: A group with more links is reduced to distinct ids first; so many pairs are spread at once.
LARGE_GROUP, STEP = 1 << 10, 1 << 20
#: Distinct pairs that a counting task holds before it passes them on.
HELD_PAIRS = 1 << 20
#: Pairs with their counts, 17 bytes each, that are broadcast; more are joined by a shuffle. A pair is a number below
#: the product of the two vocabularies, whatever the corpus.
BROADCAST_PAIRS = 1 << 20

MEASURES = [StructField(n, LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
ALIGNED = [*MEASURES, StructField("groups", StringType()), StructField("row", LongType()), StructField("pairs", BinaryType()), StructField("weights", BinaryType())]


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each A token and of each B token; both sides cover the same bytes without gaps."""
    starts = np.concatenate([e - np.diff(e, prepend=0) for e in (a_ends, b_ends)])
    ends = np.concatenate([a_ends, b_ends])
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), np.int64)
    opens[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(opens) - 1
    return group[:len(a_ends)], group[len(a_ends):]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their weights."""
    if not len(keys):
        return keys, weights
    order = np.argsort(keys, kind="stable")
    keys, weights = keys[order], weights[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(weights, first)


def _spread(a: np.ndarray, b: np.ndarray, a_weight: np.ndarray, b_weight: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, times: int):
    """Pairs ``a * times + b`` of all tokens of the same group with the product of their weights; groups count from 0 and are sorted."""
    n_b = np.bincount(b_group, minlength=int(a_group.max(initial=-1)) + 1)
    first = np.cumsum(n_b) - n_b
    each = n_b[a_group]
    at = np.repeat(first[a_group] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    return np.repeat(a * times, each) + b[at], np.repeat(a_weight, each) * b_weight[at]


def linked_pairs(a: np.ndarray, b: np.ndarray, a_group: np.ndarray, b_group: np.ndarray, doc_of: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, pair and number of links, by document and pair; ``doc_of`` names each group's document."""
    size = np.bincount(a_group, minlength=len(doc_of)) * np.bincount(b_group, minlength=len(doc_of))
    span = int(a.max(initial=0) + 1) * times
    keys, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]

    def keep(pairs, numbers, docs) -> None:
        found = _summed(docs * span + pairs, numbers)
        keys.append(found[0])
        weights.append(found[1])
        if sum(map(len, keys)) > 8 * STEP:
            keys[:], weights[:] = ([x] for x in _summed(np.concatenate(keys), np.concatenate(weights)))

    usual = size <= LARGE_GROUP
    small_a, small_b = usual[a_group], usual[b_group]
    number = np.cumsum(usual) - 1
    ones = np.ones(max(len(a), len(b)), np.int64)
    ga, gb = number[a_group[small_a]], number[b_group[small_b]]
    docs = doc_of[usual]
    pairs, numbers = _spread(a[small_a], b[small_b], ones[:len(ga)], ones[:len(gb)], ga, gb, times)
    keep(pairs, numbers, np.repeat(docs, size[usual]))
    for g in np.flatnonzero(~usual):
        (x, xn), (y, yn) = (np.unique(ids[slice(*np.searchsorted(of, (g, g + 1)))], return_counts=True) for ids, of in ((a, a_group), (b, b_group)))
        step = max(1, STEP // len(y))
        for at in range(0, len(x), step):
            part = x[at:at + step]
            keep((part[:, None] * times + y[None, :]).ravel(), (xn[at:at + step, None] * yn[None, :]).ravel(), np.full(len(part) * len(y), doc_of[g]))
    key, weight = _summed(np.concatenate(keys), np.concatenate(weights))
    return key // span, key % span, weight


class Aligner:
    """Both vocabularies, and the alignment of texts by them."""

    def __init__(self, a_path: str, b_path: str):
        self.a, self.b = ByteEncoder(a_path, special=False), PieceEncoder(b_path)
        self.sizes = [np.array([len(p) for p in v.pieces], np.int64) for v in (self.a, self.b)]
        self.times = len(self.b.pieces)
        self.names = np.array([[f"{i}{c}" for i in range(max(map(len, (self.a.pieces, self.b.pieces))))] for c in ",|;"], object)

    def _tokens(self, texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
        """The places of the texts that have tokens, and these."""
        place = [i for i, t in enumerate(texts) if t]
        plain = [texts[i].decode("utf-8", "replace") for i in place]
        found = [], [], []
        for i, x, y in zip(place, self.a.encode([" " + t for t in plain]), self.b.encode(plain)):
            whole = b" " + texts[i]
            if all(b"".join(map(v.pieces.__getitem__, ids.tolist())) == whole for v, ids in ((self.a, x), (self.b, y))):
                for out, value in zip(found, (i, x, y)):
                    out.append(value)
        return found

    def align(self, texts: list[bytes | None]) -> list[tuple]:
        """``n_a, n_b, n_groups, n_links, groups, pairs, weights`` of every text."""
        rows = [(0, 0, 0, 0, "", b"", b"")] * len(texts)
        place, xs, ys = self._tokens(texts)
        if not place:
            return rows
        a, b = (np.concatenate(v).astype(np.int64) for v in (xs, ys))
        n_a, n_b = (np.array([len(x) for x in v]) for v in (xs, ys))
        a_group, b_group = coalesce(np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b]))
        last = a_group[np.cumsum(n_a) - 1]  # of every text
        n_groups = np.diff(last, prepend=-1)
        doc_of = np.repeat(np.arange(len(place)), n_groups)
        links = np.bincount(a_group) * np.bincount(b_group)
        n_links = np.add.reduceat(links, last + 1 - n_groups)
        groups = self._groups(a, b, a_group, b_group, n_a + n_b)
        doc, pair, weight = linked_pairs(a, b, a_group, b_group, doc_of, self.times)
        edge = np.searchsorted(doc, np.arange(len(place) + 1))
        pair, weight = pair.astype("<i8"), weight.astype("<i8")
        for k, i in enumerate(place):
            part = slice(edge[k], edge[k + 1])
            rows[i] = (int(n_a[k]), int(n_b[k]), int(n_groups[k]), int(n_links[k]), groups[k], _narrow(pair[part]), _narrow(weight[part]))
        return rows

    def _groups(self, a, b, a_group, b_group, sizes) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for every text."""
        key = np.concatenate([2 * a_group, 2 * b_group + 1])
        order = np.argsort(key, kind="stable")
        key = key[order]
        mark = np.full(len(key), 2)  # behind the last token of a group
        mark[:-1] = np.where(key[1:] == key[:-1], 0, np.where(key[1:] // 2 == key[:-1] // 2, 1, 2))
        words = self.names[mark, np.concatenate([a, b])[order]].tolist()
        ends = np.cumsum(sizes).tolist()
        return ["".join(words[lo:hi])[:-1] for lo, hi in zip([0, *ends], ends)]


def vocabulary_size(b_path: str) -> int:
    """What ``weigh`` needs to know of B."""
    return len(PieceEncoder(b_path).pieces)


def _narrow(values: np.ndarray) -> bytes:
    """The numbers with one byte before them for their width."""
    kind = next(k for k in (1, 2, 4, 8) if k == 8 or int(values.max(initial=0)) < 1 << 8 * k)
    return bytes([kind]) + values.astype(f"<u{kind}").tobytes()


def _wide(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64) if data else np.zeros(0, np.int64)


def align(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs`` its id, ``n_a, n_b, n_groups, n_links, groups`` and, for ``weigh``, ``row, pairs, weights``.

    A encodes a space and the text by the byte-level vocabulary at ``a_path``, B the text by the piece model at
    ``b_path``, which sets the space itself; strings of special tokens are plain text. ``groups`` lists the ids as
    ``a1,a2|b1;a3|b2,b3``. Null and empty texts, and those whose joined tokens of either side aren't the bytes of the
    space and the text, have no tokens: zeros and an empty string. Repeated rows and rows without id are rows like any
    other; further columns are left out, an empty table gives none. Both files must be readable on every executor.
    """
    schema = StructType([StructField(doc_id, docs.schema[doc_id].dataType), *ALIGNED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = None, TaskContext.get().partitionId() << 33
        for batch in batches:
            aligner = aligner or Aligner(a_path, b_path)
            texts = utf8(batch.column(1))
            for lo, hi in pieces_by_bytes([len(t or "") for t in texts], CHUNK_BYTES):
                found = list(zip(*aligner.align(texts[lo:hi])))
                found.insert(5, range(row, row + hi - lo))
                row += hi - lo
                columns = [pa.array(v, t) for v, t in zip(found, [pa.int64()] * 4 + [pa.large_string(), pa.int64(), pa.binary(), pa.binary()])]
                columns[4] = columns[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names=schema.names)

    return docs.select(doc_id, text).mapInArrow(run, schema)


def pair_counts(aligned: DataFrame, times: int) -> DataFrame:
    """``pair, n, best``: in how many rows a pair is linked, and whether none of its A id's pairs is in more.

    A task sums its own rows first, so a pair that every row holds reaches the shuffle a few times a task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(numbers)], names=["pair", "n"])

        keys = numbers = np.zeros(0, np.int64)
        for batch in batches:
            for lo, hi in pieces_by_bytes([len(p) for p in batch.column(0).to_pylist()], 4 * HELD_PAIRS):
                new = [_wide(p) for p in batch.column(0).slice(lo, hi - lo).to_pylist()]
                keys = np.concatenate([keys, *new])
                keys, numbers = _summed(keys, np.concatenate([numbers, np.ones(len(keys) - len(numbers), np.int64)]))
                if len(keys) > HELD_PAIRS:
                    yield out()
                    keys = numbers = np.zeros(0, np.int64)
        if len(keys):
            yield out()

    seen = stored(aligned.select("pairs").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    a_id = F.floor(F.col("pair") / F.lit(times))
    most = seen.groupBy(a_id.alias("a_id")).agg(F.max("n").alias("most"))
    return seen.withColumn("a_id", a_id).join(most, "a_id").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh(aligned: DataFrame, times: int, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """The rows of ``align`` with ``n_best`` and ``count_sum`` in place of ``row, pairs, weights``.

    A pair counts in how many rows it is linked, repeated rows each; ``count_sum`` adds that up over a row's links and
    ``n_best`` counts the links whose pair no other pair of the same A id exceeds. ``times`` is the size of B's vocabulary.
    """
    spark = aligned.sparkSession
    with rows_a_batch(spark, WIDE_ROWS):
        written = stored(aligned, "aligned")
        counted = stored(pair_counts(written, times), "pair-counts")
    kept = [f for f in written.schema if f.name not in ("row", "pairs", "weights")]
    schema = StructType([*kept, StructField("n_best", LongType()), StructField("count_sum", LongType())])
    if counted.count() > broadcast_pairs:
        return _joined(written, counted, schema)
    table = counted.orderBy("pair").toArrow()
    known = share(spark, [np.asarray(table[c]) for c in ("pair", "n", "best")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known()
        for batch in batches:
            sums = []
            for p, w in zip(*(batch.column(c).to_pylist() for c in ("pairs", "weights"))):
                at, weight = np.searchsorted(pair, _wide(p)), _wide(w)
                sums.append((int(weight[best[at]].sum()), int((weight * n[at]).sum())))
            columns = [batch.column(f.name) for f in kept] + [pa.array([s[i] for s in sums], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return written.mapInArrow(run, schema)


def _joined(written: DataFrame, counted: DataFrame, schema: StructType) -> DataFrame:
    """The same by a shuffle on the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, pairs, weights = (batch.column(i).to_pylist() for i in range(3))
            for lo, hi in pieces_by_bytes([len(p) for p in pairs], CHUNK_BYTES):
                wide = [_wide(p) for p in pairs[lo:hi]]
                rows = np.repeat(np.array(row[lo:hi], np.int64), [len(p) for p in wide])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (rows, np.concatenate(wide), np.concatenate([_wide(w) for w in weights[lo:hi]]))], names=["row", "pair", "weight"])

    links = written.select("row", "pairs", "weights").mapInArrow(run, "row long, pair long, weight long")
    sums = links.join(counted, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("weight")).otherwise(0)).alias("sum_best"), F.sum(F.col("weight") * F.col("n")).alias("sum_count"))
    rows = written.drop("pairs", "weights").join(sums.withColumnRenamed("row", "sum_row"), F.col("row") == F.col("sum_row"), "left")
    return rows.select(*schema.names[:-2], F.coalesce("sum_best", F.lit(0)).alias("n_best"), F.coalesce("sum_count", F.lit(0)).alias("count_sum"))
