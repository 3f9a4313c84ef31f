"""Exact self-join of word shingle sets by Jaccard similarity, with a token-group matrix.

Sets are grouped by likeness: of its four min-hash bands a set takes the one that most others have, and a large
band is cut into groups of bounded size. The matrix holds, for every token, the groups whose union of signature
tokens has it. A signature is the first tokens of a set in one global order, frequent tokens last, and so long that
two sets of the asked similarity share a known number of them; that number bounds the overlap of a group's sets
with another group, and only pairs of groups that reach it, and whose set sizes fit, are opened and compared.

Equal sets are one node. An opened pair yields the spanning links and link counts of at most two groups, never
single pairs, so groups of many copies cost no quadratic output.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, lean, rows_a_batch, share, small, stored
from .components import components

CHUNK_BYTES = 1 << 19
#: The token order is taken from a sample: this share of all documents and so many at least, and the tokens seen
#: twice or more, so many at most. It steers speed only; the result doesn't depend on it.
ORDER_SHARE, ORDER_SAMPLE, ORDER_COUNT, ORDER_TOKENS = 0.04, 10_000, 2, 1 << 17
CELL_BITS = 22
BANDS, BAND_ROWS = 4, 5
#: A group holds about so many sets and so many tokens at most.
GROUP_SETS, GROUP_TOKENS = 512, 1 << 18
#: Pairs of groups in an Arrow batch.
OPENED_PAIRS = 4
#: Distinct pairs of token and group that a matrix task holds before it compacts them.
MATRIX_ROWS = 1 << 20
#: Rows with whole texts or sets in an Arrow batch, and tokens that a step of the min-hashes looks at.
WIDE_ROWS, HASH_STEP = 1000, 1 << 15
COLUMNS = 1 << 14

ODD = np.uint64(0x9E3779B97F4A7C15)
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of the word n-grams of whole texts."""

    BASE = 0x2545F4914F6CDD1D | 1

    def __init__(self, width: int):
        self.width = width
        self.values = mix(np.arange(1, 257, dtype=np.uint64) * ODD) | np.uint64(1)
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sets(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """A-Z count as a-z; words stand between ASCII white space; a shorter text is one shingle."""
        data = b"\n".join(texts).lower() + b"\n"
        buf = np.frombuffer(data, np.uint8)
        edge = np.diff(SPACE[buf].astype(np.int8), prepend=1)
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._grow(len(buf))
        total = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(self.values[buf] * self.power[:len(buf)], out=total[1:])
        word = mix((total[ends] - total[starts]) * self.inverse[starts])
        k = self.width
        rows = max(0, len(word) - k + 1)
        gram = word[:rows].copy()
        for j in range(1, k):
            gram = gram * ODD + word[j:rows + j]
        gram = mix(gram)
        first = np.searchsorted(starts, np.cumsum([0] + [len(t) + 1 for t in texts])).tolist()
        for a, b in zip(first, first[1:]):
            if b - a >= k:
                s = np.sort(gram[a:b - k + 1])
                yield s[np.concatenate(([True], s[1:] != s[:-1]))]
            elif b > a:
                whole = np.array([b - a], np.uint64)
                for w in word[a:b]:
                    whole = whole * ODD + w
                yield mix(whole)
            else:
                yield np.zeros(0, np.uint64)


def needed(n: int, percent: int) -> int:
    """Tokens that a set of n shares at least with any set that is similar enough."""
    return -(-percent * n // 100)


def shared(n: int) -> int:
    """Signature tokens that two similar sets have in common at least, by the smaller of these numbers."""
    return 1 + n // 48


def node_of(s: np.ndarray) -> int:
    """The number of a set; equal sets have equal numbers."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


class Signer:
    """Node, bands and signature of a set."""

    def __init__(self, percent: int, order: np.ndarray):
        self.percent, self.order = percent, order
        self.factors = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)) | np.uint64(1)

    def sign(self, s: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
        node = node_of(s)
        low = (s[:HASH_STEP, None] * self.factors).min(0)
        for lo in range(HASH_STEP, len(s), HASH_STEP):
            low = np.minimum(low, (s[lo:lo + HASH_STEP, None] * self.factors).min(0))
        low = low.reshape(BANDS, BAND_ROWS)
        # sets of like size only: the size counts as its power of the inverse similarity
        band = np.arange(BANDS, dtype=np.uint64) + np.uint64(BANDS * int(math.log(len(s)) / -math.log(self.percent / 101)))
        for j in range(BAND_ROWS):
            band = mix(band * ODD + low[:, j])
        n = len(s)
        size = min(n, n - needed(n, self.percent) + min(shared(n), needed(n, self.percent)))
        rank = self.order[(s >> np.uint64(64 - CELL_BITS)).astype(np.int64)]
        if rank.any():
            s = s[np.argsort(rank, kind="stable")[:size]]
        return node, band.view(np.int64), s[:size].view(np.int64)


def _parts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        yield from chunks(batch, column, CHUNK_BYTES)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays) if arrays else np.zeros(0, np.int64)))


def token_order(texts: DataFrame, width: int) -> np.ndarray:
    """Rank 0 for rare tokens, more for those that a bounded sample of documents shows often, by cell of the hash."""
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for _, part in _parts(batches, 0):
            for s in shingler.sets(part):
                yield pa.RecordBatch.from_arrays([pa.array(s.view(np.int64))], names=["token"])

    order = np.zeros(1 << CELL_BITS, np.uint8)
    share_of = min(1.0, max(ORDER_SHARE, ORDER_SAMPLE / max(1, texts.count())))
    found = texts.sample(share_of, seed=7).mapInArrow(lean(tokens), "token long").groupBy("token").count().filter(F.col("count") >= ORDER_COUNT)
    found = found.orderBy(F.desc("count"), "token").limit(ORDER_TOKENS).toArrow()
    cell = found["token"].to_numpy().view(np.uint64) >> np.uint64(64 - CELL_BITS)
    np.maximum.at(order, cell.astype(np.int64), (1 + np.log2(found["count"].to_numpy())).astype(np.uint8))
    return order


def _signed(texts: DataFrame, width: int, percent: int) -> DataFrame:
    signer = share(texts.sparkSession, Signer(percent, token_order(texts.select("text"), width)))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shingler = signer(), Shingler(width)
        for rows, part in _parts(batches, 2):
            sets = list(shingler.sets(part))
            full = [own.sign(s) if len(s) else (None, np.zeros(0, np.int64), np.zeros(0, np.int64)) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array([f[0] for f in full], pa.int64()),
                 _lists([f[1] for f in full]), _lists([f[2] for f in full])],
                names=["id", "mark", "n", "node", "bands", "signature"])

    schema = f"id {texts.schema['id'].dataType.simpleString()}, mark long, n long, node long, bands array<long>, signature array<long>"
    return texts.mapInArrow(lean(sign), schema)


def _matrix(postings: DataFrame) -> DataFrame:
    """Token and group of the tokens that two groups have at least."""
    def compact(token: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((group, token))
        token, group = token[order], group[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (group[1:] != group[:-1])
        return token[new], group[new]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            parts.append((batch.column(0).to_numpy(), batch.column(1).to_numpy()))
            held += batch.num_rows
            if held > MATRIX_ROWS:
                parts = [compact(*map(np.concatenate, zip(*parts)))]
                held = len(parts[0][0]) // 2  # room for as much again, so that compacting stays in proportion
        if parts:
            token, group = compact(*map(np.concatenate, zip(*parts)))
            again = token[1:] == token[:-1]
            several = np.concatenate((again, [False])) | np.concatenate(([False], again))
            token, group = token[several], group[several]
            for lo in range(0, len(token), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(token[lo:lo + (1 << 16)]), pa.array(group[lo:lo + (1 << 16)])], names=["token", "group"])

    return postings.repartition("token").mapInArrow(lean(run), "token long, group long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of one opened pair."""
    n = len(sets)
    if n == 2:
        both = np.sort(np.concatenate(sets))
        common = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), common], [common, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    kept = count > 1
    number = np.cumsum(kept) - 1
    owner, column = owner[kept[column]], number[column[kept[column]]]
    out = np.zeros((n, n), np.float64)
    for lo in range(0, int(kept.sum()), COLUMNS):
        here = (column >= lo) & (column < lo + COLUMNS)
        block = np.zeros((n, COLUMNS), np.float32)
        block[owner[here], column[here] - lo] = 1
        out += block @ block.T
    return out.astype(np.int64)


def open_pair(sides: list[int], nodes: list[int], copies: list[int], sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int, int]]:
    """(node, a node it hangs together with, linked documents of other nodes) for the nodes that have a link."""
    sizes, side = np.array([len(s) for s in sets]), np.array(sides)
    linked = (100 + percent) * overlaps(sets) >= percent * (sizes[:, None] + sizes[None, :])
    linked &= (side[:, None] != side[None, :]) if side.any() else ~np.eye(len(side), dtype=bool)
    weight = linked @ np.array(copies)
    left = linked.any(1)
    while left.any():
        root = int(np.argmax(left))
        member = np.zeros(len(left), bool)
        frontier = member.copy()
        frontier[root] = True
        while frontier.any():
            member |= frontier
            frontier = linked[frontier].any(0) & ~member
        for i in np.flatnonzero(member).tolist():
            yield nodes[i], nodes[root], int(weight[i])
        left &= ~member


def _tile(column: pa.ListArray, row: int) -> tuple[list[int], list[int], list[np.ndarray]]:
    """Nodes, copies and sets of one group."""
    lo, hi = column.offsets[row].as_py(), column.offsets[row + 1].as_py()
    held = column.values
    node, copies, tokens = (held.field(i) for i in range(3))
    offsets, values = tokens.offsets.to_numpy(), tokens.values.to_numpy().view(np.uint64)
    return node.to_numpy()[lo:hi].tolist(), copies.to_numpy()[lo:hi].tolist(), [values[offsets[i]:offsets[i + 1]] for i in range(lo, hi)]


def _opened(pairs: DataFrame, percent: int) -> DataFrame:
    """The links of pairs of groups: ``a, b``, each an array of node, copies and tokens; without ``b`` those inside ``a``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [_tile(batch.column(i), row) for i in range(2) if batch.column(i)[row].is_valid]
                nodes, copies, sets = ([x for side in sides for x in side[i]] for i in range(3))
                found = list(open_pair([k for k, side in enumerate(sides) for _ in side[0]], nodes, copies, sets, percent))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*found)], names=["src", "dst", "links"])

    return pairs.select("a", "b").mapInArrow(lean(run), "src long, dst long, links long")


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id, n_links`` for every row of ``docs``.

    Two documents link when ``100 * intersection >= percent * union`` of their sets of distinct word n-grams; a text
    of fewer words is one shingle. ``component_id`` is the smallest id reachable by links, ``n_links`` the number of
    other rows linked directly, ``mark`` a hash of the text. Null texts and texts without words have no shingles and
    no links. A row without id is left unlinked and its ``component_id`` is null. Rows with equal ids are rows like
    others. Further columns are left out.
    """
    signed = signatures(docs, doc_id, text, width, percent)
    return classes(docs, signed, doc_id, text, width, percent).drop("class")


def signatures(docs: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """A written table of ``id, mark`` (hash of the text)``, n, node, bands, signature`` for every row."""
    texts = docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    with rows_a_batch(docs.sparkSession, WIDE_ROWS):
        return stored(_signed(texts, width, percent), "signatures")


def classes(docs: DataFrame, signed: DataFrame, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """``doc_id, mark, n_shingles, component_id, n_links`` and the class's number for every signed row."""
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    sets = signed.filter("node IS NOT NULL AND id IS NOT NULL")
    nodes = stored(sets.groupBy("node").agg(
        F.min("id").alias("first_id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")

    # groups of like sets, cut to a bounded size
    bands = nodes.select("node", "n", F.explode("bands").alias("band"))
    common = bands.groupBy("band").agg(F.count("*").alias("sets"), F.sum("n").alias("tokens")).filter("sets > 1")
    best = bands.join(common, "band").groupBy("node").agg(F.max(F.struct("sets", "band", "tokens")).alias("best"))
    parts = F.greatest(F.ceil(F.col("best.sets") / GROUP_SETS), F.ceil(F.col("best.tokens") / GROUP_TOKENS))
    grouped = best.select("node", F.xxhash64("best.band", F.pmod(F.xxhash64("node"), parts)).alias("own"))
    grouped = stored(nodes.select("node", "first_id", "copies", "n").join(grouped, "node", "left").select(
        "node", "first_id", "copies", "n", F.coalesce("own", "node").alias("group")), "groups")

    # the matrix, and the pairs of groups that may hold a link
    one_each = sets.select("node", "id", "signature").join(grouped.select("node", "first_id", "group"), "node").filter("id = first_id")
    bounds = grouped.groupBy("group").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("sets"), F.min(F.expr(f"least(1 + n div 48, ({percent} * n + 99) div 100)")).alias("need"))
    matrix = _matrix(one_each.select(F.explode("signature").alias("token"), "group"))
    matrix = stored(matrix.join(bounds, "group").select("token", "group", "lo", "hi", "need"), "matrix")
    a, b = matrix.toDF("token", "g", "g_lo", "g_hi", "g_need"), matrix.toDF("token", "h", "h_lo", "h_hi", "h_need")
    fits = (F.col("g") < F.col("h")) & (F.col("g_hi") * 100 >= F.col("h_lo") * percent) & (F.col("h_hi") * 100 >= F.col("g_lo") * percent)
    met = a.join(b, (a["token"] == b["token"]) & fits).groupBy("g", "h").agg(
        F.count("*").alias("met"), F.min(F.least("g_need", "h_need")).alias("need"))
    pairs = stored(met.filter("met >= need").select("g", "h").union(bounds.filter("sets > 1").select("group", "group")), "pairs")

    # the sets of the groups to open, from their texts; a group travels as one row
    opened_groups = pairs.select(F.explode(F.array("g", "h")).alias("group")).distinct()
    members = stored(grouped.join(opened_groups, "group", "left_semi").select("group", "node", "copies", "first_id"), "members")
    wanted = members.select(F.col("first_id").alias("id")).distinct()

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for _, part in _parts(batches, 0):
            sets = [s for s in shingler.sets(part) if len(s)]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node_of(s) for s in sets], pa.int64()), _lists([s.view(np.int64) for s in sets])], names=["node", "tokens"])

    full = texts.join(small(stored(wanted, "wanted")), "id", "left_semi").select("text").mapInArrow(lean(tokens), "node long, tokens array<long>")
    # an id of several rows may bring a set more than once
    one_set = full.groupBy("node").agg(F.first("tokens").alias("tokens"))
    tiles = members.join(one_set, "node").groupBy("group").agg(F.collect_list(F.struct("node", "copies", "tokens")).alias("sets"))
    with rows_a_batch(docs.sparkSession, WIDE_ROWS):
        tiles = stored(tiles, "tiles")
    with rows_a_batch(docs.sparkSession, OPENED_PAIRS):
        a, b = tiles.select(F.col("group").alias("g"), F.col("sets").alias("a")), tiles.select(F.col("group").alias("h"), F.col("sets").alias("b"))
        within = a.filter(F.size("a") > 1).select("a", F.lit(None).cast(b.schema["b"].dataType).alias("b"))
        between = pairs.filter("g <> h").join(a, "g").join(b, "h").select("a", "b")
        opened = stored(_opened(within.union(between), percent), "opened")

    # components, and everything back to the rows
    linked = components(opened.select("src", "dst"))
    linked = linked.join(grouped.select("node", "first_id"), "node")
    least = linked.groupBy("component").agg(F.min("first_id").alias("component_id"))
    linked = linked.join(least, "component").select("node", "component_id", "component")
    counts = opened.groupBy(F.col("src").alias("node")).agg(F.sum("links").alias("links"))
    result = grouped.select("node", "first_id", "copies").join(linked, "node", "left").join(counts, "node", "left").select(
        "node", F.coalesce("component_id", "first_id").alias("component_id"), F.coalesce("component", "node").alias("class"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return signed.select("id", "mark", "n", "node").join(result, "node", "left").select(
        F.col("id").alias(doc_id), "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"),
        F.when(F.col("id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(0).cast("bigint").alias("n_links"), "class")


def first_of_class(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One document of each class of similar documents, the one with the smallest id, with all its columns.

    Of a class's rows with equal smallest ids and different texts one stays, and of rows with equal id and text one,
    any of them. Rows without id and rows without words stay. Columns of ``docs`` may have any names.
    """
    signed = signatures(docs, doc_id, text, width, percent)
    found = stored(classes(docs, signed, doc_id, text, width, percent).filter("class IS NOT NULL AND component_id IS NOT NULL").select(
        F.col(doc_id).alias("gone"), F.col("mark").alias("gone_mark"), "class", (F.col(doc_id) == F.col("component_id")).alias("first")), "found")
    # a class has one row with its smallest id, or a few
    heads = found.filter("first").groupBy("class").agg(F.min("gone_mark").alias("head"), F.max("gone_mark").alias("last")).filter("head <> last")
    others = found.filter("first").join(heads, "class").filter("gone_mark <> head")
    gone = found.filter("NOT first").select("gone", "gone_mark").union(others.select("gone", "gone_mark"))
    gone = small(stored(gone.distinct(), "gone"))
    again = signed.filter("id IS NOT NULL AND n > 0").groupBy("id", "mark").count().filter("count > 1")
    rows = docs.select(F.struct("*").alias("row"))
    own, mark = F.col("row")[doc_id], F.xxhash64(F.col("row")[text])
    kept = rows.join(gone, (own == F.col("gone")) & (mark == F.col("gone_mark")), "left_anti")
    if again.isEmpty():
        return kept.select("row.*")
    match = (own == F.col("again")) & (mark == F.col("again_mark"))
    again = stored(again.select(F.col("id").alias("again"), F.col("mark").alias("again_mark")), "again")
    twice = kept.join(again, match, "left_semi").withColumns({"own": own, "mark": mark}).dropDuplicates(["own", "mark"]).select("row")
    return kept.join(again, match, "left_anti").union(twice).select("row.*")
