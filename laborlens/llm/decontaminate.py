"""Benchmark decontamination by Wu-Manber search for many word windows at once.

Texts become words joined by single spaces, windows of benchmark words become byte patterns with a space on
either side. A shift table, indexed by a hash of the last block of bytes below the search window, tells how far
the window may move without missing a pattern; where it may not move, the bucket of that suffix hash names the
patterns to compare directly. Thousands of places of the joined texts are advanced together with numpy.

Rows are never shuffled: the pattern tables are broadcast, in blocks of at most ``block_words`` words of items. A task
with several blocks gathers some rows and searches them block by block, with one block in memory at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .common import WORD_BYTES, lean, numbered, other_columns, pieces_by_bytes, share, utf8, widened

WINDOW = 10
CHUNK_BYTES = 2 << 20
#: Words of items whose windows are searched for together, and bytes of text that are searched block by block.
BLOCK_WORDS, GATHERED_BYTES = 100_000, 32 << 20
LANE_BYTES = 2048
#: Patterns are searched by length class, so that short ones don't shorten the shifts of long ones.
LENGTH_CLASSES = (8, 16, 32)
MIX = np.uint64(0x9E3779B97F4A7C15)

SPAN = StructType([StructField("start", LongType()), StructField("length", LongType())])
FOUND = StructType([
    StructField("n_words", LongType()), StructField("n_hit", LongType()),
    StructField("spans", ArrayType(SPAN)), StructField("items", ArrayType(StringType())),
])


def words(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


def windows(item: list[bytes], width: int = WINDOW) -> set[bytes]:
    """Patterns of an item: its windows, or the whole item if it is shorter."""
    starts = range(max(1, len(item) - width + 1)) if item else ()
    return {b" " + b" ".join(item[i:i + width]) + b" " for i in starts}


class WuManber:
    """Shift table, suffix buckets and patterns of one length class."""

    def __init__(self, patterns: list[bytes]):
        self.patterns = patterns
        self.reach = min(map(len, patterns))  # only the first bytes, as many as the shortest has, move the window
        self.block = min(8, max(2, self.reach // 2))
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        padded = b"".join(p[:self.reach] + bytes(8) for p in patterns)
        heads = np.frombuffer(padded, np.uint8).reshape(len(patterns), self.reach + 8)
        last = self.reach - self.block
        blocks = [self._load(heads, j) for j in range(last + 1)]
        distinct = len(np.unique(np.concatenate(blocks)))
        self.bits = min(21, max(12, int(distinct * 2).bit_length()))
        self.shift = np.full(1 << self.bits, min(last + 1, 65535), np.uint16)
        for j, values in enumerate(blocks):
            np.minimum.at(self.shift, self._slot(values), min(last - j, 65535))
        suffix = self._slot(blocks[last])
        self.order = np.argsort(suffix, kind="stable")
        self.bucket = np.zeros((1 << self.bits) + 1, np.int32)
        np.cumsum(np.bincount(suffix, minlength=1 << self.bits), out=self.bucket[1:])
        self.first, self.last = blocks[0][self.order], blocks[last][self.order]

    def _load(self, heads: np.ndarray, j: int) -> np.ndarray:
        return np.ascontiguousarray(heads[:, j:j + 8]).view("<u8").ravel() & self.mask

    def _slot(self, values: np.ndarray) -> np.ndarray:
        return ((values * MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def search(self, data: bytes) -> Iterator[tuple[int, int]]:
        """(place, pattern) of every occurrence in ``data``, which must end in eight spare bytes."""
        size = len(data) - 8
        at_end = self.reach - self.block
        stop = size - self.reach + 1
        if stop <= 0:
            return
        view = np.ndarray((size + 1,), "<u8", data, strides=(1,))
        starts = np.arange(0, stop, LANE_BYTES, dtype=np.int64)
        ends = np.minimum(starts + LANE_BYTES, stop)
        place, found = starts, []
        while len(place):
            move = self.shift[self._slot(view[place + at_end] & self.mask)]
            halted = move == 0
            if halted.any():
                found.append(place[halted])
            place = place + np.maximum(move, 1)
            going = place < ends
            if not going.all():
                place, ends = place[going], ends[going]
        if not found:
            return
        place = np.concatenate(found)
        slot = self._slot(view[place + at_end] & self.mask)
        n = self.bucket[slot + 1] - self.bucket[slot]
        place, slot, n = place[n > 0], slot[n > 0], n[n > 0]
        for lo in range(0, len(place), 1 << 16):  # a bucket may hold many patterns
            p, s, k = place[lo:lo + (1 << 16)], slot[lo:lo + (1 << 16)], n[lo:lo + (1 << 16)]
            rank = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
            which, where = np.repeat(self.bucket[s], k) + rank, np.repeat(p, k)
            alike = ((view[where] & self.mask) == self.first[which]) & ((view[where + at_end] & self.mask) == self.last[which])
            for i, j in zip(where[alike].tolist(), self.order[which[alike]].tolist()):
                if data.startswith(self.patterns[j], i):
                    yield i, j


class Windows:
    """All windows of a block of items, ready to be searched for."""

    def __init__(self, items: list[tuple[str | None, bytes]], width: int = WINDOW):
        holders: dict[bytes, set[str]] = {}
        for item_id, text in items:
            for pattern in windows(words(text), width):
                held = holders.setdefault(pattern, set())
                if item_id is not None:
                    held.add(item_id)
        classes: dict[int, list[bytes]] = {}
        for pattern in sorted(holders):
            classes.setdefault(sum(len(pattern) >= c for c in LENGTH_CLASSES), []).append(pattern)
        self.searches = [WuManber(patterns) for patterns in classes.values()]
        self.holders = [[tuple(sorted(holders[p])) for p in s.patterns] for s in self.searches]
        self.widths = [[p.count(b" ") - 1 for p in s.patterns] for s in self.searches]

    def scan(self, texts: list[bytes | None], known: list[tuple[list, list]]) -> Iterator[tuple[int, int, list, list]]:
        """For each text: words, hit words, hit spans and items; ``known`` has spans and items of earlier blocks."""
        split = [words(t) for t in texts]
        joined = [b" " + b" ".join(w) + b" \n" for w in split]
        data = b"".join(joined) + bytes(8)
        first = np.zeros(len(joined) + 1, np.int64)
        np.cumsum([len(w) + (1 if w else 2) for w in split], out=first[1:])  # the number of spaces so far
        opened, closed, items = [], [], [set(k[1]) for k in known]
        spaces = None
        for search, holders, widths in zip(self.searches, self.holders, self.widths):
            for place, pattern in search.search(data):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)
                at = int(np.searchsorted(spaces, place))
                opened.append(at)
                closed.append(at + widths[pattern])
                items[int(np.searchsorted(first, at, "right")) - 1].update(holders[pattern])
        for d, (spans, _) in enumerate(known):
            for s in spans:
                opened.append(int(first[d]) + s["start"])
                closed.append(int(first[d]) + s["start"] + s["length"])
        runs: list[list] = [[] for _ in split]
        if opened:
            depth = np.zeros(int(first[-1]) + 2, np.int32)
            np.add.at(depth, opened, 1)
            np.add.at(depth, closed, -1)
            edges = np.diff((np.cumsum(depth) > 0).astype(np.int8), prepend=0)
            for a, b in zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()):
                d = int(np.searchsorted(first, a, "right")) - 1
                runs[d].append({"start": a - int(first[d]), "length": b - a})
        for w, spans, found in zip(split, runs, items):
            yield len(w), sum(s["length"] for s in spans), spans, sorted(found)


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every row of ``docs`` with the benchmark windows that occur in it.

    Adds ``n_words``, ``n_hit`` (words inside any occurrence), ``spans`` (start and length in words, merged) and
    ``items`` (ids as strings, sorted as strings). A null or empty text has no words. Items without words
    are left out; one without id counts for ``n_hit`` and ``spans`` only; ids that occur twice are one item. Repeated
    rows are kept as they are, and a column of ``docs`` that is named like a result is replaced by it.

    A block of items has ``block_words`` words, or is one longer item.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).alias("text")).dropna(subset=["text"])
    total = named.agg(F.sum(F.size(F.split("text", " ")))).first()[0] or 0  # about the words
    blocks = max(1, -(-total // block_words))
    out = docs.select(*other_columns(docs, FOUND.fieldNames()))
    kept, schema = out.columns, widened(out, FOUND)
    arrow_found = pa.schema([
        ("n_words", pa.int64()), ("n_hit", pa.int64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), ("items", pa.list_(pa.string())),
    ])
    tables = []
    for b in range(blocks):
        block = named if blocks == 1 else named.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b)
        tables.append(share(spark, Windows([(r.id, r.text.encode()) for r in block.collect()], window)))

    def searched(found_by: Windows, texts: list, known: list | None) -> list[tuple]:
        found = []
        for lo, hi in pieces_by_bytes([len(t or b"") for t in texts], CHUNK_BYTES):
            found += found_by.scan(texts[lo:hi], known[lo:hi] if known else [([], [])] * (hi - lo))
        return found

    def rows_of(rows: pa.RecordBatch, found: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array(list(c), f.type) for c, f in zip(zip(*found), arrow_found)]
        return pa.RecordBatch.from_arrays([*rows.columns, *columns], names=[*kept, *arrow_found.names])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if len(tables) == 1:
            found_by = tables[0]()
            for batch in batches:
                texts = utf8(batch.column(text))
                for lo, hi in pieces_by_bytes([len(t or b"") for t in texts], CHUNK_BYTES):
                    yield rows_of(batch.slice(lo, hi - lo), searched(found_by, texts[lo:hi], None))
            return
        held, size = [], 0

        def gathered() -> Iterator[pa.RecordBatch]:
            texts = [utf8(rows.column(text)) for rows in held]
            known: list[list | None] = [None] * len(held)
            for table in tables:
                found_by = table()
                known_now = [searched(found_by, t, k and [(f[2], f[3]) for f in k]) for t, k in zip(texts, known)]
                known, found_by = known_now, None
            for rows, found in zip(held, known):
                yield rows_of(rows, found)

        for batch in batches:
            sizes = [len(t or b"") for t in utf8(batch.column(text))]
            for lo, hi in pieces_by_bytes(sizes, CHUNK_BYTES):
                held.append(batch.slice(lo, hi - lo))
                size += sum(sizes[lo:hi])
                if size > GATHERED_BYTES:
                    yield from gathered()
                    held, size = [], 0
        if held:
            yield from gathered()

    return out.mapInArrow(lean(scan), schema)


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows without any benchmark window, with their own columns, whatever these are called."""
    plain, back = numbered(docs)
    return back(find_leaks(plain, items, text=plain.columns[docs.columns.index(text)], **options).filter("n_hit = 0"))
