"""Sum-of-squares online packing of token ids into sequences of fixed length.

A document of more than one sequence first gives whole sequences; the rest goes, in the order of arrival, to the
fill level that makes the sum of squared counts of partly filled windows smallest. Every Spark partition packs its
own rows, so there is no shuffle and memory holds one batch and the open windows; what is still open at the end of
a partition is closed up by cutting pieces, and its last window is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .common import chunks, lean
from .tokens import ByteEncoder

LENGTH = 1024
CHUNK_BYTES = 1 << 20
#: Bytes of one id.
ID = 4


class Packer:
    """Windows of one partition; rows are (document, start, ids, document's length, sequence, offset)."""

    def __init__(self, length: int):
        self.length = length
        self.sequences = 0
        self.counts = np.zeros(length + 1, np.int64)  # open windows by fill level
        self.open: list[list[list]] = [[] for _ in range(length)]

    def _level(self, size: int) -> int:
        """The level to add ``size`` to; 0 opens a window. Ties go to the fullest."""
        room = self.length - size
        here, there = self.counts[:room + 1], self.counts[size:]
        change = 2 * there + 1
        change[-1] = 0  # a full window isn't counted
        change[1:] += 1 - 2 * here[1:]
        usable = here > 0
        usable[0] = True
        change[~usable] = np.iinfo(np.int64).max
        return room - int(np.argmin(change[::-1]))

    def _emit(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for doc, start, ids, total in pieces:
            yield doc, start, ids, total, self.sequences, offset
            offset += len(ids) // ID
        self.sequences += 1

    def add(self, doc, ids: bytes) -> Iterator[tuple]:
        total = len(ids) // ID
        whole = total // self.length * self.length
        for start in range(0, whole, self.length):
            yield from self._emit([(doc, start, ids[start * ID:(start + self.length) * ID], total)])
        if whole == total:
            return
        size = total - whole
        level = self._level(size)
        window = self.open[level].pop() if level else []
        if level:
            self.counts[level] -= 1
        window.append((doc, whole, ids[whole * ID:], total))
        if level + size == self.length:
            yield from self._emit(window)
        else:
            self.open[level + size].append(window)
            self.counts[level + size] += 1

    def close(self) -> Iterator[tuple]:
        """Close the open windows up, the fullest first, with pieces cut from the emptiest."""
        rest = [w for level in range(self.length - 1, 0, -1) for w in self.open[level]]
        fill = [sum(len(p[2]) for p in w) // ID for w in rest]
        front, back = 0, len(rest) - 1
        while front < back:
            doc, start, ids, total = rest[back].pop()
            size = min(self.length - fill[front], len(ids) // ID)
            rest[front].append((doc, start, ids[:size * ID], total))
            fill[front] += size
            fill[back] -= size
            if size * ID < len(ids):
                rest[back].append((doc, start + size, ids[size * ID:], total))
            if fill[front] == self.length:
                yield from self._emit(rest[front])
                front += 1
            if not rest[back]:
                back -= 1
        if front == back and rest[front]:
            yield from self._tail(rest[front], fill[front])

    def _tail(self, pieces: list, size: int) -> Iterator[tuple]:
        """The last window of a partition, cut into sequences of a power of two."""
        pieces = pieces[::-1]
        while size:
            room = 1 << (size.bit_length() - 1)
            size -= room
            window = []
            while room:
                doc, start, ids, total = pieces.pop()
                n = min(room, len(ids) // ID)
                window.append((doc, start, ids[:n * ID], total))
                room -= n
                if n * ID < len(ids):
                    pieces.append((doc, start + n, ids[n * ID:], total))
            yield from self._emit(window)


def pack(docs: DataFrame, tokenizer_path: str, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
         end_id: int | None = 0) -> DataFrame:
    """Pieces of all documents: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``ids`` are little-endian unsigned 32-bit numbers in a binary column. Null and empty texts have the end id
    alone. Repeated rows and rows without id are packed like any other; further columns are left out. Sequence ids
    are the partition's number times 2**33 and a running number, so a lost task that runs again gives them again.
    ``tokenizer_path`` must be readable on every executor.
    """
    schema = StructType([
        docs.select(doc_id).schema[0], StructField("start", LongType()), StructField("length", LongType()),
        StructField("ids", BinaryType()), StructField("doc_tokens", LongType()), StructField("sequence_id", LongType()),
        StructField("offset", LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, key = None, Packer(length), pa.null()
        end = b"" if end_id is None else np.uint32(end_id).tobytes()
        base = TaskContext.get().partitionId() << 33

        def out(rows: list[tuple]) -> pa.RecordBatch:
            ids, starts, values, totals, sequences, offsets = (list(c) for c in zip(*rows))
            sizes = [len(v) // ID for v in values]
            arrays = [pa.array(ids, key), *(pa.array(c, pa.int64()) for c in (starts, sizes)), pa.array(values, pa.binary()),
                      *(pa.array(c, pa.int64()) for c in (totals, [base + s for s in sequences], offsets))]
            return pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

        for batch in batches:
            encoder = encoder or ByteEncoder(tokenizer_path)
            key = batch.schema.field(0).type
            for part, texts in chunks(batch, 1, CHUNK_BYTES):
                encoded = encoder.encode([t.decode("utf-8", "replace") for t in texts])
                rows = [r for d, e in zip(part.column(0).to_pylist(), encoded) for r in packer.add(d, e.astype("<u4").tobytes() + end)]
                if rows:
                    yield out(rows)
        if rows := list(packer.close()):
            yield out(rows)

    return docs.select(doc_id, text).mapInArrow(lean(run), schema)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 of their ids in place of the ids."""
    head = pieces.columns[:3]
    return pieces.select(*head, F.crc32("ids").cast("bigint").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def crc(ids: list[int]) -> int:
    return zlib.crc32(np.array(ids, "<u4").tobytes())
