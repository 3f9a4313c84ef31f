"""Language identification by prediction by partial matching.

Each language has a tree of byte contexts of up to three bytes, kept only where a context was seen often enough.
A byte that a context has not seen is coded by an escape and the next shorter context, over the bytes that the
longer one leaves (exclusion), so the probabilities of every context sum to one and code lengths are exact. The
trees of all languages share one set of states; the statistics are frozen after training, so the code lengths of a
whole text are a sum over its bytes, taken from one table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .common import WORD_BYTES, lean, numbered, other_columns, pieces_by_bytes, share, small, stored, utf8, widened

ORDER = 3
UNDETERMINED = "und"
#: Bits of a text's hash by which labelled texts are counted before they are ranked.
SLICE_BITS = 12
CHUNK_BYTES = 1 << 19
#: ASCII digits are no evidence of a language.
LETTER_BYTES = bytes(32 if 48 <= b <= 57 else WORD_BYTES[b] for b in range(256))

PREDICTED = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])


def letters(text: bytes) -> bytes:
    """Words of letters with a space before, between and after."""
    return b" " + b" ".join(text.translate(LETTER_BYTES).split()) + b" "


class ContextTrees:
    """Frozen trees of all languages as one automaton over the last ``ORDER`` bytes."""

    def __init__(self, texts: dict[str, list[bytes]], min_count: int = 4, max_states: int = 60_000):
        self.langs = sorted(texts)
        joined = {lang: [letters(t) for t in texts[lang]] for lang in self.langs}
        seen = sorted(set(b" ").union(*(set(t) for ts in joined.values() for t in ts)))
        self.n = len(seen) + 1  # symbol 0 is any byte that training didn't show
        self.symbol = np.zeros(256, np.uint32)
        self.symbol[seen] = np.arange(1, self.n)
        streams = {lang: [self.symbol[np.frombuffer(t, np.uint8)] for t in ts] for lang, ts in joined.items()}
        grams = {lang: [self._counts(ss, k) for k in range(ORDER + 1)] for lang, ss in streams.items()}
        keep = self._contexts(grams, min_count, max_states)
        self._build(grams, keep)

    def _counts(self, streams: list[np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct codes of k context bytes and the byte after them, with their counts."""
        codes = [self._codes(s, k) * self.n + s[k:] for s in streams if len(s) > k]
        if not codes:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.unique(np.concatenate(codes), return_counts=True)

    def _codes(self, s: np.ndarray, k: int) -> np.ndarray:
        """The code of the k bytes before every byte from the k-th on; the latest byte counts least."""
        code = np.zeros(len(s) - k, np.int64)
        for j in range(k):
            code = code * self.n + s[j:len(s) - k + j]
        return code

    def _contexts(self, grams: dict, min_count: int, max_states: int) -> list[list[np.ndarray]]:
        """Per order and language, the contexts that get a node; rare ones go until the automaton fits."""
        while True:
            keep = []
            for k in range(ORDER + 1):
                keep.append([])
                for lang in self.langs:
                    codes, counts = grams[lang][k]
                    ctx, first = np.unique(codes // self.n, return_index=True)
                    total = np.add.reduceat(counts, first) if len(first) else counts
                    ctx = ctx[total >= (min_count if k else 1)]
                    if k > 1:  # a node's shorter contexts are nodes too
                        ctx = ctx[np.isin(ctx % self.n ** (k - 1), keep[k - 1][len(keep[k])])]
                    keep[k].append(ctx)
            states = sum(len(np.unique(np.concatenate(ks))) for ks in keep)
            if states <= max_states:
                return keep
            min_count *= 2

    def _build(self, grams: dict, keep: list[list[np.ndarray]]) -> None:
        n, nl = self.n, len(self.langs)
        orders = [np.unique(np.concatenate(ks)) for ks in keep]
        offset = np.concatenate([[0], np.cumsum([len(o) for o in orders])])
        prob = np.empty((int(offset[-1]) if len(orders[0]) else 1, n, nl))
        prob[0] = 1.0 / n  # below the root: every byte alike
        states = np.zeros(1, np.int32)  # of the shorter contexts, by code
        self.state = np.zeros(n ** ORDER, np.int32)
        for k, codes in enumerate(orders):
            suffix = states[codes % n ** max(k - 1, 0)]
            base = np.broadcast_to(prob[0], (len(codes), n, nl)) if k == 0 else prob[suffix]
            level = base.copy()
            for i, lang in enumerate(self.langs):
                grams_k, counts = grams[lang][k]
                row = np.searchsorted(codes, grams_k // n)
                row[row == len(codes)] = 0
                own = np.isin(grams_k // n, keep[k][i]) & (len(codes) > 0)
                c = np.zeros((len(codes), n))
                c[row[own], grams_k[own] % n] = counts[own]
                distinct, total = (c > 0).sum(1), c.sum(1)
                node = total > 0
                left = np.where(c > 0, 0.0, base[:, :, i])
                rest = left.sum(1)
                open_ = rest > 0  # else every byte was seen and there is nothing to escape to
                weight = np.where(open_, distinct / np.maximum(rest, 1e-300), 0.0)
                mixed = (c + left * weight[:, None]) / np.maximum(total + distinct * open_, 1)[:, None]
                level[node, :, i] = mixed[node]
            prob[offset[k]:offset[k + 1]] = level
            if k:
                longer = np.tile(states, n)
                longer[codes] = offset[k] + np.arange(len(codes))
                states = longer
            elif len(codes):
                states = np.zeros(1, np.int32)
        self.state = states if len(states) == n ** ORDER else np.zeros(n ** ORDER, np.int32)
        self.cost = np.ascontiguousarray(-np.log2(prob).reshape(-1, nl), np.float32)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text (after ``letters``) in each language."""
        data = b"".join(b" " * ORDER + t for t in texts)
        s = self.symbol[np.frombuffer(data, np.uint8)].astype(np.int64)
        code = self._codes(s, ORDER)
        bits = self.cost[self.state[code] * np.int64(self.n) + s[ORDER:]]
        first = np.cumsum([0] + [len(t) + ORDER for t in texts[:-1]])
        # a text's own bytes only: neither the spaces put before the next one nor the bytes of the one before
        edges = np.stack([first, first + [len(t) for t in texts]], 1).ravel()
        return np.add.reduceat(np.vstack([bits, np.zeros((1, bits.shape[1]), np.float32)]), edges, axis=0, dtype=np.float64)[::2]

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float]]:
        bits = self.code_lengths(texts)
        gap = bits - bits.min(1, keepdims=True)
        share = np.exp2(-np.minimum(gap, 1000.0)).sum(1)
        return [self.langs[i] for i in bits.argmin(1).tolist()], (1.0 / share).tolist()


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", docs_per_lang: int = 400,
          bytes_per_lang: int = 1 << 20) -> ContextTrees | None:
    """Trees from a bounded sample of the labelled rows; None without any.

    Per language at most ``docs_per_lang`` whole texts of ``bytes_per_lang`` together, in the order of a hash of the
    text; one that doesn't fit into the bytes left is passed over. Rows without label or text are left out; equal
    texts count once.
    """
    sized = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text")).dropna().filter("text <> ''").select(
        "lang", "text", F.xxhash64("text").alias("h"), F.octet_length("text").cast("bigint").alias("n"))
    distinct = sized.filter(F.col("n") <= bytes_per_lang).groupBy("lang", "h").agg(F.max("n").alias("n"))
    # by length class, so that texts that don't fit leave enough shorter ones to choose from
    key = ["lang", "class"]
    distinct = stored(distinct.select("lang", F.length(F.bin("n")).alias("class"), "h", "n", F.shiftright("h", 64 - SLICE_BITS).alias("slice")), "labelled")
    # counted by slice of the hash first, so that only what can be drawn meets in one task
    upto = Window.partitionBy(*key).orderBy("slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = distinct.groupBy(*key, "slice").agg(F.count("*").alias("rows")).withColumn("before", F.sum("rows").over(upto) - F.col("rows"))
    cuts = slices.filter(F.col("before") < docs_per_lang).groupBy(*key).agg(F.max("slice").alias("cut"))
    near = distinct.join(small(stored(cuts, "cuts")), key).filter(F.col("slice") <= F.col("cut"))
    first = near.withColumn("r", F.row_number().over(Window.partitionBy(*key).orderBy("h"))).filter(F.col("r") <= docs_per_lang)
    ids, taken, held = [], Counter(), Counter()
    for r in sorted(first.select("lang", "h", "n").collect()):
        if taken[r.lang] < docs_per_lang and held[r.lang] + r.n <= bytes_per_lang:
            ids.append((r.lang, r.h))
            taken[r.lang] += 1
            held[r.lang] += r.n
    if not ids:
        return None
    spark = labelled.sparkSession
    wanted = F.broadcast(spark.createDataFrame(ids, "lang string, h bigint"))
    texts: dict[str, dict[str, None]] = {}
    for r in sized.join(wanted, ["lang", "h"], "left_semi").select("lang", "text").dropDuplicates().sort("lang", "text").collect():
        texts.setdefault(r.lang, {})[r.text] = None
    return ContextTrees({k: _lowered(list(v)) for k, v in texts.items()})


def _lowered(texts: list[str]) -> list[bytes]:
    return utf8(pc.utf8_lower(pa.array(texts, pa.string())))


def identify(docs: DataFrame, trees: ContextTrees | None, text: str = "text") -> DataFrame:
    """Every row with ``lang_pred`` and ``score``.

    The language whose tree codes the text in the fewest bits, ties by name; the score is its share of the
    probability over all languages. A null text, one without a letter, and every text when nothing was learned is
    ``und`` with score 0. A column named like a result is replaced by it.
    """
    out = docs.select(*other_columns(docs, PREDICTED.fieldNames()))
    kept, schema = out.columns, widened(out, PREDICTED)
    shared = share(docs.sparkSession, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = shared()
        for batch in batches:
            column = batch.column(text)
            known = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_pylist()
            sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
            for lo, hi in pieces_by_bytes(sizes, CHUNK_BYTES):
                langs, scores = [UNDETERMINED] * (hi - lo), [0.0] * (hi - lo)
                rows = [i for i in range(lo, hi) if known[i]] if trees else []
                if rows:
                    texts = utf8(pc.utf8_lower(column.take(pa.array(rows))))
                    for i, lang, score in zip(rows, *trees.predict([letters(t) for t in texts])):
                        langs[i - lo], scores[i - lo] = lang, score
                part = batch.select(kept).slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, *PREDICTED.fieldNames()])

    return out.mapInArrow(lean(run), schema)


def fold(doc_id: Column) -> Column:
    """0 to 3, from a checksum of the id as text; null without id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def known_language(docs: DataFrame, trees: ContextTrees | None, min_score: float = 0.0, text: str = "text") -> DataFrame:
    """The rows whose language is found, with their own columns, whatever these are called."""
    plain, back = numbered(docs)
    found = identify(plain, trees, text=plain.columns[docs.columns.index(text)])
    return back(found.filter((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)))
