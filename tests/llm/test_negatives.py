"""Integer products, heaps and mined negatives against plain Python."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from laborlens.llm import negatives
from laborlens.llm.negatives import Heaps, strassen


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 7), (64, 64, 64), (65, 33, 130), (200, 64, 300), (0, 4, 3), (5, 0, 6)])
@pytest.mark.parametrize("high", [300, 1 << 40, 1 << 62])
def test_products_are_exact(shape, high):
    rng = np.random.default_rng(1)
    m, k, n = shape
    a, b = rng.integers(-high, high, (m, k)), rng.integers(-high, high, (k, n))
    want = np.zeros((m, n), np.int64)
    for t in range(k):
        want += a[:, t, None] * b[t]  # both wrap around at 2**64
    assert np.array_equal(strassen(a, b, leaf=4), want) and np.array_equal(strassen(a, b), want)


def test_heaps_merge_like_one_sort():
    rng = np.random.default_rng(2)
    one, parts, all_rows = Heaps(6, 3), [Heaps(6, 3) for _ in range(4)], []
    for i in range(20):
        scores, ids = rng.integers(-4, 5, (6, 30)), rng.integers(0, 40, 30)
        scores[0] = np.iinfo(np.int64).min if i % 2 else np.iinfo(np.int64).max
        allowed = rng.random((6, 30)) < 0.6
        one.offer(np.arange(6), scores, allowed, ids)
        parts[i % 4].offer(np.arange(6), scores, allowed, ids)
        all_rows += [(s, -int(scores[s, c]), int(ids[c])) for s in range(6) for c in range(30) if allowed[s, c]]
    for p in parts[1:]:
        parts[0].merge(p)
    want = [r for s in range(6) for r in sorted(x for x in all_rows if x[0] == s)[:3]]
    for h in (one, parts[0]):
        assert [(int(s), -int(v), int(i)) for s, v, i in zip(h.slot, h.score, h.id)] == want


def mined(rows, every, positives=5, negatives=3, low=50, high=95):
    good = [(i, lab, [math.floor(256 * x) for x in v]) for i, lab, v in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for anchor, label, a in good:
        if anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b)), i, lab) for i, lab, b in good]
        for s, i, _ in sorted(x for x in scored if x[2] == label and x[1] != anchor)[:positives]:
            fits = sorted(x for x in scored if x[2] != label and -low * s <= -100 * x[0] <= -high * s)[:negatives]
            out += [(anchor, i, r + 1, x[1], -s, -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def vectors(rng, n, width, start=0):
    centres = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    return [(start + i, rng.randrange(4), [x + rng.gauss(0, 0.7) for x in rng.choice(centres)]) for i in range(n)]


def run(spark, rows, every=5, **options):
    df = spark.createDataFrame([(*r, "x", None) for r in rows], "vec_id long, label int, embedding array<double>, score string, tile long").repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CANDIDATE_ROWS", 40)
    monkeypatch.setattr(negatives, "ANCHOR_ROWS", 8)
    rng = random.Random(4)
    rows = vectors(rng, 150, 40)
    rows += [(1000 + i, i % 3, rows[7][2]) for i in range(30)]  # one common vector: many ties
    rows += [(2000, None, [1.0] * 40), (2005, 1, None), (2010, 2, [math.nan] * 40), (2015, 3, [math.inf] + [0.0] * 39), (2020, 3, [None] * 40), (None, 1, [1.0] * 40)]
    rows += [(3000, 1, [0.0] * 40), (3005, 2, []), (3010, 0, [5.0, -3.0]), (rows[3][0], 2, rows[4][2]), rows[10], rows[11], (-5, 1, rows[12][2])]
    want = mined(rows, 5)
    assert len(want) > 100
    assert run(spark, rows) == want
    assert run(spark, rows, block_bytes=1) == want  # a pass for each tile of anchors
    assert run(spark, rows, positives=2, negatives=4, low=20, high=80) == mined(rows, 5, 2, 4, 20, 80)


def test_empty_and_large_numbers(spark):
    assert run(spark, []) == [] and run(spark, [(1, 1, [1.0]), (2, 2, [1.0])]) == []
    assert run(spark, [(0, 1, [1.0]), (5, 1, [1.0])]) == []
    rows = [(0, 1, [3e5, 2.0]), (1, 1, [3e5, 1.0]), (2, 2, [2e5, 7.0]), (3, 2, [1e300, 0.0]), (4, 2, [1.6e5, 0.0])]
    assert [r[3] for r in run(spark, rows) if r[0] == 0][:2] == [2, 4]


def test_spark_needs_no_row_of_other_columns(spark):
    df = spark.createDataFrame([(0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.7, 0.0])], "vec_id int, label byte, embedding array<float>")
    got = negatives.hard_negatives(df, F.col("vec_id") == 0).collect()
    assert [(r.anchor_id, r.positive_id, r.rank, r.negative_id) for r in got] == [(0, 1, 1, 2)]
