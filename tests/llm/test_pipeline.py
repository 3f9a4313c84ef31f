"""Every stage of the pipeline on odd rows: clashing names, equal ids, nulls, long texts and empty tables."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"
CLASHING = "lang_pred string, score double, n_words string, n_hit long, spans string, items string, gone string, gone_mark long, again long, again_mark string, row string, node long, mark string, `class` string, component string, pairs string"
SCHEMA = f"doc_id long, text string, lang string, {CLASHING}"
STAGES = dict(corpus_pipeline.STAGES)


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def frame(spark, rows):
    rest = ("x", 1.0, "w", 2, "s", "i", "g", 3, 4, "m", "r", 5, "k", "c", "p", "q")
    return spark.createDataFrame([(*r, *rest) for r in rows], SCHEMA)


ROWS = [(i, prose(i), "en") for i in range(12)] + [
    (20, prose(3) + " one", "en"), (21, prose(3) + " two", "en"),  # near copies of 3
    (30, prose(4), "en"), (30, prose(4) + " end", "en"),  # equal ids, near copies of each other and of 4
    (1, prose(99) + " a", "de"), (1, prose(99) + " b", "de"), (2, prose(98), "de"),  # equal ids, unlike texts and like ones
    (5, prose(5), "en"), (40, None, "en"), (41, "", None), (None, prose(50), "en"), (None, prose(50), "en"), (42, "1 2 3", "en"), (43, "word " * 100_000, "en")]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_stages_keep_columns_of_any_name(spark, name):
    docs = frame(spark, ROWS)
    found = STAGES[name](spark, docs, SF)
    assert found.schema.simpleString() == docs.schema.simpleString()
    rows = found.collect()
    assert rows and {tuple(r)[3:] for r in rows} == {tuple(docs.first())[3:]}
    assert STAGES[name](spark, docs.limit(0), SF).collect() == []


def test_language_stage(spark):
    kept = STAGES["language id"](spark, frame(spark, ROWS), SF).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted((str(r[0]), str(r[1])) for r in ROWS if r[1] and any(c.isalpha() for c in r[1]))


def test_near_duplicate_stage(spark):
    kept = STAGES["n-gram jaccard join"](spark, frame(spark, ROWS), SF).collect()
    got = sorted((str(r.doc_id), str(r.text)[:12] if r.text else r.text) for r in kept)
    ids = [r.doc_id for r in kept]
    assert sorted(i for i in ids if i is not None and i < 12) == sorted([*range(12), 1, 2])  # an unlike text of the same id stands for its own class
    assert [i for i in ids if i in (20, 21, 30)] == [] and ids.count(None) == 2, got
    assert {40, 41, 42, 43} <= set(ids)
    like = [r.text for r in kept if r.doc_id == 1 and r.text.startswith(prose(99))]
    assert len(like) == 1  # of near copies with one id, one


def test_decontamination_stage(spark):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("length(text) > 100").first()
    rows = [*ROWS, (60, f"before {item.text} after", "en")]
    kept = STAGES["benchmark decontamination"](spark, frame(spark, rows), SF).collect()
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r[0]) for r in ROWS)


def test_packing_stage(spark):
    pieces = STAGES["packing"](spark, frame(spark, ROWS), SF).collect()
    assert {r.doc_id for r in pieces} == {r[0] for r in ROWS}
    assert sum(r.doc_tokens for r in pieces if r.start == 0 and r.doc_id == 40) == 1
    assert STAGES["packing"](spark, frame(spark, ROWS).limit(0), SF).collect() == []


def test_settings_are_left_alone(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    for stage in STAGES.values():
        stage(spark, frame(spark, ROWS[:3]), SF)
    assert spark.conf.get(name) == before
