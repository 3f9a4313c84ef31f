"""The registered queries of the folder against SQL, and the pipeline against its stages' meaning."""

import sys
from pathlib import Path

import pytest
from compare import duck, rows_of

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from laborlens.llm import decontaminate, jaccard_join, langid, queries  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cur = duck(SF).execute(queries.SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cur.fetchall())


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_held_out_languages(spark):
    truth = {r.doc_id: r.lang for r in queries.table(spark, SF, "documents").select("doc_id", "lang").collect()}
    held = [r for r in queries.QUERIES["op6_language_id"](spark, SF).collect() if r.held_out]
    assert held and sum(truth[r.doc_id] == r.lang_pred for r in held) >= 0.95 * len(held)


def test_pipeline(spark):
    docs = queries.table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language id", "n-gram jaccard join", "benchmark decontamination", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs, SF).columns == docs.columns
    kept = docs.join(langid.identify(docs, langid.learn(docs)).filter("lang_pred <> 'und'").select("doc_id"), "doc_id")
    one = jaccard_join.similar_documents(kept, width=5, percent=80).filter("doc_id = component_id").select("doc_id")
    clean = decontaminate.find_leaks(kept.join(one, "doc_id"), queries.table(spark, SF, "benchmark")).filter("n_hit = 0")
    pieces = corpus_pipeline.run(spark, SF)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in clean.collect()}
