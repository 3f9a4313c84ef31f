"""Decontamination, Jaccard join, licenses and sharding against brute force."""

import random
import re

import pytest
from pyspark.sql import Row, functions as F

from laborlens.llm import decontaminate, jaccard_join, licenses, sharding

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC = "doc_id long, text string, n_hit string"


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def leaks(text, items, width=10):
    w, hit, found = WORD.findall(lowered(text)), set(), set()
    for name, item in items:
        v = WORD.findall(lowered(item))
        for i in range(max(1, len(v) - width + 1) if v else 0):
            p = v[i:i + width]
            for j in range(len(w) - len(p) + 1):
                if w[j:j + len(p)] == p:
                    hit.update(range(j, j + len(p)))
                    found.add(str(name))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block_words", [1 << 20, 40])
def test_leaks_equal_brute_force(spark, block_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "GATHERED_BYTES", 3000)
    rng = random.Random(3)
    items = [(i, prose(rng, rng.choice([1, 2, 9, 10, 11, 40]), 60)) for i in range(12)] + [(90, None), (91, "... !"), (None, "lonely"), (3, "w1 w2"), (92, "ÀB é")]
    texts = [prose(rng, rng.choice([1, 5, 60, 300]), 60) for _ in range(40)]
    texts += [t.upper().replace(" ", "\n--") for t in texts[:5]] + [items[4][1], f"x {items[5][1]}, y {items[5][1]}!", None, "", "  ", "àb É Àb é", "a" * 200_000]
    docs = [(i, t, "own") for i, t in enumerate(texts)] + [(0, texts[0], "again"), (None, texts[1], None)]
    known = [(n, t) for n, t in items if n is not None and t is not None]
    got = decontaminate.find_leaks(spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id long, text string"), block_words=block_words)
    assert got.columns == ["doc_id", "text", "n_words", "n_hit", "spans", "items"]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r.n_words, r.n_hit, r["items"]) == leaks(r.text, known)
        assert sum(s.length for s in r.spans) == r.n_hit


def test_items_without_id_are_hits_without_name(spark):
    items = spark.createDataFrame([(None, "b c"), (1, "e"), (2, None), (3, "c"), (None, "x")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b c d"), (2, "x y x"), (3, "d e"), (4, "y")], "doc_id long, text string")
    for block_words in (1 << 20, 1):
        got = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.find_leaks(docs, items, block_words=block_words).collect()}
        assert got == {1: (2, ["3"]), 2: (2, []), 3: (1, ["1"]), 4: (0, [])}
    assert [r.doc_id for r in decontaminate.clean_documents(docs, items).collect()] == [4]


def test_no_items_and_no_documents(spark):
    docs, items = spark.createDataFrame([(1, "a b", "")], DOC), spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_leaks(docs, items).first().n_hit == 0
    assert decontaminate.find_leaks(docs.limit(0), spark.createDataFrame([(1, "a")], items.schema)).count() == 0
    clean = decontaminate.clean_documents(docs.drop("n_hit"), spark.createDataFrame([(1, "b")], items.schema))
    assert clean.columns == ["doc_id", "text"] and clean.count() == 0


def classes(texts, width, percent):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered(t))
        sets.append(frozenset([tuple(w)] if 0 < len(w) < width else [tuple(w[i:i + width]) for i in range(len(w) - width + 1)]))
    top = list(range(len(sets)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    links = [0] * len(sets)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)))
                top[y] = x
    return [(len(s), find(i), links[i]) for i, s in enumerate(sets)]


@pytest.mark.parametrize(("width", "percent"), [(4, 85), (5, 80)])
def test_classes_equal_brute_force(spark, width, percent, monkeypatch):
    monkeypatch.setattr(jaccard_join, "GROUP_SETS", 8)  # large groups are cut
    rng = random.Random(width)
    texts = []
    for size in (3, 30, 60, 200, 200):
        base = prose(rng, size, 5000).split()
        for _ in range(30):
            copy = base[:]
            for _ in range(rng.randrange(0, max(2, size // 25))):
                copy[rng.randrange(size)] = f"x{rng.randrange(10**6)}"
            texts.append(" ".join(copy))
    passage = prose(rng, 40, 5000)
    texts += [f"{prose(rng, 60, 5000)} {passage}" for _ in range(25)] + [None, "", " \n\t", "one", "ONE", "one two", "\x0bone\ttwo\x0c", "É é", "é É", "long " * 30_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.n_links) for r in jaccard_join.similar_documents(docs, width=width, percent=percent).collect()}
    assert got == dict(enumerate(classes(texts, width, percent)))
    kept = jaccard_join.first_of_class(docs, width=width, percent=percent)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, c in enumerate(classes(texts, width, percent)) if c[1] == i]


def test_similar_rows_without_id_and_repeated(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (None, "a b c d e"), (2, "a b c d e"), (7, None), (7, "z z"), (5, "z z")], "doc_id long, text string")
    rows = sorted(jaccard_join.similar_documents(docs).drop("mark").collect(), key=str)
    assert sorted(tuple(r) for r in rows if r.doc_id is not None) == [(1, 2, 1, 2), (1, 2, 1, 2), (2, 2, 1, 2), (5, 1, 5, 1), (7, 0, 7, 0), (7, 1, 5, 1)]
    assert [tuple(r) for r in rows if r.doc_id is None] == [(None, 2, None, 0)]
    kept = jaccard_join.first_of_class(docs, width=4, percent=85)
    assert sorted(map(str, kept.collect())) == sorted(map(str, [Row(doc_id=1, text="a b c d e"), Row(doc_id=None, text="a b c d e"), Row(doc_id=7, text=None), Row(doc_id=5, text="z z")]))
    assert jaccard_join.similar_documents(docs.limit(0)).count() == 0


def test_license_places_and_spans(spark):
    notice = licenses.NOTICES["mit-notice"].split()
    edited = notice[:10] + ["indeed"] + notice[10:20] + notice[21:]
    texts = ["The MIT License, the mit-license; MIT/License", "cc by cc by", "İcc bY", None, "", "gnu general public licenses", "x GNU General\nPublic License",
             " ".join(edited), " ".join(notice[:12]), "Licensed under CC BY-NC 4.0.", "word " * 50_000 + "apache license"]
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)] + [(None, "cc by", 0.0), (1, "cc by cc by", 0.0)], "doc_id long, text string, score double")
    got = licenses.scan(docs).collect()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == len(docs.collect())
    for i, t in enumerate(texts):
        w = WORD.findall(lowered(t))
        places = sorted((j, label) for label, p in licenses.PHRASES.items() for j in range(len(w)) if w[j:j + len(p.split())] == p.split())
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None)
        assert r.base_labels == ",".join(sorted({p[1] for p in places}))
    assert (by[7].labels, by[8].labels, by[9].labels) == ("mit-notice", "", "cc-by,cc-by-nc-4.0")
    assert 0.8 <= by[7].score < 1 and by[9].score == 1 and by[4].score == 0
    assert [r.n_base for r in got if r.doc_id is None] == [1]
    assert licenses.scan(docs.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [50, 1000, 1 << 20])
def test_shards_fit_and_are_shortest(spark, limit):
    rng = random.Random(limit)
    rows = [(i, "x" * rng.choice([0, 1, 10, 30, 200]), "s") for i in range(300)] + [(None, None, "s"), (None, "é" * 20, None)]
    rows += [(7, "same text", "copy")] * 120 + [(8, "y" * 40, "copy")] * 5
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string, shard string"), limit).collect()
    assert sorted((str(r.doc_id), r.n_bytes) for r in got) == sorted((str(i), len((t or "").encode())) for i, t, _ in rows)
    sums = {}
    for r in got:
        sums.setdefault(r.shard, []).append(r.n_bytes)
    for r in got:
        assert r.shard_bytes == sum(sums[r.shard]) and (r.shard_bytes <= limit or len(sums[r.shard]) == 1 or max(sums[r.shard]) == r.shard_bytes)
        assert r.depth == len(r.shard.partition("#")[0])
    plain = [s for s in sums if "#" not in s]
    for s in plain:  # a bucket is split only if the bucket above is over the limit
        assert not s or sum(sum(v) for k, v in sums.items() if k.startswith(s[:-1])) > limit
        assert not any(t != s and t.startswith(s) for t in plain)


def test_no_rows_to_shard(spark):
    assert sharding.assign(spark.createDataFrame([], DOC)).count() == 0


def test_shards_are_written(spark, tmp_path):
    rows = [(i, "t" * i, "own") for i in range(50)] + [(None, "no id", "x"), (None, "no id", "x"), (3, "ttt", "own"), (4, None, None)] + [(9, "same " * 8, "copy")] * 20
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    sharding.write(docs, str(tmp_path / "out"), 200)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((str(r.doc_id), str(r.text)) for r in back.collect()) == sorted((str(i), str(t)) for i, t, _ in rows)
    assert back.groupBy("shard").agg(F.sum(F.length("text")).alias("n")).filter("n > 200").count() == 0
    assert back.select("shard").distinct().count() > 5


def test_query_splits_the_smallest_table(spark):
    from laborlens.llm import queries

    assert queries.QUERIES["op3_sharding"](spark, "/root/testdata/sf0.001").select("shard").distinct().count() > 1
