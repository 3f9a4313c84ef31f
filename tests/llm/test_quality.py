"""The rule ledger, its policies and its ablations against brute force."""

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from laborlens.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measure(text):
    t = text or ""
    w = WORD.findall(t)
    grams = Counter(zip(w, w[1:], w[2:]))
    again = {j for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for j in range(i, i + 3)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t), "n_upper": sum("A" <= c <= "Z" for c in t),
            "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again)}


def fails(m):
    conditions = [m["n_words"] < 50, 2 * m["n_repeat_words"] > m["n_words"], 10 * m["n_symbols"] > 3 * m["n_words"], m["n_dup_lines"] > 0 and 2 * m["n_dup_lines"] >= m["n_lines"],
                  m["word_chars"] < 2 * m["n_words"], m["word_chars"] > 15 * m["n_words"], 2 * m["n_upper"] > m["word_chars"]]
    return sum(1 << i for i, c in enumerate(conditions) if c)


def texts():
    rng = random.Random(5)
    prose = lambda n, k: " ".join(rng.choice("abcdé") * rng.randrange(1, 4) + str(rng.randrange(k)) for _ in range(n))
    found = [prose(rng.randrange(120), rng.choice([1, 3, 1000])) for _ in range(40)]
    found += [None, "", "   \n\t", "a", "a b", "a b c", "a a a", "a a a a", "x y z\x0bx y z", "a b c d 日本語 a b", "same\nsame\n\nsame\r\nother\n \nsame"]
    found += ["<b> | # $ %% &&& ***> ok", prose(60, 9999).upper(), "w" * 100_000, " ".join(["q"] * 30_000), prose(20_000, 10**9), "i " * 80, "pneumonoultramicroscopic " * 60]
    return found


def ledger_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, _words string, failures string")
    return quality.ledger(docs)


def test_ledger_equals_brute_force(spark):
    rows = [(i, t, "own", "kept", "x") for i, t in enumerate(texts())] + [(0, texts()[0], "", "again", None), (None, "a b", None, None, None)]
    out = ledger_of(spark, rows)
    assert out.columns == ["doc_id", "text", "_words", *quality.MEASURES, "failures"]
    got = out.collect()
    assert len(got) == len(rows) and {r["_words"] for r in got} == {"kept", "again", None}
    for r in got:
        m = measure(r.text)
        assert {k: r[k] for k in m} == m, r.text and r.text[:60]
        assert r.failures == fails(m)


def test_policies_and_ablations(spark):
    rows = ledger_of(spark, [(i, t, "", "", "") for i, t in enumerate(texts())])
    found = [r.failures for r in rows.collect()]
    for policy in [*quality.POLICIES, quality.Policy("v3", 0, soft=127, least=2), quality.Policy("none", 0)]:
        def out(f, gone=0, policy=policy):
            return bool(f & policy.hard & ~gone) or bin(f & policy.soft & ~gone).count("1") >= policy.least

        kept = {r.doc_id: r.kept for r in quality.decide(rows, policy).collect()}
        assert kept == {i: not out(f) for i, f in enumerate(found)}
        got = {r.rule: (r.n, r.failed, r.rejected, r["only"]) for r in quality.ablations(rows, [policy]).collect()}
        assert got == {name: (len(found), sum(f >> i & 1 for f in found), sum(map(out, found)), sum(out(f) and not out(f, 1 << i) for f in found))
                       for i, name in enumerate(quality.RULES)}
    either = both = 0
    both = ~both
    for f in found:
        either, both = either | f, both & f
    seen = quality.failed_rules(rows).first()
    assert (seen["some"], seen["all"]) == (either, both)
    halves = quality.ablations(rows.withColumn("half", F.col("doc_id") % 2), by=["half"])
    assert halves.count() == 2 * 2 * len(quality.RULES)


def test_empty_table(spark):
    rows = ledger_of(spark, [])
    assert rows.collect() == [] and quality.ablations(rows).collect() == [] and quality.decide(rows).columns[-1] == "kept"
