"""Language trees and the choice of page nodes against independent counts, and readers on hostile input."""

import itertools
import math
import random
import time
from collections import Counter, defaultdict

import numpy as np
import pytest

from laborlens.llm import html_text, langid, warc


def ppm(texts, alphabet, min_count, order):
    """Prediction by partial matching with exclusion, from dictionaries of counts."""
    counts = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        for k in range(order + 1):
            for j in range(k, len(t)):
                counts[k][t[j - k:j]][t[j]] += 1

    def node(ctx):
        if ctx and (sum(counts[len(ctx)][ctx].values()) < min_count or not (len(ctx) < 2 or node(ctx[1:]))):
            return None
        return counts[len(ctx)].get(ctx)

    def probability(ctx, symbol):
        if ctx is None:
            return 1 / alphabet
        shorter = ctx[1:] if ctx else None
        seen = node(ctx)
        if not seen:
            return probability(shorter, symbol)
        rest = 1 - sum(probability(shorter, s) for s in seen)
        rest = max(rest, 0.0)
        escapes = len(seen) if rest > 1e-12 else 0
        total = sum(seen.values()) + escapes
        return seen[symbol] / total if symbol in seen else escapes * probability(shorter, symbol) / rest / total

    return probability


@pytest.mark.parametrize("min_count", [1, 2, 4])
def test_code_lengths_equal_counts(min_count):
    rng = random.Random(min_count)
    texts = {lang: [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(12)).encode() for _ in range(4)]
             for lang, letters in (("one", "aab"), ("two", "abcd"), ("three", "aeé"))}
    trees = langid.ContextTrees(texts, min_count=min_count)
    joined = {lang: [langid.letters(t) for t in ts] for lang, ts in texts.items()}
    alphabet = len(set(b" ").union(*(set(t) for ts in joined.values() for t in ts))) + 1
    asked = [b"abab", b"dcba a", "éa ae".encode(), b"", b"bbbbbb bb"]
    got = trees.code_lengths([langid.letters(t) for t in asked])
    for column, lang in enumerate(sorted(texts)):
        probability = ppm(joined[lang], alphabet, min_count, langid.ORDER)
        for row, t in enumerate(asked):
            s = b" " * langid.ORDER + langid.letters(t)
            bits = -sum(math.log2(probability(s[j - langid.ORDER:j], s[j])) for j in range(langid.ORDER, len(s)))
            assert got[row, column] == pytest.approx(bits, rel=1e-4)


def test_decoding_is_the_best_consistent_choice():
    rng = random.Random(7)
    for _ in range(150):
        n = rng.randrange(2, 10)
        page = html_text.Page("")
        page.parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        page.tag, page.attributes, page.linked = ["div"] * n, [""] * n, [0] * n
        leaves = set(range(1, n)) - set(page.parent)
        page.text = [f"t{i}" if i in leaves else "" for i in range(n)]
        odds = np.array([rng.gauss(0, 2) for _ in range(n)])

        def score(chosen):
            total = 0.0
            for i in range(n):
                weight = 3.0 if page.text[i] else 1.0
                total += -math.log1p(math.exp(-odds[i] if chosen[i] else odds[i])) * weight
                if i and not chosen[i] and chosen[page.parent[i]] and page.parent[i]:
                    total -= html_text.PARTING
            return total

        choices = [c for c in itertools.product([True, False], repeat=n) if c[0] and all(c[page.parent[i]] or not c[i] for i in range(1, n))]
        best = max(choices, key=score)
        assert page.decode(odds) == " ".join(page.text[i] for i in range(n) if best[i] and page.text[i])


HOSTILE = {
    "open tags": "<a " * 300_000, "open quotes": "<a b=\"" * 150_000, "open quotes with an end": "<a b='" * 150_000 + ">", "unmatched ends": "<div>" * 50_000 + "</p>" * 100_000,
    "rows without table": "<div>" * 50_000 + "<tr></tr>" * 50_000, "items below a list": "<ul><li><div>" + "<div>" * 50_000 + "<li></li>" * 50_000,
    "open scripts": "<div>x</div>" + "<script></script " * 60_000, "open comments": "<!-- " * 200_000, "open heads": "<head>" * 100_000,
    "deep": "<div>" * 100_000 + "text" + "</div>" * 100_000, "long attribute": "<div class='" + "ad " * 300_000 + "'>x</div>",
}


@pytest.mark.parametrize("name", sorted(HOSTILE))
def test_hostile_pages_take_linear_time(name):
    source = HOSTILE[name]
    started = time.process_time()
    html_text.Page(source)
    assert time.process_time() - started < 10, len(source)


def test_formulas_are_text():
    page = html_text.Page("<article><p>Here <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>")
    assert "".join(page.text).replace(" ", "") == "Herex=2holds."


def test_large_archives_take_linear_time():
    one = warc.member(warc.record("1", "u", b"payload", "", None))
    seconds = []
    for copies in (10_000, 40_000):
        data = one * copies
        started = time.process_time()
        assert sum(r.reason is None for r in warc.salvage(data)) == copies
        seconds.append(time.process_time() - started)
    assert seconds[1] < 8 * seconds[0] and seconds[1] < 30
    started = time.process_time()
    assert [r.length for r in warc.salvage(b"WARC/1.1\r\n" * 20_000)] == [200_000]
    assert time.process_time() - started < 30


def test_large_member_is_unpacked_in_steps():
    content = warc.record("1", "u", random.Random(1).randbytes(3 << 20), "", None)
    packed = warc.member(content)
    assert [r.fields["warc-record-id"] for r in warc.salvage(packed * 2)] == ["<urn:page:1>"] * 2
    assert [r.reason for r in warc.salvage(packed[:-20])] == ["member ends early"]
