"""Groups, links and counts of two tokenizations against plain Python, and the encoders against their libraries."""

import bisect
import functools
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from laborlens.llm import alignment
from laborlens.llm.tokens import ByteEncoder, byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def corpus():
    rng = random.Random(8)
    given = pq.read_table(f"{SF}/documents.parquet", columns=["text"])["text"].to_pylist()
    odd = [None, "", " ", "a", "\n\n  x \t y", "日本語のテキスト", "🙂🙂 é", "<|endoftext|> and </s><s>", "▁ under", "=" * 5000, "\x00z", " lead", "ﬁ", "<0x41>", "é" * 40, "0123456789" * 300]
    return odd + given[:60] + ["".join(chr(rng.choice([32, 65, 97, 233, 8364, 128512]) + rng.randrange(3)) for _ in range(200)) for _ in range(10)]


@functools.cache
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def tokens(text):
    a, b = libraries()
    letters = byte_letters()
    x = a.encode(" " + text, add_special_tokens=False).ids
    y = b.encode(text)
    xb = [bytes(letters[c] for c in a.id_to_token(i)) for i in x]
    yb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in y for p in [b.id_to_piece(i)]]
    whole = (" " + text).encode()
    return (x, y, xb, yb) if b"".join(xb) == whole == b"".join(yb) else None


def groups(text):
    found = text and tokens(text)
    if not found:
        return []
    x, y, xb, yb = found
    ends = [set(np.cumsum([len(p) for p in side]).tolist()) for side in (xb, yb)]
    cuts = sorted(ends[0] & ends[1])
    of = [[bisect.bisect_left(cuts, e) for e in np.cumsum([len(p) for p in side])] for side in (xb, yb)]
    return [([t for t, g in zip(x, of[0]) if g == i], [t for t, g in zip(y, of[1]) if g == i]) for i in range(len(cuts))]


@pytest.mark.parametrize("limits", [{}, {"LARGE_GROUP": 2, "STEP": 4, "HELD_PAIRS": 50, "CHUNK_BYTES": 3000}])
def test_equals_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(alignment, name, value)
    texts = corpus()
    texts = texts + texts[20:23]
    held = [groups(t) for t in texts]
    pairs = [Counter((a, b) for g in gs for a in g[0] for b in g[1]) for gs in held]
    count = Counter(p for c in pairs for p in c)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    ids = [i if i % 7 else -1 - i for i in range(len(texts))]
    want = sorted((i, sum(len(g[0]) for g in gs), sum(len(g[1]) for g in gs), len(gs), sum(c.values()),
                   ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in gs),
                   sum(n for p, n in c.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in c.items()))
                  for i, gs, c in zip(ids, held, pairs))
    docs = spark.createDataFrame([(i, t, "own") for i, t in zip(ids, texts)], "doc_id long, text string, n_a string").repartition(3)
    aligned = alignment.align(docs, A, B)
    for broadcast_pairs in (1 << 20, 0):
        got = alignment.weigh(aligned, alignment.vocabulary_size(B), broadcast_pairs)
        assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
        assert sorted(tuple(r) for r in got.collect()) == want
    assert sum(bool(g) for g in held) > 60 and max(c.total() for c in pairs) > 400


def test_query_digests(spark):
    from laborlens.llm import queries

    docs = queries.table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.QUERIES["op13_token_alignment"](spark, SF).collect()}
    assert len(got) == len(docs)
    for r in docs[::9]:
        gs = groups(r.text)
        text = ";".join(f"{','.join(map(str, g[0]))}|{','.join(map(str, g[1]))}" for g in gs)
        assert got[r.doc_id].groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")
        assert (got[r.doc_id].n_groups, got[r.doc_id].n_a) == (len(gs), sum(len(g[0]) for g in gs))


def test_empty_tables_and_missing_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.weigh(alignment.align(docs, A, B), 32_000).collect() == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id string, text string")
    for broadcast_pairs in (1 << 20, 0):
        got = alignment.weigh(alignment.align(docs, A, B), 32_000, broadcast_pairs).collect()
        assert sorted((str(r.doc_id), r.n_links, r.n_best, r.count_sum) for r in got) == [("1", 0, 0, 0), ("None", 2, 2, 4), ("None", 2, 2, 4)]


@pytest.mark.parametrize("special", [True, False])
def test_byte_encoder_equals_its_library(special):
    texts = [t for t in corpus() if t is not None] + ["a" * 50_000, " " * 50_000, "x<|endoftext|>", "'s 'S ''ll don't", "\r\n  x"]
    slow = Tokenizer.from_file(A)
    slow.encode_special_tokens = not special
    encoder = ByteEncoder(A, special)
    assert encoder.fast is not None
    want = [slow.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want
    encoder.fast, encoder.slow = None, slow
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_other_vocabularies_run_by_their_own_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = ByteEncoder(path)
    assert encoder.fast is None
    assert encoder.encode(["Two words"])[0].tolist() == Tokenizer.from_file(path).encode("Two words", add_special_tokens=False).ids
