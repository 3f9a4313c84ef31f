"""Chats, archives, pages, embeddings, languages and packing."""

import json
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from laborlens.llm import chat, embedding_dedup, html_text, langid, packing, page_layouts, warc

CALL = "conv_id long, call_id string, turn long, name string, arguments string, extra int"
RESULT = "conv_id long, call_id string, turn long, content string"
PROPERTY = "name string, property string, kind string, required boolean"


def linked(spark, calls, results):
    properties = [("find", "q", "string", True), ("find", "n", "number", False), ("find", "tags", "array", False)]
    return {(r.conv_id, r.call_id): r for r in chat.link_calls(
        spark.createDataFrame([(*c, 1) for c in calls], CALL), spark.createDataFrame(results, RESULT), spark.createDataFrame(properties, PROPERTY)).collect()}


def test_calls_are_linked_ordered_and_checked(spark):
    calls = [(1, "a", 0, "find", '{"q": "x", "n": 2}'), (1, "b", 2, "find", '{"q":"a","tags":[3, 1]}'), (1, "c", 4, "find", '{"q":"b","n":1.5}'),
             (1, "a", 0, "find", '{"q": "x", "n": 2}'), (1, "a", 9, "find", '{"q": "later"}'),
             (2, "a", 0, "find", '{"n":"2","z":null,"q":7}'), (2, "b", 1, "seek", "{}"), (2, "c", 2, "find", "[1]"), (2, "d", 3, "find", "no json"), (2, "e", 4, "find", None),
             (3, "x", 0, "find", '{"q":"y"}'), (3, "y", 1, "find", '{"q":"x"}'), (3, "z", 2, "find", '{"q":"y"}'), (None, "n", 0, "find", "{}"), (4, None, 0, "find", "{}")]
    results = [(1, "a", 1, "one"), (1, "a", 1, "one"), (1, "a", 3, "two"), (1, "b", 1, "early \"quoted\"\n"), (9, "q", 0, "alone"), (2, "c", None, "no turn")]
    got = linked(spark, calls, results)
    assert {k: r.status for k, r in got.items()} == {
        (1, "a"): "linked", (1, "b"): "early", (1, "c"): "unanswered", (2, "a"): "unanswered", (2, "b"): "unanswered", (2, "c"): "linked",
        (2, "d"): "unanswered", (2, "e"): "unanswered", (3, "x"): "unanswered", (3, "y"): "unanswered", (3, "z"): "unanswered", (9, "q"): "orphan"}
    assert [got[1, c].level for c in "abc"] == [0, 1, 2] and [got[3, c].level for c in "xyz"] == [-1, -1, -1]
    assert got[2, "a"].violations == ["n is no number", "q is no string", "unknown z"]
    assert (got[2, "b"].violations, got[2, "c"].violations, got[2, "d"].violations, got[2, "e"].violations) == (["unknown tool"], *[["not an object"]] * 3)
    assert got[1, "a"].json == '{"arguments":{"n":2,"q":"x"},"content":"one","id":"a","name":"find"}'
    for r in got.values():
        value = json.loads(r.json)
        assert r.json == json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def test_long_chains_and_cycles_are_ordered(spark, monkeypatch):
    written = []

    def counted(df, purpose, stored=chat.stored):
        written.append(purpose)
        assert len(written) < 30
        return stored(df, purpose)

    monkeypatch.setattr(chat, "stored", counted)
    call = lambda conv, i, *needs: (conv, f"c{i}", i, "find", json.dumps({k: f"c{n}" for k, n in zip(("q", "n", "tags"), needs)}))
    calls = [call(1, i, *[i - 1] * (i > 0)) for i in range(10_050)]
    calls += [call(2, i, *needs) for i, needs in enumerate([(), (0,), (1, 0), (2, 1), (3, 5), (4, 0), (5,), (1,)])]
    calls += [call(3, i, (i + 1) % 7) for i in range(7)] + [call(3, 7, 3), call(3, 8, 7, 9), call(3, 9)]
    got = linked(spark, calls, [])
    assert all(got[1, f"c{i}"].level == i for i in range(10_050))
    assert [got[2, f"c{i}"].level for i in range(8)] == [0, 1, 2, 3, -1, -1, -1, 2]
    assert [got[3, f"c{i}"].level for i in range(10)] == [-1] * 9 + [0]


def test_levels_equal_brute_force(spark):
    rng, needs = random.Random(5), {}
    for conv in range(40):
        for i in range(12):  # later calls are named in some conversations, so that cycles arise
            among = range(12) if conv % 2 else range(i)
            needs[conv, i] = sorted({rng.choice(among) for _ in range(rng.choice([0, 1, 1, 2, 3]))} - {i}) if among else []
    level = {k: 0 for k, v in needs.items() if not v}
    for _ in needs:
        level |= {(c, i): 1 + max(level[c, n] for n in v) for (c, i), v in needs.items() if v and all((c, n) in level for n in v)}
    calls = [(c, f"c{i}", i, "find", json.dumps({k: f"c{n}" for k, n in zip(("q", "n", "tags"), v)})) for (c, i), v in needs.items()]
    got = linked(spark, calls, [])
    assert {k: got[k[0], f"c{k[1]}"].level for k in needs} == {k: level.get(k, -1) for k in needs}


def test_ladders_are_ordered_in_few_steps(spark, monkeypatch):
    written = []

    def counted(df, purpose, stored=chat.stored):
        written.append(purpose)
        assert len(written) < 20
        return stored(df, purpose)

    monkeypatch.setattr(chat, "stored", counted)
    calls = [(1, f"c{i}", i, "find", json.dumps({"q": f"c{i - 1}", "tags": [f"c{i - 2}"]} if i > 1 else {"q": "x"})) for i in range(1000)]
    got = linked(spark, calls, [])
    assert [got[1, f"c{i}"].level for i in range(1000)] == [0, 0, *range(1, 999)]


def test_needs_at_any_depth_and_of_any_tool(spark):
    calls = [(1, "a", 0, "find", '{"q":"x"}'), (1, 'b"é', 1, "seek", '{"deep":{"list":[1,["a"]]},"a":1}'),
             (1, "c", 2, "find", '{"tags":["b\\"\\u00e9"],"q":"none"}'),
             (1, "d", 3, "find", '{"c":"x"}'), (1, "e", 4, "find", "not c"), (1, "f", 5, "find", '["c"]'), (2, "g", 0, "find", '{"q":"c"}')]
    got = linked(spark, calls, [])
    assert {k[1]: r.level for k, r in got.items()} == {"a": 0, 'b"é': 1, "c": 2, "d": 0, "e": 0, "f": 3, "g": 0}


def test_nested_schemas_and_numbers(spark):
    schema = "name string, property string, kind string, required boolean, allowed array<string>, low double, high double"
    rules = [("book", "place", "object", True, None, None, None), ("book", "place.city", "string", True, ['"x"', '"y"'], None, None), ("book", "place.at", "array", False, None, None, None),
             ("book", "place.at[]", "number", False, None, 0.0, 9.5), ("book", "rows", "array", False, None, None, None), ("book", "rows[]", "object", False, None, None, None),
             ("book", "rows[].id", "integer", True, None, None, None), ("book", "size", "number", False, ["1", "2.5"], None, None), ("book", "free", "object", False, None, None, None)]
    arguments = {
        "good": '{"place":{"city":"x","at":[1,9.5,0]},"rows":[{"id":1},{"id":2}],"size":1.0,"free":{"any":[1]}}', "city": '{"place":{"city":"z"}}',
        "deep": '{"place":{"city":"y","at":[10,"a",-0.5],"more":1},"rows":[{},{"id":1.5},3],"size":25e-1}', "none": "{}", "text": '{"place":"x","size":3}', "twice": '{"place":{"city":"x","city":"y"}}',
        "numbers": '{"place":{"city":"x","at":[1e0, 1.50, 100e-2, -0, 0.10]}}', "broken": "{"}
    calls = spark.createDataFrame([(1, k, i, "book", v, 0) for i, (k, v) in enumerate(arguments.items())], CALL)
    found = chat.link_calls(calls, spark.createDataFrame([], RESULT), spark.createDataFrame(rules, schema))
    got = {r.call_id: r for r in found.collect()}
    assert {k: r.violations for k, r in got.items()} == {
        "good": [], "city": ["place.city is none of its values"], "none": ["missing place"], "text": ["place is no object", "size is none of its values"], "twice": ["repeated key"],
        "deep": ["missing rows[].id", "place.at[] is no number", "place.at[] is out of range", "rows[] is no object", "rows[].id is no integer", "unknown place.more"],
        "numbers": [], "broken": ["not an object"]}
    assert json.loads(got["numbers"].json)["arguments"]["place"]["at"] == [1, 1.5, 1, 0, 0.1]
    assert '"at":[1,1.5,1,0,0.1]' in got["numbers"].json and '"size":2.5' in got["deep"].json and '"size":1}' in got["good"].json
    assert json.loads(got["twice"].json)["arguments"] == {"text": arguments["twice"]}


def test_every_turn_is_in_the_output(spark):
    from laborlens.llm import queries

    sf = "/root/testdata/sf0.01"
    turns = {(r.conv_id, r.turn) for r in queries.table(spark, sf, "conversations").select("conv_id", "turn").collect()}
    rows = queries.QUERIES["op5_chat_formatting"](spark, sf).collect()
    assert {(r.conv_id, t) for r in rows for t in (r.call_turn, r.result_turn) if t is not None} == turns
    assert {r.status for r in rows} >= {"linked", "message"}


def test_no_calls(spark):
    assert linked(spark, [], []) == {}


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, digest string")


def test_archives_round_trip(spark, tmp_path):
    big, rng = "é" * 600, random.Random(1)
    texts = [big, big, big, "small", "small", None, "", "\x00\r\n\r\nWARC/1.1\r\n" + "z" * 2000, "".join(chr(rng.randrange(1, 0xD000)) for _ in range(100_000))]
    rows = [(i, f"http://x/{i} a\r\nb", t, "own") for i, t in enumerate(texts)] + [(None, None, big, None), (1, "http://x", big, None)]
    warc.write_archives(warc.plan_records(pages(spark, rows)), str(tmp_path / "a"), archive_bytes=3000)
    got = warc.read_archives(spark, str(tmp_path / "a")).collect()
    assert len(got) == len(rows) and not [r for r in got if r.gap]
    by = {r.id: r for r in got}
    assert [by[str(i)].record_type for i in range(9)] == ["revisit", "revisit", "response", *["response"] * 6]
    assert by["0"].refers_to == "2" and by["0"].payload_bytes == 1200 and by[""].record_type == "revisit"
    assert all(bytes(by[str(i)].payload) == (texts[i] or "").encode() for i in range(2, 9))
    assert by["0"].payload_digest == by["2"].payload_digest and by["0"].payload is None
    warc.write_archives(warc.plan_records(pages(spark, [])), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0


def test_damaged_archives_are_salvaged():
    plain = [warc.record(str(i), "u", b"payload %d" % i, "", None) for i in range(6)]
    members = [warc.member(p) for p in plain]
    ids = lambda data: [r.fields["warc-record-id"][10:-1] for r in warc.salvage(data) if r.reason is None]
    gaps = lambda data: [(r.offset, r.length) for r in warc.salvage(data) if r.reason]
    assert ids(b"".join(members)) == list("012345") and gaps(b"\0".join(members)) == []
    broken = bytearray(members[2])
    broken[len(broken) // 2] ^= 0xFF
    at = len(members[0] + members[1])
    for damage in (bytes(broken), members[2][:-9], b"noise", b""):
        data = b"".join(members[:2]) + damage + b"".join(members[3:])
        assert ids(data) == list("01345") and gaps(data) == ([(at, len(damage))] if damage else [])
    text = b"".join(plain)
    cut = text.replace(b"payload 1", b"payload X").replace(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:4>", b"")
    assert ids(cut) == list("0235")
    assert sum(n for _, n in gaps(cut)) + sum(r.length for r in warc.salvage(cut) if r.reason is None) == len(cut)
    assert ids(warc.member(cut)) == list("0235") and gaps(b"WARC/1.1\r\n" * 3) == [(0, 30)] and list(warc.salvage(b"")) == []


@pytest.mark.parametrize("level", [0, 4])
def test_records_before_a_damage_are_kept(level):
    rng = random.Random(3)
    plain = [warc.record(str(i), "u", rng.randbytes(3000), "", None) for i in range(60)]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    one = packer.compress(b"".join(plain)) + packer.flush()
    after = warc.member(warc.record("next", "u", b"x", "", None))
    read = lambda data: [(r.fields["warc-record-id"][10:-1] if r.fields else None, r.offset, r.length if r.reason else 0) for r in warc.salvage(data)]
    whole = [(str(i), 0, 0) for i in range(60)]
    trailer = one[:-8] + bytes([one[-8] ^ 1]) + one[-7:]
    assert read(trailer + after) == [*whole, (None, 0, len(one)), ("next", len(one), 0)]
    assert read(one[:-4]) == [*whole, (None, 0, len(one) - 4)]
    flipped = bytearray(one)
    flipped[len(one) // 2] ^= 0xFF
    got = [r[0] for r in read(bytes(flipped) + after)]
    assert got[:28] == [str(i) for i in range(28)] and got[-1] == "next" and None in got and len(set(got)) == len(got)
    bare = [p.replace(b"WARC-Block-Digest", b"X-Block-Digest") for p in plain[:2]]
    lost = bytearray(warc.member(b"".join(bare)))
    lost[-8] ^= 1
    assert read(bytes(lost)) == [(None, 0, len(lost))]


@pytest.fixture(scope="module")
def trees(spark):
    return html_text.train(spark, 250)


def test_main_text(spark, trees):
    right = total = 0
    for source in page_layouts.layouts(120, seed=5):
        page = html_text.Page(source)
        want = " ".join(t.replace(page_layouts.MARK, "") for t in page.text if page_layouts.MARK in t)
        page.labels()
        got = page.decode(trees.odds(page.features()))
        common = len(set(got.split()) & set(want.split()))
        right += 2 * common
        total += len(set(got.split())) + len(set(want.split()))
    assert right / total > 0.93
    rows = [(1, "<nav><a href=x>Home</a></nav><article><h1>T &amp; &eacute;</h1><p>One\n two&nbsp;three, and more of it.<p>Four <b>five</b>six seven.</article><footer>&copy; me</footer>", "a"),
            (1, None, "b"), (2, "", None), (3, "<script>var a='<p>no</p>'</script><!-- no -->", "c"), (None, "plain words only, no tags at all.", "d"), (4, "<div><" * 2000, "e"),
            (5, "<p>" + "word " * 100_000 + "end.", "f"), (6, "<a title=\"x>y", "g")]
    got = html_text.counted(html_text.main_text(spark.createDataFrame(rows, "page_id long, html string, text string"), trees))
    assert got.columns == ["page_id", "text", "n_chars"]
    texts = [r.text for r in got.collect()]
    assert texts[0] == "T & é One two three, and more of it. Four fivesix seven." and texts[1:4] == ["", "", ""] and len(texts) == 8
    assert texts[4] == "plain words only, no tags at all." and len(texts[6]) == 500_004


@pytest.mark.parametrize("source", [
    "<head><meta charset=x><title>no</title><script>'<p>no</p>'</script><!-- no --><article><p>aa</p></article>",
    "<html><head><title>no</title></head><article>aa</article>", "<head><title>no</title>aa", "<head><title>no<body><p>aa", "<head><title>no</head>aa",
    "<head><noscript><link></noscript><p>aa", "<head><noscript><p>aa", *(f"<{tag} x=1><p>aa" for tag in ("svg", "object", "video", "select", "noscript")),
    "<svg>no</svg><p>aa", "<svg><svg>" * 1000 + "<p>aa", "<p>aa<script>no<p>no", "<p>aa<textarea>no", "<title>no</title><p>aa<style>no"])
def test_text_behind_an_open_head_or_raw_element(source):
    assert [t for t in html_text.Page(source).text if t] == ["aa"]


def test_rejected_nodes_keep_nothing_below(trees):
    page = html_text.Page("<div><p>aa</p><p>bb</p></div><section><p>cc</p></section>")
    odds = {"div": -9.0, "section": 9.0}
    assert page.decode(np.array([odds.get(t, 1.0 if t == "#text" else 0.5) for t in page.tag])) == "cc"


def test_near_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64))
    x = [b + s * rng.normal(size=64) * np.linalg.norm(b) / 8 for b in base for s in (0, 0.2, 0.3, 0.4, 0.46)] + list(rng.normal(size=(300, 64)))
    x = [v.astype(np.float32).tolist() for v in x]
    odd = [None, [], [0.0] * 64, [float("nan")] + [1.0] * 63, [None] + [1.0] * 63, [float("inf")] + [1.0] * 63, [1.0, 2.0], [2.0, 4.0], [3e38] * 64, [1e38] * 64]
    rows = [(i, v, 0) for i, v in enumerate(x + odd)] + [(0, x[0], 1), (1000, x[0], 1), (None, x[0], 1)]
    got = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, kept int")).collect()
    assert len(got) == len(rows)
    unit = {}
    for k, (i, v, _) in enumerate(rows):
        if v and None not in v and np.isfinite(v).all() and any(v) and i is not None:
            u = np.array(v, np.float64) / np.abs(v).max()
            unit[k] = u / np.linalg.norm(u)
    links = {k: [j for j in unit if j != k and len(unit[j]) == len(unit[k]) and unit[j] @ unit[k] >= 0.9] for k in unit}
    true = sum(map(len, links.values()))
    found = sum(r.n_links for r in got)
    assert 0.99 * true <= found <= true
    by = {r.vec_id: r for r in got}
    at = len(x)
    assert all(by[at + j].n_links == 0 and by[at + j].kept for j in range(6)) and by[at + 7].component_id == at + 6 and by[at + 9].component_id == at + 8
    assert by[1000].component_id == 0 and not by[1000].kept and [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, True)]
    assert embedding_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_large_buckets_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    rng = np.random.default_rng(1)
    x = np.ones(64) + 0.01 * rng.normal(size=(150, 64))
    got = embedding_dedup.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")).collect()
    assert {r.n_links for r in got} == {149} and {r.component_id for r in got} == {0}


@pytest.mark.parametrize(("dim", "hashes"), [(64, 3), (64, 4), (64, 5), (64, 6), (384, 4)])
def test_recall_holds_with_more_hashes(dim, hashes):
    x, y = embedding_dedup.pairs_at(0.9, dim, 1500, seed=7)
    planned = embedding_dedup.scheme(dim, hashes, 0.9)
    met = embedding_dedup.meetings(embedding_dedup.buckets(x, *planned), embedding_dedup.buckets(y, *planned)).any(1).mean()
    print(dim, hashes, planned, met)
    assert met >= 0.99


@pytest.mark.parametrize("hashes", [5, 6])
def test_links_of_a_large_table_are_found(spark, monkeypatch, hashes):
    monkeypatch.setattr(embedding_dedup, "hashes_for", lambda rows, dim: hashes if dim == 64 else 1)
    x, y = embedding_dedup.pairs_at(0.901, 64, 300, seed=8)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([x, y]))] + [(900 + i, [1.0, i + 1.0]) for i in range(3)]
    got = {r.vec_id: r for r in embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert sum(got[300 + i].component_id == i for i in range(300)) >= 0.98 * 300 and [got[900 + i].n_links for i in range(3)] == [1, 2, 1]


def test_no_cosine_is_too_low(spark):
    x = np.random.default_rng(9).normal(size=(30, 16))
    got = embedding_dedup.near_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>"), least=-1.0).collect()
    assert embedding_dedup.scheme(16, 2, -1.0) == (0, 1) and {r.n_links for r in got} == {29}


TEXTS = {"en": "the cat and the dog went to the old house by the water where they found some bread", "fr": "le chat et le chien sont allés à la vieille maison près de l'eau où ils ont trouvé du pain",
         "de": "die katze und der hund gingen zu dem alten haus am wasser wo sie etwas brot fanden"}


def test_languages(spark):
    rng = random.Random(2)
    some = lambda lang, n: " ".join(rng.choices(TEXTS[lang].split(), k=n))
    learned = [(lang, some(lang, 40)) for lang in TEXTS for _ in range(30)] + [(None, "unlabelled"), ("xx", None)]
    trees = langid.learn(spark.createDataFrame(learned, "lang string, text string"))
    assert trees.langs == ["de", "en", "fr"]
    rows = [(i, some(lang, 12), lang) for i, lang in enumerate(list(TEXTS) * 30)]
    odd = [(900, None, "x"), (901, "", "x"), (902, "12 34 !?", "x"), (903, "Ж", "x"), (904, "THE CAT!!" * 30_000, "en"), (None, "the dog", "en"), (904, "the dog", None)]
    got = langid.identify(spark.createDataFrame(rows + odd, "doc_id long, text string, lang_pred string"), trees).collect()
    assert got[0].__fields__ == ["doc_id", "text", "lang_pred", "score"] and len(got) == len(rows) + len(odd)
    assert sum(r.lang_pred == lang for r, (_, _, lang) in zip(got, rows)) == len(rows)
    assert [r.lang_pred for r in got[90:93]] == ["und"] * 3 and [r.score for r in got[90:93]] == [0.0] * 3
    assert got[94].lang_pred == "en" and all(0 <= r.score <= 1 for r in got)
    nothing = langid.learn(spark.createDataFrame([], "lang string, text string"))
    assert nothing is None and {r.lang_pred for r in langid.identify(spark.createDataFrame(rows, "doc_id long, text string, l string"), nothing).collect()} == {"und"}


def test_copies_and_long_texts_leave_room_in_the_sample(spark, monkeypatch):
    monkeypatch.setattr(langid, "ContextTrees", lambda texts: {lang: sorted(map(len, ts)) for lang, ts in texts.items()})
    learn = lambda texts, **bounds: langid.learn(spark.createDataFrame([("en", t) for t in texts], "lang string, text string"), **bounds)
    texts = [f"{'the cat ' * 5}{i:03d}" for i in range(500)] + [f"{'x' * 900}{i:03d}" for i in range(50)]
    ordered = [r.text for r in spark.createDataFrame([(t,) for t in texts], "text string").orderBy(F.xxhash64("text")).collect()]
    shorts = [t for t in ordered if len(t) == 43]
    assert learn([shorts[0]] * 1000 + shorts) == {"en": [43] * 400}
    assert learn([shorts[0]] * 1000 + shorts, bytes_per_lang=43 * 100) == {"en": [43] * 100}
    second = [i for i, t in enumerate(ordered) if len(t) == 903][25]
    before = [t for t in ordered[:second] if len(t) == 43][:1]
    after = [t for t in ordered[second:] if len(t) == 43]
    assert learn([*before, ordered[second], *after], bytes_per_lang=910) == {"en": [43] * 21}


def test_code_lengths_are_exact():
    trees = langid.ContextTrees({"a": [b"abracadabra abra"] * 3, "b": [b"banana bandana"] * 3}, min_count=1)
    prob = np.exp2(-trees.cost.astype(float)).reshape(-1, trees.n, 2)
    assert np.allclose(prob.sum(1), 1)  # every context codes every byte, and nothing else
    one, two = trees.code_lengths([langid.letters(b"abra")]), trees.code_lengths([langid.letters(b"banana"), langid.letters(b"abra"), langid.letters(b"zz")])
    assert np.allclose(one[0], two[1])


def test_packing(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["word", "Wörter,", "it's", "\n", " ", "\t", "x\ny", "1234", "<|endoftext|>", "."], k=rng.choice([0, 1, 9, 700, 3000]))) for _ in range(60)]
    texts += [None, "", " ", "\n", "a", "long " * 50_000]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(0, texts[0], 5), (None, "no id", 5)]
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    pieces = packing.pack(docs, path).collect()
    from tokenizers import Tokenizer

    tokenizer, sequences, by = Tokenizer.from_file(path), {}, {}
    for p in pieces:
        assert len(p.ids) == 4 * p.length and 0 < p.length <= 1024
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by.setdefault(p.doc_id, []).append(p)
    for i, t in list(enumerate(texts))[1:]:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        own = sorted(by[i], key=lambda p: p.start)
        assert [p.start for p in own] == [sum(q.length for q in own[:k]) for k in range(len(own))] and {p.doc_tokens for p in own} == {len(ids)}
        assert b"".join(bytes(p.ids) for p in own) == np.array(ids, "<u4").tobytes()
    assert sum(p.length for p in by[0]) == 2 * by[0][0].doc_tokens and len(by[None]) == 1
    padding = 0
    for held in sequences.values():
        held.sort()
        assert [o for o, _ in held] == [sum(n for _, n in held[:k]) for k in range(len(held))]
        size = sum(n for _, n in held)
        assert size <= 1024
        padding += 0 if size & (size - 1) == 0 else 1024 - size
    assert padding == 0
    assert packing.pack(docs.limit(0), path).count() == 0
    first = packing.digests(packing.pack(docs, path)).first()
    assert first.ids_crc32 == zlib.crc32(bytes(next(p.ids for p in pieces if (p.sequence_id, p.offset) == (first.sequence_id, first.offset))))


def test_sum_of_squares_choice():
    packer = packing.Packer(10)
    for i, size in enumerate([6, 6, 3]):
        list(packer.add(i, bytes(4 * size)))
    # two windows at 6: adding 3 to one of them lowers the sum of squares, a new window raises it
    assert packer.counts[6] == 1 and packer.counts[9] == 1
