"""The queries of this folder and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import scratch_path
from . import alignment, chat, decontaminate, embedding_dedup, html_text, jaccard_join, langid, licenses, negatives, packing, quality, sharding, warc

Runner = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Runner] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Runner], Runner]:
    def register(run: Runner) -> Runner:
        QUERIES[run.__name__] = run
        if sql:
            SQL[run.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


DECONTAMINATION_SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
pattern AS (
  SELECT DISTINCT id, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS p
  FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0)),
doc AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
place AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS p
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc CROSS JOIN (SELECT DISTINCT k FROM pattern) WHERE len(w) >= k)),
found AS (SELECT doc_id, place.k, i, id FROM place JOIN pattern USING (p) WHERE place.k = pattern.k),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""


@query(DECONTAMINATION_SQL)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of benchmark words in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query()
def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents that share 85 in 100 of their four-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.similar_documents(docs, width=4, percent=85).drop("mark")


@query()
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.counted(html_text.main_text(pages, html_text.train(spark)))


#: Bytes of a shard in the query; small enough to split the smallest given table.
SHARD_BYTES = 1 << 18

SHARDING_SQL = f"""
WITH doc AS (
  SELECT doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))), 1, 15) AS BIGINT) AS hash
  FROM documents),
bucket AS (
  SELECT depth, hash >> (60 - depth) AS prefix, sum(n_bytes) AS bytes
  FROM doc CROSS JOIN (SELECT unnest(range(0, 40)) AS depth) GROUP BY ALL),
leaf AS (
  SELECT doc_id, n_bytes, hash, min(bucket.depth) AS depth
  FROM doc JOIN bucket ON hash >> (60 - bucket.depth) = prefix WHERE bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT doc_id, n_bytes, CASE WHEN leaf.depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(leaf.depth AS INTEGER), '0') END AS shard,
       CAST(leaf.depth AS INTEGER) AS depth, CAST(bytes AS BIGINT) AS shard_bytes
FROM leaf JOIN bucket ON leaf.depth = bucket.depth AND hash >> (60 - bucket.depth) = prefix"""


@query(SHARDING_SQL)
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document, a quarter of a MiB of text at most."""
    return sharding.assign(table(spark, sf_dir, "documents"), SHARD_BYTES)


CHAT_SQL = """
WITH RECURSIVE call AS (
  SELECT conv_id, conv_id || '-' || turn AS call_id, turn AS call_turn, 'reply' AS name, text,
         CASE WHEN EXISTS (SELECT 1 FROM conversations b WHERE b.conv_id = a.conv_id AND b.turn = a.turn - 2 AND b.role = 'user')
              THEN conv_id || '-' || (turn - 2) END AS need
  FROM conversations a WHERE role = 'user'),
result AS (SELECT conv_id, conv_id || '-' || (turn - 1) AS call_id, turn AS result_turn, text AS content FROM conversations WHERE role = 'assistant'),
level AS (
  SELECT conv_id, call_id, 0 AS level FROM call WHERE need IS NULL
  UNION ALL
  SELECT call.conv_id, call.call_id, level + 1 FROM call JOIN level ON call.conv_id = level.conv_id AND call.need = level.call_id),
joined AS (SELECT * FROM call FULL JOIN result USING (conv_id, call_id) LEFT JOIN level USING (conv_id, call_id)),
message AS (SELECT * FROM conversations WHERE role IS NULL OR role NOT IN ('user', 'assistant'))
SELECT conv_id, call_id, name, call_turn, result_turn, CAST(level AS INTEGER) AS level,
       CASE WHEN name IS NULL THEN 'orphan' WHEN content IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       CASE WHEN name IS NOT NULL AND text IS NULL THEN 'question is no string' ELSE '' END AS violations,
       '{' || concat_ws(',',
         CASE WHEN name IS NULL THEN NULL ELSE '"arguments":{' || concat_ws(',', '"after":' || to_json(coalesce(need, '')), '"question":' || to_json(text), '"turn":' || call_turn) || '}' END,
         '"content":' || to_json(content), '"id":' || to_json(call_id), '"name":' || to_json(name)) || '}' AS json
FROM joined
UNION ALL
SELECT conv_id, conv_id || '-' || turn, NULL, turn, NULL, 0, 'message', '',
       '{' || concat_ws(',', '"content":' || to_json(text), '"id":' || to_json(conv_id || '-' || turn), '"role":' || to_json(role)) || '}'
FROM message"""


@query(CHAT_SQL)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user turn as a call that names the call before it, every assistant turn as the result of the turn before,
    and the turns of other roles as messages."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    asked = turns.filter("role = 'user'")
    name = F.concat_ws("-", "conv_id", "turn")
    before = asked.select("conv_id", (F.col("turn") + 2).alias("turn"), name.alias("after"))
    arguments = F.to_json(F.struct("turn", F.col("text").alias("question"), F.coalesce("after", F.lit("")).alias("after")))
    calls = asked.join(before, ["conv_id", "turn"], "left").select(
        "conv_id", name.alias("call_id"), "turn", F.lit("reply").alias("name"), arguments.alias("arguments"))
    results = turns.filter("role = 'assistant'").select(
        "conv_id", F.concat_ws("-", "conv_id", F.col("turn") - 1).alias("call_id"), "turn", F.col("text").alias("content"))
    properties = spark.sql("SELECT * FROM VALUES ('reply', 'after', 'string', true), ('reply', 'question', 'string', true), "
                           "('reply', 'turn', 'integer', true) AS t(name, property, kind, required)")
    others = turns.filter("role IS NULL OR role NOT IN ('user', 'assistant')").select("conv_id", name.alias("call_id"), "turn", "role", F.col("text").alias("content"))
    linked = chat.link_calls(calls, results, properties).unionByName(chat.messages(others))
    return linked.withColumn("violations", F.concat_ws(",", "violations"))


@query()
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three of four folds."""
    docs = table(spark, sf_dir, "documents")
    fold = langid.fold(F.col("doc_id"))
    trees = langid.learn(docs.filter(fold != 2))
    return langid.identify(docs.select("doc_id", "text"), trees).select(
        "doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query()
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of embeddings with a cosine of 0.9 at least."""
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


WARC_SQL = f"""
WITH page AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
named AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM page)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM named"""


@query(WARC_SQL)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to archives and read back."""
    path = scratch_path(spark, "archives")
    warc.write_archives(warc.plan_records(table(spark, sf_dir, "pages")), path)
    found = warc.read_archives(spark, path, payloads=False).filter("gap IS NULL")
    return found.select(F.col("id").try_cast("bigint").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast("bigint").alias("refers_to"))


def _licenses_sql() -> str:
    """The same spans from joins on the words themselves."""
    return f"""
WITH template(label, base, size, slack, k, t, t0, t1, t2) AS (VALUES {licenses.template_values()}),
doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(0, len(w))) AS p FROM doc),
vote AS (
  SELECT DISTINCT doc_id, label, base, size, slack, k, t, p, p - t AS diagonal
  FROM place JOIN template ON w[p + 1] = t0 AND w[p + 2] = t1 AND (t2 IS NULL OR w[p + 3] = t2)),
opened AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, label ORDER BY diagonal) <= slack THEN 0 ELSE 1 END AS opens FROM vote),
merged AS (SELECT *, sum(opens) OVER (PARTITION BY doc_id, label ORDER BY diagonal) AS span FROM opened),
covered AS (SELECT *, unnest(range(t, t + k)) AS word FROM merged),
span AS (
  SELECT doc_id, label, base, size, span, min(p) AS first, max(p + k - 1) AS last, count(DISTINCT word) AS n
  FROM covered GROUP BY ALL),
kept AS (
  SELECT *, n / size AS share FROM span
  WHERE CASE WHEN base THEN n = size ELSE n / size >= {licenses.SHARE} AND last - first < 2 * size END),
found AS (
  SELECT doc_id, count(*) FILTER (base) AS n_base, min(first) FILTER (base) AS first_word, max(first) FILTER (base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
         string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM kept GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM doc LEFT JOIN found USING (doc_id)"""


@query(_licenses_sql())
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, packed into sequences of 1024."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return packing.digests(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


def _quality_sql() -> str:
    failures = " | ".join(f"(CASE WHEN {rule} THEN {1 << i} ELSE 0 END)" for i, rule in enumerate(quality.RULES.values()))
    last = quality.POLICIES[-1]
    return f"""
WITH doc AS (SELECT doc_id, row_number() OVER () AS place, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT doc_id, place, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM doc),
gram AS (
  SELECT place, i, array_to_string(w[i:i + 2], ' ') AS g
  FROM (SELECT place, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) > 2)),
again AS (SELECT place, i FROM (SELECT place, i, count(*) OVER (PARTITION BY place, g) AS c FROM gram) WHERE c > 1),
repeats AS (SELECT place, count(DISTINCT j) AS n FROM (SELECT place, unnest(range(i, i + 3)) AS j FROM again) GROUP BY place),
measured AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(length(regexp_replace(t, '[^A-Z]', '', 'g')) AS BIGINT) AS n_upper, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN repeats USING (place)),
ledger AS (SELECT *, CAST({failures} AS BIGINT) AS failures FROM measured)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT ((failures & {last.hard}) <> 0 OR bit_count(failures & {last.soft}) >= {last.least}) AS kept
FROM ledger"""


@query(_quality_sql())
def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every rule's measurement and failure bit for every document, and the decision of the last policy."""
    rows = quality.decide(quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text")))
    base = F.col("failures").bitwiseAND(F.lit(quality.BASE).cast("bigint")) != 0
    return rows.withColumn("base_failed", base).drop("text")


NEGATIVES_SQL = """
WITH vec AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM vec a JOIN vec b ON a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
ranked AS (
  SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank,
         id AS negative_id, positive_score, score AS negative_score
  FROM positive JOIN scored USING (anchor_id)
  WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3"""


@query(NEGATIVES_SQL)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three negatives for each of five positives of every fiftieth vector, some labels moved on by one."""
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


@query()
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies share the bytes of every document."""
    import public_tokenizers

    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    found = alignment.weigh(aligned.withColumn("groups_sha256", digest).drop("groups"), alignment.vocabulary_size(paths[1]))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
