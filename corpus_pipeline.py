"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as the
next stage's ``docs``. All stages but the last return the columns of their input, whatever further ones it has and
whatever these are called; the last returns pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from laborlens.llm import decontaminate, jaccard_join, langid, packing
from laborlens.llm.common import stored
from laborlens.llm.queries import table

#: Near copies: shingles of five words, Jaccard similarity of 0.8 at least.
SHINGLE, SIMILARITY = 5, 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; null and empty texts and texts without a letter go.

    Learned from the labelled rows of three of four folds; without any, no language is found and nothing stays. Rows
    without id teach nothing and are judged like others, repeated rows each for themselves.
    """
    trees = langid.learn(docs.filter(langid.fold(F.col("doc_id")) != 2))
    return langid.known_language(docs, trees)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, that with the smallest id.

    Rows without id and texts without words link with nothing and stay; of repeated rows one stays.
    """
    return jaccard_join.first_of_class(docs, width=SHINGLE, percent=SIMILARITY)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any ten words in a row of a benchmark item.

    Null and empty texts, and all documents where the benchmark is empty, stay; rows are judged each for themselves.
    """
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed; null and empty texts have the end id alone, repeated rows are packed each.

    An empty table gives no sequences.
    """
    import public_tokenizers

    return packing.digests(packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language id", language),
    ("n-gram jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", sequences),
]

#: Language models, similarity classes and tokens aren't expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
