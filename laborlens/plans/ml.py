"""Learned models on ``pyspark.ml``: clusters, quality scores and text classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.profile import zero_filled
from .tables import materialize

SPAM_THRESHOLD = 0.85  # fixed value: the score from which a posting counts as junk


def demand_vectors(df: DataFrame, key: str = "skill_name", date_col: str = "period_start", value: str = "demand_count") -> DataFrame:
    """One vector per series: its share of demand in every month of the table.

    A vector is as long as the calendar.
    """
    filled = zero_filled(df, key, date_col, value)
    points = F.array_sort(F.collect_list(F.struct(date_col, F.col(value).cast("double").alias("y"))))
    series = filled.groupBy(key).agg(points.alias("_points"), F.sum(value).cast("double").alias("_total"))
    shares = F.transform("_points", lambda p: F.coalesce(F.try_divide(p["y"], F.col("_total")), F.lit(0.0)))
    return series.select(key, array_to_vector(shares).alias("features"))


def trend_clusters(df: DataFrame, k: int = 20, seed: int = 42, key: str = "skill_name", **columns: str) -> DataFrame:
    """k-means over the demand vectors: (key, cluster)."""
    vectors = demand_vectors(df, key, **columns)
    model = KMeans(k=k, seed=seed, featuresCol="features", predictionCol="cluster").fit(vectors)
    return model.transform(vectors).select(key, "cluster")


def text_features(text: str) -> dict[str, Column]:
    """Simple shape features of a posting text."""
    length = F.length(text)
    words = F.size(F.split(F.trim(text), r"\s+"))

    def share(pattern: str) -> Column:
        return F.coalesce(F.try_divide(F.regexp_count(text, F.lit(pattern)).cast("double"), length), F.lit(0.0))

    return {
        "f_log_length": F.log1p(length.cast("double")),
        "f_word_length": F.coalesce(F.try_divide(length.cast("double"), words), F.lit(0.0)),
        "f_digits": share(r"\d"),
        "f_upper": share(r"\p{Lu}"),
        "f_symbols": share(r"[^\p{L}\p{N}\s]"),
        "f_lines": share(r"\n"),
        "f_links": share(r"https?://"),
    }


def _features(text: str | None) -> dict[str, Column]:
    return text_features(text) if text else {n: F.col(n) for n in text_features("text")}


def measure_texts(df: DataFrame, columns: Sequence[str], text: str = "text") -> DataFrame:
    """The ``columns`` named and the shape features in place of the text.

    For texts that are both fitted and scored: they are read once, and joins move numbers.
    """
    return df.select(*columns, *[c.alias(n) for n, c in text_features(text).items()])


def fit_quality_model(
    labelled: DataFrame, text: str | None = "text", label: str = "label", max_rows: int | None = None
) -> PipelineModel:
    """Logistic regression on the shape features; ``label`` is 1 for junk.

    Fitted on every labelled row unless ``max_rows`` asks for that many, the first ones by a hash of the text.
    Without ``text`` the rows come from ``measure_texts``.
    """
    features = _features(text)
    # each text is measured once, where it is read; an ordering moves its hash and numbers only
    measured = labelled.dropna(subset=[*([text] if text else features), label]).select(
        F.col(label).cast("double").alias("label"), *[c.alias(n) for n, c in features.items()],
        F.xxhash64(*([text] if text else features)).alias("_hash"))
    if max_rows is not None:
        measured = measured.orderBy("_hash").limit(max_rows)
    rows = materialize(measured.drop("_hash"), "quality-rows")
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True),
        LogisticRegression(maxIter=50, regParam=0.01),
    ]).fit(rows)


def posting_quality_score(
    df: DataFrame, model: PipelineModel, identity: Sequence[str], text: str | None = "text", threshold: float = SPAM_THRESHOLD
) -> DataFrame:
    """Junk probability per posting and whether it reaches the threshold. Without ``text`` the rows come from ``measure_texts``."""
    rows = df.select(*identity, *[c.alias(n) for n, c in _features(text).items()])
    scored = model.transform(rows).withColumn("spam_probability", vector_to_array("probability")[1])
    return scored.select(*identity, "spam_probability", (F.col("spam_probability") >= threshold).alias("is_spam"))


def fit_text_classifier(
    labelled: DataFrame, text: str = "text", label: str = "category", features: int = 1 << 14, max_rows: int = 20_000
) -> PipelineModel:
    """TF-IDF over hashed words and a multinomial logistic regression.

    Fitted on at most ``max_rows`` labelled rows, the first ones by a hash of the text.
    """
    labelled = labelled.dropna(subset=[text, label]).orderBy(F.xxhash64(text)).limit(max_rows)
    return Pipeline(stages=[
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
        RegexTokenizer(inputCol=text, outputCol="words", pattern=r"[^\p{L}\p{N}]+"),
        HashingTF(inputCol="words", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features", minDocFreq=2),
        LogisticRegression(maxIter=20, regParam=0.01, family="multinomial"),
    ]).fit(labelled.select(text, label))


def classify_text(df: DataFrame, model: PipelineModel, identity: Sequence[str], text: str = "text") -> DataFrame:
    """Most likely category per text with its probability."""
    names = F.array(*[F.lit(n) for n in model.stages[0].labels])
    scored = PipelineModel(stages=model.stages[1:]).transform(df.select(*identity, text))
    return scored.select(
        *identity,
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("category"),
        F.array_max(vector_to_array("probability")).alias("probability"),
    )
