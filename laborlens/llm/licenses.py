"""License scan by diagonal voting, on Spark expressions alone.

All rolling word k-grams of every text are joined with the k-grams of the templates. A match at word p of the text
and word t of the template votes for the diagonal p - t; a text that holds the template votes often for one
diagonal, an edited text for a few neighbouring ones, which are merged. A merged span counts when enough of the
template's words stand in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import ascii_lower

#: Phrases and their labels. Every place where the words stand consecutively counts.
PHRASES = {
    "gpl": "gnu general public license",
    "apache": "apache license",
    "cc-by": "cc by",
    "mit": "mit license",
}
#: Lines and notices of well-known licenses, found with small changes too.
NOTICES = {
    "apache-2.0": "licensed under the apache license version 2 0",
    "apache-2.0-notice": "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
    "bsd-notice": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "licensed under cc by nc 4 0",
    "gpl-3.0": "this work is licensed under the gnu general public license version 3",
    "gpl-notice": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "isc-notice": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
    "mit-line": "released under the mit license",
    "mit-notice": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mpl-2.0-notice": "this source code form is subject to the terms of the mozilla public license v 2 0",
}
PHRASE_GRAM, NOTICE_GRAM = 2, 3
#: Diagonals of a notice so many words apart are one span; the span counts with so large a part of its words.
SLACK, SHARE = 3, 0.8
#: Characters between words, after lower-casing.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def template_rows() -> list[tuple]:
    """label, base, words, slack, k, place and the k words from there, for every template k-gram."""
    rows = []
    for base, texts, k, slack in ((True, PHRASES, PHRASE_GRAM, 0), (False, NOTICES, NOTICE_GRAM, SLACK)):
        for label, text in texts.items():
            words = text.split()
            rows += [(label, base, len(words), slack, k, t, *(words[t:t + k] + [None])[:3]) for t in range(len(words) - k + 1)]
    return rows


def template_values() -> str:
    """The rows as a SQL VALUES list; words and labels have no quotes."""
    quoted = [["NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v).lower() for v in r] for r in template_rows()]
    return ", ".join(f"({', '.join(r)})" for r in quoted)


def _grams(second, third):
    """Hashes of the two and three words from a place on; null where the text ends."""
    return (F.when(second.isNotNull(), F.xxhash64(F.lit(PHRASE_GRAM), "w0", second)),
            F.when(third.isNotNull(), F.xxhash64(F.lit(NOTICE_GRAM), "w0", second, third)))


def _templates(spark: SparkSession) -> DataFrame:
    two, three = _grams(F.col("w1"), F.col("w2"))
    rows = spark.sql(f"SELECT * FROM VALUES {template_values()} AS t(label, base, size, slack, k, t, w0, w1, w2)")
    return rows.withColumn("gram", F.when(F.col("k") == PHRASE_GRAM, two).otherwise(three)).withColumnsRenamed({"w0": "t0", "w1": "t1", "w2": "t2"})


def _worded(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    words = F.array_remove(F.split(ascii_lower(F.coalesce(F.col(text), F.lit(""))), BETWEEN), "")
    return docs.select(F.col(doc_id).alias("id"), F.xxhash64(text).alias("mark"), words.alias("words"))


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Verified spans: ``id, mark, label, base, first, last, share``; words count from 0, rows with equal id and text are one."""
    spark = docs.sparkSession
    placed = _worded(docs, doc_id, text).select("id", "mark", "words", F.posexplode("words").alias("p", "w0"))
    second, third = F.get("words", F.col("p") + 1), F.get("words", F.col("p") + 2)
    grams = placed.select("id", "mark", "p", "w0", second.alias("w1"), third.alias("w2"), F.explode(F.array(*_grams(second, third))).alias("gram"))
    same = (F.col("w0") == F.col("t0")) & (F.col("w1") == F.col("t1")) & (F.col("t2").isNull() | (F.col("w2") == F.col("t2")))
    # the templates are fixed above, about 200 rows
    votes = grams.join(F.broadcast(_templates(spark)), "gram").filter(same).select(
        "id", "mark", "label", "base", "size", "slack", "k", "t", "p", (F.col("p") - F.col("t")).alias("diagonal")).distinct()
    one_template = Window.partitionBy("id", "mark", "label").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(one_template) > F.col("slack")
    merged = votes.withColumn("opens", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("span", F.sum("opens").over(one_template))
    key = ["id", "mark", "label", "base", "size", "span"]
    covered = merged.select(*key, "p", "k", F.explode(F.sequence("t", F.col("t") + F.col("k") - 1)).alias("word"))
    found = covered.groupBy(*key).agg(
        F.min("p").alias("first"), F.max(F.col("p") + F.col("k") - 1).alias("last"), F.count_distinct("word").alias("covered"))
    share = F.col("covered") / F.col("size")
    return found.withColumn("share", share).filter(
        F.when(F.col("base"), F.col("covered") == F.col("size")).otherwise((share >= SHARE) & (F.col("last") - F.col("first") < 2 * F.col("size")))
    ).select("id", "mark", "label", "base", "first", "last", "share")


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for every row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score``.

    ``n_base`` counts the places of the phrases, ``first_word`` and ``last_word`` are their smallest and largest
    start; ``score`` is the largest part of a template found, 1 with any phrase and 0 with nothing. Null and empty
    texts have no words. Null ids and repeated rows are kept; further columns are left out.
    """
    found = spans(docs, doc_id, text)
    start = F.when(F.col("base"), F.col("first"))
    label = F.when(F.col("base"), F.col("label"))
    found = found.groupBy("id", "mark").agg(
        F.count(start).alias("n_base"), F.min(start).alias("first_word"), F.max(start).alias("last_word"),
        F.concat_ws(",", F.array_sort(F.collect_set(label))).alias("base_labels"),
        F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"), F.max("share").alias("score"),
    ).withColumnsRenamed({"id": "found_id", "mark": "found_mark"})
    rows = _worded(docs, doc_id, text).select("id", "mark", F.size("words").cast("bigint").alias("n_words"))
    joined = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("mark") == F.col("found_mark")), "left")
    return joined.select(
        F.col("id").alias(doc_id), "n_words", F.coalesce("n_base", F.lit(0)).alias("n_base"), F.col("first_word").cast("bigint").alias("first_word"),
        F.col("last_word").cast("bigint").alias("last_word"), F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"))
