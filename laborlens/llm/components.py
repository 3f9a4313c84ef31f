"""Connected components over a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links`` (``src``, ``dst``: long); a component is its smallest node.

    Alternates large-star and small-star steps: every node hands its larger, then its smaller neighbours to the
    smallest one it sees, until a round changes nothing, after about log n of them. A step is an aggregate and a join on its result, so a node with
    very many neighbours is combined map-side and split by the adaptive join; each round is a written table.
    """
    star = links.select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).filter("src <> dst").distinct()
    before = None
    while True:
        star = stored(star, "links")
        mark = star.agg(F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first()
        if mark == before:
            nodes = star.select(F.col("src").alias("node"), F.col("dst").alias("component"))
            return nodes.union(star.select("dst", "dst")).distinct()
        before = mark
        both = star.union(star.select("dst", "src"))
        least = both.groupBy("src").agg(F.min("dst").alias("m")).select("src", F.least("src", "m").alias("m"))
        large = both.join(least, "src").filter("dst > src").select(F.col("dst").alias("src"), F.col("m").alias("dst")).filter("src <> dst").distinct()
        least = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(least, "src")
        star = small.select("src", F.col("m").alias("dst")).union(small.filter("dst <> m").select("dst", "m")).distinct()
