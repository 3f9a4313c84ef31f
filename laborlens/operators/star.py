"""A star schema that grows by loads: fact, dimensions and the bridge between postings and their skills.

Members of a dimension get a whole number once and keep it. A load adds the members that aren't there yet, numbered
on from the largest key, and its own fact and bridge rows; earlier rows are never touched, so keys stay what they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..plans.tables import materialize

#: Parts in which new members are numbered side by side.
PARTS = 256


@dataclass(frozen=True)
class Star:
    """``dimensions`` have ``<name>_key`` and their attributes, ``fact`` the keys and measures, each of ``bridges`` the
    posting's id and a member's key."""

    fact: DataFrame
    dimensions: Mapping[str, DataFrame]
    bridges: Mapping[str, DataFrame] = field(default_factory=dict)


def _same(left: DataFrame, right: DataFrame, attributes: Sequence[str]) -> Column:
    """Equal attributes; a missing one equals a missing one."""
    condition = F.lit(True)
    for a in attributes:
        condition = condition & left[a].eqNullSafe(right[a])
    return condition


def grown(members: DataFrame, name: str, attributes: Sequence[str], held: DataFrame | None = None) -> DataFrame:
    """The dimension with those of ``members`` that it hasn't got yet.

    New members are spread over parts by a hash; a part's keys follow those of the parts before it, so no task
    numbers them all. Equal loads give equal keys.
    """
    key = f"{name}_key"
    found = members.select(*attributes).distinct()
    if held is not None:
        found = found.join(held, _same(found, held, attributes), "left_anti")
    found = materialize(found.withColumn("_part", F.pmod(F.xxhash64(*attributes), F.lit(PARTS))), f"{name}-members")
    last = F.lit(0) if held is None else held.agg(F.coalesce(F.max(key), F.lit(0))).scalar()
    # one row a part: the unpartitioned window adds up 256 counts at most
    before = F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_n")
    starts = found.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select("_part", (before + last).alias("_start"))
    place = F.row_number().over(W.partitionBy("_part").orderBy(*attributes))
    fresh = found.join(starts, "_part").select((F.col("_start") + place).cast("bigint").alias(key), *attributes)
    fresh = materialize(fresh, f"{name}-keys")
    return fresh if held is None else held.select(key, *attributes).unionByName(fresh)


def _keyed(rows: DataFrame, dimension: DataFrame, name: str, attributes: Sequence[str]) -> DataFrame:
    """The rows with the member's key in place of its attributes."""
    own = dimension.select(F.col(f"{name}_key"), *[F.col(a).alias(f"_{name}_{a}") for a in attributes])
    condition = F.lit(True)
    for a in attributes:
        condition = condition & F.col(a).eqNullSafe(F.col(f"_{name}_{a}"))
    return rows.join(own, condition).drop(*[f"_{name}_{a}" for a in attributes])


def load_star(
    postings: DataFrame, dimensions: Mapping[str, Sequence[str]], measures: Sequence[str], bridges: Mapping[str, str] | None = None,
    posting_id: str = "id", held: Star | None = None,
) -> Star:
    """The star after a load of postings that it hasn't got yet.

    ``dimensions`` name their attribute columns, ``bridges`` an array column each, whose distinct entries are the
    members of a dimension of that name with the attribute ``name``. A posting without entries has no bridge rows,
    null entries are none. Missing attributes are members too, so every posting finds its keys.
    """
    bridges = bridges or {}
    tables, links = {}, {}
    fact = postings
    for name, attributes in dimensions.items():
        tables[name] = grown(postings, name, attributes, held and held.dimensions[name])
        fact = _keyed(fact, tables[name], name, attributes)
    for name, column in bridges.items():
        entries = postings.select(posting_id, F.explode(F.array_distinct(column)).alias("name")).filter("name IS NOT NULL")
        tables[name] = grown(entries, name, ["name"], held and held.dimensions[name])
        links[name] = _keyed(entries, tables[name], name, ["name"]).select(posting_id, f"{name}_key")
    fact = fact.select(posting_id, *[f"{name}_key" for name in dimensions], *[m for m in measures if m != posting_id])
    if held is not None:
        fact = held.fact.unionByName(fact)
        links = {name: held.bridges[name].unionByName(rows) for name, rows in links.items()}
    return Star(fact, tables, links)
