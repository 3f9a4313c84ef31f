"""Filters, joins, aggregates, windows, sampling and profiles on small frames."""

import datetime as dt
import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W, functions as F

from laborlens.operators import aggregates, analytics, filters, joins, paging, profile, projections, sampling, setops, star, windows
from laborlens.operators.quantiles import exact_percentiles


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def test_blank_criteria_are_absent(spark):
    df = spark.createDataFrame(
        [("50% Dev", "NY", True), ("Senior dev", "ny", False), (None, "LA", None)], "title string, location string, is_remote boolean"
    )
    assert filters.search_jobs(df, title=" ", location="").count() == 3
    assert filters.search_jobs(df, title="DEV", location="NY").count() == 2
    assert filters.search_jobs(df, title="0%").count() == 1  # taken literally
    assert filters.search_jobs(df, is_remote=True).count() == 1
    assert filters.search_jobs(df, is_remote=False).count() == 3


def test_exclude_periods_falls_back(series):
    df = series({"a": [1, 2, 3, 4, 5], "b": [1, 2, 3, None, None]})
    kept = filters.exclude_periods(df, ["2000-01-01"])
    assert rows(kept.groupBy("skill_name").count()) == [("a", 4), ("b", 3)]
    every = filters.exclude_periods(df, [f"2000-0{m}-01" for m in range(1, 6)])
    assert every.count() == 8


def test_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(dt.date(2000, 1, 1), 1)], "d date, v int").write.parquet(str(tmp_path / "t"))
    plan = filters.since(spark.read.parquet(str(tmp_path / "t")), "d", "2000-01-01")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(d,2000-01-01)" in plan


def test_listing_tokens_keep_blanks(spark):
    df = spark.createDataFrame([("a, b,,a",), ("",), (None,)], "skills string")
    assert rows(aggregates.listing_skill_counts(df)) == [("", 1), ("a", 2), ("b", 1)]


def test_avg_salary(spark):
    df = spark.createDataFrame([(1, 2), (3, None), (5, 6)], "salary_min int, salary_max int")
    df = df.select(*[F.col(c).cast("decimal(10,2)").alias(c) for c in df.columns])
    assert aggregates.avg_salary(df).first()[0] == 3.5
    assert aggregates.avg_salary(df.filter("salary_max is null")).first()[0] == 0.0


def test_predictions_limits(spark, series):
    df = series({"a": [1, 2]}).withColumnRenamed("demand_count", "predicted_demand")
    with pytest.raises(ValueError):
        aggregates.predictions(df, 0)
    with pytest.raises(ValueError):
        aggregates.predictions(df, 51)
    assert aggregates.predictions(df, 1, skill="a").first()[1] == 1.5


def test_nulls_lead_in_descending_order(spark):
    df = spark.createDataFrame([(1, dt.date(2020, 1, 1)), (2, None), (3, dt.date(2021, 1, 1))], "id int, posted_date date")
    assert [r.id for r in paging.page(df, paging.jobs_order(), 0, 2).collect()] == [2, 3]
    assert paging.page_info(df, 1, 2).first().asDict() == {"totalElements": 3, "totalPages": 2, "number": 1, "size": 2}
    with pytest.raises(ValueError):
        paging.page(df, paging.jobs_order(), -1)


def test_densify(spark, series):
    df = series({"a": [1, None, 3], "b": [7]}).unionByName(series({"a": [5]}))
    assert [r[2] for r in rows(joins.densify(df, "skill_name"))] == [6.0, 0.0, 3.0, 7.0]


def test_gaps(series):
    df = series({"a": [1] + [None] * 8 + [2, 3], "b": [1, None, 2]})
    assert [(r[0], r[3]) for r in rows(windows.gaps(df))] == [("a", 9)]


def test_cap_keeps_unknown_series(spark):
    forecast = spark.createDataFrame([("a", 100.0), ("z", 100.0)], "skill_name string, predicted_demand double")
    history = spark.createDataFrame([("a", 3), ("a", 2)], "skill_name string, demand_count int")
    assert rows(joins.cap_to_history(forecast, history)) == [("a", 15.0), ("z", 100.0)]


def test_related_skills_matches_brute_force(spark):
    rng = random.Random(1)
    posts = [sorted(rng.sample("abcdef", rng.randint(0, 4))) for _ in range(200)]
    df = spark.createDataFrame([(p,) for p in posts], "skills array<string>")
    got = {(r.target, r.skill): (r.co_count, r.co_occurrence, r.correlation) for r in joins.related_skills(df, ["a", "b"]).collect()}
    for target in "ab":
        for skill in set("abcdef") - {target}:
            x = np.array([target in p for p in posts], float)
            y = np.array([skill in p for p in posts], float)
            both, rate, phi = got[target, skill]
            assert both == (x * y).sum() and rate == pytest.approx((x * y).sum() / x.sum())
            assert phi == pytest.approx(np.corrcoef(x, y)[0, 1])


def test_trailing_window_falls_back(series):
    df = series({"a": [1, 2, 3] + [None] * 12 + [4], "b": list(range(12))})
    got = rows(windows.trailing_window(df).groupBy("skill_name").count())
    assert got == [("a", 3), ("b", 6)]


def test_constant_series(series):
    df = series({"a": [4, 4, 4]})
    assert {r.scaled for r in windows.minmax_scale(df).collect()} == {0.0}
    assert windows.sigma_flags(df).filter("is_outlier").count() == 0
    assert windows.endpoint_slope(series({"a": [4]})).first()[1] == 0.0


def test_folds(series):
    for n, sizes in ((3, []), (4, [1, 1, 1]), (24, [6, 6, 6])):
        folds = windows.time_series_folds(series({"a": list(range(n))}))
        tests = folds.filter("is_test").groupBy("fold").count().orderBy("fold")
        assert [r[1] for r in tests.collect()] == sizes
    trained = folds.filter("not is_test").groupBy("fold").count().orderBy("fold")
    assert [r[1] for r in trained.collect()] == [6, 12, 18]


def test_iqr_flags(series):
    values = [10, 11, 12, 11, 10, 12, 11, 100]
    df = series({"a": values})
    q1, q3 = np.percentile(values, [25, 75])
    for k in (1.5, 3.0):
        got = windows.iqr_flags(df, k).filter("is_outlier").select("demand_count").collect()
        assert [r[0] for r in got] == [v for v in values if v > q3 + k * (q3 - q1) or v < q1 - k * (q3 - q1)]


def test_positional_quantile(series):
    values = [5, 1, 4, 2, 3, 9, 7]
    assert windows.positional_quantile(series({"a": values})).first()[1] == sorted(values)[int(len(values) * 0.8)]


def test_top_n_per_key_with_a_hot_key(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < 0.7 else f"k{rng.randint(0, 5)}", rng.randint(0, 1000), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, v int, id int")
    got = rows(windows.top_n_per_key(df, ["k"], [F.desc("v"), F.asc("id")], 25, ["id"], salts=8))
    want = []
    for key in {d[0] for d in data}:
        want += sorted((d for d in data if d[0] == key), key=lambda d: (-d[1], d[2]))[:25]
    assert got == sorted(want)


@pytest.mark.parametrize("kind", ["uniform", "hot", "few", "one"])
def test_exact_percentiles(spark, kind):
    rng = np.random.default_rng(3)
    values = {
        "uniform": rng.normal(size=5000),
        "hot": np.where(rng.random(5000) < 0.4, 1.0, rng.random(5000) * 3),
        "few": rng.integers(0, 3, 50).astype(float),
        "one": np.array([4.0]),
    }[kind]
    probabilities = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    df = spark.createDataFrame(pd.DataFrame({"x": values, "y": values * 2 + 1})).withColumn("z", F.lit(None).cast("double"))
    got = {r[0]: r[1] for r in exact_percentiles(df, ["x", "y", "z"], probabilities).collect()}
    assert set(got) == {"x", "y"}
    assert got["x"] == pytest.approx(np.quantile(values, probabilities))
    assert got["y"] == pytest.approx(np.quantile(values * 2 + 1, probabilities))


def test_stratified_sample_with_a_hot_stratum(spark):
    data = [("hot", i) for i in range(4000)] + [("mid", i) for i in range(4000, 4200)] + [("few", i) for i in range(4200, 4210)]
    df = spark.createDataFrame(data, "month string, id int")
    first = rows(sampling.stratified_sample(df, "month", 100, ["id"]))
    assert {m: sum(r[0] == m for r in first) for m in ("few", "hot", "mid")} == {"few": 10, "hot": 33, "mid": 33}
    again = rows(sampling.stratified_sample(df.repartition(7), "month", 100, ["id"]))
    assert first == again and len(set(first)) == len(first)
    assert rows(sampling.stratified_sample(df, "month", 100, ["id"], seed=1)) != first


def test_sample_per_partition(spark):
    df = spark.range(1000)
    got = sampling.sample_per_partition(df, 10, ["id"], blocks=5)
    assert got.count() == 50 and got.distinct().count() == 50
    assert sampling.sample_per_partition(df, 5000, ["id"], blocks=5).count() == 1000


def test_repeat_rows(spark):
    df = spark.createDataFrame([("a", 0), ("b", 120), ("c", 999)], "k string, n int")
    got = sampling.repeat_rows(df, sampling.copies_per_hundred(F.col("n")))
    assert rows(got, "k", "copy_index") == [("b", 0), ("c", 0), ("c", 1)]
    got = sampling.repeat_rows(df, sampling.copies_per_fifty(F.col("n")))
    assert rows(got.groupBy("k").count()) == [("a", 1), ("b", 2), ("c", 19)]


def test_sample_takes_any_number_of_strata(spark):
    df = spark.range(120_000).select("id", F.concat(F.lit("s"), "id").alias("stratum"))
    assert sampling.stratified_sample(df, "stratum", 110_002, ["id"]).count() == 110_002


def test_block_sample_keeps_every_small_block(spark):
    df = spark.range(5_000)
    sizes = df.groupBy(F.pmod(F.xxhash64("id"), F.lit(3)).alias("block")).count().collect()
    got = sampling.sample_per_partition(df, 2_000, ["id"], 3)
    kept = {r.block: r["count"] for r in got.groupBy(F.pmod(F.xxhash64("id"), F.lit(3)).alias("block")).count().collect()}
    assert kept == {r.block: min(2_000, r["count"]) for r in sizes}


def test_percentiles_with_nan_and_infinity(spark):
    rows = [(1.0, float("nan")), (2.0, float("inf")), (float("nan"), 1.0), (None, 2.0), (4.0, 3.0)]
    got = {r.column_name: r.percentiles for r in exact_percentiles(spark.createDataFrame(rows, "a double, b double"), ["a", "b"], [0.0, 0.5, 1.0]).collect()}
    assert got == {"a": [1.0, 2.0, 4.0], "b": [1.0, 2.5, float("inf")]}


def test_facets_are_complete(spark):
    df = spark.range(60).select((F.col("id") % 25).cast("string").alias("company"))
    assert analytics.facet_counts(df, ["company"]).count() == 25
    assert analytics.facet_counts(df, ["company"], k=3).count() == 3


def test_normalize_demand_drops_incomplete_rows(spark):
    df = spark.createDataFrame([("2024-02-10", " Go ", "3"), ("x", "Go", "3"), ("2024-02-10", None, "3"), ("2024-02-10", "Go", "?")],
                               "day string, tool string, total string")
    got = projections.normalize_demand(df, "day", "tool", "total").collect()
    assert len(got) == 1 and got[0].skill_name == "Go" and got[0].period_end == dt.date(2024, 2, 29)


def test_mask_columns(spark):
    df = spark.createDataFrame([(1,), (None,)], "v int")
    masked = [r.v for r in projections.mask_columns(df, ["v"], "s").collect()]
    assert len(masked[0]) == 64 and masked[1] is None


def test_length_violations(spark):
    df = spark.createDataFrame([("USDX", "t"), ("USD", "t")], "salary_currency string, title string")
    assert dict(rows(projections.length_violations(df))) == {"salary_currency": 1, "title": 0}


def test_dedupe_latest(spark):
    df = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, 1, None)], "id int, at int, v string")
    assert rows(setops.dedupe_latest(df, ["id"], ["at"])) == [(1, 2, "new"), (2, 1, None)]


def test_histogram_closes_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    got = rows(profile.histogram(df, "x", 5), "bin", "n")
    assert got == [(1, 2), (2, 2), (3, 2), (4, 2), (5, 3)]
    assert rows(profile.histogram(spark.createDataFrame([(1.0,)] * 3, "x double"), "x", 5), "bin", "n") == [(1, 3)]


def test_timestamp_profile_of_text(spark):
    df = spark.createDataFrame([("2024-01-05",), ("2024-03-01T10:00:00",), ("bad",), (None,)], "t string")
    got = profile.timestamp_profile(df, "t").first()
    assert (got.non_null, got.months) == (3, 2)


def test_month_seasonality(series):
    got = profile.month_seasonality(series({"a": [10, 20, 30]})).first()
    assert (got.strength_pct, got.peak_month, got.trough_month) == (100.0, 3, 1)


def test_completeness(series):
    got = rows(profile.completeness(series({"a": [1] * 12, "b": [1, 2]})))
    assert got == [("a", 12, 12, True, False), ("b", 2, 12, False, True)]


def test_spike_periods(series):
    df = series({"a": [1, 1, 50, 1, 1], "b": [2, 2, 60, 2, 2]})
    assert [r.avg_demand for r in profile.spike_periods(df).collect()] == [55.0]


def test_ema_and_fill(series):
    got = [r[3] for r in rows(windows.ema(series({"a": [1, 2, 4]}), 0.5))]
    assert got == [1.0, 1.5, 2.75]
    df = series({"a": [1, None, 3, 4], "b": [1, None, None, None, 5]})
    assert [r[2] for r in rows(windows.fill_gaps(df, "forward"))] == [1.0, 1.0, 3.0, 4.0]
    assert [r[2] for r in rows(windows.fill_gaps(df, "mean"))][1] == pytest.approx(statistics.mean([1, 3, 4]))
    with pytest.raises(ValueError):
        windows.fill_gaps(df, "guess")


def test_year_over_year_ignores_positions(series):
    df = series({"a": [10] + [None] * 11 + [15, 16]})
    got = {r.period_start: r.yoy_growth_pct for r in joins.year_over_year(df).collect()}
    assert got[dt.date(2001, 1, 1)] == 50.0 and got[dt.date(2001, 2, 1)] is None


def test_growth_needs_a_base(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 31),), (dt.date(2024, 1, 1),)], "posted_date date")
    got = df.agg(analytics.growth_value(F.lit("2024-01-31").cast("date"), 10).alias("g")).first()
    assert got.g is None


def test_sampled_lines_are_looked_up_in_the_table(spark, monkeypatch):
    from laborlens.registry import series

    sf = "/root/testdata/sf0.001"
    assert {r.known for r in series.l06(spark, sf).select("known").collect()} == {True}
    draw = sampling.sample_per_partition
    # a supplier that the line doesn't have, in an order of fewer than seven lines
    small = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").count().filter("count < 7").agg(F.min("l_orderkey")).first()[0]
    wrong = F.when(F.col("l_orderkey") == small, -1).otherwise(F.col("l_suppkey")).cast("bigint").alias("l_suppkey")
    monkeypatch.setattr(sampling, "sample_per_partition", lambda p, *a, **b: draw(p, *a, **b).select("l_orderkey", "l_linenumber", "l_partkey", wrong))
    got = {r.l_orderkey: r.known for r in series.l06(spark, sf).collect()}
    assert [k for k, known in got.items() if not known] == [small]


@pytest.mark.parametrize("rows_a_range", [7, 1000])
def test_stored_pages(spark, tmp_path, rows_a_range):
    rows = [(i, None if i % 9 == 0 else (i * 7) % 5, f"t{i}") for i in range(60)]  # one value for many rows
    order = [paging.Key("v", descending=True, nulls_first=True), paging.Key("id")]
    df = spark.createDataFrame(rows, "id int, v int, title string")
    pages = paging.store_pages(df, order, str(tmp_path / "pages"), rows_a_range)
    want = sorted(rows, key=lambda r: (r[1] is not None, -(r[1] or 0), r[0]))
    assert [tuple(r) for n in range(9) for r in pages.page(n, 8).collect()] == want
    for n in (0, 1, 7, 30, 58, 59):
        assert [tuple(r) for r in pages.after([want[n][1], want[n][0]], 5).collect()] == want[n + 1:n + 6]
    assert [tuple(r) for r in pages.after([9, 0], 2).collect()] == [w for w in want if w[1] is not None][:2]  # a key that isn't there
    assert tuple(pages.info(3, 8).first()) == (60, 8, 3, 8)
    nulls_last = [paging.Key("v", nulls_first=False), paging.Key("id", descending=True)]
    pages = paging.store_pages(df, nulls_last, str(tmp_path / "last"), rows_a_range)
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, -r[0]))
    assert [tuple(r) for r in pages.page(2, 11).collect()] == want[22:33]
    assert [tuple(r) for r in pages.after([want[40][1], want[40][0]], 30).collect()] == want[41:]
    empty = paging.store_pages(df.limit(0), order, str(tmp_path / "empty"))
    assert empty.page(0).collect() == [] and empty.after([1, 1]).collect() == [] and empty.info().first().totalElements == 0


def test_deep_page_reads_its_range_only(spark, tmp_path):
    df = spark.range(5000).withColumn("v", F.col("id") % 3)
    pages = paging.store_pages(df, [paging.Key("v"), paging.Key("id")], str(tmp_path / "pages"), 500)
    found = pages.page(100, 20)
    assert found.count() == 20
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_range#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_ranges_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(paging, "MAX_RANGES", 5, raising=False)
    df = spark.range(600).withColumn("v", F.col("id") % 3)
    pages = paging.store_pages(df, [paging.Key("v"), paging.Key("id")], str(tmp_path / "pages"), 10)
    want = sorted((i % 3, i) for i in range(600))
    assert pages.directory.count() <= 5 and pages.directory.agg(F.sum("_rows")).first()[0] == 600
    assert [(r.v, r.id) for n in (0, 11, 29) for r in pages.page(n, 20).collect()] == want[:20] + want[220:240] + want[580:]
    assert [(r.v, r.id) for r in pages.after(list(want[333]), 20).collect()] == want[334:354]


def test_postings_cross_one_shuffle_for_orders_and_customers(spark):
    """The customer comes with the order, and part texts are added after that join."""
    from laborlens.plans import domain

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = domain.postings(spark, "/root/testdata/sf0.001", "id", "title", "industry")._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    on = [line for line in plan.splitlines() if "Join LeftOuter" in line]
    assert ["l_partkey" in on[0], "l_orderkey" in on[1], "o_custkey" in on[2]] == [True] * 3


def test_lines_are_not_grouped_as_a_whole(spark):
    from laborlens.registry import series

    plan = series.l06(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join FullOuter" not in plan and "LeftSemi" in plan


def test_normalized_dates_are_parsed_once(spark):
    df = spark.createDataFrame([("2024-02-10", "Go", "3")], "day string, tool string, total string")
    plan = projections.normalize_demand(df, "day", "tool", "total")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("M/d/yyyy H:mm:ss") == 1


def test_star_keys_last(spark):
    schema = "id int, company string, city string, region string, skills array<string>, pay double"
    one = [(1, "a", "x", "N", ["s", "t", "s"], 1.0), (2, None, "x", "S", None, 2.0), (3, "b", None, None, ["t", None], 3.0)]
    two = [(4, "c", "x", "N", ["u", "s"], 4.0), (5, None, "y", "N", [], 5.0), (6, "a", None, None, ["t"], 6.0)]
    dims = {"company": ["company"], "place": ["city", "region"]}
    first = star.load_star(spark.createDataFrame(one, schema), dims, ["pay"], {"skill": "skills"})
    again = star.load_star(spark.createDataFrame(one, schema), dims, ["pay"], {"skill": "skills"})
    both = star.load_star(spark.createDataFrame(two, schema), dims, ["pay"], {"skill": "skills"}, held=first)

    def keys(s, name):
        return {tuple(r)[1:]: r[0] for r in s.dimensions[name].collect()}

    for name in ("company", "place", "skill"):
        before, after = keys(first, name), keys(both, name)
        assert before == keys(again, name)
        assert before.items() <= after.items() and sorted(after.values()) == list(range(1, len(after) + 1))
    assert set(keys(both, "company")) == {("a",), ("b",), ("c",), (None,)} and set(keys(both, "skill")) == {("s",), ("t",), ("u",)}
    company, place, skill = ({v: k for k, v in keys(both, n).items()} for n in ("company", "place", "skill"))
    got = {r.id: (company[r.company_key][0], *place[r.place_key], r.pay) for r in both.fact.collect()}
    assert got == {r[0]: (r[1], r[2], r[3], r[5]) for r in one + two}
    assert sorted((r.id, skill[r.skill_key][0]) for r in both.bridges["skill"].collect()) == [
        (1, "s"), (1, "t"), (3, "t"), (4, "s"), (4, "u"), (6, "t")]


def test_star_loads_read_postings_written_once(spark, tmp_path, monkeypatch):
    from laborlens.registry import documented

    def day(year):
        return dt.datetime(year, 3, 1)

    given = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA"), (1, "EUROPE")]),
        "nation": ("n_nationkey int, n_name string, n_regionkey int", [(0, "INDIA", 0), (1, "JAPAN", 0), (2, "FRANCE", 1)]),
        "supplier": ("s_suppkey bigint, s_name string, s_nationkey int", [(1, "a", 0), (2, "b", 1), (3, "c", 2), (4, None, 0)]),
        "part": ("p_partkey bigint, p_name string", [(1, "red ring"), (2, "blue ring"), (3, "red red"), (4, None)]),
        "customer": ("c_custkey bigint, c_mktsegment string", [(1, "x"), (2, None)]),
        "orders": ("o_orderkey bigint, o_custkey bigint", [(1, 1), (2, 2), (3, None)]),
        "lineitem": (
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_extendedprice double, l_shipdate timestamp",
            [(1, 1, 1, 1, 10.0, day(1995)), (1, 2, 3, 2, 20.0, day(1996)), (2, 1, 1, 1, 30.0, day(2000)), (2, 2, 2, 2, 40.0, day(2001)),
             (3, 3, 4, 1, 50.0, day(1997)), (3, 4, 1, 2, 60.0, day(2001)), (9, 9, 2, 1, 70.0, day(1996)), (4, 2, 4, 1, None, day(2001))],
        ),
    }
    for name, (schema, table) in given.items():
        spark.createDataFrame(table, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    read, grown = [], star.grown
    monkeypatch.setattr(star, "grown", lambda members, *rest: (read.extend(members.inputFiles()), grown(members, *rest))[1])
    found = documented.j11b(spark, str(tmp_path))
    read += found.inputFiles()
    assert read and not [f for f in read if str(tmp_path / "lineitem.parquet") in f]  # no dimension, fact or bridge runs the joins again
    got = {(r.skill, r.location): (r.n, r.salaries and float(r.salaries)) for r in found.collect()}
    assert got == {("red", "INDIA"): (3, 90.0), ("ring", "INDIA"): (3, 40.0), ("blue", "INDIA"): (1, None), ("blue", "JAPAN"): (1, 40.0), ("ring", "JAPAN"): (1, 40.0)}


def test_sample_ranks_only_near_draws(spark):
    df = spark.range(20_000).withColumn("v", F.col("id") * 2)
    drawn = sampling.sample_per_partition(df, 50, ["id"], blocks=4)
    block = F.pmod(F.xxhash64("id"), F.lit(4))
    counts = {r[0]: r[1] for r in drawn.groupBy(block).count().collect()}
    assert counts == {i: 50 for i in range(4)} and drawn.select("id").distinct().count() == 200
    assert drawn.join(df, ["id", "v"], "left_anti").count() == 0
    order = [F.shiftrightunsigned(F.xxhash64(F.lit(42), "id"), 1), F.col("id")]
    want = df.withColumn("b", block).withColumn("r", F.row_number().over(W.partitionBy("b").orderBy(*order))).filter("r <= 50")
    assert {r.id for r in drawn.collect()} == {r.id for r in want.collect()}
    few = sampling.sample_per_partition(df.limit(30), 50, ["id"], blocks=4)
    assert few.count() == 30 and sampling.sample_per_partition(df.limit(0), 5, ["id"], 2).count() == 0


def test_percentiles_narrow_down_exactly(spark, monkeypatch):
    from laborlens.operators import quantiles

    monkeypatch.setattr(quantiles, "KEPT", 64)  # a small sketch errs more, so that all branches are taken
    monkeypatch.setattr(quantiles, "MARGIN", 0.01)
    rng = np.random.default_rng(11)
    columns = {
        "plain": rng.normal(size=6000), "heavy": np.where(rng.random(6000) < 0.7, 5.0, rng.integers(0, 40, 6000)),
        "two": np.where(rng.random(6000) < 0.5, 1.0, 2.0), "same": np.full(6000, 3.0), "far": np.where(rng.random(6000) < 0.3, np.inf, -rng.random(6000)),
    }
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns.values())], ", ".join(f"{c} double" for c in columns)).repartition(5)
    p = [0.0, 0.01, 0.25, 0.5, 0.685, 0.9, 1.0]
    got = {r[0]: r[1] for r in quantiles.exact_percentiles(df, list(columns), p).collect()}
    for name, values in columns.items():
        s = np.sort(values)
        for q, v in zip(p, got[name]):
            at = q * (len(s) - 1)
            low, high = s[math.floor(at)], s[math.ceil(at)]
            assert v == (low if low == high else low + (high - low) * (at - math.floor(at))), (name, q)
