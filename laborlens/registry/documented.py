"""Reports and transforms that go beyond the served tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates
from ..operators import aggregates, analytics, filters, joins, projections, setops, star, windows
from ..plans import domain
from ..plans.tables import materialize
from ..sources import readers
from .core import CLOSED, DEMAND, FORECASTS, POSTING_SKILLS, POSTINGS, REGIONAL, query

AS_OF = "2001-06-30"
DAY = f"DATE '{AS_OF}'"
SALARY = "CAST(sum(salary_min + salary_max) AS DOUBLE) / 2 / count(*)"


def tagged(spark, sf, *columns: str):
    """Postings with their skills as an array."""
    return aggregates.split_skills(domain.postings(spark, sf, "skills", *columns))


def growth_sql(days: int) -> str:
    """Percent change of the last days against the days before."""
    def between(newest: int, oldest: int) -> str:
        return f"count(*) FILTER (CAST(posted_date AS DATE) <= {DAY} - {newest} AND CAST(posted_date AS DATE) > {DAY} - {oldest})"

    return f"round(100.0 * ({between(0, days)} - {between(days, 2 * days)}) / nullif({between(days, 2 * days)}, 0), 1)"


# ------------------------------------------------------- projections and filters


@query(
    "p16_standardize_text",
    "SELECT DISTINCT lower(trim(lang, ' ')) AS lang, lower(trim(source, ' ')) AS source, lower(trim(text, ' ')) AS text FROM documents WHERE text IS NOT NULL",
)
def p16(spark, sf):
    return projections.standardize_text(domain.table(spark, sf, "documents").select("lang", "source", "text"), ["lang", "source", "text"])


@query("p17_mask_columns", "SELECT o_orderkey, sha256('pepper' || CAST(o_custkey AS VARCHAR)) AS o_custkey, o_orderstatus FROM orders")
def p17(spark, sf):
    orders = domain.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return projections.mask_columns(orders, ["o_custkey"], "pepper")


SEARCH = """found AS (SELECT * FROM postings WHERE list_has_any(string_split(skills, ','), ['red', 'blue']) AND region IN ('ASIA', 'EUROPE')
  AND industry IN ('BUILDING', 'MACHINERY') AND salary_min >= 905 AND salary_max <= 90000 AND posted_date > TIMESTAMP '1996-01-01')"""


def _found(spark, sf):
    p = tagged(spark, sf, "id", "title", "company", "region", "industry", "salary_min", "salary_max", "posted_date")
    return filters.advanced_search(
        p, skills=["red", "blue"], regions=["ASIA", "EUROPE"], industries=["BUILDING", "MACHINERY"],
        salary_min=905, salary_max=90000, posted_after="1996-01-01",
    )


@query(
    "f13_advanced_search",
    f"WITH {POSTINGS}, {SEARCH} SELECT id, title, company, region, CAST(posted_date AS DATE) AS day, (SELECT count(*) FROM found) AS total FROM found ORDER BY posted_date DESC, id LIMIT 100 OFFSET 5",
)
def f13(spark, sf):
    rows = filters.search_page(_found(spark, sf), [F.desc("posted_date"), "id"], 100, 5)
    return rows.select("id", "title", "company", "region", F.to_date("posted_date").alias("day"), "total")


@query(
    "f13_facets",
    f"""WITH {POSTINGS}, {SEARCH}, pairs AS (
          SELECT 'region' AS facet, region AS value FROM found UNION ALL SELECT 'industry', industry FROM found
          UNION ALL SELECT 'skills', unnest(list_distinct(string_split(skills, ','))) FROM found)
        SELECT facet, value, count(*) AS n FROM pairs GROUP BY 1, 2""",
)
def f13f(spark, sf):
    return analytics.facet_counts(_found(spark, sf), ["region", "industry", "skills"])


@query(
    "f14_validate_salary",
    f"WITH {POSTINGS} SELECT location, count(*) AS n FROM postings WHERE salary_min > 0 AND salary_max > 0 AND salary_min <= salary_max GROUP BY 1",
)
def f14(spark, sf):
    p = domain.postings(spark, sf, "location", "salary_min", "salary_max")
    return filters.validate_salary(p).groupBy("location").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f14_drop_spam",
    """SELECT doc_id FROM documents WHERE CASE WHEN length(text) < 40 THEN 0.5 ELSE 0 END + CASE WHEN contains(text, 'http') THEN 0.4 ELSE 0 END
       + CASE WHEN contains(text, '@') THEN 0.3 ELSE 0 END < 0.5""",
)
def f14s(spark, sf):
    rules = [(F.length("text") < 40, 0.5), (F.col("text").contains("http"), 0.4), (F.col("text").contains("@"), 0.3)]
    return filters.drop_spam(domain.table(spark, sf, "documents"), rules, 0.5).select("doc_id")


@query(
    "f15_search_skills",
    f"""WITH {POSTINGS}, d AS (SELECT title AS skill_name, split_part(title, ' ', 2) AS category, count(*) AS demand FROM postings GROUP BY 1, 2)
        SELECT skill_name, category, demand, 1 - levenshtein(lower(skill_name), 'red') / CAST(greatest(length(skill_name), 3) AS DOUBLE) AS match_score, count(*) OVER () AS total
        FROM d WHERE contains(lower(skill_name), 'red') ORDER BY demand DESC, skill_name LIMIT 20""",
    doubles=("match_score",), places=4,
)
def f15(spark, sf):
    counted = domain.postings(spark, sf, "title").groupBy(F.col("title").alias("skill_name")).agg(F.count(F.lit(1)).alias("demand"))
    named = counted.select("skill_name", F.split_part("skill_name", F.lit(" "), F.lit(2)).alias("category"), "demand")
    return filters.search_skills(named, "RED")


# ------------------------------------------------------------------------ joins


@query(
    "j09_year_over_year",
    f"""WITH {CLOSED} SELECT a.skill_name, a.period_start, a.demand_count AS current, b.demand_count AS previous,
        round(100.0 * (a.demand_count - b.demand_count) / b.demand_count, 1) AS yoy_growth_pct
        FROM closed a LEFT JOIN closed b ON a.skill_name = b.skill_name AND b.period_start = a.period_start - INTERVAL 12 MONTH""",
    doubles=("yoy_growth_pct",), places=1,
)
def j09(spark, sf):
    return joins.year_over_year(domain.closed_skill_demand(spark, sf))


@query(
    "j10_related_skills",
    f"""WITH {POSTING_SKILLS}, t AS (SELECT unnest(['red', 'blue']) AS target), n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM postings),
        c AS (SELECT skill, CAST(count(*) AS DOUBLE) AS a FROM posting_skills GROUP BY 1),
        b AS (SELECT target, skill, CAST(count(*) AS DOUBLE) AS joint FROM posting_skills JOIN t ON list_contains(string_split(skills, ','), target) AND skill <> target GROUP BY 1, 2)
        SELECT b.target, b.skill, CAST(joint AS BIGINT) AS co_count, joint / ct.a AS co_occurrence,
               (n * joint - c.a * ct.a) / sqrt(c.a * ct.a * (n - c.a) * (n - ct.a)) AS correlation
        FROM b JOIN c ON b.skill = c.skill JOIN c ct ON ct.skill = b.target CROSS JOIN n""",
    doubles=("co_occurrence", "correlation"),
)
def j10(spark, sf):
    return joins.related_skills(tagged(spark, sf), ["red", "blue"])


STAR = {"company": ["company"], "location": ["location", "region"], "industry": ["industry"]}


def _star(spark, sf, *measures):
    """Two loads, cut by the date of posting; the second finds most members there.

    The postings are written once: every dimension, fact and bridge of both loads reads them, not the joins behind them.
    """
    p = tagged(spark, sf, "id", "company", "location", "region", "industry", "posted_date", *measures)
    p = materialize(p, "star-postings", compression="zstd")
    early = F.col("posted_date") < F.lit("1998-06-01").cast("date")
    first = star.load_star(p.filter(early), STAR, ["posted_date", *measures], {"skill": "skills"})
    return first, star.load_star(p.filter(~early), STAR, ["posted_date", *measures], {"skill": "skills"}, held=first)


@query(
    "j11_build_star",
    f"""WITH {POSTING_SKILLS} SELECT name, n, n AS last_key, true AS keys_kept FROM (
          SELECT 'company' AS name, count(*) AS n FROM (SELECT DISTINCT company FROM postings)
          UNION ALL SELECT 'location', count(*) FROM (SELECT DISTINCT location, region FROM postings)
          UNION ALL SELECT 'industry', count(*) FROM (SELECT DISTINCT industry FROM postings)
          UNION ALL SELECT 'skill', count(*) FROM (SELECT DISTINCT skill FROM posting_skills))
        UNION ALL SELECT 'fact', count(*), NULL, true FROM postings
        UNION ALL SELECT 'skill bridge', count(*), NULL, true FROM posting_skills""",
)
def j11(spark, sf):
    """Members with their largest key after two loads, and whether the members of the first load have kept theirs."""
    first, both = _star(spark, sf)
    parts = []
    for name, after in both.dimensions.items():
        key = f"{name}_key"
        attributes = [c for c in after.columns if c != key]
        before = first.dimensions[name].withColumnsRenamed({c: f"old_{c}" for c in after.columns})
        same = F.lit(True)
        for a in attributes:
            same = same & F.col(a).eqNullSafe(F.col(f"old_{a}"))
        kept = F.bool_and(F.col(f"old_{key}").isNull() | (F.col(key) == F.col(f"old_{key}")))
        parts.append(after.join(before, same, "left").agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.max(key).alias("last_key"), kept.alias("keys_kept")))
    for name, rows in (("fact", both.fact), ("skill bridge", both.bridges["skill"])):
        parts.append(rows.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("last_key"), F.lit(True).alias("keys_kept")))
    return setops.union_all(parts)


@query(
    "j11_star_rollup",
    f"WITH {POSTINGS} SELECT location, industry, count(*) AS n, sum(salary_max) AS salaries FROM postings GROUP BY 1, 2",
    doubles=("salaries",), places=2,
)
def j11r(spark, sf):
    _, both = _star(spark, sf, "salary_max")
    # counted by key first: the dimension names join a table of groups, not of postings
    counted = both.fact.groupBy("location_key", "industry_key").agg(F.count(F.lit(1)).alias("n"), F.sum("salary_max").alias("salaries"))
    return counted.join(both.dimensions["location"], "location_key").join(both.dimensions["industry"], "industry_key").select("location", "industry", "n", "salaries")


@query(
    "j11_skill_bridge",
    f"""WITH {POSTING_SKILLS} SELECT skill, location, count(*) AS n, sum(salary_max) AS salaries FROM posting_skills WHERE region = 'ASIA' GROUP BY 1, 2""",
    doubles=("salaries",), places=2,
)
def j11b(spark, sf):
    """Postings and salaries per skill and location of a region, from keys until the last step."""
    _, both = _star(spark, sf, "salary_max")
    asia = both.dimensions["location"].filter(F.col("region") == "ASIA")
    rows = both.fact.join(asia.select("location_key"), "location_key").select("id", "location_key", "salary_max")
    counted = rows.join(both.bridges["skill"], "id").groupBy("skill_key", "location_key").agg(F.count(F.lit(1)).alias("n"), F.sum("salary_max").alias("salaries"))
    return counted.join(both.dimensions["skill"], "skill_key").join(asia, "location_key").select(F.col("name").alias("skill"), "location", "n", "salaries")


@query(
    "u04_merge_sources",
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, 'delta' AS origin FROM lineitem
                  UNION ALL SELECT l_orderkey, l_linenumber, l_shipdate + INTERVAL 1 DAY, l_partkey, l_suppkey, 'stream' FROM lineitem WHERE l_returnflag = 'R')
       SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, origin DESC) = 1""",
)
def u04(spark, sf):
    columns = ["l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey"]
    delta = domain.table(spark, sf, "lineitem")
    stream = delta.filter(F.col("l_returnflag") == "R").withColumn("l_shipdate", F.col("l_shipdate") + F.expr("interval 1 day"))
    frames = [delta.select(*columns, F.lit("delta").alias("origin")), stream.select(*columns, F.lit("stream").alias("origin"))]
    return setops.merge_sources(frames, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey", "origin"])


# ---------------------------------------------------------------------- reports


@query(
    "a32_demand_trends",
    f"""WITH {POSTINGS}, p AS (SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period, count(*) AS n, {SALARY} AS avg_salary, count(DISTINCT source) AS source_count
          FROM postings WHERE list_contains(string_split(skills, ','), 'red') AND region = 'ASIA' GROUP BY 1)
        SELECT a.*, round(100.0 * (a.n - b.n) / b.n, 1) AS growth_rate FROM p a LEFT JOIN p b ON b.period = a.period - INTERVAL 1 MONTH""",
    doubles=("avg_salary", "growth_rate"), places=8,
)
def a32(spark, sf):
    p = tagged(spark, sf, "posted_date", "region", "industry", "source", "salary_min", "salary_max")
    return analytics.demand_trends(p, "month", skill="red", region="ASIA")


@query(
    "a32_trend_summary",
    f"""WITH {POSTINGS}, s AS (SELECT count(*) AS total_postings, {SALARY} AS avg_salary, {growth_sql(90)} AS growth_90d FROM postings)
        SELECT *, CASE WHEN growth_90d > 0 THEN 'up' WHEN growth_90d < 0 THEN 'down' ELSE 'flat' END AS trend_direction FROM s""",
    doubles=("avg_salary", "growth_90d"), places=2,
)
def a32s(spark, sf):
    return analytics.trend_summary(domain.postings(spark, sf, "posted_date", "salary_min", "salary_max"), AS_OF)


@query(
    "a33_skill_ranking",
    f"""WITH {POSTING_SKILLS}, r AS (SELECT skill, count(*) AS postings_count, {SALARY} AS avg_salary, {growth_sql(30)} AS growth_30d, {growth_sql(90)} AS growth_90d,
          row_number() OVER (ORDER BY count(*) DESC, skill) AS rank FROM posting_skills GROUP BY 1)
        SELECT *, round(postings_count * 100.0 / (SELECT count(*) FROM postings), 1) AS postings_pct, (SELECT count(*) FROM r) AS total FROM r WHERE rank > 2 AND rank <= 12""",
    doubles=("avg_salary", "growth_30d", "growth_90d", "postings_pct"), longs=("rank",), places=4,
)
def a33(spark, sf):
    return analytics.skill_ranking(tagged(spark, sf, "posted_date", "salary_min", "salary_max"), AS_OF, 10, 2)


@query(
    "a34_skill_overview",
    f"""WITH {POSTINGS}, s AS (SELECT *, CAST((salary_min + salary_max) / 2 AS DOUBLE) AS salary, CAST(posted_date AS DATE) AS d FROM postings WHERE list_contains(string_split(skills, ','), 'red'))
        SELECT 'red' AS skill, count(*) FILTER (d = {DAY}) AS current, count(*) FILTER (d <= {DAY} AND d > {DAY} - 30) / 30.0 AS avg_30d,
               count(*) FILTER (d <= {DAY} AND d > {DAY} - 90) / 90.0 AS avg_90d,
               CASE sign(count(*) FILTER (d <= {DAY} AND d > {DAY} - 30) * 3 - count(*) FILTER (d <= {DAY} AND d > {DAY} - 90)) WHEN 1 THEN 'up' WHEN -1 THEN 'down' ELSE 'flat' END AS trend,
               avg(salary) AS salary_avg, quantile_cont(salary, 0.25) AS salary_p25, median(salary) AS salary_median, quantile_cont(salary, 0.75) AS salary_p75 FROM s""",
    doubles=("avg_30d", "avg_90d", "salary_avg", "salary_p25", "salary_median", "salary_p75"), places=3,
)
def a34(spark, sf):
    return analytics.skill_overview(tagged(spark, sf, "posted_date", "salary_min", "salary_max"), "red", AS_OF)


@query(
    "a34_skill_breakdown",
    f"""WITH {POSTINGS}, s AS (SELECT * FROM postings WHERE list_contains(string_split(skills, ','), 'red')), w AS (SELECT count(*) AS n, {SALARY} AS sal FROM s)
        SELECT industry, count(*) AS postings, {SALARY} AS avg_salary, count(*) * 100.0 / any_value(w.n) AS postings_pct, ({SALARY}) / any_value(w.sal) AS salary_premium
        FROM s CROSS JOIN w GROUP BY 1""",
    doubles=("avg_salary", "postings_pct", "salary_premium"), places=3,
)
def a34b(spark, sf):
    return analytics.skill_breakdown(tagged(spark, sf, "industry", "salary_min", "salary_max"), "red", "industry")


TOP_LIST = "string_agg(name || ':' || n, ',' ORDER BY n DESC, name)"


@query(
    "a35_location_summary",
    f"""WITH {POSTING_SKILLS},
        i AS (SELECT location, industry AS name, count(*) AS n FROM postings GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, industry) <= 3),
        s AS (SELECT location, skill AS name, count(*) AS n FROM posting_skills GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY location ORDER BY count(*) DESC, skill) <= 3),
        b AS (SELECT location, min(region) AS region, count(*) AS postings_count, {SALARY} AS avg_salary, {growth_sql(90)} AS growth_90d FROM postings GROUP BY 1)
        SELECT b.*, postings_count * 100.0 / (SELECT count(*) FROM postings) AS postings_pct,
               (SELECT {TOP_LIST} FROM i WHERE i.location = b.location) AS top_industries, (SELECT {TOP_LIST} FROM s WHERE s.location = b.location) AS top_skills FROM b""",
    doubles=("avg_salary", "growth_90d", "postings_pct"), places=3,
)
def a35(spark, sf):
    p = tagged(spark, sf, "posted_date", "location", "region", "industry", "salary_min", "salary_max")
    summary = analytics.location_summary(p, AS_OF)

    def shown(name):
        return F.array_join(F.transform(name, lambda e: F.concat(e["name"], F.lit(":"), e["n"].cast("string"))), ",")

    return summary.withColumns({"top_industries": shown("top_industries"), "top_skills": shown("top_skills")})


COMPANY = "Supplier#000000007"


@query(
    "a36_company_volume",
    f"""WITH {POSTINGS}, m AS (SELECT company, CAST(date_trunc('month', posted_date) AS DATE) AS month, count(*) AS n FROM postings WHERE company = '{COMPANY}' GROUP BY 1, 2),
        a AS (SELECT *, avg(n) OVER (ORDER BY month RANGE BETWEEN INTERVAL 2 MONTH PRECEDING AND CURRENT ROW) AS avg_3m,
                     avg(n) OVER (ORDER BY month RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW) AS avg_12m FROM m)
        SELECT *, CASE WHEN avg_3m - avg_12m > 0 THEN 'up' WHEN avg_3m - avg_12m < 0 THEN 'down' ELSE 'flat' END AS trend FROM a""",
    doubles=("avg_3m", "avg_12m"),
)
def a36(spark, sf):
    return analytics.company_volume(domain.postings(spark, sf, "company", "posted_date"), COMPANY)


@query(
    "a36_company_profile",
    f"""WITH {POSTING_SKILLS}, c AS (SELECT * FROM postings WHERE company = '{COMPANY}')
        (SELECT 'skill' AS section, skill AS name, count(*) AS n, {SALARY} AS avg_salary FROM posting_skills WHERE company = '{COMPANY}' GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
        UNION ALL (SELECT 'title', title, count(*) AS n, {SALARY} FROM c GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
        UNION ALL SELECT 'location', location, count(*), {SALARY} FROM c GROUP BY 2""",
    doubles=("avg_salary",), places=3,
)
def a36p(spark, sf):
    return analytics.company_profile(tagged(spark, sf, "company", "title", "location", "salary_min", "salary_max"), COMPANY)


@query(
    "a36_company_ranking",
    f"""WITH {POSTINGS} SELECT company, count(*) AS postings, {SALARY} AS avg_salary, {growth_sql(90)} AS hiring_growth, row_number() OVER (ORDER BY count(*) DESC, company) AS rank
        FROM postings WHERE list_contains(string_split(skills, ','), 'red') GROUP BY 1 ORDER BY rank LIMIT 20""",
    doubles=("avg_salary", "hiring_growth"), longs=("rank",), places=3,
)
def a36r(spark, sf):
    return analytics.company_ranking(tagged(spark, sf, "company", "posted_date", "salary_min", "salary_max"), AS_OF, skill="red")


@query(
    "a37_analytics_summary",
    f"""WITH {POSTING_SKILLS}, t AS (SELECT count(*) AS a, count(*) FILTER (CAST(posted_date AS DATE) = {DAY}) AS b, {growth_sql(30)} AS c,
          (SELECT count(DISTINCT skill) FROM posting_skills) AS d, count(DISTINCT company) AS e, {SALARY} AS f FROM postings)
        SELECT 'totals' AS section, 'total_postings' AS name, CAST(a AS DOUBLE) AS value FROM t UNION ALL SELECT 'totals', 'new_postings_today', b FROM t
        UNION ALL SELECT 'totals', 'postings_growth_30d', c FROM t UNION ALL SELECT 'totals', 'unique_skills', d FROM t
        UNION ALL SELECT 'totals', 'unique_companies', e FROM t UNION ALL SELECT 'totals', 'avg_salary', f FROM t
        UNION ALL (SELECT 'trending_skill', skill, {growth_sql(30)} AS v FROM posting_skills GROUP BY 2 HAVING v IS NOT NULL ORDER BY v DESC, 2 LIMIT 5)
        UNION ALL (SELECT 'active_region', region, count(*) AS v FROM postings GROUP BY 2 ORDER BY v DESC, 2 LIMIT 5)""",
    doubles=("value",), places=3,
)
def a37(spark, sf):
    p = tagged(spark, sf, "posted_date", "company", "region", "salary_min", "salary_max")
    return analytics.analytics_summary(p, AS_OF)


@query(
    "a38_demand_cube",
    f"""WITH {POSTING_SKILLS}, c AS (SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period, region, skill, industry, count(*) AS n, {SALARY} AS avg_salary
          FROM posting_skills GROUP BY 1, 2, 3, 4)
        SELECT a.*, round(100.0 * (a.n - b.n) / b.n, 1) AS growth_rate FROM c a LEFT JOIN c b
          ON b.region = a.region AND b.skill = a.skill AND b.industry = a.industry AND b.period = a.period - INTERVAL 1 MONTH""",
    doubles=("avg_salary", "growth_rate"), places=8,
)
def a38(spark, sf):
    return analytics.demand_cube(tagged(spark, sf, "posted_date", "region", "industry", "salary_min", "salary_max"))


@query(
    "a39_freshness",
    f"""WITH {POSTING_SKILLS} SELECT max(posted_date) AS last_update, count(*) AS records_processed, count(DISTINCT region) AS regions,
        (SELECT count(DISTINCT skill) FROM posting_skills) AS skills, count(DISTINCT company) AS companies FROM postings""",
)
def a39(spark, sf):
    return analytics.freshness(tagged(spark, sf, "posted_date", "region", "company"))


@query(
    "a40_period_growth",
    f"""WITH {CLOSED} SELECT skill_name, max(period_start) AS latest_date, CAST(sum(demand_count) AS BIGINT) AS total_demand FROM closed
        WHERE period_start >= DATE '2000-01-01' GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 10""",
)
def a40(spark, sf):
    return aggregates.period_growth(domain.closed_skill_demand(spark, sf), "2000-01-01")


@query(
    "a40_latest_examples",
    f"WITH {DEMAND} SELECT skill_name, demand_count FROM demand WHERE period_start = DATE '2001-05-01' ORDER BY demand_count DESC, skill_name LIMIT 5",
)
def a40l(spark, sf):
    return aggregates.latest_examples(domain.skill_demand(spark, sf), "2001-05-01")


@query(
    "a40_forecast_on",
    f"""WITH {FORECASTS} SELECT skill_name, predicted_demand, confidence_lower, confidence_upper FROM forecasts
        WHERE forecast_date = DATE '2007-12-01' ORDER BY predicted_demand DESC, skill_name LIMIT 5""",
    doubles=("predicted_demand", "confidence_lower", "confidence_upper"),
)
def a40f(spark, sf):
    return aggregates.forecast_on(domain.stored_forecasts(spark, sf), "2007-12-01")


@query(
    "a42_share_over_time",
    f"""WITH {POSTINGS}, c AS (SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period, job_type, count(*) AS n FROM postings GROUP BY 1, 2)
        SELECT *, n / CAST(sum(n) OVER (PARTITION BY period) AS DOUBLE) AS share FROM c""",
    doubles=("share",),
)
def a42(spark, sf):
    return analytics.share_over_time(domain.postings(spark, sf, "posted_date", "job_type"), "job_type")


@query(
    "a42_salary_trend",
    f"WITH {POSTINGS} SELECT CAST(date_trunc('quarter', posted_date) AS DATE) AS period, industry, {SALARY} AS avg_salary, count(*) AS n FROM postings GROUP BY 1, 2",
    doubles=("avg_salary",), places=3,
)
def a42s(spark, sf):
    return analytics.salary_trend(domain.postings(spark, sf, "posted_date", "industry", "salary_min", "salary_max"), "industry", "quarter")


@query(
    "a43_salary_demand_corr",
    f"""WITH {POSTING_SKILLS}, m AS (SELECT skill, date_trunc('month', posted_date) AS month, CAST(count(*) AS DOUBLE) AS n, {SALARY} AS s FROM posting_skills GROUP BY 1, 2)
        SELECT skill, corr(s, n) AS correlation, count(*) AS months FROM m GROUP BY 1""",
    doubles=("correlation",),
)
def a43(spark, sf):
    return analytics.salary_demand_corr(tagged(spark, sf, "posted_date", "salary_min", "salary_max"))


# ---------------------------------------------------------------------- windows

DAILY = "daily AS (SELECT event_type AS skill_name, CAST(ts AS DATE) AS day, count(*) AS demand_count FROM events GROUP BY 1, 2)"


def _daily(spark, sf):
    return domain.table(spark, sf, "events").groupBy(F.col("event_type").alias("skill_name"), F.to_date("ts").alias("day")).agg(
        F.count(F.lit(1)).alias("demand_count")
    )


@query(
    "w13_lag_features",
    f"""WITH {DAILY} SELECT a.*, b.demand_count AS lag_1d, c.demand_count AS lag_7d, d.demand_count AS lag_30d FROM daily a
        LEFT JOIN daily b ON b.skill_name = a.skill_name AND b.day = a.day - 1 LEFT JOIN daily c ON c.skill_name = a.skill_name AND c.day = a.day - 7
        LEFT JOIN daily d ON d.skill_name = a.skill_name AND d.day = a.day - 30""",
)
def w13(spark, sf):
    return windows.lag_features(_daily(spark, sf))


@query(
    "w13_ema",
    f"""WITH RECURSIVE {CLOSED}, n AS (SELECT *, row_number() OVER (PARTITION BY skill_name ORDER BY period_start) AS i FROM closed),
        e AS (SELECT skill_name, period_start, CAST(demand_count AS DOUBLE) AS demand_count, i, CAST(demand_count AS DOUBLE) AS ema FROM n WHERE i = 1
              UNION ALL SELECT n.skill_name, n.period_start, CAST(n.demand_count AS DOUBLE), n.i, 0.3 * n.demand_count + 0.7 * e.ema FROM n JOIN e ON n.skill_name = e.skill_name AND n.i = e.i + 1)
        SELECT skill_name, period_start, demand_count, ema FROM e""",
    doubles=("ema",),
)
def w13e(spark, sf):
    return windows.ema(domain.closed_skill_demand(spark, sf), 0.3)


@query(
    "w14_moving_average",
    f"""WITH {DAILY} SELECT *, avg(demand_count) OVER (PARTITION BY skill_name ORDER BY day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW) AS avg_30d FROM daily""",
    doubles=("avg_30d",),
)
def w14(spark, sf):
    return windows.moving_average(_daily(spark, sf), 30)


@query(
    "w14_moving_average_months",
    f"""WITH {CLOSED} SELECT skill_name, period_start, demand_count, avg(demand_count) OVER (PARTITION BY skill_name ORDER BY period_start RANGE BETWEEN INTERVAL 11 MONTH PRECEDING AND CURRENT ROW) AS avg_12m FROM closed""",
    doubles=("avg_12m",),
)
def w14m(spark, sf):
    return windows.moving_average_months(domain.closed_skill_demand(spark, sf), 12)


FILL = f"""{REGIONAL}, sparse AS (SELECT skill_name || '/' || region AS skill_name, period_start, CAST(demand_count AS DOUBLE) AS y FROM regional),
  span AS (SELECT skill_name, min(period_start) AS a, max(period_start) AS b FROM sparse GROUP BY 1),
  grid AS (SELECT skill_name, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS period_start FROM span),
  raw AS (SELECT g.skill_name, g.period_start, y FROM grid g LEFT JOIN sparse s ON s.skill_name = g.skill_name AND s.period_start = g.period_start)"""


@query(
    "w15_fill_forward",
    f"""WITH {FILL}, f AS (SELECT skill_name, period_start, last_value(y IGNORE NULLS) OVER (PARTITION BY skill_name ORDER BY period_start ROWS UNBOUNDED PRECEDING) AS demand_count,
          y IS NULL AS imputed, avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0 END) OVER (PARTITION BY skill_name) AS m FROM raw)
        SELECT skill_name, period_start, demand_count, imputed FROM f WHERE m <= 0.9""",
)
def w15(spark, sf):
    df = domain.regional_demand(spark, sf)
    keyed = df.select(F.concat_ws("/", "skill_name", "region").alias("skill_name"), "period_start", "demand_count")
    return windows.fill_gaps(keyed, "forward", max_missing=0.9)


@query(
    "w15_fill_mean",
    f"""WITH {FILL}, f AS (SELECT skill_name, period_start, coalesce(y, avg(y) OVER (PARTITION BY skill_name)) AS demand_count,
          y IS NULL AS imputed, avg(CASE WHEN y IS NULL THEN 1.0 ELSE 0 END) OVER (PARTITION BY skill_name) AS m FROM raw)
        SELECT skill_name, period_start, demand_count, imputed FROM f WHERE m <= 0.9""",
    doubles=("demand_count",),
)
def w15m(spark, sf):
    df = domain.regional_demand(spark, sf)
    keyed = df.select(F.concat_ws("/", "skill_name", "region").alias("skill_name"), "period_start", "demand_count")
    return windows.fill_gaps(keyed, "mean", max_missing=0.9)


# ---------------------------------------------------------------------- sources


@query(
    "s11_incremental_scan",
    "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders WHERE o_orderdate > TIMESTAMP '2000-12-31' GROUP BY 1",
)
def s11(spark, sf):
    fresh = readers.incremental_scan(domain.table(spark, sf, "orders"), "o_orderdate", "2000-12-31")
    return fresh.groupBy(dates.month_start("o_orderdate").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query("s11_high_water_mark", "SELECT max(o_orderdate) AS high_water_mark FROM orders")
def s11h(spark, sf):
    return readers.high_water_mark(domain.table(spark, sf, "orders"), "o_orderdate")
