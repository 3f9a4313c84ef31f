"""Projections, filters, joins, aggregates, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates, text, values
from ..operators import aggregates, filters, joins, paging, projections, setops, windows
from ..plans import domain, etl
from ..session import scratch_path
from ..session import scratch_path
from .core import CLOSED, DEMAND, FORECASTS, POSTING_SKILLS, POSTINGS, VOLUME, query

# ------------------------------------------------------------------ projections


@query(
    "p01_normalize_demand",
    """SELECT CAST(l_shipdate AS DATE) AS period_start, trim(l_shipmode_text) AS skill_name,
              CAST(l_quantity AS DOUBLE) AS demand_count,
              last_day(CAST(l_shipdate AS DATE)) AS period_end, 'Global' AS region, 'General' AS industry
       FROM (SELECT *, ' ' || l_returnflag || l_linestatus || ' ' AS l_shipmode_text FROM lineitem)""",
)
def p01(spark, sf):
    # spread over all cores: texts take long to parse, and a file has few splits
    raw = domain.table(spark, sf, "lineitem").repartition("l_orderkey", "l_linenumber").select(
        # four forms of the same day
        F.when(F.col("l_linenumber") % 4 == 0, F.date_format("l_shipdate", "MM/dd/yyyy"))
        .when(F.col("l_linenumber") % 4 == 1, F.date_format("l_shipdate", "d MMM yyyy"))
        .when(F.col("l_linenumber") % 4 == 2, F.date_format("l_shipdate", "MMMM d, yyyy"))
        .otherwise(F.col("l_shipdate").cast("string")).alias("day"),
        F.concat(F.lit(" "), "l_returnflag", "l_linestatus", F.lit(" ")).alias("skill"),
        F.col("l_quantity").cast("string").alias("demand"),
    )
    return projections.normalize_demand(raw, "day", "skill", "demand")


@query(
    "p02_shape_skill_demand",
    f"""WITH {DEMAND} SELECT period_start, last_day(period_start) AS period_end, skill_name, demand_count,
        'Malaysia' AS region, 'General' AS industry FROM demand""",
)
def p02(spark, sf):
    return projections.shape_skill_demand(domain.skill_demand(spark, sf), "Malaysia")


LISTING_WORDS = ("red", "blue", "green", "widget", "gadget", "steel", "copper")


def _raw_listings(spark, sf):
    """Postings in the layout of the raw CSV, with the text forms its parsers expect."""
    p = domain.postings(
        spark, sf, "id", "title", "company", "location", "salary_min", "salary_max", "posted_date",
        "experience_level", "is_remote", "source",
    )
    thousands = [F.floor(F.col(c) / 1000).cast("string") for c in ("salary_min", "salary_max")]
    return p.select(
        F.col("id").alias("Job Id"),
        F.col("title").alias("Job Title"),
        F.col("company").alias("Company"),
        F.concat("location", F.when(F.col("is_remote"), " (Remote)").otherwise("")).alias("location"),
        F.concat(F.lit("$"), thousands[0], F.lit("K-$"), thousands[1], F.lit("K")).alias("Salary Range"),
        F.when(F.col("source") == "O", "Full-Time").when(F.col("source") == "F", "Intern").alias("Work Type"),
        F.date_format("posted_date", "yyyy-MM-dd").alias("Job Posting Date"),
        F.concat(F.lit("We need "), "title", F.lit(", soon")).alias("Job Description"),
        F.concat(F.substring("experience_level", 1, 1), F.lit(" to 15 Years")).alias("Experience"),
    )


@query(
    "p03_shape_job_listings",
    f"""WITH {POSTINGS}
    SELECT title, company, location || CASE WHEN is_remote THEN ' (Remote)' ELSE '' END AS location,
           CAST(floor(salary_min / 1000) * 1000 AS DOUBLE) AS salary_min,
           CASE WHEN NOT is_remote THEN CAST(floor(salary_max / 1000) * 1000 AS DOUBLE) END AS salary_max,
           'USD' AS salary_currency, 'kaggle-jobs' AS source, id AS source_id, posted_date,
           CASE source WHEN 'O' THEN 'FT' WHEN 'F' THEN 'IN' ELSE '' END AS job_type,
           CASE WHEN CAST(left(experience_level, 1) AS INT) >= 5 THEN 'SE'
                WHEN CAST(left(experience_level, 1) AS INT) >= 2 THEN 'MI' ELSE 'EN' END AS experience_level,
           'General' AS industry, is_remote,
           array_to_string(list_sort(list_distinct(list_filter(string_split(title, ' '),
             lambda w: w IN ({", ".join(f"'{w}'" for w in LISTING_WORDS)})))), ',') AS skills
    FROM postings""",
    doubles=("salary_min", "salary_max"),
)
def p03(spark, sf):
    raw = _raw_listings(spark, sf)
    # an upper bound that the money column can't hold
    large = F.when(F.col("location").endswith("(Remote)"), F.regexp_replace("Salary Range", r"-\$\d+K", r"-\$9999999K")).otherwise(F.col("Salary Range"))
    shaped = projections.shape_job_listings(raw.withColumn("Salary Range", large), LISTING_WORDS)
    return shaped.withColumn("posted_date", F.col("posted_date").cast("timestamp_ntz"))


@query(
    "p04_parse_salary_range",
    f"""WITH {POSTINGS} SELECT id, CAST(floor(salary_min / 1000) AS BIGINT) * 1000 AS low,
        CAST(floor(salary_max / 1000) AS BIGINT) * 1000 AS high FROM postings""",
)
def p04(spark, sf):
    low, high = values.salary_bounds("Salary Range")
    return _raw_listings(spark, sf).select(F.col("Job Id").alias("id"), low.alias("low"), high.alias("high"))


@query(
    "p05_experience_level",
    """SELECT CASE WHEN TRY_CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS INT) >= 5 THEN 'SE'
                   WHEN TRY_CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS INT) >= 2 THEN 'MI'
                   WHEN TRY_CAST(regexp_extract(o_orderpriority, '^(\\d+)', 1) AS INT) >= 0 THEN 'EN'
                   ELSE 'MI' END AS level, count(*) AS n FROM orders GROUP BY 1""",
)
def p05(spark, sf):
    orders = domain.table(spark, sf, "orders")
    return orders.groupBy(values.experience_level("o_orderpriority").alias("level")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p06_map_values",
    """SELECT CASE l_returnflag WHEN 'R' THEN 'FT' WHEN 'A' THEN 'PT' ELSE '' END AS code, count(*) AS n
       FROM lineitem GROUP BY 1""",
)
def p06(spark, sf):
    code = values.map_values("l_returnflag", {"R": "FT", "A": "PT"})
    return domain.table(spark, sf, "lineitem").groupBy(code.alias("code")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p07_is_remote",
    f"""WITH {POSTINGS} SELECT location, contains(location || CASE WHEN is_remote THEN ' (Remote)' ELSE ' (remote)' END,
        'Remote') AS remote, count(*) AS n FROM postings GROUP BY 1, 2""",
)
def p07(spark, sf):
    p = domain.postings(spark, sf, "location", "is_remote")
    shown = F.concat("location", F.when(F.col("is_remote"), " (Remote)").otherwise(" (remote)"))
    return p.groupBy("location", values.is_remote(shown).alias("remote")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "p08_listing_view",
    f"""WITH {POSTINGS} SELECT id, title, company, location, CAST(salary_min AS DOUBLE) AS salary_min,
        CAST(salary_max AS DOUBLE) AS salary_max, salary_currency, source, posted_date, job_type, experience_level,
        industry, is_remote, replace(skills, ',', '|') AS skills FROM postings""",
    doubles=("salary_min", "salary_max"),
)
def p08(spark, sf):
    view = projections.listing_view(domain.postings(spark, sf))
    return view.withColumn("skills", F.array_join("skills", "|"))


@query(
    "p09_demand_view",
    f"""WITH {DEMAND} SELECT concat_ws('@', skill_name, period_start) AS id, skill_name AS skillName,
        demand_count AS demandCount, period_start AS periodStart, last_day(period_start) AS periodEnd,
        'Global' AS region, 'General' AS industry FROM demand""",
)
def p09(spark, sf):
    demand = projections.shape_skill_demand(domain.skill_demand(spark, sf), "Global")
    return projections.demand_view(demand.withColumn("id", F.concat_ws("@", "skill_name", "period_start")))


@query(
    "p09_forecast_view",
    f"""WITH {FORECASTS} SELECT id, skill_name AS skillName, forecast_date AS forecastDate,
        predicted_demand AS predictedDemand, confidence_lower AS confidenceLower,
        confidence_upper AS confidenceUpper, model_version AS modelVersion, region FROM forecasts""",
    doubles=("predictedDemand", "confidenceLower", "confidenceUpper"),
)
def p09f(spark, sf):
    return projections.forecast_view(domain.stored_forecasts(spark, sf))


@query(
    "p10_format_salary",
    f"""WITH {POSTINGS}, cut AS (
          SELECT CASE WHEN is_remote THEN NULL ELSE salary_min END AS lo,
                 CASE WHEN source = 'O' THEN NULL ELSE salary_max END AS hi FROM postings)
        SELECT CASE WHEN lo IS NOT NULL AND hi IS NOT NULL
                      THEN '$' || CAST(round(lo / 1000.0, 0) AS BIGINT) || 'k – $' || CAST(round(hi / 1000.0, 0) AS BIGINT) || 'k'
                    WHEN lo IS NOT NULL THEN 'From $' || CAST(round(lo / 1000.0, 0) AS BIGINT) || 'k'
                    WHEN hi IS NOT NULL THEN 'Up to $' || CAST(round(hi / 1000.0, 0) AS BIGINT) || 'k'
                    ELSE 'N/A' END AS salary_label, count(*) AS n FROM cut GROUP BY 1""",
)
def p10(spark, sf):
    p = domain.postings(spark, sf, "is_remote", "source", "salary_min", "salary_max", "salary_currency")
    cut = p.withColumns({
        "salary_min": F.when(~F.col("is_remote"), F.col("salary_min")),
        "salary_max": F.when(F.col("source") != "O", F.col("salary_max")),
    })
    return projections.with_salary_label(cut).groupBy("salary_label").agg(F.count(F.lit(1)).alias("n"))


@query(
    "p11_month_label",
    f"WITH {VOLUME} SELECT date, strftime(date, '%b %Y') AS month_label, count FROM volume",
)
def p11(spark, sf):
    return projections.with_month_label(domain.order_volume(spark, sf), "date").select("date", "month_label", "count")


@query(
    "p12_round_forecasts",
    f"""WITH {FORECASTS} SELECT skill_name, forecast_date, round(CAST(predicted_demand AS DECIMAL(18,6)), 2) AS predicted_demand,
        round(CAST(confidence_lower AS DECIMAL(18,6)), 2) AS confidence_lower,
        round(CAST(confidence_upper AS DECIMAL(18,6)), 2) AS confidence_upper FROM forecasts""",
    doubles=("predicted_demand", "confidence_lower", "confidence_upper"),
)
def p12(spark, sf):
    rounded = projections.round_forecasts(domain.stored_forecasts(spark, sf), 2)
    return rounded.select("skill_name", "forecast_date", "predicted_demand", "confidence_lower", "confidence_upper")


@query(
    "p13_with_model_metadata",
    f"WITH {DEMAND} SELECT skill_name, period_start, demand_count, 'LinReg_NoSpike_v3' AS model_version, 'Global' AS region FROM demand",
)
def p13(spark, sf):
    demand = domain.skill_demand(spark, sf).select("skill_name", "period_start", "demand_count")
    return projections.with_model_metadata(demand, "LinReg_NoSpike_v3")


@query(
    "p15_unpivot_bounds",
    f"""WITH {FORECASTS} SELECT skill_name, forecast_date, 'upper' AS line, confidence_upper AS value FROM forecasts
        UNION ALL SELECT skill_name, forecast_date, 'lower', confidence_lower FROM forecasts
        UNION ALL SELECT skill_name, forecast_date, 'predicted', predicted_demand FROM forecasts""",
    doubles=("value",),
)
def p15(spark, sf):
    return projections.unpivot_bounds(domain.stored_forecasts(spark, sf))


# ---------------------------------------------------------------------- filters


@query(
    "f01_not_null",
    "SELECT count(*) AS n FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND l.toxic IS NOT NULL",
)
def f01(spark, sf):
    joined = domain.table(spark, sf, "documents").select("doc_id").join(domain.table(spark, sf, "labels"), "doc_id", "left")
    return aggregates.count_rows(filters.not_null(joined, ["quality", "toxic"]))


@query(
    "f02_non_blank",
    "SELECT lang, count(*) AS n FROM documents WHERE text IS NOT NULL AND trim(text, ' ') <> '' GROUP BY lang",
)
def f02(spark, sf):
    docs = domain.table(spark, sf, "documents")
    return docs.filter(filters.non_blank("text")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f03_contains_ci",
    f"WITH {POSTINGS} SELECT title, count(*) AS n FROM postings WHERE contains(lower(title), 'red') GROUP BY title",
)
def f03(spark, sf):
    p = domain.postings(spark, sf, "title")
    return p.filter(filters.contains_ci("title", "ReD")).groupBy("title").agg(F.count(F.lit(1)).alias("n"))


@query("f04_equals_ci", f"WITH {POSTINGS} SELECT count(*) AS n FROM postings WHERE lower(industry) = 'machinery'")
def f04(spark, sf):
    return aggregates.count_rows(domain.postings(spark, sf, "industry").filter(filters.equals_ci("industry", "Machinery")))


@query("f05_is_true", f"WITH {POSTINGS} SELECT location, count(*) AS n FROM postings WHERE is_remote GROUP BY location")
def f05(spark, sf):
    p = domain.postings(spark, sf, "location", "is_remote")
    return p.filter(filters.is_true("is_remote")).groupBy("location").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f06_search_jobs",
    f"""WITH {POSTINGS} SELECT id, title, location, industry, experience_level FROM postings
        WHERE contains(lower(title), 'blue') AND lower(location) = 'nation_3' AND lower(industry) = 'building' AND is_remote""",
)
def f06(spark, sf):
    p = domain.postings(spark, sf, "id", "title", "location", "industry", "experience_level", "is_remote")
    found = filters.search_jobs(p, title="Blue", location="Nation_3", industry="BUILDING", experience_level=" ", is_remote=True)
    return found.drop("is_remote")


@query("f07_by_id", "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderpriority AS priority FROM orders WHERE o_orderkey = 7")
def f07(spark, sf):
    orders = domain.table(spark, sf, "orders")
    return filters.by_id(orders, 7, "o_orderkey").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
    )


@query(
    "f08_date_between",
    """SELECT CAST(l_shipdate AS DATE) AS day, count(*) AS n FROM lineitem
       WHERE l_shipdate BETWEEN TIMESTAMP '1997-02-01' AND TIMESTAMP '1997-03-31' GROUP BY 1""",
)
def f08(spark, sf):
    chosen = filters.date_between(domain.table(spark, sf, "lineitem"), "l_shipdate", "1997-02-01", "1997-03-31")
    return chosen.groupBy(F.to_date("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("f09_exclude_total", f"WITH {FORECASTS} SELECT skill_name, count(*) AS n FROM forecasts WHERE skill_name <> '(job_listings_total)' GROUP BY 1")
def f09(spark, sf):
    rows = filters.exclude_total(domain.stored_forecasts(spark, sf))
    return rows.groupBy("skill_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "f09_only_total",
    f"WITH {FORECASTS} SELECT forecast_date, predicted_demand FROM forecasts WHERE skill_name = '(job_listings_total)'",
    doubles=("predicted_demand",),
)
def f09t(spark, sf):
    return filters.only_total(domain.stored_forecasts(spark, sf)).select("forecast_date", "predicted_demand")


SPIKES = ("1998-02-01", "1998-03-01", "1998-04-01", "1998-05-01", "1998-06-01")
SPIKES_SQL = ", ".join(f"DATE '{d}'" for d in SPIKES)


@query(
    "f10_exclude_periods",
    f"""WITH {CLOSED}, kept AS (SELECT *, count(*) FILTER (period_start NOT IN ({SPIKES_SQL})) OVER (PARTITION BY skill_name) AS k FROM closed)
        SELECT skill_name, period_start, demand_count FROM kept WHERE k < 3 OR period_start NOT IN ({SPIKES_SQL})""",
)
def f10(spark, sf):
    kept = filters.exclude_periods(domain.closed_skill_demand(spark, sf), SPIKES)
    return kept.select("skill_name", "period_start", "demand_count")


@query("f11_since", "SELECT l_returnflag AS flag, count(*) AS n FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY 1")
def f11(spark, sf):
    recent = filters.since(domain.table(spark, sf, "lineitem"), "l_shipdate", "2000-01-01")
    return recent.groupBy(F.col("l_returnflag").alias("flag")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f12_min_series_length",
    """WITH s AS (SELECT o_custkey AS skill_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS period_start, count(*) AS demand_count
                  FROM orders GROUP BY ALL),
            sized AS (SELECT *, count(*) OVER (PARTITION BY skill_name) AS k FROM s)
       SELECT skill_name, period_start, demand_count FROM sized WHERE k >= 8""",
)
def f12(spark, sf):
    monthly = domain.table(spark, sf, "orders").groupBy(
        F.col("o_custkey").alias("skill_name"), dates.month_start("o_orderdate").alias("period_start")
    ).agg(F.count(F.lit(1)).alias("demand_count"))
    return filters.min_series_length(monthly, 8)


# ------------------------------------------------------------------------ joins


@query(
    "j01_lookup_join",
    "SELECT n_name, r_name, count(*) AS n FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2",
)
def j01(spark, sf):
    customers = domain.table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    nations = domain.table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    named = joins.lookup_join(joins.lookup_join(customers, nations, "n_nationkey"), domain.table(spark, sf, "region"), "r_regionkey")
    return named.groupBy("n_name", "r_name").agg(F.count(F.lit(1)).alias("n"))


@query(
    "j02_skills_with_dates",
    """SELECT p_brand AS skill_name, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1, 2""",
)
def j02(spark, sf):
    job_skills = domain.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill_abr"))
    listed = domain.table(spark, sf, "orders").select(F.col("o_orderkey").alias("job_id"), F.col("o_orderdate").alias("listed_date"))
    skill_map = domain.table(spark, sf, "part").select(F.col("p_partkey").alias("skill_abr"), F.col("p_brand").alias("skill_name"))
    dated = joins.skills_with_dates(job_skills, listed, skill_map)
    return dated.groupBy("skill_name", dates.month_start("listed_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "j03_cap_to_history",
    f"""WITH {FORECASTS}, peak AS (SELECT skill_name, max(demand_count) * 0.8 AS cap FROM closed GROUP BY 1)
        SELECT f.skill_name, forecast_date, CASE WHEN cap IS NULL THEN predicted_demand ELSE least(predicted_demand, cap) END AS predicted_demand,
               confidence_lower, confidence_upper FROM forecasts f LEFT JOIN peak p ON f.skill_name = p.skill_name""",
    doubles=("predicted_demand", "confidence_lower", "confidence_upper"),
)
def j03(spark, sf):
    capped = joins.cap_to_history(domain.stored_forecasts(spark, sf), domain.closed_skill_demand(spark, sf), factor=0.8)
    return capped.select("skill_name", "forecast_date", "predicted_demand", "confidence_lower", "confidence_upper")


@query(
    "j04_restrict_to_top",
    f"""WITH {CLOSED}, top AS (SELECT lower(skill_name) AS k FROM closed GROUP BY 1 ORDER BY sum(demand_count) DESC, 1 LIMIT 5)
        SELECT skill_name, period_start, demand_count FROM closed WHERE lower(skill_name) IN (SELECT k FROM top)""",
)
def j04(spark, sf):
    demand = domain.closed_skill_demand(spark, sf)
    return joins.restrict_to_top(demand, aggregates.top_skills(demand, 5), "skill_name", 5, ignore_case=True)


@query(
    "j07_align_on_dates",
    f"""WITH {FORECASTS}, top AS (SELECT skill_name FROM forecasts GROUP BY 1 ORDER BY avg(predicted_demand) DESC, 1 LIMIT 5),
        wanted AS (SELECT * FROM forecasts WHERE skill_name IN (SELECT skill_name FROM top) AND
                   NOT (skill_name <> '(job_listings_total)' AND month(forecast_date) = 6)),
        days AS (SELECT DISTINCT forecast_date FROM wanted)
        SELECT t.skill_name, d.forecast_date, w.predicted_demand FROM top t CROSS JOIN days d
        LEFT JOIN wanted w ON w.skill_name = t.skill_name AND w.forecast_date = d.forecast_date""",
    doubles=("predicted_demand",),
)
def j07(spark, sf):
    stored = domain.stored_forecasts(spark, sf)
    ranking = stored.groupBy("skill_name").agg(F.avg("predicted_demand").alias("p")).orderBy(F.desc("p"), "skill_name")
    wanted = joins.restrict_to_top(stored, ranking, "skill_name", 5)
    # leave one month out of the skill series, so that the alignment has something to fill
    holes = wanted.filter((F.col("skill_name") == "(job_listings_total)") | (F.month("forecast_date") != 6))
    return joins.align_on_dates(holes)


def _history_and_forecast(spark, sf):
    stored = filters.only_total(domain.stored_forecasts(spark, sf))
    predicted = stored.select(
        F.col("forecast_date").alias("date"), F.col("predicted_demand").alias("count"), "confidence_lower", "confidence_upper"
    )
    history = domain.order_volume(spark, sf).select("date", F.col("count").cast("double").alias("count"))
    return history, predicted


HISTORY_AND_FORECAST = f"""{FORECASTS}, {VOLUME}, history AS (SELECT date, CAST(count AS DOUBLE) AS count FROM volume),
  predicted AS (SELECT forecast_date AS date, predicted_demand AS count, confidence_lower, confidence_upper
                FROM forecasts WHERE skill_name = '(job_listings_total)')"""


@query(
    "j08_trend_timeline",
    f"""WITH {HISTORY_AND_FORECAST} SELECT coalesce(h.date, p.date) AS date, h.count AS historical, p.count AS predicted,
        p.confidence_lower AS lower, p.confidence_upper AS upper FROM history h FULL OUTER JOIN predicted p ON h.date = p.date""",
    doubles=("historical", "predicted", "lower", "upper"),
)
def j08(spark, sf):
    return joins.trend_timeline(*_history_and_forecast(spark, sf))


# ------------------------------------------------------------------- aggregates


@query("a01_count_rows", f"WITH {POSTINGS} SELECT count(*) AS n FROM postings")
def a01(spark, sf):
    return aggregates.count_rows(domain.postings(spark, sf, "id"))


@query("a01_count_remote", f"WITH {POSTINGS} SELECT count(*) AS n FROM postings WHERE is_remote")
def a01r(spark, sf):
    return aggregates.count_if(domain.postings(spark, sf, "is_remote"), filters.is_true("is_remote"))


@query(
    "a02_avg_salary",
    f"WITH {POSTINGS} SELECT coalesce(round(CAST(sum(salary_min + salary_max) AS DOUBLE) / 2 / count(*), 2), 0.0) AS avg_salary FROM postings WHERE salary_min IS NOT NULL AND salary_max IS NOT NULL",
    doubles=("avg_salary",), places=2,
)
def a02(spark, sf):
    return aggregates.avg_salary(domain.postings(spark, sf, "salary_min", "salary_max"))


@query(
    "a03_top_locations",
    f"WITH {POSTINGS} SELECT location AS name, count(*) AS n FROM postings WHERE location IS NOT NULL AND location <> '' GROUP BY 1 ORDER BY n DESC, name LIMIT 10",
)
def a03(spark, sf):
    return aggregates.top_by_count(domain.postings(spark, sf, "location"), "location")


@query(
    "a03_top_industries",
    f"WITH {POSTINGS} SELECT industry AS name, count(*) AS n FROM postings WHERE industry IS NOT NULL AND industry <> '' GROUP BY 1 ORDER BY n DESC, name LIMIT 10",
)
def a03i(spark, sf):
    return aggregates.top_by_count(domain.postings(spark, sf, "industry"), "industry")


TOP_LISTING_SKILLS = "SELECT trim(unnest(string_split(skills, ','))) AS name, count(*) AS n FROM postings WHERE skills <> '' GROUP BY 1 ORDER BY n DESC, name LIMIT 20"


@query("a04_top_skills_from_listings", f"WITH {POSTINGS} {TOP_LISTING_SKILLS}")
def a04(spark, sf):
    return aggregates.top_skills_from_listings(domain.postings(spark, sf, "skills"))


@query(
    "a05_dashboard_stats",
    f"""WITH {POSTINGS}
    SELECT 'totals' AS section, 'total_jobs' AS name, CAST(count(*) AS DOUBLE) AS value FROM postings
    UNION ALL SELECT 'totals', 'avg_salary', round(CAST(sum(salary_min + salary_max) AS DOUBLE) / 2 / count(*), 2) FROM postings
    UNION ALL SELECT 'totals', 'remote_jobs', count(*) FILTER (is_remote) FROM postings
    UNION ALL (SELECT 'industry', industry, count(*) AS n FROM postings WHERE industry <> '' GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
    UNION ALL (SELECT 'location', location, count(*) AS n FROM postings WHERE location <> '' GROUP BY 2 ORDER BY n DESC, 2 LIMIT 10)
    UNION ALL (SELECT 'skill', name, n FROM ({TOP_LISTING_SKILLS}))""",
    doubles=("value",), places=2,
)
def a05(spark, sf):
    return aggregates.dashboard_stats(
        domain.postings(spark, sf, "salary_min", "salary_max", "is_remote", "industry", "location", "skills")
    )


@query("a06_monthly_counts", f"WITH {POSTINGS} SELECT CAST(date_trunc('month', posted_date) AS DATE) AS month, count(*) AS n FROM postings WHERE posted_date IS NOT NULL GROUP BY 1")
def a06(spark, sf):
    return aggregates.monthly_counts(domain.postings(spark, sf, "posted_date"), "posted_date")


@query(
    "a07_skill_month_counts",
    f"""WITH {POSTING_SKILLS} SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period_start, skill AS skill_name, count(*) AS demand_count
        FROM posting_skills GROUP BY 1, 2""",
)
def a07(spark, sf):
    p = aggregates.split_skills(domain.postings(spark, sf, "posted_date", "skills"))
    return aggregates.skill_month_counts(p, "posted_date")


@query(
    "a07_skill_month_counts_with_total",
    f"""WITH {POSTING_SKILLS} SELECT CAST(date_trunc('month', posted_date) AS DATE) AS period_start, skill AS skill_name, count(*) AS demand_count
        FROM posting_skills GROUP BY 1, 2
        UNION ALL SELECT CAST(date_trunc('month', posted_date) AS DATE), '(job_listings_total)', count(*) FROM postings GROUP BY 1""",
)
def a07t(spark, sf):
    p = aggregates.split_skills(domain.postings(spark, sf, "posted_date", "skills"))
    return aggregates.skill_month_counts_with_total(p, "posted_date")


@query(
    "a08_monthly_demand",
    """SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period_start, l_returnflag AS skill_name, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS demand_count
       FROM lineitem GROUP BY 1, 2""",
)
def a08(spark, sf):
    daily = domain.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("period_start"), F.col("l_returnflag").alias("skill_name"), F.col("l_quantity").cast("bigint").alias("demand_count")
    )
    return aggregates.monthly_demand(daily)


@query(
    "a09_total_demand",
    f"WITH {DEMAND} SELECT period_start, CAST(sum(demand_count) AS BIGINT) AS count, min(last_day(period_start)) AS period_end FROM demand GROUP BY 1",
)
def a09(spark, sf):
    return aggregates.total_demand(projections.shape_skill_demand(domain.skill_demand(spark, sf), "Global"))


@query(
    "a10_top_skills",
    f"WITH {DEMAND} SELECT lower(skill_name) AS skill_name, CAST(sum(coalesce(demand_count, 0)) AS BIGINT) AS total_demand FROM demand GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20",
)
def a10(spark, sf):
    return aggregates.top_skills(domain.skill_demand(spark, sf))


@query(
    "a11_forecast_trends",
    f"""WITH {FORECASTS}, ranked AS (SELECT lower(skill_name) AS skill_name, avg(coalesce(predicted_demand, 0)) AS average_predicted_demand
          FROM forecasts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)
        SELECT r.skill_name, average_predicted_demand, row_number() OVER (PARTITION BY r.skill_name ORDER BY forecast_date) - 1 AS position,
               forecast_date, predicted_demand FROM ranked r JOIN forecasts f ON lower(f.skill_name) = r.skill_name""",
    doubles=("average_predicted_demand", "predicted_demand"), longs=("position",),
)
def a11(spark, sf):
    trends = aggregates.forecast_trends(domain.stored_forecasts(spark, sf))
    points = trends.select("skill_name", "average_predicted_demand", F.posexplode("forecasts").alias("position", "p"))
    return points.select("skill_name", "average_predicted_demand", "position", "p.forecast_date", "p.predicted_demand")


@query(
    "a12_predictions",
    f"""WITH {FORECASTS} SELECT skill_name, CAST(sum(round(CAST(predicted_demand AS DECIMAL(18,6)), 2)) AS DOUBLE) / count(*) AS average_predicted_demand
        FROM forecasts WHERE skill_name <> '(job_listings_total)' GROUP BY 1 ORDER BY round(average_predicted_demand, 2) DESC, 1 LIMIT 10""",
    doubles=("average_predicted_demand",), places=2,
)
def a12(spark, sf):
    return aggregates.predictions(domain.stored_forecasts(spark, sf), 10)


@query(
    "a13_min_max_by_series",
    f"""WITH {FORECASTS} SELECT skill_name, min(predicted_demand) AS min_value, max(predicted_demand) AS max_value FROM forecasts
        GROUP BY 1 ORDER BY max_value DESC, skill_name LIMIT 10""",
    doubles=("min_value", "max_value"),
)
def a13(spark, sf):
    return aggregates.min_max_by_series(domain.stored_forecasts(spark, sf))


@query(
    "a31_top_pct",
    f"""WITH {POSTINGS} SELECT title AS name, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM postings), 2) AS pct FROM postings
        WHERE title IS NOT NULL GROUP BY 1 ORDER BY n DESC, name LIMIT 20""",
    doubles=("pct",), places=2,
)
def a31(spark, sf):
    return aggregates.top_pct(domain.postings(spark, sf, "title"), "title")


# ------------------------------------------------------- sorts, pages and top-k


@query(
    "l01_page",
    f"WITH {POSTINGS} SELECT id, title, posted_date FROM postings ORDER BY posted_date DESC NULLS FIRST, id LIMIT 20 OFFSET 40",
)
def l01(spark, sf):
    return paging.page(domain.postings(spark, sf, "id", "title", "posted_date"), paging.jobs_order(), 2, 20)


def _pages(spark, sf):
    df = domain.postings(spark, sf, "id", "title", "posted_date")
    return paging.store_pages(df, paging.JOBS_KEYS, scratch_path(spark, "pages"), rows_a_range=2_000)


DEEP_PAGE = f"WITH {POSTINGS} SELECT id, title, posted_date FROM postings ORDER BY posted_date DESC NULLS FIRST, id LIMIT 20 OFFSET 4000"


@query("l01_deep_page", DEEP_PAGE)
def l01d(spark, sf):
    return _pages(spark, sf).page(200, 20)


@query("l01_next_page", DEEP_PAGE)
def l01n(spark, sf):
    """The page behind the last row of the one before."""
    pages = _pages(spark, sf)
    last = pages.page(199, 20).tail(1)[0]
    return pages.after([last.posted_date, last.id], 20)


@query(
    "l01_page_info",
    f"""WITH {POSTINGS} SELECT count(*) AS totalElements, CAST(ceil(count(*) / 20.0) AS BIGINT) AS totalPages, 2 AS number, 20 AS size
        FROM postings WHERE contains(lower(title), 'red')""",
    longs=("number", "size"),
)
def l01i(spark, sf):
    return paging.page_info(filters.search_jobs(domain.postings(spark, sf, "title"), title="red"), 2, 20)


@query(
    "l02_sort_order_nulls_first",
    """SELECT d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       ORDER BY l.quality DESC NULLS FIRST, d.doc_id LIMIT 500""",
    longs=("quality",),
)
def l02(spark, sf):
    joined = domain.table(spark, sf, "documents").select("doc_id").join(domain.table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return paging.page(joined, [F.desc_nulls_first("quality"), F.asc("doc_id")], 0, 500)


@query(
    "l02_demand_page",
    f"WITH {DEMAND} SELECT skill_name, period_start, demand_count FROM demand WHERE contains(lower(skill_name), '#1') ORDER BY demand_count DESC NULLS FIRST, skill_name, period_start LIMIT 20",
)
def l02d(spark, sf):
    found = filters.search_demand(domain.skill_demand(spark, sf), skill="#1")
    return paging.page(found, paging.demand_order(), 0, 20)


@query(
    "l02_forecast_page",
    f"WITH {FORECASTS} SELECT skill_name, forecast_date, predicted_demand FROM forecasts ORDER BY skill_name, forecast_date LIMIT 20 OFFSET 20",
    doubles=("predicted_demand",),
)
def l02f(spark, sf):
    stored = domain.stored_forecasts(spark, sf).select("skill_name", "forecast_date", "predicted_demand")
    return paging.page(stored, paging.forecast_order(), 1, 20)


@query(
    "l03_top_k",
    f"WITH {DEMAND} SELECT skill_name, period_start, demand_count FROM demand ORDER BY demand_count DESC, skill_name, period_start LIMIT 8",
)
def l03(spark, sf):
    return paging.top_k(domain.skill_demand(spark, sf), paging.demand_order(), 8)


@query(
    "l04_last_k",
    "SELECT * FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(*) AS n FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12) ORDER BY month",
)
def l04(spark, sf):
    return paging.last_k(aggregates.monthly_counts(domain.table(spark, sf, "orders"), "o_orderdate"), "month", 12)


@query(
    "w01_ranked",
    f"""WITH {POSTINGS}, top AS (SELECT title, count(*) AS n FROM postings GROUP BY 1 ORDER BY n DESC, title LIMIT 20)
        SELECT title, n, row_number() OVER (ORDER BY n DESC, title) AS rank FROM top""",
    longs=("rank",),
)
def w01(spark, sf):
    counted = domain.postings(spark, sf, "title").groupBy("title").agg(F.count(F.lit(1)).alias("n"))
    return windows.ranked(counted, [F.desc("n"), F.asc("title")], 20)


# --------------------------------------------------------------- set operations


@query(
    "u01_union_all",
    f"""WITH {DEMAND} SELECT skill_name, period_start, CAST(demand_count AS BIGINT) AS demand_count FROM demand
        UNION ALL SELECT '(job_listings_total)', period_start, CAST(sum(demand_count) AS BIGINT) FROM demand GROUP BY period_start""",
)
def u01(spark, sf):
    return etl.with_total_series(domain.skill_demand(spark, sf))


@query(
    "u02_historical_and_predicted",
    f"""WITH {HISTORY_AND_FORECAST} SELECT date, count, NULL AS confidence_lower, NULL AS confidence_upper, 'historical' AS kind FROM history
        UNION ALL SELECT date, count, confidence_lower, confidence_upper, 'predicted' FROM predicted""",
    doubles=("count", "confidence_lower", "confidence_upper"),
)
def u02(spark, sf):
    return setops.historical_and_predicted(*_history_and_forecast(spark, sf))


@query(
    "u03_distinct_dates",
    f"WITH {HISTORY_AND_FORECAST} SELECT date FROM history UNION SELECT date FROM predicted",
)
def u03(spark, sf):
    return setops.distinct_dates(_history_and_forecast(spark, sf), "date")


# -------------------------------------------------------------------- functions

COMMON_WORDS = ("The", "and", "of", "to", "in", "is", "on", "la", "le", "et", "der", "die", "und", "que", "los")
WORDS_SQL = ", ".join(f"'{w.lower()}'" for w in COMMON_WORDS)
TOKENS_SQL = "list_distinct(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), lambda w: w IN (" + WORDS_SQL + ")))"


@query(
    "c01_extract_skills",
    f"SELECT doc_id, array_to_string(list_sort({TOKENS_SQL}), ',') AS skills FROM documents",
)
def c01(spark, sf):
    docs = domain.table(spark, sf, "documents").select("doc_id", "text")
    found = text.extract_skills("text", COMMON_WORDS)
    return docs.select("doc_id", text.join_list(F.transform(found, F.lower)).alias("skills"))


@query(
    "c01_posting_demand",
    f"""WITH tagged AS (SELECT lang, unnest({TOKENS_SQL}) AS word FROM documents)
        SELECT lang, word, count(*) AS n FROM tagged GROUP BY 1, 2""",
)
def c01d(spark, sf):
    docs = domain.table(spark, sf, "documents").select("doc_id", "lang", "text")
    tagged = docs.select("lang", F.explode(text.extract_skills("text", COMMON_WORDS)).alias("word"))
    return tagged.groupBy("lang", F.lower("word").alias("word")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c03_text_functions",
    """SELECT doc_id, lower(trim(text, ' ')) AS cleaned, left(text, 60) AS head, 'Senior ' || lang || ' Engineer' AS title,
              contains(text, 'the') AS has_the, source || ' ' || lang AS joined FROM documents""",
)
def c03(spark, sf):
    docs = domain.table(spark, sf, "documents")
    return docs.select(
        "doc_id", text.clean_text("text").alias("cleaned"), text.shorten("text", 60).alias("head"),
        text.fill_template("Senior {} Engineer", "lang").alias("title"), F.col("text").contains("the").alias("has_the"),
        text.joined_text("source", "lang").alias("joined"),
    )


@query(
    "c04_parse_date",
    """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS iso_day, CAST(NULL AS DATE) AS not_iso,
              CAST(o_orderdate AS DATE) AS any_form, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_form,
              CAST(NULL AS DATE) AS no_form, CAST(o_orderdate AS DATE) + 7305 AS from_ms, CAST(o_orderdate AS DATE) + 7305 AS from_s FROM orders""",
)
def c04(spark, sf):
    orders = domain.table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    # moved on by 20 years: milliseconds are told from seconds by a size reached in 2001
    seconds = (F.unix_date(F.to_date("o_orderdate")).cast("bigint") + 7305) * 86400
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.to_date(dates.parse_date(day, "iso_date")).alias("iso_day"),
        F.to_date(dates.parse_date(F.concat(day, F.lit("T10:00")), "iso_date")).alias("not_iso"),
        F.to_date(dates.parse_date(
            F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
            .when(F.col("o_orderkey") % 3 == 1, F.date_format("o_orderdate", " d MMM yyyy")).otherwise(day)
        )).alias("any_form"),
        F.to_date(dates.parse_date(F.date_format("o_orderdate", "MMM yyyy"))).alias("month_form"),
        F.to_date(dates.parse_date(F.concat(F.lit("on "), day))).alias("no_form"),
        F.to_date(dates.parse_date((seconds * 1000).cast("double"), "epoch")).alias("from_ms"),
        F.to_date(dates.parse_date(seconds.cast("double"), "epoch")).alias("from_s"),
    )


@query(
    "c05_date_arithmetic",
    """WITH d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day FROM lineitem)
       SELECT day, CAST(date_trunc('month', day) AS DATE) AS month_start, last_day(day) AS month_end,
              CAST(day + INTERVAL 1 MONTH AS DATE) AS next_month, day + 30 AS next_30,
              (year(day) - 1995) * 12 + month(day) - 1 AS gap, date_diff('day', DATE '1995-01-01', day) / 30.44 AS t,
              month(day) AS month, CAST(date_trunc('week', day) AS DATE) AS week FROM d""",
    doubles=("t",), longs=("gap", "month"),
)
def c05(spark, sf):
    days = domain.table(spark, sf, "lineitem").select(F.to_date("l_shipdate").alias("day")).distinct()
    origin = F.lit("1995-01-01").cast("date")
    return days.select(
        "day", dates.month_start("day").alias("month_start"), dates.month_end("day").alias("month_end"),
        dates.add_period("day", 1).alias("next_month"), dates.add_period("day", 1, "30 days").alias("next_30"),
        dates.month_gap("day", origin).alias("gap"), dates.months_since("day", origin).alias("t"),
        F.month("day").alias("month"), dates.period_start("day", "week").alias("week"),
    )


@query(
    "c06_math",
    """SELECT o_orderkey AS id, greatest(1000.0, least(300000.0, o_totalprice)) AS clipped, o_totalprice / (o_custkey + 0.000001) AS ratio,
              sin(o_custkey) AS s, cos(o_custkey) AS c, sqrt(o_totalprice) AS r, pow(1.015, o_custkey % 12) AS g FROM orders""",
    doubles=("clipped", "ratio", "s", "c", "r", "g"),
)
def c06(spark, sf):
    price, customer = F.col("o_totalprice"), F.col("o_custkey")
    return domain.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), values.clip(price, 1000.0, 300000.0).alias("clipped"),
        values.safe_ratio(price, customer).alias("ratio"), F.sin(customer).alias("s"), F.cos(customer).alias("c"),
        F.sqrt(price).alias("r"), F.pow(F.lit(1.015), customer % 12).alias("g"),
    )


@query(
    "c07_arrays",
    f"""WITH {POSTINGS} SELECT skills, array_to_string(list_sort(list_distinct(string_split(skills, ','))), ',') AS joined,
        string_split(skills, ',')[1] AS first, len(string_split(skills, ',')) AS items, count(*) AS n FROM postings GROUP BY 1, 2, 3, 4""",
    longs=("items",),
)
def c07(spark, sf):
    p = domain.postings(spark, sf, "skills").withColumn("items_", text.split_list("skills"))
    return p.groupBy(
        "skills", text.join_list("items_").alias("joined"), text.first_n("items_", 1)[0].alias("first"), F.size("items_").alias("items")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c08_coercion",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '"k": (\\d+)', 1) AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS bad,
              event_type = 'click' AS is_click, coalesce(CASE WHEN event_type = 'view' THEN event_type END, 'USD') AS unit FROM events""",
    doubles=("k", "bad"),
)
def c08(spark, sf):
    kind = F.col("event_type")
    token = F.when(kind == "click", "true").when(kind == "view", "\"true\"")
    return domain.table(spark, sf, "events").select(
        "event_id", values.to_number(F.get_json_object("props", "$.k")).alias("k"), values.to_number("event_type").alias("bad"),
        values.strict_bool(token).alias("is_click"), values.or_default(F.when(kind == "view", kind), "USD").alias("unit"),
    )


@query(
    "c09_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
              '{"event_type":"' || event_type || '","user_id":' || user_id || ',"note":null}' AS document FROM events""",
)
def c09(spark, sf):
    events = domain.table(spark, sf, "events")
    return events.select(
        "event_id", values.parse_json("props", "k BIGINT")["k"].alias("k"),
        values.to_document("event_type", "user_id", F.lit(None).cast("string").alias("note")).alias("document"),
    )
