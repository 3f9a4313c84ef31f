"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose the
data and the local cores; BENCH_QUERIES may name queries, or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from laborlens.operators import aggregates, joins  # noqa: E402
from laborlens.plans import domain  # noqa: E402
from laborlens.plans.tables import materialize  # noqa: E402
from laborlens.registry import QUERIES  # noqa: E402
from laborlens.session import build_session  # noqa: E402

HEADLINE = (
    # extraction and aggregation over raw postings
    "c01_extract_skills", "c01_posting_demand", "a07_skill_month_counts_with_total", "j02_skills_with_dates",
    "a05_dashboard_stats", "f06_search_jobs", "l01_page", "a06_monthly_counts",
    # profiling
    "a14_series_stats", "a15_describe", "a18_numeric_profile", "a28_histogram", "m15_characterize",
    # series and models
    "j05_densify", "w08_iqr_flags", "m02_grouped_ols", "m03_cross_validate", "m04_linreg_forecast",
    "m04_forecast_table_capped", "m05_stable_mean_forecast", "m06_trend_following", "m08_median_blend",
    "m09_holt_winters", "m10_seasonal_ar", "m11_lag_regression", "m17_region_forecast",
    # serving and reports
    "a10_top_skills", "a11_forecast_trends", "a12_predictions", "j09_year_over_year", "j10_related_skills",
    "a33_skill_ranking", "a35_location_summary", "a38_demand_cube", "f13_facets", "u04_merge_sources",
    # sampling, sources and streams
    "l07_stratum_sizes", "k01_write_tsv", "t03_sink_postings", "t04_live_counts",
)


def serving(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to build the stored tables once, and to serve from them."""
    timings: dict[str, float] = {}

    def timed(name: str, work):
        started = time.perf_counter()
        done = work()
        timings[name] = round(time.perf_counter() - started, 3)
        return done

    demand = timed("build_demand", lambda: domain.demand_table(spark, sf_dir))
    forecasts = timed("build_forecasts", lambda: materialize(domain.stored_forecasts(spark, sf_dir), "forecasts"))
    served = {
        "serve_top_skills": lambda: aggregates.top_skills(demand),
        "serve_forecast_trends": lambda: aggregates.forecast_trends(forecasts),
        "serve_predictions": lambda: aggregates.predictions(forecasts, 10),
        "serve_year_over_year": lambda: joins.year_over_year(demand),
    }
    for name, query in served.items():
        timed(name, lambda query=query: query().collect())
    return timings


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    asked = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if asked == "all" else asked.split(",") if asked else list(HEADLINE)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["a01_count_rows"].run(spark, sf_dir).collect()  # start-up is not part of any query
    timings: dict[str, float] = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - started, 3)
        if asked:
            print(f"{timings[name]:8.2f}  {name}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "serving": {} if asked else serving(spark, sf_dir),
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
