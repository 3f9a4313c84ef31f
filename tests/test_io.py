"""Sources, sinks and streams."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from laborlens.operators import projections
from laborlens.plans import etl
from laborlens.registry import QUERIES
from laborlens.schemas import JOB_LISTINGS
from laborlens.session import scratch_path
from laborlens.sources import readers, sinks
from laborlens.streaming import live, postings


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir") + "/x-")


def test_seed_tsv_forms(spark, tmp_path):
    names = JOB_LISTINGS.fieldNames()
    lines = ["\t".join(names)]
    for flag in ("t", "True", "f", "False", ""):
        lines.append("\t".join(["Dev", "", "NY", "78158", "", "USD", "s", "1", "2024-01-25", "PT", "Senior", "General", flag, "Excel"]))
    (tmp_path / "seed.tsv").write_text("\n".join(lines) + "\n")
    got = readers.read_seed_tsv(spark, str(tmp_path / "seed.tsv")).collect()
    assert [r.is_remote for r in got] == [True, True, False, False, None]
    assert got[0].company is None and got[0].salary_max is None and float(got[0].salary_min) == 78158
    assert got[0].posted_date == dt.datetime(2024, 1, 25)


def test_postings_csv_with_quotes_and_breaks(spark, tmp_path):
    (tmp_path / "p.csv").write_text('a,Job Title,b\n1,"He said ""hi"",\nnext line",x\n')
    got = readers.read_postings_csv(spark, str(tmp_path / "p.csv"), ["a", "Job Title", "b"], ["Job Title"]).collect()
    assert [r[0] for r in got] == ['He said "hi",\nnext line']


def test_latin_1(spark, tmp_path):
    (tmp_path / "l.csv").write_bytes("name,n\nJosé,1\n".encode("latin-1"))
    row = readers.read_inferred_csv(spark, str(tmp_path / "l.csv"), "ISO-8859-1").first()
    assert (row.name, row.n) == ("José", 1)


def test_roles_and_keys():
    roles = readers.detect_roles(["period_start", "end_date", "title", "skill_name", "demand", "total"])
    assert (roles.date, roles.skill, roles.demand) == ("period_start", "skill_name", "total")
    assert not readers.detect_roles(["a", "b"]).complete
    assert readers.detect_join_keys(["job_id", "skill_abr"], ["skill_abr", "skill_name"]) == ("skill_abr", "skill_abr", "skill_name")


def test_first_valid_file(spark, tmp_path):
    valid = "month,skill,count\n" + "".join(f"20{20 + i // 12}-{i % 12 + 1:02d}-03,Go,{i}\n" for i in range(14)) + "bad,Go,1\n2020-01-09,Go,5\n"
    files = {
        "a.csv": "skill,count\nGo,1\n", "b.csv": "month,skill,count\n2020-01-01,Go,1\n2022-01-01,Go,1\n",
        "c.csv": "month,skill,count\n" + "2020-01-01,Go,1\n" * 9, "d.csv": valid,
    }
    for name, body in files.items():
        (tmp_path / name).write_text(body)
    paths = [str(tmp_path / n) for n in reversed(files)]
    got, source = readers.load_first_valid(spark, paths, lambda: None)
    assert source.endswith("d.csv") and got.count() == 14
    assert got.orderBy("period_start").first().demand_count == 5.0
    fallback = spark.range(1)
    assert readers.load_first_valid(spark, paths[1:], lambda: fallback) == (fallback, "fallback")


def test_forecast_document_round_trip(spark, tmp_path):
    past = spark.createDataFrame([(dt.date(2024, 2, 1), 3.0), (dt.date(2024, 1, 1), 2.0)], "date date, count double")
    future = spark.createDataFrame([(dt.date(2024, 3, 1), 4.0, 3.111, 5.555)], "date date, count double, confidence_lower double, confidence_upper double")
    sinks.write_trend_document(past, future, str(tmp_path / "doc"))
    body = json.loads(next((tmp_path / "doc").glob("part-*.json")).read_text())
    assert body["historical"][0] == {"date": "2024-01-01", "count": 2.0, "confidenceLower": None, "confidenceUpper": None}
    assert body["predicted"][0]["confidenceUpper"] == 5.56
    got = readers.read_forecast_doc(spark, str(tmp_path / "doc")).orderBy("date").collect()
    assert [r.kind for r in got] == ["historical", "historical", "predicted"] and got[2].confidence_lower == 3.11


def test_append_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a",), (None,)], "title string")
    for batch in (0, 1, 1):
        sinks.append_table(df, path, batch)
    assert spark.read.parquet(path).count() == 2


def test_unknown_export_format(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.export(spark.range(1), str(tmp_path / "x"), "excel")


def test_partitioned_layout(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), 1), (dt.datetime(2024, 11, 5), 2)], "ts timestamp, v int")
    sinks.write_partitioned(df, str(tmp_path / "p"), "ts")
    assert (tmp_path / "p" / "year=2024" / "month=01" / "day=05").is_dir()


def test_incremental_scan(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert readers.incremental_scan(df, "v", None).count() == 3
    assert readers.incremental_scan(df, "v", 2).count() == 1
    assert readers.high_water_mark(df, "v").first()[0] == 3


def test_raw_postings_to_demand(spark):
    raw = spark.createDataFrame(
        [("Go dev", "go and SQL", "2024-01-05T01:00:00Z"), (None, "sql", "2024-01-09"), ("Java", None, None)],
        "job_title string, descriptions string, listingDate string",
    )
    got = etl.posting_demand(raw).orderBy("skill_name").collect()
    assert [(r.skill_name, r.demand_count, r.region) for r in got] == [("Go", 1, "Malaysia"), ("SQL", 2, "Malaysia")]


def test_sampled_listings(spark):
    columns = ["Job Id", "Job Title", "Company", "location", "Salary Range", "Work Type", "Job Posting Date", "Job Description", "Experience"]
    rows = [(str(i), "Dev", None, "Remote", "$59K-$99K", "Full-Time", f"2024-0{1 + i % 2}-10", "Python, SQL", "5 to 15 Years") for i in range(40)]
    raw = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))
    got = etl.sampled_listings(raw, total=11).collect()
    assert len(got) == 11 and list(got[0].asDict()) == JOB_LISTINGS.fieldNames()
    assert (got[0].company, got[0].job_type, got[0].experience_level, got[0].skills, got[0].is_remote) == ("", "FT", "SE", "Python,SQL", True)


MESSAGES = {
    '{"title":"a","salaryMin":12.5,"salaryMax":"99","isRemote":true,"skills":["x","y"],"postedDate":"2024-02-03"}': None,
    '{"title":"b","salaryCurrency":null,"isRemote":"true","skills":[]}': None,
    '{"title":"c","salaryCurrency":"EUR","skills":null}': None,
    '{"title":"d","postedDate":"2024-02-03T10:00"}': "postedDate",
    '{"title":"e","salaryMin":"lots"}': "salaryMin",
    '{"title":"f","skills":"x"}': "skills",
    '{"company":"g"}': "title",
    "{broken": "malformed",
    "": "malformed",
}


def test_message_rules(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    parsed = {r.value: r for r in postings.parse_postings(df).collect()}
    assert {m: r.reject_reason for m, r in parsed.items()} == MESSAGES
    a, b, c = (parsed[m] for m in list(MESSAGES)[:3])
    assert (float(a.salary_min), float(a.salary_max), a.is_remote, a.skills, a.salary_currency) == (12.5, 99.0, True, "x,y", "USD")
    assert (b.salary_currency, b.is_remote, b.skills, b.posted_date) == (None, False, None, None)
    assert c.salary_currency == "EUR"


def test_fields_are_taken_out_in_two_passes(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "value string")
    plan = postings.parse_postings(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_variant_get(") == 2
    odd = ['{"title":"t","salaryMin":true}', '{"title":"t","salaryMin":{"a":1}}', '{"title":"t","postedDate":20240101}',
           '{"title":"t","salaryMax":null,"jobId":1.50}', '{"title":"t","postedDate":"2024-02-30"}', '[{"title":"t"}]']
    got = {r.value: r for r in postings.parse_postings(spark.createDataFrame([(m,) for m in odd], "value string")).collect()}
    assert [got[m].reject_reason for m in odd] == ["salaryMin", "salaryMin", "postedDate", None, "postedDate", "malformed"]
    assert got[odd[3]].job_id == "1.5"


def test_messages_are_spread_before_they_are_parsed(spark):
    """The given tables are one split here, or a few at any size."""
    plan = QUERIES["p14_posting_from_json"].run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("parseJson") < plan.index("RepartitionByExpression [l_orderkey")


def drain(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def test_sink_restarts_without_duplicates(spark, tmp_path):
    source, table, rejects = (tmp_path / n for n in ("in", "table", "rejects"))
    source.mkdir()
    (source / "1.txt").write_text("\n".join(m for m in MESSAGES if m) + "\n")
    for run in range(2):
        if run:
            (source / "2.txt").write_text('{"title":"z"}\n')
        stream = postings.file_ingest(spark, str(source), "value string", "text")
        drain(postings.sink_postings(stream, str(table), str(rejects), str(tmp_path / "checkpoint")))
    assert sorted(r.title for r in spark.read.parquet(str(table)).collect()) == ["a", "b", "c", "z"]
    assert spark.read.parquet(str(rejects)).count() == 5


def write_events(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps({"ts": t, "k": k}) for t, k in rows) + "\n")


def test_late_rows_are_dropped(spark, tmp_path):
    source = tmp_path / "events"
    schema = "ts timestamp, k string"
    first = [("2024-01-01T00:00:05Z", "a"), ("2024-01-01T00:05:00Z", "a")]
    for run, rows in enumerate([first, [("2024-01-01T00:00:06Z", "a"), ("2024-01-01T00:09:00Z", "a")]]):
        write_events(source, f"{run}.json", rows)
        counted = live.live_counts(postings.file_ingest(spark, str(source), schema), "ts", ["k"])
        drain(counted.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")))
    got = spark.read.parquet(str(tmp_path / "out")).orderBy("window_start").collect()
    assert [(r.window_start.minute, r.n) for r in got] == [(0, 1), (5, 1)]


def test_stream_duplicates(spark, tmp_path):
    source = tmp_path / "events"
    write_events(source, "0.json", [("2024-01-01T00:00:05Z", "a"), ("2024-01-01T00:00:07Z", "a"), ("2024-01-01T00:00:09Z", "b")])
    stream = live.dedupe_stream(postings.file_ingest(spark, str(source), "ts timestamp, k string"), "ts", ["k"])
    drain(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")))
    assert sorted(r.k for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_demand_index_keeps_the_newest_state(spark, tmp_path):
    source = tmp_path / "events"
    for run, rows in enumerate([[("2024-01-01T00:00:05Z", "a")], [("2024-01-01T00:00:07Z", "a"), ("2024-01-01T00:00:09Z", "b")]]):
        write_events(source, f"{run}.json", rows)
        stream = postings.file_ingest(spark, str(source), "ts timestamp, k string").withColumn("v", F.lit(2.0))
        index = live.demand_index(stream, "ts", ["k"], "v")
        drain(live.upsert(index, str(tmp_path / "index"), str(tmp_path / "cp")))
    got = live.current(spark.read.parquet(str(tmp_path / "index")), ["day", "k"]).orderBy("k").collect()
    assert [(r.k, r.n, r.total) for r in got] == [("a", 2, 4.0), ("b", 1, 2.0)]


def test_no_window_trends(spark, tmp_path):
    """One event an hour: no window reaches twice the usual count, and nothing is stored."""
    first = dt.datetime(2024, 1, 1)
    rows = pa.table({"event_id": range(744), "ts": [first + dt.timedelta(hours=i) for i in range(744)], "user_id": range(744),
                     "event_type": ["a"] * 744, "value": [1.0] * 744})
    pq.write_table(rows, tmp_path / "events.parquet")
    assert QUERIES["t07_trending_alerts"].run(spark, str(tmp_path)).collect() == []


def test_views(spark):
    df = spark.createDataFrame([(1, "t", "a, b,,")], "id int, title string, skills string")
    for c in ("company", "location", "salary_min", "salary_max", "salary_currency", "source", "posted_date", "job_type", "experience_level", "industry", "is_remote"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    assert projections.listing_view(df).first().skills == ["a", "b"]


def test_index_is_kept_in_place_and_survives_replays(spark, tmp_path, monkeypatch):
    path, wanted = str(tmp_path / "index"), {}

    def batch(number):
        """Two open days, one key old and one new in each batch."""
        rows = [(dt.date(2024, 1, 1 + (number // 5) + d), f"k{k}", number * 10 + k) for d in (0, 1) for k in (number % 3, number)]
        return spark.createDataFrame(list(dict.fromkeys(rows)), "day date, k string, n long")

    def state():
        return {(r.day, r.k): r.n for r in live.read_index(spark, path).collect()}

    assert live.read_index(spark, path) is None
    counts = []
    for number in range(12):
        df = batch(number)
        before = dict(wanted)
        wanted |= {(r.day, r.k): r.n for r in df.collect()}
        if number == 7:  # lost after the versions were written and before the mark
            monkeypatch.setattr(live.files, "touch", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                live.merge_batch(df, number, path, ["k"])
            assert state() == before
            monkeypatch.undo()
        if number == 9:  # lost after the mark and before the old versions were deleted
            monkeypatch.setattr(live.files, "remove", lambda *a: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                live.merge_batch(df, number, path, ["k"])
            assert state() == wanted
            monkeypatch.undo()
        live.merge_batch(df, number, path, ["k"])
        live.merge_batch(df, number, path, ["k"])  # run again as a whole
        live.merge_batch(batch(0), 0, path, ["k"])  # and long after
        assert state() == wanted
        counts.append(len(list((tmp_path / "index").rglob("part-*.parquet"))))
    assert counts[-1] <= 2 * len({d for d, _ in wanted}) and len(list((tmp_path / "index" / "marks").glob("[0-9]*"))) == 1
    live.merge_batch(batch(0).limit(0), 12, path, ["k"])
    assert state() == wanted


def test_index_stream(spark, tmp_path):
    source = tmp_path / "events"
    for run, rows in enumerate([[("2024-01-01T00:00:05Z", "a"), ("2024-01-02T00:00:05Z", "a")], [("2024-01-01T00:00:07Z", "a"), ("2024-01-01T00:00:09Z", "b")]]):
        write_events(source, f"{run}.json", rows)
        stream = postings.file_ingest(spark, str(source), "ts timestamp, k string").withColumn("v", F.lit(2.0))
        drain(live.upsert_index(live.demand_index(stream, "ts", ["k"], "v"), str(tmp_path / "index"), str(tmp_path / "cp"), ["k"]))
    got = live.read_index(spark, str(tmp_path / "index")).orderBy("day", "k").collect()
    assert [(r.day.day, r.k, r.n, r.total) for r in got] == [(1, "a", 2, 4.0), (1, "b", 1, 2.0), (2, "a", 1, 2.0)]
