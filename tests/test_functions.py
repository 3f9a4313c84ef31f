"""Column functions on small in-line frames."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from laborlens.functions import dates, text, values
from laborlens.functions.vocab import DESCRIPTION_SKILLS, POSTING_SKILLS, WORK_TYPES

TEXTS = [
    "C++ dev", "C++11 and C#x", "JavaScript not Java", "go to market", "we offer REST API, Rest Api", "Pythonic python",
    "éJava Javaé Java", "vue.js vueXjs node.js", "Machine Learning/Data Science", "under_java_score", "", None,
    "CI/CD;GIT\nLinux\tAWS", "power bi Power  BI", "ſql MYSQL sql", "C# C++",
]


def column(spark, rows, expression, kind="string"):
    df = spark.createDataFrame([(r,) for r in rows], f"x {kind}")
    return [r[0] for r in df.select(expression).collect()]


def scanned(vocabulary, value):
    """The terms a case-insensitive left-to-right scan with word boundaries reports."""
    if value is None:
        return set()
    names = {t.lower(): t for t in vocabulary}
    pattern = re.compile(r"\b(" + "|".join(re.escape(t) for t in vocabulary) + r")\b", re.I)
    return {names[m.lower().replace("ſ", "s")] for m in pattern.findall(value)}


@pytest.mark.parametrize("vocabulary", [POSTING_SKILLS, DESCRIPTION_SKILLS, ("Cloud", "Cloud Computing", "computing power")])
def test_extract_skills_equals_a_scan(spark, vocabulary):
    texts = TEXTS + ["cloud computing power", "Cloud, computing"]
    got = column(spark, texts, text.extract_skills("x", vocabulary))
    assert [set(g) for g in got] == [scanned(vocabulary, t) for t in texts]
    assert all(len(g) == len(set(g)) for g in got)


def test_overlapping_vocabularies_are_recognised():
    assert not text._can_overlap(POSTING_SKILLS)
    assert not text._can_overlap(DESCRIPTION_SKILLS)
    assert text._can_overlap(["Cloud", "Cloud Computing"])
    assert text._can_overlap(["data science", "science fiction"])
    assert not text._can_overlap(["Java", "JavaScript", "SQL", "MySQL"])


def test_lookaround_finds_symbol_terms(spark):
    got = column(spark, ["C++ dev", "C# and Go"], text.extract_skills("x", POSTING_SKILLS, "lookaround"))
    assert [sorted(g) for g in got] == [["C++"], ["C#", "Go"]]


def test_lists(spark):
    assert column(spark, ["a, b,,a", " ", None, ","], text.split_list("x")) == [["a", "b", "a"], None, None, []]
    assert column(spark, ["b,a,b"], text.join_list(text.split_list("x"))) == ["a,b"]
    assert column(spark, ["b,a,b"], text.first_n(text.split_list("x"), 2)) == [["b", "a"]]


def test_text_helpers(spark):
    assert column(spark, ["a%"], text.fill_template("100% {} dev", "x")) == ["100% a% dev"]
    df = spark.createDataFrame([("a", None), (None, "b"), ("a", "b")], "l string, r string")
    assert [r[0] for r in df.select(text.joined_text("l", "r")).collect()] == ["a", "b", "a b"]


def test_dates(spark):
    rows = ["2024-01-31", "2024-01-31T00:00", "2024-13-01", "24-1-1", None]
    got = column(spark, rows, dates.parse_date("x", "iso_date"))
    assert got[0] == dt.datetime(2024, 1, 31) and got[1:] == [None] * 4
    assert column(spark, ["x", "2024-05-06T07:08:09"], F.to_date(dates.parse_date("x"))) == [None, dt.date(2024, 5, 6)]
    got = column(spark, [1.7e12, 1.7e9], F.to_date(dates.parse_date("x", "epoch")), "double")
    assert got == [dt.date(2023, 11, 14)] * 2
    grid = dates.month_grid("2024-11-01", "2025-02-01")
    assert column(spark, [1], F.size(grid), "int") == [4]
    assert column(spark, [1], F.size(dates.month_grid("2025-05-01", "2027-12-01")), "int") == [32]
    assert column(spark, [1], F.size(dates.month_grid("2025-05-01", "2025-04-01")), "int") == [0]
    assert column(spark, ["2024-01-31"], dates.add_period("x", 1)) == [dt.date(2024, 2, 29)]
    assert column(spark, ["2024-01-31"], dates.month_label(F.to_date("x"))) == ["Jan 2024"]


def test_date_forms_are_tried_on_texts_of_their_shape(spark):
    texts = ["3/4/2024", "003/04/2024 5:06", "3/4/2024 23:06:07", "2024/3/4", "2024/3/4 1:02:03", "3-4-2024", "4.3.2024", "20240304", "4 Mar 2024",
             "4-mar-2024", "4 March 2024", "Mar 4, 2024", "MARCH 4, 2024", "Mar 2024", "March 2024", "May 2024", "May-2024", "3/2024", "3/4/+12024", "3/4/-0024",
             "13/4/2024", "3/4/24", "4 Foo 2024", "Foo 4, 2024", "3/4/2024 5:6", "", "x", "2024", "-3/4/2024", "Marchy 2024", "10000304"]
    df = spark.createDataFrame([(t,) for t in texts], "x string")
    plain = F.coalesce(F.try_to_timestamp("x"), *[F.try_to_timestamp("x", F.lit(form)) for form in dates.DATE_FORMS])
    pairs = df.select(dates.parse_date("x").cast("string"), plain.cast("string")).collect()
    assert [p[0] for p in pairs] == [p[1] for p in pairs] and sum(p[0] is not None for p in pairs) >= 19
    days = spark.range(366).select(F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    for form in dates.DATE_FORMS:  # every text of a form has its shape, and fails no other form before
        assert days.filter(~F.date_format("day", form).rlike(dates.form_shape(form))).count() == 0
    plan = df.select(dates.parse_date("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("CASE WHEN RLIKE") >= len(dates.DATE_FORMS)  # the column name repeats the expression


def test_salary(spark):
    low, high = values.salary_bounds("x")
    rows = ["$59K-$99K", "$59K", "59K-99K", None, "$1K-$2K plus"]
    assert column(spark, rows, low) == [59000, None, None, None, 1000]
    assert column(spark, rows, high) == [99000, None, None, None, 2000]
    df = spark.createDataFrame(
        [(Decimal(59000), Decimal(99499), "USD"), (Decimal(59000), None, "EUR"), (None, Decimal(99500), "USD"), (None, None, "USD")],
        "a decimal(10,2), b decimal(10,2), c string",
    )
    got = [r[0] for r in df.select(values.format_salary("a", "b", "c")).collect()]
    assert got == ["$59k – $99k", "From EUR59k", "Up to $100k", "N/A"]


def test_levels_and_maps(spark):
    rows = ["5 to 15 Years", "2 Years", "0", "Senior", None, "12"]
    assert column(spark, rows, values.experience_level("x")) == ["SE", "MI", "EN", "MI", "MI", "SE"]
    assert column(spark, ["Full-Time", "full-time", None], values.map_values("x", WORK_TYPES)) == ["FT", "", ""]
    assert column(spark, ["Remote, US", "remote", None], values.is_remote("x")) == [True, False, False]
    assert column(spark, ["t", "True", "f", "False", "", None], values.text_flag("x")) == [True, True, False, False, None, None]
    assert column(spark, ["12.5", "x", None], values.to_number("x")) == [12.5, None, None]
    assert column(spark, ["true", '"true"', None], values.strict_bool("x")) == [True, False, False]


def test_half_up_rounding(spark):
    assert column(spark, [2.675], F.round("x", 2), "double") == [2.68]
