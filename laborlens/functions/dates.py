"""Date parsing and calendar arithmetic."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, functions as F

DAYS_PER_MONTH = 30.44  # fixed value: mean month length used for the time axis
# Date forms beyond ISO, tried in this order; of 3/4/2024 the month comes first.
DATE_FORMS = (
    "M/d/yyyy", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "yyyy/M/d", "yyyy/M/d H:mm:ss", "M-d-yyyy", "d.M.yyyy", "yyyyMMdd",
    "d MMM yyyy", "d-MMM-yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MMM yyyy", "MMMM yyyy", "MMM-yyyy", "M/yyyy",
)
# What a text must look like to fit a form; a number may have leading zeros and a year a sign, month names are any words (short ones of three letters).
# A form that doesn't fit raises and catches an error for each row, which costs far more than the test.
FORM_PARTS = {"yyyy": r"[+-]?\d{4,}", "MMMM": r"\D{3,}", "MMM": r"\D{3}", "MM": r"\d\d", "dd": r"\d\d", "mm": r"\d\d", "ss": r"\d\d", "M": r"\d+", "d": r"\d+", "H": r"\d+"}
EPOCH_MS_FLOOR = 1e12  # fixed value: larger numbers are epoch milliseconds


def parse_date(column: Column | str, kind: str = "flexible") -> Column:
    """Text or number to timestamp; what cannot be parsed becomes NULL.

    kinds: ``flexible`` (any ISO form, else the first of ``DATE_FORMS`` that fits), ``iso_date`` (exactly ``yyyy-MM-dd``),
    ``epoch_ms``, ``epoch_s``, and ``epoch`` (unit told by magnitude, row by row).
    """
    value = _column(column)
    if kind == "flexible":
        text = F.trim(value.cast("string"))
        fitting = [F.when(text.rlike(form_shape(form)), F.try_to_timestamp(text, F.lit(form))) for form in DATE_FORMS]
        return F.coalesce(F.try_to_timestamp(text), *fitting)
    if kind == "iso_date":
        exact = F.when(value.rlike(r"^\d{4}-\d{2}-\d{2}$"), value)
        return exact.try_cast("date").cast("timestamp")
    if kind == "epoch_ms":
        return F.timestamp_millis(value.cast("long"))
    if kind == "epoch_s":
        return F.timestamp_millis((value * 1000).cast("long"))
    if kind == "epoch":
        return F.when(value > EPOCH_MS_FLOOR, parse_date(value, "epoch_ms")).otherwise(
            parse_date(value, "epoch_s")
        )
    raise ValueError(f"unknown date kind {kind!r}")


def form_shape(form: str) -> str:
    """A pattern that every text of a date form matches; some that don't parse match it too."""
    parts = re.findall(r"([A-Za-z])(\1*)|(.)", form)
    return "^" + "".join(FORM_PARTS[a + b] if a else re.escape(c) for a, b, c in parts) + "$"


def month_start(column: Column | str) -> Column:
    return F.trunc(_column(column).cast("date"), "month")


def month_end(column: Column | str) -> Column:
    return F.last_day(_column(column).cast("date"))


def period_start(column: Column | str, grain: str) -> Column:
    """First day of the day, week (Monday), month, quarter or year."""
    return F.date_trunc(grain, _column(column)).cast("date")


def month_index(column: Column | str) -> Column:
    """Months since year 0; the difference of two is the month gap."""
    day = _column(column)
    return F.year(day) * 12 + F.month(day)


def month_gap(later: Column | str, earlier: Column | str) -> Column:
    return month_index(later) - month_index(earlier)


def add_period(column: Column | str, steps: Column | int, step: str = "1 month") -> Column:
    """Move by calendar months or by fixed 30-day steps."""
    day = _column(column).cast("date")
    count = steps if isinstance(steps, Column) else F.lit(steps)
    if step == "1 month":
        return F.add_months(day, count)
    if step == "30 days":
        return F.date_add(day, (count * 30).cast("int"))
    raise ValueError(f"unknown step {step!r}")


def months_since(column: Column | str, origin: Column) -> Column:
    """Fractional months since the origin on the 30.44-day axis."""
    return F.datediff(_column(column), origin) / F.lit(DAYS_PER_MONTH)


def month_grid(start: Column | str, end: Column | str) -> Column:
    """Array of month starts, both ends included; empty when end precedes start."""
    first, last = _as_date(start), _as_date(end)
    return F.when(
        first <= last, F.sequence(first, last, F.expr("interval 1 month"))
    ).otherwise(F.array().cast("array<date>"))


def month_label(column: Column | str) -> Column:
    return F.date_format(_column(column), "MMM yyyy")


def literal_like(df: DataFrame, column: str, value: str | dt.date | dt.datetime) -> Column:
    """The value as a literal of the column's own type, so that filters reach the scan."""
    return F.lit(value).cast(df.schema[column].dataType)


def _as_date(value: Column | str | dt.date) -> Column:
    return value.cast("date") if isinstance(value, Column) else F.lit(value).cast("date")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
