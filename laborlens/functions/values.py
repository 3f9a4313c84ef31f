"""Numbers, coercions, code maps and JSON."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F, types as T


def to_number(column: Column | str, kind: str = "double") -> Column:
    return _column(column).try_cast(kind)


def strict_bool(json_token: Column | str) -> Column:
    """True only for the bare JSON token ``true``; text and NULL are false."""
    return F.coalesce(_column(json_token) == "true", F.lit(False))


def text_flag(column: Column | str) -> Column:
    """Flags written as t/f or True/False; blank stays NULL."""
    text = F.lower(F.trim(_column(column)))
    return F.when(text.isin("t", "true"), True).when(text.isin("f", "false"), False)


def or_default(column: Column | str, default) -> Column:
    return F.coalesce(_column(column), F.lit(default))


def clip(column: Column, low: Column | float | None, high: Column | float | None) -> Column:
    value = column
    if high is not None:
        value = F.least(value, _literal(high))
    if low is not None:
        value = F.greatest(value, _literal(low))
    return value


def safe_ratio(top: Column, bottom: Column, guard: float = 1e-6) -> Column:
    """Ratio with a small guard added to the denominator."""
    return top / (bottom + F.lit(guard))


def pct_change(new: Column, old: Column, scale: int = 1) -> Column:
    """Percent change, NULL when the base is zero or missing."""
    return F.round(F.try_divide((new - old) * 100.0, old), scale)


def map_values(column: Column | str, mapping: Mapping[str, str], default: str | None = "") -> Column:
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), _column(column)), F.lit(default))


def salary_bounds(column: Column | str) -> tuple[Column, Column]:
    """Lower and upper bound of a ``$59K-$99K`` range; any other form gives NULLs."""
    text = _column(column)
    form = r"^\$(\d+)K-\$(\d+)K"
    low, high = [
        F.try_multiply(F.regexp_extract(text, form, group).try_cast("bigint"), F.lit(1000)) for group in (1, 2)
    ]
    return low, high


def experience_level(column: Column | str) -> Column:
    """Level code from the leading number of years; unknown means mid level."""
    years = F.regexp_extract(_column(column), r"^(\d+)", 1).try_cast("bigint")
    return F.when(years >= 5, "SE").when(years >= 2, "MI").when(years >= 0, "EN").otherwise("MI")


def is_remote(location: Column | str) -> Column:
    return F.coalesce(_column(location).contains("Remote"), F.lit(False))


def format_salary(low: Column | str, high: Column | str, currency: Column | str) -> Column:
    low, high, unit = _column(low), _column(high), _column(currency)
    sign = F.when(unit == "USD", F.lit("$")).otherwise(F.coalesce(unit, F.lit("null")))

    def thousands(amount: Column) -> Column:
        return F.concat(sign, F.round(amount / 1000, 0).cast("bigint").cast("string"), F.lit("k"))

    return (
        F.when(low.isNotNull() & high.isNotNull(), F.concat(thousands(low), F.lit(" – "), thousands(high)))
        .when(low.isNotNull(), F.concat(F.lit("From "), thousands(low)))
        .when(high.isNotNull(), F.concat(F.lit("Up to "), thousands(high)))
        .otherwise("N/A")
    )


def parse_json(column: Column | str, schema: T.StructType | str) -> Column:
    return F.from_json(_column(column), schema)


def to_document(*columns: str | Column) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def _literal(value: Column | float) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
