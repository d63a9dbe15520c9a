"""Derived columns: conforming rules, buckets, calendar attributes, number text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.specs import ColumnRule, quoted

RESCUED = "_rescued_data"


def conform(df: DataFrame, rules: Iterable[ColumnRule]) -> DataFrame:
    """Drop the rescue column, then apply each rule whose input column exists."""
    derived = {
        rule.target or rule.column: rule.derive(F.col(quoted(rule.column)))
        for rule in rules
        if rule.column in df.columns
    }
    df = df.drop(RESCUED)
    return df.withColumns(derived) if derived else df


def bucket(value: Column, bounds: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first upper bound above ``value``; NULL falls to ``otherwise``."""
    label = F
    for bound, name in bounds:
        label = label.when(value < bound, F.lit(name))
    return label.otherwise(F.lit(otherwise))


def calendar_columns(date: Column, fiscal_start_month: int = 1) -> dict[str, Column]:
    """Calendar attributes of a date.

    The week is the ISO week while the fiscal year follows the calendar (shifted by
    ``fiscal_start_month``), so the two disagree around New Year.
    """
    fiscal = F.year(date) if fiscal_start_month == 1 else F.year(
        F.add_months(date, 13 - fiscal_start_month)
    )
    return {
        "quarter": F.quarter(date),
        "fiscal_year": fiscal,
        "week_number": F.weekofyear(date),
        "is_weekend": F.dayofweek(date).isin(1, 7),
        "day_of_year": F.dayofyear(date),
    }


def percent(part: Column, whole: Column, places: int) -> Column:
    """``part / whole * 100`` rounded half-even; 0.0 when ``whole`` is zero."""
    ratio = F.try_divide(part.cast("double"), whole.cast("double")) * F.lit(100.0)
    return F.bround(F.coalesce(ratio, F.lit(0.0)), places)


def number_text(value: Column, places: int) -> Column:
    """Shortest decimal text with at least one fraction digit: ``0.0``, ``33.3333``."""
    return F.regexp_replace(F.format_string(f"%.{places}f", value), r"(\.\d+?)0+$", "$1")
