"""Named row predicates that must hold for every row of a published result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    """``predicate`` is SQL text over the result's columns; NULL counts as a violation."""

    name: str
    predicate: str

    def violated(self) -> Column:
        return ~F.coalesce(F.expr(self.predicate), F.lit(False))


class ExpectationError(ValueError):
    """Raised instead of publishing; ``violations`` holds the count by expectation."""

    def __init__(self, table: str, violations: Mapping[str, int]) -> None:
        self.violations = dict(violations)
        text = ", ".join(f"{name}={count}" for name, count in self.violations.items())
        super().__init__(f"{table} violates expectations: {text}")


def violation_columns(expectations: Sequence[Expectation]) -> dict[str, Column]:
    """One aggregate per expectation, to observe while a result is written."""
    return {e.name: F.count_if(e.violated()) for e in expectations}


def violations(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """Violation counts as rows ``(expectation, violations)``, in one pass."""
    counts = df.agg(*[c.alias(name) for name, c in violation_columns(expectations).items()])
    pairs = [
        F.struct(F.lit(e.name).alias("expectation"), F.col(f"`{e.name}`").alias("violations"))
        for e in expectations
    ]
    return counts.select(F.inline(F.array(*pairs)))


def require(df: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """The rows unchanged, failing the query when one breaks an expectation.

    The test is a filter, because an unused projected column would be pruned away.
    """
    if not expectations:
        return df
    return df.filter(
        reduce(
            Column.__and__,
            [
                F.when(e.violated(), F.raise_error(F.lit(f"expectation {e.name} violated")).cast("boolean"))
                .otherwise(F.lit(True))
                for e in expectations
            ],
        )
    )
