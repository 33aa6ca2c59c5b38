"""Helpers shared by the query modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources.tables import fixture, fixture_cte, read_table  # noqa: F401

from ..operators.cleaning import COUNT_COLS  # noqa: F401  (the fixed input columns)

DIGITS = 6


def r6(c) -> Column:
    """Round a computed double to 6 decimals (float sums differ by order; results are compared rounded)."""
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), DIGITS)


def sql_r6(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), {DIGITS})"
