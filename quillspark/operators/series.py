"""Window operators over ordered series.

These run on daily rows (one row per date per series), so the ordered window spans at most a few
thousand rows per ``by`` group. Operators that may see post-grain data use ``ordered.carry_last``.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _w(order: str, by: Sequence[str] = ()):
    return Window.partitionBy(*by).orderBy(F.col(order)) if by else Window.orderBy(F.col(order))


def trailing_mean(col: str, n: int, order: str, by: Sequence[str] = (), min_periods: int = 1) -> Column:
    """``rolling(n, min_periods).mean()``: trailing n-row mean, null until ``min_periods`` values."""
    w = _w(order, by).rowsBetween(-(n - 1), 0)
    return F.when(F.count(F.col(col)).over(w) >= min_periods, F.avg(F.col(col)).over(w))


def centered_mean(col: str, n: int, order: str, by: Sequence[str] = ()) -> Column:
    """``rolling(n, center=True).mean()``: full windows only. Odd n spans -(n//2)..n//2,
    even n spans -(n//2)..n//2-1 (pandas puts the extra row before the centre)."""
    lo = -(n // 2)
    hi = n // 2 if n % 2 else n // 2 - 1
    w = _w(order, by).rowsBetween(lo, hi)
    return F.when(F.count(F.col(col)).over(w) == n, F.avg(F.col(col)).over(w))


def diff(col: str, order: str, by: Sequence[str] = (), periods: int = 1) -> Column:
    return F.col(col) - F.lag(F.col(col), periods).over(_w(order, by))


def ffilled(col: str, order: str, by: Sequence[str] = ()) -> Column:
    return F.last(F.col(col), ignorenulls=True).over(_w(order, by).rowsBetween(Window.unboundedPreceding, 0))


def add_pct_change(df: DataFrame, col: str, order: str, out: str, periods: int = 1,
                   by: Sequence[str] = (), scale: float = 1.0) -> DataFrame:
    """``pct_change(periods)``: forward fill first (pandas' pad default), then x / x.shift(n) - 1."""
    d = df.withColumn("_filled", ffilled(col, order, by))
    prev = F.lag(F.col("_filled"), periods).over(_w(order, by))
    return d.withColumn(out, F.when(prev != 0, (F.col("_filled") / prev - 1.0) * scale)).drop("_filled")


def lag_rows(col: str, order: str, by: Sequence[str] = (), periods: int = 1) -> Column:
    return F.lag(F.col(col), periods).over(_w(order, by))


def with_series(df: DataFrame, **cols: Column) -> DataFrame:
    return df.withColumns(cols)
