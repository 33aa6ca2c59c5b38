"""Scalar Column expressions for report formatting and bucketing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def human_format(c) -> Column:
    """Short number text: 1.2B / 3.4M / 5.6K (one decimal, half-even) or the integer part."""
    x = _c(c).cast("double")
    a = F.abs(x)

    def unit(div: float, suffix: str) -> Column:
        return F.format_string("%.1f" + suffix, F.bround(x / F.lit(div), 1))

    return (F.when(a >= 1e9, unit(1e9, "B"))
            .when(a >= 1e6, unit(1e6, "M"))
            .when(a >= 1e3, unit(1e3, "K"))
            .otherwise(F.format_string("%.0f", F.bround(x, 0))))


def significance_stars(p) -> Column:
    p = _c(p)
    return (F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise(""))


def quality_bucket(retention_pct) -> Column:
    r = _c(retention_pct)
    return F.when(r >= 95, "good").when(r >= 80, "fair").otherwise("poor")


def safe_pct(num, den) -> Column:
    """num / den * 100, null when den is 0 or null (no division error on empty input)."""
    d = _c(den)
    return F.when(d.isNull() | (d == 0), F.lit(None).cast("double")).otherwise(_c(num) / d * 100.0)
