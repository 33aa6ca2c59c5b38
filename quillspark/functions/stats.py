"""Statistical helpers: scalar forms for tests and columns for result rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _betacf(a: float, b: float, x: float, max_iter: int = 300, eps: float = 3e-16) -> float:
    # Lentz's continued fraction for the incomplete beta function.
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, max_iter + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < eps:
            break
    return h


def betainc_reg(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    front = math.exp(lbeta)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def pearson_p_value_scalar(r: float | None, n: int | None) -> float | None:
    """Two-sided p-value of Pearson's r under the t distribution with n-2 degrees of freedom."""
    if r is None or n is None or (isinstance(r, float) and math.isnan(r)) or n < 3:
        return None
    r = max(-1.0, min(1.0, float(r)))
    dof = n - 2
    if abs(r) == 1.0:
        return 0.0
    t2 = r * r * dof / (1.0 - r * r)
    return betainc_reg(dof / 2.0, 0.5, dof / (dof + t2))


def pearson_p_value(r, n) -> Column:
    """Two-sided p-value of Pearson's r with n - 2 degrees of freedom, as a column.

    For whole degrees of freedom v the t distribution is a finite sum: with sin = |r| and cos = sqrt(1 - r^2),
    P(|T| < t) = sin * (1 + 1/2 cos^2 + 1*3/(2*4) cos^4 + ...), v/2 terms, if v is even, and
    2/pi * (asin|r| + sin * (cos + 2/3 cos^3 + 2*4/(3*5) cos^5 + ...)), (v-1)/2 terms, if it is odd. The terms are
    folded over a sequence on the JVM; terms below 1e-18 of the sum are past its last digit and no longer change it."""
    r = (F.col(r) if isinstance(r, str) else r).cast("double")
    n = (F.col(n) if isinstance(n, str) else n).cast("long")
    v = n - 2
    odd = F.pmod(v, F.lit(2)) == 1
    size = F.least(F.abs(r), F.lit(1.0))
    cos2 = F.lit(1.0) - size * size
    first = F.when(odd, F.sqrt(cos2)).otherwise(F.lit(1.0))
    count = F.when(odd, (v - 1) / 2).otherwise(v / 2).cast("int")
    steps = F.when(count > 1, F.sequence(F.lit(1), count - 1)).otherwise(F.array().cast("array<int>"))
    state = F.struct(first.alias("term"), first.alias("total"))

    def add(acc, k):
        factor = F.when(odd, (2 * k) / (2 * k + 1)).otherwise((2 * k - 1) / (2 * k))
        term = acc["term"] * factor * cos2
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.when(count > 0, F.aggregate(steps, state, add, lambda acc: acc["total"])).otherwise(0.0)
    inside = F.when(odd, (F.asin(size) + size * total) * F.lit(2.0 / math.pi)).otherwise(size * total)
    p = F.when(size == 1.0, 0.0).otherwise(F.greatest(F.lit(0.0), F.lit(1.0) - inside))
    return F.when(r.isNotNull() & ~F.isnan(r) & (v >= 1), p)


def sql_pearson_p_value(rows: str, key: str, r: str, n: str) -> str:
    """The same sum for DuckDB: ``(key, p)`` for the rows of a relation."""
    return f"""SELECT {key}, CASE WHEN {r} IS NULL OR {n} < 3 THEN NULL WHEN abs({r}) >= 1 THEN 0.0 ELSE greatest(0.0, 1 - CASE WHEN odd
   THEN (asin(abs({r})) + abs({r}) * coalesce(t, 0)) * 2 / pi() ELSE abs({r}) * coalesce(t, 0) END) END AS p
 FROM (SELECT a.{key}, a.{r}, a.{n}, ({n} - 2) % 2 = 1 AS odd, sum(term) AS t FROM {rows} a LEFT JOIN (
   SELECT {key}, CASE WHEN odd THEN sqrt(c2) ELSE 1 END * exp(sum(CASE WHEN k = 0 THEN 0 WHEN odd THEN ln(2.0 * k / (2 * k + 1)) + ln(c2) ELSE ln((2.0 * k - 1) / (2 * k)) + ln(c2) END)
       OVER (PARTITION BY {key} ORDER BY k)) AS term
   FROM (SELECT {key}, ({n} - 2) % 2 = 1 AS odd, 1 - {r} * {r} AS c2,
         unnest(range(0, CASE WHEN ({n} - 2) % 2 = 1 THEN ({n} - 3) // 2 ELSE ({n} - 2) // 2 END)) AS k FROM {rows} WHERE abs({r}) < 1)) b USING ({key})
   GROUP BY a.{key}, a.{r}, a.{n})"""
