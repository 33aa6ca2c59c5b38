"""Grouped profiles, pivots, top-k and distribution operators."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_medians(df: DataFrame, key: str, cols: Sequence[str], parts: int = 256) -> DataFrame:
    """``(key, median of each column)``, exact, without a task that holds a key's values.

    Values are counted first (combined map-side). A key's range is cut into ``parts`` even ranges, whose counts tell
    in which of them the middle ranks lie; only the values there are ordered. Nulls don't count."""
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    v = df.selectExpr(f"`{key}` AS k", f"stack({len(cols)}, {stack}) AS (c, v)").where("v IS NOT NULL")
    counts = v.groupBy("k", "c", "v").agg(F.count(F.lit(1)).alias("n"))
    ends = counts.groupBy(F.col("k").alias("ek"), F.col("c").alias("ec")).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("n").alias("total"))
    part = F.when(F.col("hi") > F.col("lo"), F.least(F.lit(parts - 1), F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * parts))).otherwise(0)
    placed = counts.join(F.broadcast(ends), F.col("k").eqNullSafe(F.col("ek")) & (F.col("c") == F.col("ec"))).select(
        "k", "c", "v", "n", "total", part.cast("int").alias("p"))
    before = Window.partitionBy("k", "c").orderBy("p")                        # at most ``parts`` rows of a key
    ranges = placed.groupBy("k", "c", "p", "total").agg(F.sum("n").alias("m")).withColumn("upto", F.sum("m").over(before))
    low, high = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    middle = ranges.where((F.col("upto") >= low) & (F.col("upto") - F.col("m") < high)).select(
        F.col("k").alias("mk"), F.col("c").alias("mc"), F.col("p").alias("mp"), (F.col("upto") - F.col("m")).alias("base"))
    near = placed.join(F.broadcast(middle), F.col("k").eqNullSafe(F.col("mk")) & (F.col("c") == F.col("mc")) & (F.col("p") == F.col("mp")))
    inner = Window.partitionBy("k", "c", "p").orderBy("v")
    ranked = near.withColumn("to", F.col("base") + F.sum("n").over(inner))
    picks = ranked.groupBy("k", "c").agg(F.min(F.when(F.col("to") >= low, F.col("v"))).alias("a"), F.min(F.when(F.col("to") >= high, F.col("v"))).alias("b"))
    wide = picks.groupBy("k").pivot("c", list(cols)).agg(F.first((F.col("a") + F.col("b")) / 2))
    return wide.withColumnRenamed("k", key)


def profile(df: DataFrame, key: str, spec: dict[str, Sequence[str]], digits: int = 2) -> DataFrame:
    """``groupby(key).agg({col: [mean, median, sum, count]}).round(digits)`` with flattened names
    ``col_agg`` (P18). Sums of all-null groups are 0, as in pandas; rounding is half-even."""
    plain = {"mean": lambda c: F.bround(F.avg(c), digits), "sum": lambda c: F.coalesce(F.sum(c), F.lit(0)), "count": F.count, "max": F.max}
    names = [(c, a) for c, aggs in spec.items() for a in aggs]
    out = df.groupBy(key).agg(*[plain[a](F.col(c)).alias(f"{c}_{a}") for c, a in names if a != "median"])
    middle = [c for c, a in names if a == "median"]
    if middle:
        med = exact_medians(df, key, middle).select(F.col(key).alias("_mk"), *[F.bround(c, digits).alias(f"{c}_median") for c in middle])
        out = out.join(med, F.col(key).eqNullSafe(F.col("_mk")), "left").drop("_mk")
    return out.select(key, *[f"{c}_{a}" for c, a in names])


def pivot_counts(df: DataFrame, row_key: str, col_key: str, values: Sequence[str], names: Sequence[str],
                 total: str | None = "total") -> DataFrame:
    """``groupby([row, col]).size().unstack(fill_value=0)`` for a known value list, plus a row total.
    Values are given so Spark skips the extra job that discovers them."""
    p = df.groupBy(row_key).pivot(col_key, list(values)).count().na.fill(0, subset=list(values))
    p = p.select(row_key, *[F.col(f"`{v}`").cast("bigint").alias(n) for v, n in zip(values, names)])
    if total:
        p = p.withColumn(total, sum((F.col(n) for n in names), F.lit(0)).cast("bigint"))
    return p


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k: Spark plans ``orderBy().limit(k)`` as TakeOrderedAndProject (per-partition top-k, then
    a k-row merge), so no full sort or single-task shuffle of the input."""
    return df.orderBy(*order).limit(k)


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """Per-group top-k with ``row_number() <= k``; Spark inserts a partial WindowGroupLimit before the
    shuffle, so at most k rows per group and map partition cross the network."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def equal_width_histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """``hist(bins=n)`` counts: n equal bins between min and max, last edge inclusive; a constant
    column spans [x-0.5, x+0.5] as numpy does. Always n rows."""
    spark = df.sparkSession
    x = df.select(F.col(col).cast("double").alias("x")).where(F.col("x").isNotNull())
    rng = x.agg(F.min("x").alias("mn"), F.max("x").alias("mx")).select(
        F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
        F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    b = F.least(F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    counts = x.crossJoin(F.broadcast(rng)).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = spark.range(bins).select(F.col("id").cast("int").alias("bin")).crossJoin(F.broadcast(rng))
    return (grid.join(counts, "bin", "left")
            .select("bin", (F.col("lo") + F.col("bin") * width).alias("lo"),
                    (F.col("lo") + (F.col("bin") + 1) * width).alias("hi"),
                    F.coalesce("n", F.lit(0)).alias("n")))
