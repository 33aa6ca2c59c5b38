"""As-of join, fills and windows against pandas (brute force on small literal series)."""
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from quillspark.operators import ordered, series


def D(i):
    return dt.date(2020, 1, 1) + dt.timedelta(days=i)


def test_asof_backward_matches_merge_asof(spark):
    left = [(i, D(i * 3)) for i in range(40)]
    right = [(D(i * 7 + 2), float(i) if i % 5 else None) for i in range(20)]
    l = spark.createDataFrame(left, "id long, date date")
    r = spark.createDataFrame(right, "Date date, Close double")
    got = ordered.asof_backward(l, r, "date", "Date", ["Close"]).orderBy("id").toPandas()
    pl = pd.DataFrame(left, columns=["id", "date"])
    pr = pd.DataFrame(right, columns=["Date", "Close"])
    pl["t"] = pd.to_datetime(pl["date"])
    pr["t"] = pd.to_datetime(pr["Date"])
    exp = pd.merge_asof(pl.sort_values("t"), pr.sort_values("t"), on="t", direction="backward")
    assert np.allclose(got["Close"].to_numpy(dtype=float), exp["Close"].to_numpy(dtype=float), equal_nan=True)


def test_ffill_bfill_matches_pandas(spark):
    vals = [None, None, 3.0, None, 5.0, None, None, 8.0, None]
    df = spark.createDataFrame([(D(i * 20), v) for i, v in enumerate(vals)], "d date, x double")
    got = ordered.ffill_bfill(df, "x", "d", out="y").orderBy("d").toPandas()["y"].to_numpy(dtype=float)
    exp = pd.Series(vals, dtype=float).ffill().bfill().to_numpy()
    assert np.allclose(got, exp)


def test_windows_match_pandas(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(100, 10, 40)
    x[5] = np.nan
    df = spark.createDataFrame([(D(i), None if np.isnan(v) else float(v)) for i, v in enumerate(x)], "d date, x double")
    df = series.add_pct_change(df, "x", "d", "p3", periods=3)
    got = df.select("d", series.trailing_mean("x", 7, "d").alias("m7"), series.centered_mean("x", 7, "d").alias("c7"),
                    series.centered_mean("x", 14, "d").alias("c14"), "p3").orderBy("d").toPandas()
    s = pd.Series(x)
    assert np.allclose(got["m7"], s.rolling(7, min_periods=1).mean(), equal_nan=True)
    assert np.allclose(got["c7"].astype(float), s.rolling(7, center=True).mean(), equal_nan=True)
    assert np.allclose(got["c14"].astype(float), s.rolling(14, center=True).mean(), equal_nan=True)
    assert np.allclose(got["p3"].astype(float), s.ffill() / s.ffill().shift(3) - 1, equal_nan=True)


def test_carry_last_hot_group_split_into_buckets(spark):
    # one group, many buckets: the cross-bucket carry must reach rows whose bucket has no value
    rows = [(0, i, float(i) if i % 97 == 0 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, o long, v double")
    out = ordered.carry_last(df, "v", ["o"], "c", by=["g"], bucket=F.floor(F.col("o") / 50)).orderBy("o").toPandas()
    exp = pd.Series([r[2] for r in rows]).ffill()
    assert np.allclose(out["c"].astype(float), exp, equal_nan=True)
