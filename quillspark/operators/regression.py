"""Regression operators (M1-M15): split, oversampling, target scaling, model fitting and evaluation.

Evaluation operators take a DataFrame with actual and predicted columns and compute their statistic in
one aggregate (one-row thresholds such as mean(y) are broadcast back). Model fitting uses spark.ml; the
linear epsilon-insensitive SVR, which spark.ml lacks, is a sub-gradient loop whose gradient is one
distributed aggregate per step.
"""

from __future__ import annotations

import uuid
from typing import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage
from . import series
from . import vectors as vx


def hash_split(df: DataFrame, key: str, seed: int = 42, test_pct: int = 20, out: str = "is_train") -> DataFrame:
    """M1: seeded 80/20 split that depends only on the key (stable under repartitioning): the first 32 bits of an
    md5, which any engine reproduces."""
    digest = F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")))
    return df.withColumn(out, F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100 >= test_pct)


def smote(train: DataFrame, key: str, features: Sequence[str], target: str, ratio: float = 0.5, k: int = 5,
          seed: int = 0) -> DataFrame:
    """M2: floor(ratio * n) synthetic rows. Row s picks a base row and one of its k nearest neighbours
    (Euclidean, unscaled features) by seeded hashes and interpolates features and target with one alpha.
    The neighbour search is the blocked exact k-NN join; picks are joins, not driver loops."""
    spark = train.sparkSession
    feats = list(features)
    t = train.select(key, F.array(*[F.col(c).cast("double") for c in feats]).alias("_x"), F.col(target).cast("double").alias("_y"))
    n = t.count()
    n_syn = int(n * ratio)
    if n_syn == 0 or n < 2:
        return train.limit(0).select(*feats, target)
    from pyspark.sql import Window
    # dense integer ids for the training rows (daily grain): k-NN and the picks join on them
    idx = cut_lineage(t.withColumn("_i", F.row_number().over(Window.orderBy(key)) - 1))
    nn = vx.knn(idx.select("_i", "_x"), "_i", "_x", k, metric="euclidean", n_rows=n)
    nn = nn.withColumn("_r", F.col("rank") - 1)
    syn = spark.range(n_syn).select(
        F.col("id").alias("s"),
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)).alias("_bi"),
        F.pmod(F.xxhash64("id", F.lit(seed + 1)), F.lit(min(k, n - 1))).alias("_pick"),
        (F.pmod(F.xxhash64("id", F.lit(seed + 2)), F.lit(1_000_000)) / 1_000_000.0).alias("alpha"))
    base = idx.select(F.col("_i").alias("_bi"), F.col(key).alias("base"), F.col("_x").alias("_bx"),
                      F.col("_y").alias("_by"))
    s = syn.join(base, "_bi").join(nn.select(F.col("src").alias("_bi"), F.col("_r").alias("_pick"), F.col("dst").alias("_ni")),
                                  ["_bi", "_pick"])
    s = s.join(idx.select(F.col("_i").alias("_ni"), F.col(key).alias("nbr"), F.col("_x").alias("_nx"), F.col("_y").alias("_ny")), "_ni")
    x = F.zip_with("_bx", "_nx", lambda a, b: a + F.col("alpha") * (b - a))
    y = F.col("_by") + F.col("alpha") * (F.col("_ny") - F.col("_by"))
    out = s.select("s", "base", "nbr", "alpha", x.alias("_x"), y.alias(target))
    return out.select("s", "base", "nbr", "alpha", *[F.col("_x")[i].alias(c) for i, c in enumerate(feats)], target)


def target_stats(train: DataFrame, target: str) -> DataFrame:
    """Mean and sample std of ln(target) over training rows (one row)."""
    return train.agg(F.avg(F.ln(target)).alias("t_mean"), F.stddev_samp(F.ln(target)).alias("t_std"))


def normalize_target(df: DataFrame, stats: DataFrame, target: str, out: str = "y") -> DataFrame:
    return df.crossJoin(F.broadcast(stats)).withColumn(out, (F.ln(target) - F.col("t_mean")) / F.col("t_std"))


def inverse_target(c: Column) -> Column:
    return F.exp(c * F.col("t_std") + F.col("t_mean"))


def metrics(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M8: r2, rmse, mae, mse in one aggregate."""
    a = df.agg(F.avg(y).alias("_ym"), F.count(F.lit(1)).alias("n"),
               F.sum(F.pow(F.col(y) - F.col(yhat), 2)).alias("_sse"),
               F.sum(F.abs(F.col(y) - F.col(yhat))).alias("_sae"))
    sst = df.crossJoin(F.broadcast(a.select("_ym"))).agg(F.sum(F.pow(F.col(y) - F.col("_ym"), 2)).alias("_sst"))
    has = F.col("n") > 0          # empty input gives nulls, not a division error
    return a.crossJoin(sst).select(
        "n", F.when(F.col("_sst") > 0, 1 - F.col("_sse") / F.col("_sst")).alias("r2"),
        F.when(has, F.sqrt(F.col("_sse") / F.col("n"))).alias("rmse"), F.when(has, F.col("_sae") / F.col("n")).alias("mae"),
        F.when(has, F.col("_sse") / F.col("n")).alias("mse"))


def direction_accuracy(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M9: % of rows where prediction and actual fall on the same side of mean(actual)."""
    m = df.agg(F.avg(y).alias("_t"))
    same = (F.col(yhat) > F.col("_t")) == (F.col(y) > F.col("_t"))
    return df.crossJoin(F.broadcast(m)).agg((F.avg(same.cast("double")) * 100.0).alias("accuracy"),
                                            F.first("_t").alias("threshold"))


def direction_confusion(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """2x2 above/below table; all four cells present."""
    spark = df.sparkSession
    m = df.agg(F.avg(y).alias("_t"))
    c = (df.crossJoin(F.broadcast(m))
           .groupBy((F.col(y) > F.col("_t")).alias("actual_above"), (F.col(yhat) > F.col("_t")).alias("predicted_above"))
           .agg(F.count(F.lit(1)).alias("n")))
    grid = spark.createDataFrame([(a, b) for a in (False, True) for b in (False, True)], "actual_above boolean, predicted_above boolean")
    return grid.join(c, ["actual_above", "predicted_above"], "left").select(
        "actual_above", "predicted_above", F.coalesce("n", F.lit(0)).alias("n"))


def calibration(train: DataFrame, y: str, yhat: str) -> DataFrame:
    """Least-squares line y ~ yhat on training rows (slope, intercept)."""
    return train.agg(F.regr_slope(y, yhat).alias("slope"), F.regr_intercept(y, yhat).alias("intercept"),
                     F.count(F.lit(1)).alias("n_train"))


def prediction_series(test: DataFrame, ts: str, y: str, yhat: str, window: int = 7) -> DataFrame:
    """Time-ordered actual, prediction, centred rolling mean of the prediction (full windows), residual."""
    s = test.select(ts, F.col(y).alias("actual"), F.col(yhat).alias("predicted"))
    s = s.withColumn("predicted_smooth", series.centered_mean("predicted", window, ts))
    return s.withColumn("residual", F.col("actual") - F.col("predicted_smooth"))


def calibrated(df: DataFrame, train: DataFrame, y: str, yhat: str, out: str = "pred") -> DataFrame:
    """M11 applied: ``df`` with its predictions moved by the line of the training rows."""
    line = calibration(train, y, yhat).select(F.col("slope").alias("_slope"), F.col("intercept").alias("_intercept"))
    return df.crossJoin(F.broadcast(line)).withColumn(out, F.col("_slope") * F.col(yhat) + F.col("_intercept")).drop("_slope", "_intercept")


def in_price_units(df: DataFrame, *cols: str) -> DataFrame:
    """``cols`` (z-scored logs) in the target's own units; ``df`` holds ``t_mean`` and ``t_std``."""
    return df.withColumns({c: inverse_target(F.col(c)) for c in cols})


def prediction_summary(df: DataFrame, y: str, yhat: str) -> DataFrame:
    """M14's figures, one row: rows, correlation of actual and predicted, and both means. Null without two rows, or
    where one side is constant."""
    corr = F.try_divide(F.covar_samp(y, yhat), F.stddev_samp(y) * F.stddev_samp(yhat))   # corr() itself raises on a constant
    return df.agg(F.count(F.lit(1)).alias("n"), corr.alias("correlation"),
                  F.avg(y).alias("actual_mean"), F.avg(yhat).alias("predicted_mean"))


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(
        df.withColumns({c: F.col(c).cast("double") for c in features}))


def tree_leaves(spark, model) -> DataFrame:
    """``(tree, leaf, value)``: the prediction of every leaf of a fitted forest, numbered as ``predictLeaf`` numbers them
    (in pre-order). Read from the forest's stored nodes; as large as the model."""
    path = checkpoint_dir(spark).rstrip("/") + f"/quill_tables/{uuid.uuid4().hex}"
    model.write().overwrite().save(path)
    nodes = spark.read.parquet(path + "/data").select("treeID", "nodeData.id", "nodeData.prediction", "nodeData.leftChild")
    w = Window.partitionBy("treeID").orderBy("id")
    return nodes.where("leftChild < 0").select(F.col("treeID").alias("tree"), (F.row_number().over(w) - 1).alias("leaf"), F.col("prediction").alias("value"))


def forest_values(model, df: DataFrame, row: str, keep: Sequence[str], first: int = 0) -> DataFrame:
    """``(row, *keep, tree, value)``: the prediction of every tree of a fitted forest for every row, trees numbered from
    ``first``: one pass finds a row's leaf in every tree, a join gives the leaves' predictions."""
    from pyspark.ml.functions import vector_to_array
    leaves = model.copy().setLeafCol("_leaf").transform(df)
    leaves = cut_lineage(leaves.select(row, *keep, vector_to_array("_leaf").alias("_leaves")))
    each = leaves.select(row, *keep, F.posexplode("_leaves").alias("tree", "leaf")).withColumn("leaf", F.col("leaf").cast("int"))
    return each.join(tree_leaves(df.sparkSession, model), ["tree", "leaf"]).select(row, *keep, (F.col("tree") + first).alias("tree"), "value")


def curve_of(values: DataFrame, row: str, y: str, side: str, grid: Sequence[int], by: Sequence[str] = ()) -> DataFrame:
    """RMSE, on each ``side``, of the forests made of the first ``grid`` trees: running means of the trees' predictions."""
    sizes = values.sparkSession.createDataFrame([(int(g),) for g in grid], "trees int")
    # a tree counts for every forest that is larger than its number: at most one row for each size of the grid
    means = (values.join(F.broadcast(sizes), F.col("tree") < F.col("trees")).groupBy(row, *by, side, y, "trees")
             .agg(F.avg("value").alias("_pred")))
    return means.groupBy(*by, side, "trees").agg(F.sqrt(F.avg(F.pow(F.col("_pred") - F.col(y), 2))).alias("rmse"))


def forest_curve(model, df: DataFrame, y: str, side: str, grid: Sequence[int]) -> DataFrame:
    """RMSE, on each ``side`` of ``df``, of the forests made of a fitted forest's first ``grid`` trees."""
    rows = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_y", F.col(y))
    return curve_of(forest_values(model, rows, "_row", [side, "_y"]), "_row", "_y", side, grid)


def linear_svr(train: DataFrame, features: Sequence[str], label: str, C: float = 0.01, epsilon: float = 10.0,
               lr: float = 0.1, tol: float = 1e-3, patience: int = 25, max_iter: int = 20_000):
    """M6: linear epsilon-insensitive SVR, minimising 0.5|w|^2 + C * sum(max(0, |y - w.x - b| - eps)) by
    sub-gradient steps on standardised features. Each step's gradient and loss are one distributed aggregate.

    Stops at a zero sub-gradient, or when ``patience`` steps have not lowered the best loss by a share of ``tol``;
    raises if ``max_iter`` steps reach neither. Returns the best (w on raw features, b)."""
    feats = list(features)
    st = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(feats)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(feats)], F.count(F.lit(1)).alias("n")).first()
    mu = np.array([st[f"m{i}"] or 0.0 for i in range(len(feats))])
    sd = np.array([st[f"s{i}"] or 1.0 for i in range(len(feats))])
    sd[sd == 0] = 1.0
    z = [((F.col(c) - float(mu[i])) / float(sd[i])) for i, c in enumerate(feats)]
    w, b = np.zeros(len(feats)), 0.0
    best, best_at, since = None, (w, b), 0
    for it in range(max_iter):
        pred = sum((F.lit(float(w[i])) * z[i] for i in range(len(feats))), F.lit(float(b)))
        r = F.col(label) - pred
        g = F.when(r > epsilon, -1.0).when(r < -epsilon, 1.0).otherwise(0.0)
        row = train.agg(*[F.sum(g * z[i]).alias(f"g{i}") for i in range(len(feats))], F.sum(g).alias("gb"),
                        F.sum(F.greatest(F.lit(0.0), F.abs(r) - epsilon)).alias("loss")).first()
        loss = 0.5 * float(w @ w) + C * (row["loss"] or 0.0)
        since = 0 if best is None or loss < best - tol * abs(best) else since + 1
        if best is None or loss < best:
            best, best_at = loss, (w, b)
        gw = w + C * np.array([row[f"g{i}"] or 0.0 for i in range(len(feats))])
        gb = C * (row["gb"] or 0.0)
        if since >= patience or (np.abs(gw).max(initial=0.0) < tol and abs(gb) < tol):
            w, b = best_at
            w_raw = w / sd
            return w_raw, float(b) - float((w_raw * mu).sum())
        step = lr / np.sqrt(it + 1) / max(1.0, C * st["n"])
        w, b = w - step * gw, b - step * gb
    raise RuntimeError(f"linear_svr: the loss still falls after {max_iter} steps")
