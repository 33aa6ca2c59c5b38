"""Evaluation operators against numpy, p-values, SMOTE interpolation, SVR, split stability."""
import math

import numpy as np
from pyspark.sql import functions as F

from quillspark.functions.stats import betainc_reg, pearson_p_value_scalar
from quillspark.operators import regression as rg


def test_metrics_match_numpy(spark):
    rng = np.random.default_rng(5)
    y = rng.normal(size=200)
    p = y + rng.normal(scale=0.3, size=200)
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(y, p)], "y double, p double")
    m = rg.metrics(df, "y", "p").first()
    assert abs(m.r2 - (1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9
    assert abs(m.rmse - math.sqrt(((y - p) ** 2).mean())) < 1e-9
    assert abs(m.mae - np.abs(y - p).mean()) < 1e-9
    acc = rg.direction_accuracy(df, "y", "p").first().accuracy
    t = y.mean()
    assert abs(acc - ((p > t) == (y > t)).mean() * 100) < 1e-9
    conf = {(r.actual_above, r.predicted_above): r.n for r in rg.direction_confusion(df, "y", "p").collect()}
    assert sum(conf.values()) == 200 and len(conf) == 4


def test_p_values():
    # t-distribution two-sided p for r=0.5, n=10 (dof 8): t = 1.63299, p ~= 0.141
    assert abs(pearson_p_value_scalar(0.5, 10) - 0.1411) < 5e-4
    assert abs(betainc_reg(2.0, 3.0, 0.4) - 0.5248) < 1e-4
    assert pearson_p_value_scalar(1.0, 5) == 0.0 and pearson_p_value_scalar(0.3, 2) is None


def test_smote_rows_between_parents(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(rng.normal(size=(60, 3)))]
    df = spark.createDataFrame(rows, "k long, f1 double, f2 double, y double")
    syn = rg.smote(df, "k", ["f1", "f2"], "y", ratio=0.5, k=5, seed=1).collect()
    assert len(syn) == 30
    byk = {r[0]: r for r in rows}
    for s in syn:
        b, n = byk[s.base], byk[s.nbr]
        assert s.base != s.nbr and 0 <= s.alpha < 1
        for j, c in ((1, "f1"), (2, "f2"), (3, "y")):
            assert min(b[j], n[j]) - 1e-9 <= s[c] <= max(b[j], n[j]) + 1e-9


def test_hash_split_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = {r.k for r in rg.hash_split(df, "k").where("is_train").collect()}
    b = {r.k for r in rg.hash_split(df.repartition(7), "k").where("is_train").collect()}
    assert a == b and 700 < len(a) < 900


def test_linear_svr_wide_epsilon_is_flat(spark):
    df = spark.createDataFrame([(float(i), float(i % 3) / 10) for i in range(50)], "x double, y double")
    w, b = rg.linear_svr(df, ["x"], "y", C=0.01, epsilon=10.0)
    assert abs(w[0]) < 1e-12 and abs(b) < 1e-12
    w2, b2 = rg.linear_svr(df.withColumn("y", F.col("x") * 2.0), ["x"], "y", C=10.0, epsilon=0.1, lr=20.0, tol=1e-2, patience=15)
    assert abs(w2[0] - 2) < 0.1 and abs(b2) < 1


def test_forest_rows_keep_their_nodes(spark, monkeypatch):
    """A forest's fit doesn't send the trees grown so far with every level's tasks."""
    import pyspark.ml.regression as reg

    from quillspark.plans import q_models as qm
    made, init = [], reg.RandomForestRegressor.fit
    monkeypatch.setattr(reg.RandomForestRegressor, "fit", lambda self, df: made.append(self) or init(self, df))
    df = spark.createDataFrame([(float(i), float(i % 3)) for i in range(40)], "x double, y double")
    qm._fit("rf", rg.assemble(df, ["x"]), dict(kind="rf", numTrees=3, maxDepth=3, seed=1))
    assert made[0].getCacheNodeIds()
