"""Model queries on small training sets: winner's predictions, importances, boosting rounds, validation sizes."""
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from quillspark.operators import regression as rg
from quillspark.plans import q_models

SPECS = {"Random Forest": dict(kind="rf", numTrees=4, maxDepth=3, seed=42),
         "Gradient Boosted Trees": dict(kind="gbt", maxIter=4, maxDepth=3, stepSize=0.3, seed=42)}


@pytest.fixture()
def sets(spark, scratch_dir, monkeypatch):
    """120 training and 40 test days; the price follows the first two features."""
    rng = np.random.default_rng(4)
    names = q_models.FEATURES
    x = rng.normal(size=(160, len(names)))
    close = np.exp(0.4 * x[:, 0] - 0.3 * x[:, 1] + 0.05 * rng.normal(size=160) + 4)
    rows = [(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, close))]
    df = spark.createDataFrame(rows, "i int, " + ", ".join(f"`{c}` double" for c in names) + ", close_price double")
    df = df.withColumn("timestamp", F.expr("timestamp '2020-01-01 00:00:00' + make_interval(0, 0, 0, i)"))
    train, test = df.where("i < 120"), df.where("i >= 120")
    stats = rg.target_stats(train, "close_price")
    tr, te = (rg.assemble(rg.normalize_target(part, stats, "close_price"), names).cache() for part in (train, test))
    monkeypatch.setattr(q_models, "_training_sets", lambda s, d: (tr, te, stats))
    monkeypatch.setattr(q_models, "_model_path", lambda s, d, name, spec: f"{scratch_dir}/{name.replace(' ', '_')}")
    return tr, te


def test_winner_series_and_summary(spark, sets):
    tr, te = sets
    board = q_models.leaderboard(spark, SF_SMALL, SPECS).collect()
    name, model = q_models.best_model(spark, SF_SMALL, SPECS)
    assert name == board[0]["model"] and board[0]["test_r2"] >= board[1]["test_r2"]
    a, b = (model.transform(t).orderBy("timestamp").select("y", "prediction", "t_mean", "t_std").toPandas() for t in (tr, te))
    slope, intercept = np.polyfit(a["prediction"], a["y"], 1)
    scale = lambda z: np.exp(z * b["t_std"] + b["t_mean"])
    actual, pred, plain = scale(b["y"]), scale(slope * b["prediction"] + intercept), scale(b["prediction"])
    smooth = pred.rolling(7, center=True).mean()
    got = q_models.winner_series(spark, SF_SMALL, SPECS).orderBy("timestamp").toPandas()
    for column, want in (("actual", actual), ("predicted", pred), ("predicted_smooth", smooth), ("residual", actual - smooth)):
        np.testing.assert_allclose(got[column].to_numpy(float), want.to_numpy(), rtol=1e-7, atol=1e-7)
    np.testing.assert_allclose(np.sort(actual), np.sort([r[0] for r in te.select("close_price").collect()]), rtol=1e-9)
    s = q_models.winner_summary(spark, SF_SMALL, SPECS).first()
    assert (s["model"], s["n"]) == (name, 40)
    assert abs(s["correlation"] - np.corrcoef(actual, pred)[0, 1]) < 1e-9
    assert abs(s["actual_mean"] - actual.mean()) < 1e-6 and abs(s["predicted_mean"] - pred.mean()) < 1e-6
    assert abs(s["accuracy"] - 100 * np.mean((plain > actual.mean()) == (actual > actual.mean()))) < 1e-9


def test_winner_is_trained_where_none_is_saved(spark, sets):
    assert q_models.winner_summary(spark, SF_SMALL, SPECS).first()["model"] in SPECS


def test_importances_rank_the_features_that_matter(spark, sets):
    top = q_models.importance_top15(spark, SF_SMALL, specs=SPECS).collect()
    assert len(top) == 15 and {top[0]["feature"], top[1]["feature"]} == set(q_models.FEATURES[:2])
    assert [r["importance"] for r in top] == sorted((r["importance"] for r in top), reverse=True)
    ties = [r["feature"] for r in top if r["importance"] == 0.0]
    assert ties == sorted(ties)


def test_boosting_rounds(spark, sets):
    got = q_models.boosting_curve(spark, SF_SMALL, SPECS).orderBy("round").collect()
    assert [r["round"] for r in got] == [1, 2, 3, 4] and all(r["val_rmse"] > 0 for r in got)
    assert all(a["train_rmse"] > b["train_rmse"] for a, b in zip(got, got[1:]))


def test_validation_sizes(spark, sets):
    got = q_models.validation_curve(spark, SF_SMALL, grid=(2, 4), folds=3, specs=SPECS).orderBy("n_estimators").collect()
    assert [r["n_estimators"] for r in got] == [2, 4] and all(0 < r["train_rmse"] < r["val_rmse"] for r in got)


def test_summary_without_rows_or_variation(spark):
    rows = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "y double, p double")
    flat, none = rg.prediction_summary(rows, "y", "p").first(), rg.prediction_summary(rows.limit(0), "y", "p").first()
    assert tuple(flat) == (2, None, 2.0, 2.0) and tuple(none) == (0, None, None, None)
