"""Daily feature table (Q7) and model training / evaluation.

Evaluation operators are checked exactly against DuckDB with a deterministic stand-in prediction on the
price table (y = Close, yhat = 0.9 y + (day number mod 7), test rows = day number mod 5 = 0). Model fits
are checked by properties.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting as bo
from ..operators import cleaning as cl
from ..operators import ordered
from ..operators import regression as rg
from ..operators import text_features as tf
from ..session import checkpoint_dir, cut_lineage, sweep
from ..sources import sinks
from .common import COUNT_COLS, fixture, fixture_cte, r6

FEATURES = COUNT_COLS + ["sentiment_compound"] + [f"tfidf_{i}" for i in range(10)] + [f"embed_{i}" for i in range(8)]
SOURCE_ORDER = {"tweets": 0, "retweets": 1, "replies": 2}
SOURCE_KIND = {"tweets": "original", "retweets": "retweet", "replies": "reply"}


def cleaned_posts(raw):
    """The three cleaned tables (Q2 to Q4) of raw posts, tagged with their source, as one:
    (row_id, date, source, text, the six counts). A retweet's text is its content."""
    routed = cl.route(raw.select("row_id", *cl.RAW_COLUMNS))
    out = None
    for source, kind in SOURCE_KIND.items():
        part = cl.cleaned(routed, kind).select(
            "row_id", F.to_date("timestamp").alias("date"), F.lit(source).alias("source"),
            F.col("tweet" if kind == "retweet" else "text").alias("text"), *COUNT_COLS)
        out = part if out is None else out.unionByName(part)
    return out


def daily_features(spark, d, svd_k: int = 10, embed_n: int = 8, dim: int = 64):
    """Q7 over the cleaned posts: one row per posting day: six summed counts, close price (as-of backward, then ffill/bfill),
    lexicon sentiment, 10 SVD components of TF-IDF and 8 hashed-embedding components; F10 null check."""
    src_rank = F.create_map(*[x for k, v in SOURCE_ORDER.items() for x in (F.lit(k), F.lit(v))])
    order = ["src_rank", "row_id"]
    posts = cleaned_posts(fixture(spark, d, "raw_dated_posts")).where(F.col("date").isNotNull()).withColumn("src_rank", src_rank[F.col("source")])
    # the texts are read once: their tokens, valences and counts are what sentiment, TF-IDF, SVD and embeddings share
    # ...and a day's lie together, so that a task counts the words of few days and hands on each word once. Ranges of days
    # would be drawn from a sample, for which Spark reads and cuts all texts a time more; a day that is too large is split
    p = cut_lineage(tf.scan(posts, "date", [*order, *COUNT_COLS]).hint("rebalance", F.col("date")))
    sweep(spark)
    counts = p.groupBy("date").agg(*[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in COUNT_COLS])
    stock = fixture(spark, d, "stock").select("Date", "Close")
    # daily rows: plain ordered windows (the calendar bounds them)
    daily = ordered.asof_backward(counts, stock, "date", "Date", ["Close"], bucket_fn=None)
    daily = ordered.ffill_bfill(daily, "Close", "date", out="close_price", bucket_fn=None).drop("Close")
    words = cut_lineage(tf.day_words(p, "date", order))
    sweep(spark)
    sent = tf.day_sentiment(p, "date")
    w, _vocab = tf.tfidf_of(p, words, "date", order)
    svd = tf.truncated_svd(w, "date", "term", "weight", svd_k)
    emb = tf.hash_embeddings_of(words, "date", dim=dim)
    emb = emb.select("date", *[F.col("embedding")[i].alias(f"embed_{i}") for i in range(embed_n)])
    out = (daily.join(sent, "date", "left").join(svd, "date", "left").join(emb, "date", "left")
                .na.fill(0.0, subset=["sentiment_compound"] + [f"tfidf_{i}" for i in range(svd_k)] + [f"embed_{i}" for i in range(embed_n)]))
    return out.select(F.col("date").alias("timestamp"), *COUNT_COLS, "close_price", *FEATURES[6:])


def assert_no_nulls(df):
    """one aggregate over all columns; raises when any null is present."""
    row = df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).first()
    bad = {c: row[c] for c in df.columns if row[c]}
    if bad:
        raise ValueError(f"nulls after feature creation: {bad}")
    return df


def feature_overview(spark, d):
    """A20 + A22 over the feature table: mean of each count and mean |tfidf_i| (long form)."""
    f = daily_features(spark, d)
    cols = COUNT_COLS + [f"tfidf_{i}" for i in range(10)]
    a = f.agg(*[F.avg(c).alias(c) if c in COUNT_COLS else F.avg(F.abs(c)).alias(c) for c in cols])
    stack = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    return a.selectExpr(f"stack({len(cols)}, {stack}) AS (feature, mean_value)")


INPUTS = ("orders", "documents", "lineitem")
POSTS = "cleaned"           # part of the keys of stages and models: tables made from raw posts are not read again
SEED = 42


def _stage(spark, d, label, build):
    """S7 over the feature table's inputs: every model query of a session, or a later one, reads what the first made."""
    return sinks.stage(spark, label, build, [f"{d.rstrip('/')}/{t}.parquet" for t in INPUTS], {"seed": SEED, "features": FEATURES, "posts": POSTS})


def _prepared(spark, d):
    f = _stage(spark, d, "daily_features", lambda: daily_features(spark, d))
    return rg.hash_split(assert_no_nulls(f), "timestamp", SEED)


def split_80_20(spark, d):
    """M1: (timestamp, is_train) of every day of ``dated_posts``. A day's side hangs on the day alone, so the days that
    cleaning leaves in the feature table have the same side there."""
    days = fixture(spark, d, "dated_posts").where("date is not null").select(F.col("date").alias("timestamp")).distinct()
    return rg.hash_split(days, "timestamp", SEED).select("timestamp", "is_train")


SQL_SPLIT = fixture_cte("dated_posts") + """SELECT DISTINCT date AS timestamp,
 CAST('0x' || substr(md5(CAST(date AS VARCHAR) || ':42'), 1, 8) AS BIGINT) % 100 >= 20 AS is_train
FROM dated_posts WHERE date IS NOT NULL"""


def smote_rows(spark, d):
    """M2: synthetic training rows with their parents and alpha."""
    f = _prepared(spark, d)
    return rg.smote(f.where("is_train"), "timestamp", FEATURES, "close_price")


def _training_sets(spark, d):
    """Training rows with synthetic ones, test rows, and the target's scaling; each a stage."""
    f = _prepared(spark, d)
    train = f.where("is_train")

    def augmented():
        syn = rg.smote(train, "timestamp", FEATURES, "close_price").select(*FEATURES, "close_price")
        return train.select(*FEATURES, "close_price").unionByName(syn)

    aug = _stage(spark, d, "augmented", augmented)
    stats = _stage(spark, d, "target_stats", lambda: rg.target_stats(aug, "close_price"))
    tr = _stage(spark, d, "train", lambda: rg.assemble(rg.normalize_target(aug, stats, "close_price"), FEATURES).coalesce(8))
    te = _stage(spark, d, "test", lambda: rg.assemble(rg.normalize_target(f.where(~F.col("is_train")), stats, "close_price"), FEATURES).coalesce(8))
    return tr, te, stats


# The candidates and their sizes.
MODEL_SPECS = {
    "Random Forest": dict(kind="rf", numTrees=400, maxDepth=20, minInstancesPerNode=1, seed=42),
    "Gradient Boosted Trees": dict(kind="gbt", maxIter=400, maxDepth=8, stepSize=0.05, subsamplingRate=0.8, seed=42),
    "Linear SVR": dict(kind="svr", C=0.01, epsilon=10.0),
}
TREE_GRID = (50, 100, 150, 200, 250, 300)


def _fit(kind: str, train, params: dict):
    p = dict(params)
    p.pop("kind", None)
    if kind == "rf":
        return bo.forest(train, "features", "y", **p)
    if kind == "gbt":
        return bo.gbt(train, "features", "y", **p)
    w, b = rg.linear_svr(train, FEATURES, "y", **p)
    return ("svr", w, b)


def _predict(model, df):
    if isinstance(model, tuple):
        _k, w, b = model
        pred = sum((F.lit(float(w[i])) * F.col(c).cast("double") for i, c in enumerate(FEATURES)), F.lit(float(b)))
        return df.withColumn("prediction", pred)
    return model.transform(df)


def _model_path(spark, d, name: str, spec: dict) -> str:
    key = sinks.fingerprint(spark, [f"{d.rstrip('/')}/{t}.parquet" for t in INPUTS], {"name": name, "spec": spec, "seed": SEED, "features": FEATURES, "posts": POSTS})
    return checkpoint_dir(spark).rstrip("/") + f"/models/{key}"


def fitted(spark, d, name: str, spec: dict):
    """The candidate fitted on this input: loaded if a former query saved it, else fitted and saved."""
    path = _model_path(spark, d, name, spec)
    model = sinks.load_model(spark, path)
    if model is None:
        tr, _te, _stats = _training_sets(spark, d)
        model = _fit(spec["kind"], tr, spec)
        sinks.save_model(spark, model, path, name, {}, {"target": "z-scored log"}, FEATURES)
    return model


def train_all(spark, d, specs: dict | None = None, save_to: str | None = None):
    """M7 + L6: fit the candidates side by side, score train R2 and test metrics; best first. A candidate that fails
    keeps its row, with the error. The best one is saved with its scores (S8)."""
    from concurrent.futures import ThreadPoolExecutor
    specs = specs or MODEL_SPECS
    tr, te, _stats = _training_sets(spark, d)

    def one(item):
        name, spec = item
        try:
            m = fitted(spark, d, name, spec)
            mtr = rg.metrics(_predict(m, tr), "y", "prediction").first()
            pte = _predict(m, te)
            mte = rg.metrics(pte, "y", "prediction").first()
            acc = rg.direction_accuracy(pte, "y", "prediction").first()
            return (name, mtr["r2"], mte["r2"], mte["rmse"], mte["mae"], acc["accuracy"], None), m
        except Exception as e:  # noqa: BLE001 - reported in the candidate's row
            return (name, None, None, None, None, None, f"{type(e).__name__}: {e}"[:300]), None

    with ThreadPoolExecutor(len(specs)) as pool:
        done = list(pool.map(one, specs.items()))
    models = {row[0]: m for row, m in done if m is not None}
    df = spark.createDataFrame([row for row, _ in done], "model string, train_r2 double, test_r2 double, test_rmse double, "
                               "test_mae double, test_accuracy double, error string")
    ranked = [row for row, m in done if m is not None and row[2] is not None]
    if ranked:
        best = max(ranked, key=lambda row: row[2])
        scores = dict(zip(("train_r2", "test_r2", "test_rmse", "test_mae", "test_accuracy"), best[1:6]))
        path = save_to or _model_path(spark, d, "best", specs)
        sinks.save_model(spark, models[best[0]], path, best[0], scores, {"target": "z-scored log", "split": "80/20"}, FEATURES,
                         saved_at=_model_path(spark, d, best[0], specs[best[0]]))
    return df.orderBy(F.col("test_r2").desc_nulls_last()), models, (tr, te)


def best_model(spark, d, specs: dict | None = None):
    """Name and model of the saved winner (S8); the candidates are trained first where none is saved yet."""
    specs = specs or MODEL_SPECS
    path = _model_path(spark, d, "best", specs)
    model = sinks.load_model(spark, path)
    if model is not None:
        return sinks.model_name(spark, path), model
    _df, models, _sets = train_all(spark, d, specs)
    name = sinks.model_name(spark, path)
    return name, models[name]


def _winner_test(spark, d, specs: dict | None = None):
    """The winner's name, and the test rows with its prediction and the calibrated one, as z-scored logs."""
    name, model = best_model(spark, d, specs)
    tr, te, _stats = _training_sets(spark, d)
    return name, rg.calibrated(_predict(model, te), _predict(model, tr), "y", "prediction")


def winner_series(spark, d, specs: dict | None = None):
    """Q8 + M14: the saved winner's calibrated test predictions in price units, smoothed over 7 test rows."""
    _name, t = _winner_test(spark, d, specs)
    return rg.prediction_series(rg.in_price_units(t, "y", "pred"), "timestamp", "y", "pred", 7)


def winner_summary(spark, d, specs: dict | None = None):
    """Q8 + M14 + M9: the saved winner's name, correlation and means of its calibrated test predictions, and the
    direction accuracy of its uncalibrated ones, in price units."""
    name, t = _winner_test(spark, d, specs)
    t = rg.in_price_units(t, "y", "pred", "prediction")
    side = rg.direction_accuracy(t, "y", "prediction").select("accuracy")
    return rg.prediction_summary(t, "y", "pred").crossJoin(F.broadcast(side)).select(F.lit(name).alias("model"), "*")


def leaderboard(spark, d, specs: dict | None = None):
    return train_all(spark, d, specs)[0]


def importance_top15(spark, d, n: int = 15, specs: dict | None = None):
    """M15 + L5: feature importances of the boosted model, top n."""
    name = "Gradient Boosted Trees"
    imp = fitted(spark, d, name, (specs or MODEL_SPECS)[name]).featureImportances.toArray().tolist()
    df = spark.createDataFrame(list(zip(FEATURES, map(float, imp))), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(n)


def boosting_curve(spark, d, specs: dict | None = None):
    """RMSE per boosting round on the training part and a held-out 20% of it."""
    tr, _te, _s = _training_sets(spark, d)
    # held-out 20% of the training part, chosen by a seeded hash of the row's features
    tr = tr.withColumn("_fit", F.pmod(F.xxhash64(*FEATURES[:6], F.lit(7)), F.lit(100)) >= 20)
    fit, held = tr.where("_fit"), tr.where(~F.col("_fit"))
    m = _fit("gbt", fit, (specs or MODEL_SPECS)["Gradient Boosted Trees"])
    a, b = (_round_errors(m, side) for side in (fit, held))
    rows = [(i + 1, x, y) for i, (x, y) in enumerate(zip(a, b))]
    return spark.createDataFrame(rows, "round int, train_rmse double, val_rmse double")


def _round_errors(model, df) -> list[float]:
    """RMSE after each boosting round (``evaluateEachIteration`` gives mean squared errors)."""
    return [float(x) ** 0.5 for x in model.evaluateEachIteration(df, "squared")]


def validation_curve(spark, d, grid=TREE_GRID, folds: int = 3, specs: dict | None = None):
    """3-fold train / validation RMSE of the forest for each tree count (hash folds).

    Forests of one fold are nested: one forest of the most trees is fitted a fold, and a smaller one is its first trees.
    The RMSE of all sizes comes from running means of the trees' single predictions (``rg.forest_curve``)."""
    from concurrent.futures import ThreadPoolExecutor
    from functools import reduce
    tr, _te, _s = _training_sets(spark, d)
    fold = F.pmod(F.xxhash64(*FEATURES[:6], F.lit(3)), F.lit(folds))
    tr = cut_lineage(tr.withColumn("_fold", fold).withColumn("_row", F.monotonically_increasing_id()))
    spec = {k: v for k, v in (specs or MODEL_SPECS)["Random Forest"].items() if k not in ("kind", "numTrees")}
    most = max(grid)

    def one(part):
        # a fold's forest in the parts that bo.forest would join: a part is gone once its trees' predictions are written
        k, at = part
        m = bo.forest_part(tr.where(F.col("_fold") != k), "features", "y", most, at, **spec)
        rows = tr.withColumn("_held", F.col("_fold") == k)
        return cut_lineage(rg.forest_values(m, rows, "_row", ["_held", "y"], first=at)).withColumn("_k", F.lit(k))

    parts = [(k, at) for k in range(folds) for at in bo.parts(most)]
    with ThreadPoolExecutor(bo.AT_ONCE) as pool:                  # the fits run side by side
        values = reduce(lambda a, b: a.unionByName(b), pool.map(one, parts))
    curves = rg.curve_of(values, "_row", "y", "_held", grid, by=["_k"])
    return (curves.groupBy(F.col("trees").alias("n_estimators"))
            .agg(F.avg(F.when(~F.col("_held"), F.col("rmse"))).alias("train_rmse"), F.avg(F.when(F.col("_held"), F.col("rmse"))).alias("val_rmse")))


# ------------------------------------------------------------------ evaluation operators, exact checks
def _standin(spark, d):
    s = fixture(spark, d, "stock").select("Date", "Close")
    key = F.datediff(F.col("Date"), F.lit("1990-01-01").cast("date"))
    return s.select("Date", F.col("Close").alias("y"), (F.col("Close") * 0.9 + F.pmod(key, F.lit(7))).alias("yhat"),
                    (F.pmod(key, F.lit(5)) != 0).alias("is_train"))


_STANDIN_SQL = fixture_cte("stock") + """, si AS (SELECT Date, Close AS y, Close * 0.9 + ((Date - DATE '1990-01-01') % 7) AS yhat,
  ((Date - DATE '1990-01-01') % 5) <> 0 AS is_train FROM stock)
"""


def target_norm(spark, d):
    """Z-scored log target with training statistics, and its inverse."""
    s = _standin(spark, d)
    st = rg.target_stats(s.where("is_train"), "y")
    z = rg.normalize_target(s, st, "y", out="z")
    return z.select("Date", "is_train", r6("z").alias("z"), r6(rg.inverse_target(F.col("z"))).alias("y_back"))


SQL_TARGET_NORM = _STANDIN_SQL + """, st AS (SELECT avg(ln(y)) AS m, stddev_samp(ln(y)) AS s FROM si WHERE is_train),
zz AS (SELECT Date, is_train, y, (ln(y) - m) / s AS z, m, s FROM si, st)
SELECT Date, is_train, round(z, 6) AS z, round(exp(z * s + m), 6) AS y_back FROM zz"""


def regression_metrics(spark, d):
    m = rg.metrics(_standin(spark, d).where(~F.col("is_train")), "y", "yhat")
    return m.select("n", r6("r2").alias("r2"), r6("rmse").alias("rmse"), r6("mae").alias("mae"), r6("mse").alias("mse"))


SQL_METRICS = _STANDIN_SQL + """, t AS (SELECT * FROM si WHERE NOT is_train), a AS (SELECT avg(y) AS ym FROM t)
SELECT count(*) AS n, round(1 - sum((y - yhat) ^ 2) / sum((y - ym) ^ 2), 6) AS r2, round(sqrt(avg((y - yhat) ^ 2)), 6) AS rmse,
 round(avg(abs(y - yhat)), 6) AS mae, round(avg((y - yhat) ^ 2), 6) AS mse FROM t, a"""


def direction_accuracy(spark, d):
    a = rg.direction_accuracy(_standin(spark, d).where(~F.col("is_train")), "y", "yhat")
    return a.select(r6("accuracy").alias("accuracy"), r6("threshold").alias("threshold"))


SQL_DIRECTION = _STANDIN_SQL + """, t AS (SELECT * FROM si WHERE NOT is_train), a AS (SELECT avg(y) AS th FROM t)
SELECT round(avg(CASE WHEN (yhat > th) = (y > th) THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy, round(max(th), 6) AS threshold FROM t, a"""


def direction_confusion(spark, d):
    """M10 on calibrated test predictions: the line of M11 is fitted on the training rows first."""
    s = _standin(spark, d)
    line = rg.calibration(s.where("is_train"), "y", "yhat")
    t = s.where(~F.col("is_train")).crossJoin(F.broadcast(line)).withColumn("pred", F.col("slope") * F.col("yhat") + F.col("intercept"))
    return rg.direction_confusion(t, "y", "pred")


SQL_CONFUSION = _STANDIN_SQL + """, t AS (SELECT * FROM si WHERE NOT is_train), a AS (SELECT avg(y) AS th FROM t),
l AS (SELECT regr_slope(y, yhat) AS sl, regr_intercept(y, yhat) AS ic FROM si WHERE is_train),
c AS (SELECT y > th AS actual_above, sl * yhat + ic > th AS predicted_above, count(*) AS n FROM t, a, l GROUP BY 1, 2),
g AS (SELECT * FROM (VALUES (false, false), (false, true), (true, false), (true, true)) v(actual_above, predicted_above))
SELECT g.actual_above, g.predicted_above, coalesce(c.n, 0) AS n FROM g LEFT JOIN c USING (actual_above, predicted_above)"""


def calibration_line(spark, d):
    c = rg.calibration(_standin(spark, d).where("is_train"), "y", "yhat")
    return c.select(r6("slope").alias("slope"), r6("intercept").alias("intercept"), "n_train")


SQL_CALIBRATION = _STANDIN_SQL + """SELECT round(regr_slope(y, yhat), 6) AS slope, round(regr_intercept(y, yhat), 6) AS intercept,
 count(*) AS n_train FROM si WHERE is_train"""


def prediction_series(spark, d):
    """The series of M14 with M11, of the stand-in prediction in its own units: test predictions calibrated by the
    training line, then smoothed over 7 test rows. ``prediction_prices`` scales back from z-scored logs."""
    s = _standin(spark, d)
    c = rg.calibration(s.where("is_train"), "y", "yhat")
    t = s.where(~F.col("is_train")).crossJoin(F.broadcast(c)).withColumn(
        "pred", F.col("slope") * F.col("yhat") + F.col("intercept"))
    p = rg.prediction_series(t, "Date", "y", "pred", 7)
    return p.select("Date", "actual", r6("predicted").alias("predicted"), r6("predicted_smooth").alias("predicted_smooth"),
                    r6("residual").alias("residual"))


SQL_PRED_SERIES = _STANDIN_SQL + """, c AS (SELECT regr_slope(y, yhat) AS sl, regr_intercept(y, yhat) AS ic FROM si WHERE is_train),
t AS (SELECT Date, y AS actual, sl * yhat + ic AS predicted FROM si, c WHERE NOT is_train),
sm AS (SELECT *, CASE WHEN count(predicted) OVER w = 7 THEN avg(predicted) OVER w END AS ps FROM t
       WINDOW w AS (ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT Date, actual, round(predicted, 6) AS predicted, round(ps, 6) AS predicted_smooth, round(actual - ps, 6) AS residual FROM sm"""


def _standin_test(spark, d):
    """The stand-in's test rows as z-scored logs, calibrated, then back in price units."""
    s = _standin(spark, d)
    stats = rg.target_stats(s.where("is_train"), "y")
    z = rg.normalize_target(s, stats, "y", out="z").withColumn("zhat", (F.ln("yhat") - F.col("t_mean")) / F.col("t_std"))
    t = rg.calibrated(z.where(~F.col("is_train")), z.where("is_train"), "z", "zhat")
    return rg.in_price_units(t, "z", "pred", "zhat")


_STANDIN_TEST_SQL = _STANDIN_SQL + """, st AS (SELECT avg(ln(y)) AS m, stddev_samp(ln(y)) AS s FROM si WHERE is_train),
z AS (SELECT Date, is_train, (ln(y) - m) / s AS z, (ln(yhat) - m) / s AS zhat, m, s FROM si, st),
c AS (SELECT regr_slope(z, zhat) AS sl, regr_intercept(z, zhat) AS ic FROM z WHERE is_train),
t AS (SELECT Date, exp(z * s + m) AS actual, exp((sl * zhat + ic) * s + m) AS predicted, exp(zhat * s + m) AS uncalibrated FROM z, c WHERE NOT is_train)
"""


def prediction_prices(spark, d):
    """M14 whole, of the stand-in prediction: calibrated as z-scored logs, scaled back, smoothed over 7 test rows."""
    p = rg.prediction_series(_standin_test(spark, d), "Date", "z", "pred", 7)
    return p.select("Date", *[r6(c).alias(c) for c in ("actual", "predicted", "predicted_smooth", "residual")])


SQL_PRED_PRICES = _STANDIN_TEST_SQL + """, sm AS (SELECT *, CASE WHEN count(predicted) OVER w = 7 THEN avg(predicted) OVER w END AS ps FROM t
       WINDOW w AS (ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT Date, round(actual, 6) AS actual, round(predicted, 6) AS predicted, round(ps, 6) AS predicted_smooth, round(actual - ps, 6) AS residual FROM sm"""


def prediction_summary(spark, d):
    """M14's figures and M9 after inverse scaling, of the stand-in prediction."""
    t = _standin_test(spark, d)
    side = rg.direction_accuracy(t, "z", "zhat").select("accuracy")
    s = rg.prediction_summary(t, "z", "pred").crossJoin(F.broadcast(side))
    return s.select("n", *[r6(c).alias(c) for c in ("correlation", "actual_mean", "predicted_mean", "accuracy")])


SQL_PRED_SUMMARY = _STANDIN_TEST_SQL + """, a AS (SELECT avg(actual) AS th FROM t)
SELECT count(*) AS n, round(corr(actual, predicted), 6) AS correlation, round(avg(actual), 6) AS actual_mean, round(avg(predicted), 6) AS predicted_mean,
 round(avg(CASE WHEN (uncalibrated > th) = (actual > th) THEN 1.0 ELSE 0.0 END) * 100.0, 6) AS accuracy FROM t, a"""


REGISTRY = {
    "daily_features": (daily_features, None),
    "feature_overview": (feature_overview, None),
    "split_80_20": (split_80_20, SQL_SPLIT),
    "smote_rows": (smote_rows, None),
    "target_norm": (target_norm, SQL_TARGET_NORM),
    "regression_metrics": (regression_metrics, SQL_METRICS),
    "direction_accuracy": (direction_accuracy, SQL_DIRECTION),
    "direction_confusion": (direction_confusion, SQL_CONFUSION),
    "calibration_line": (calibration_line, SQL_CALIBRATION),
    "prediction_series": (prediction_series, SQL_PRED_SERIES),
    "prediction_prices": (prediction_prices, SQL_PRED_PRICES),
    "prediction_summary": (prediction_summary, SQL_PRED_SUMMARY),
    "leaderboard": (leaderboard, None),
    "winner_series": (winner_series, None),
    "winner_summary": (winner_summary, None),
    "importance_top15": (importance_top15, None),
    "boosting_curve": (boosting_curve, None),
    "validation_curve": (validation_curve, None),
}
