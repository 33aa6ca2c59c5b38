"""CSV readers (positions, strict columns, null tokens), sinks, stage cache and the streaming router."""
import os

import pytest
from pyspark.sql import functions as F

from quillspark.plans import q_cleaning as qc
from quillspark.sources import csv as sc
from quillspark.sources import sinks as sk
from quillspark.streaming.ingest import route_stream
from conftest import SF_SMALL


def _raw_posts(spark):
    p = qc.fixture(spark, SF_SMALL, "posts")
    return p.select("row_id", *[F.col(c).cast("string").alias(c) for c in sc.POST_COLUMNS if c != "quote"],
                    F.lit("").alias("quote"))


def test_csv_round_trip_keeps_file_order(spark, scratch_dir):
    raw = _raw_posts(spark).orderBy("row_id")
    path = os.path.join(scratch_dir, "posts_csv")
    sk.write_table(raw.drop("row_id").coalesce(1), path, fmt="csv")
    back = sc.read_csv_strings(spark, path, sc.POST_COLUMNS)
    got = back.orderBy("row_id").select("fullText").collect()
    exp = raw.select("fullText").collect()
    assert [r[0] for r in got] == [r[0] for r in exp]
    assert back.agg(F.min("row_id"), F.max("row_id")).first() == (0, 999)
    with pytest.raises(KeyError):
        sc.read_csv_strings(spark, path, ["fullText", "nope"])


def test_stage_file_reread_types(spark, scratch_dir):
    path = os.path.join(scratch_dir, "stage_csv")
    df = spark.createDataFrame([("NA", "3"), ("x", "n/a"), ("none", "2.0")], "text string, likeCount string")
    sk.write_table(df.coalesce(1), path, fmt="csv")
    got = sc.read_stage_csv(spark, path, counts=["likeCount"]).orderBy("row_id").collect()
    assert [(r.text, r.likeCount) for r in got] == [(None, 3), ("x", None), ("none", 2)]


def test_drop_helpers(spark):
    df = spark.createDataFrame([(0, "a", 1), (1, "junk", 2), (2, "b", 3)], "row_id long, Date string, `Adj Close` long")
    out = sc.drop_strict(sc.drop_positions(df, [1]), "Adj Close")
    assert out.columns == ["row_id", "Date"] and out.count() == 2
    with pytest.raises(KeyError):
        sc.drop_strict(out, "Adj Close")


def test_partitioned_sink_and_stage_cache(spark, scratch_dir):
    r = qc.route_posts(spark, SF_SMALL)
    out = os.path.join(scratch_dir, "routed")
    sk.write_table(r, out, partition_by=["kind"], sort_within=["timestamp"])
    assert {"kind=original", "kind=reply", "kind=retweet"} <= set(os.listdir(out))
    calls = []

    def build():
        calls.append(1)
        return r.groupBy("kind").count()
    a = sk.stage(spark, "split_counts", build, inputs=[out], params={"v": 1}, root=scratch_dir)
    b = sk.stage(spark, "split_counts", build, inputs=[out], params={"v": 1}, root=scratch_dir)
    assert len(calls) == 1 and sorted(a.collect()) == sorted(b.collect())
    sk.stage(spark, "split_counts", build, inputs=[out], params={"v": 2}, root=scratch_dir)
    assert len(calls) == 2


def test_streaming_router_matches_batch(spark, scratch_dir):
    src = os.path.join(scratch_dir, "incoming")
    raw = _raw_posts(spark).drop("row_id")
    sk.write_table(raw.coalesce(2), src, fmt="csv")
    for f in os.listdir(src):
        if not f.endswith(".csv"):
            os.remove(os.path.join(src, f))
    out = os.path.join(scratch_dir, "stream_out")
    q = route_stream(spark, src, out, os.path.join(scratch_dir, "stream_ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(out).groupBy("kind").count().collect()
    exp = qc.routed(spark, SF_SMALL).groupBy("kind").count().collect()
    assert sorted(got) == sorted(exp)


def test_save_model_writes_model_metadata_and_features(spark, scratch_dir):
    from pyspark.ml.regression import RandomForestRegressor
    from quillspark.operators import regression as rg
    df = spark.createDataFrame([(float(i), float(i % 7), float(i) * 2.0) for i in range(60)], "a double, b double, y double")
    m = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=5, maxDepth=3, seed=1).fit(rg.assemble(df, ["a", "b"]))
    out = os.path.join(scratch_dir, "best")
    sk.save_model(spark, m, out, "Random Forest", {"test_r2": 0.9}, {"t_mean": 1.0, "t_std": 2.0}, ["a", "b"])
    meta = spark.read.text(out + "/model_metadata").first()[0]
    assert '"n_features": 2' in meta and "RandomForestRegressionModel" in meta
    assert [r[0] for r in spark.read.option("header", True).csv(out + "/feature_columns").collect()] == ["a", "b"]
    from pyspark.ml.regression import RandomForestRegressionModel
    assert RandomForestRegressionModel.load(out + "/model").getNumTrees == 5


def test_routed_files_are_compressed(spark, monkeypatch):
    """The routed posts' files hold whole texts: they are written compressed, and what comes back is the same."""
    import os

    from conftest import SF_SMALL
    from quillspark.plans import q_cleaning as qc
    found = []
    scratch = qc._scratch
    monkeypatch.setattr(qc, "_scratch", lambda s: found.append(scratch(s)) or found[-1])
    back = {r["kind"]: (r["n_rows"], r["id_sum"]) for r in qc.routed_files(spark, SF_SMALL).collect()}
    files = [f for _d, _s, fs in os.walk(found[0].removeprefix("file:")) for f in fs if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)
    rows = qc.routed(spark, SF_SMALL).groupBy("kind").agg({"row_id": "sum", "*": "count"}).collect()
    assert back == {r["kind"]: (r["count(1)"], r["sum(row_id)"]) for r in rows}
