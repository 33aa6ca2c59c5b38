"""Every operator on an empty frame: no division by zero (ANSI on), sensible empty or null results."""
from pyspark.sql import functions as F

from quillspark.operators import aggregates as ag
from quillspark.operators import cleaning as cl
from quillspark.operators import graph as gx
from quillspark.operators import regression as rg
from quillspark.operators import text_features as tf


def test_empty_inputs(spark):
    yy = spark.createDataFrame([], "y double, p double")
    m = rg.metrics(yy, "y", "p").first()
    assert m.n == 0 and m.rmse is None and m.r2 is None
    assert rg.direction_accuracy(yy, "y", "p").first().accuracy is None
    assert sum(r.n for r in rg.direction_confusion(yy, "y", "p").collect()) == 0
    raw = spark.createDataFrame([], "row_id long, " + ", ".join(f"{c} string" for c in cl.RAW_COLUMNS))
    routed = cl.route(raw)
    assert [r.n for r in cl.class_counts(routed).collect()] == [0, 0, 0]
    wf = cl.waterfall({k: cl.TAGGERS[k](routed) for k in cl.KINDS}).collect()
    assert all(r.rows_in == 0 and r.removed == 0 for r in wf)
    h = ag.equal_width_histogram(spark.createDataFrame([], "x double"), "x", 5).collect()
    assert len(h) == 5 and all(r.n == 0 for r in h)
    e = spark.createDataFrame([], "src long, dst long, weight double")
    v = spark.createDataFrame([(1,), (2,)], "id long")
    assert gx.modularity(e, v.withColumn("community", F.col("id"))).first().modularity is None
    assert sorted(r.community for r in gx.louvain(e, v).collect()) == [1, 2]
    posts = spark.createDataFrame([], "day int, row_id long, text string")
    w, vocab = tf.tfidf(posts, "day", ["row_id"])
    assert w.count() == 0 and vocab.count() == 0
    assert tf.sentiment_scores(posts, "day").count() == 0
