"""Conservation and keep-first semantics of the cleaning jobs."""
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.operators import cleaning as cl
from quillspark.plans import q_cleaning as qc


def test_waterfall_conserves_rows(spark):
    wf = qc.cleaning_waterfall(spark, SF_SMALL).collect()
    routed = qc.routed(spark, SF_SMALL).groupBy("kind").count().collect()
    n_in = {r["kind"]: r["count"] for r in routed}
    for kind in cl.KINDS:
        rows = sorted([r for r in wf if r.kind == kind], key=lambda r: r.step_no)
        assert rows[0].rows_in == n_in.get(kind, 0)
        for a, b in zip(rows, rows[1:]):
            assert a.rows_out == b.rows_in
        out = {"original": qc.clean_originals, "reply": qc.clean_replies, "retweet": qc.clean_retweets}[kind]
        assert rows[-1].rows_out == out(spark, SF_SMALL).count()


def test_classes_partition_input(spark):
    r = qc.routed(spark, SF_SMALL)
    assert r.count() == r.where(F.col("kind").isin(cl.KINDS)).count() == 1000


def test_keep_first_dedupe_and_repartition_invariance(spark):
    rows = [(1, "a", 1), (2, "a", 1), (3, "b", None), (4, "b", None), (5, "b", 0), (6, "a", 2)]
    df = spark.createDataFrame(rows, "row_id long, text string, n long")
    ids = sorted(r[0] for r in cl.keep_first_ids(df, ["text", "n"]).collect())
    assert ids == [1, 3, 5, 6]
    ids8 = sorted(r[0] for r in cl.keep_first_ids(df.repartition(8), ["text", "n"]).collect())
    assert ids8 == ids


def test_clean_texts_have_no_double_blanks(spark):
    t = qc.clean_originals(spark, SF_SMALL)
    assert t.where(F.col("text").contains("  ") | (F.col("text") != F.trim("text"))).count() == 0


def test_texts_are_not_moved_for_counts(spark):
    """Where only authors are counted, the ranking of duplicates holds digests and flags, no texts."""
    def windows(node):
        kids = node.children()
        own = [node.output().mkString(",")] if node.nodeName() == "Window" else []
        return own + [w for i in range(kids.size()) for w in windows(kids.apply(i))]

    r = qc.clean_retweets(spark, SF_SMALL).groupBy("originalAuthor").count()
    found = windows(r._jdf.queryExecution().optimizedPlan())
    assert found and not any(name in w for w in found for name in ("tweet#", "_clean#", "text#"))
