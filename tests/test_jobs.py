"""Composite jobs: the community and price job, whole texts in the views, saved models, loops that end."""
import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quillspark.operators import graph as gx
from quillspark.plans import q_graph, q_models
from quillspark.sources import sinks
from quillspark.sources.tables import fixture


def test_posts_hold_whole_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n = docs.count()
    dated = fixture(spark, SF_SMALL, "dated_posts").where("text is not null")
    want = dated.select((F.col("row_id") % n).alias("doc_id"), F.length("text").alias("got")).join(docs, "doc_id")
    assert want.where("got <> length(text)").count() == 0
    posts = fixture(spark, SF_SMALL, "posts")
    longest = posts.agg(F.max(F.length("fullText"))).first()[0]
    assert longest > 1000


def test_community_price_job(spark):
    rows = q_graph.community_price_job(spark, SF_SMALL).orderBy("rank").collect()
    assert 0 < len(rows) <= 14 and [r["rank"] for r in rows] == list(range(1, len(rows) + 1))
    assert [r["diff"] for r in rows] == sorted((r["diff"] for r in rows), reverse=True)
    assert len({r["label"] for r in rows}) == len(rows)
    assert all(-0.5 <= r["modularity"] <= 1 for r in rows)


def test_louvain_never_lowers_modularity(spark):
    edges = [(a, b, 1.0) for g in (range(0, 6), range(6, 12), range(12, 18)) for a in g for b in g if a < b] + [(5, 6, 1.0), (11, 12, 1.0)]
    log = []
    e = spark.createDataFrame(edges, "src long, dst long, weight double")
    part = gx.louvain(e, spark.range(19), _log=log.append)
    groups = {}
    for r in part.collect():
        groups.setdefault(r["community"], set()).add(r["id"])
    assert sorted(map(sorted, groups.values())) == [list(range(6)), list(range(6, 12)), list(range(12, 18)), [18]]
    assert log and gx.modularity(e, part).first()["modularity"] > 0.5


def test_pointer_cycles_raise(spark):
    with pytest.raises(RuntimeError):
        gx.resolve_pointers(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "node long, target long"), max_rounds=3)


def test_linear_model_is_saved_and_loaded(spark, scratch_dir):
    w, b = [0.5, -2.0], 3.25
    sinks.save_model(spark, ("svr", w, b), scratch_dir + "/m", "svr", {"r2": 1.0}, {}, ["x", "z"])
    kind, w2, b2 = sinks.load_model(spark, scratch_dir + "/m")
    assert (kind, list(w2), b2) == ("svr", w, b)
    assert sinks.load_model(spark, scratch_dir + "/none") is None
    with pytest.raises(TypeError):
        sinks.save_model(spark, object(), scratch_dir + "/x", "x", {}, {}, [])


def test_failing_candidate_keeps_its_row(spark, monkeypatch):
    tr = spark.createDataFrame([(1.0,)], "y double")
    monkeypatch.setattr(q_models, "_training_sets", lambda s, d: (tr, tr, None))

    def broken(*_):
        raise ValueError("no fit")
    monkeypatch.setattr(q_models, "fitted", broken)
    row = q_models.leaderboard(spark, SF_SMALL, {"One": {"kind": "rf"}}).first()
    assert row["model"] == "One" and row["test_r2"] is None and "no fit" in row["error"]

def _two_groups(tmp):
    """Two groups of eight equal texts each whose vectors have a cosine between 0.3 and 0.7, and posts on days with prices."""
    shared = "market price share value report "
    texts = [shared + "apple banana cherry grape lemon "] * 8 + [shared + "rocket engine launch orbit booster "] * 8
    day = lambda i: datetime.datetime(1996, 1, 1) + datetime.timedelta(days=i)
    pq.write_table(pa.table({"doc_id": list(range(16)), "text": texts}), f"{tmp}/documents.parquet")
    n = 160
    pq.write_table(pa.table({"o_orderkey": list(range(n)), "o_orderdate": [day(i % 20) for i in range(n)], "o_orderpriority": ["x"] * n,
                             "o_custkey": list(range(n)), "o_totalprice": [1.0] * n}), f"{tmp}/orders.parquet")
    pq.write_table(pa.table({"l_orderkey": list(range(20)), "l_linenumber": [1] * 20, "l_shipdate": [day(i) for i in range(20)],
                             "l_extendedprice": [100.0 + 60 * (i % 4 == 3) for i in range(20)], "l_quantity": [1.0] * 20}), f"{tmp}/lineitem.parquet")
    return str(tmp)


def test_price_job_runs_louvain_and_merges_at_its_own_threshold(spark, tmp_path, monkeypatch):
    d = _two_groups(tmp_path)
    ran, plain = [], gx.louvain
    monkeypatch.setattr(gx, "louvain", lambda *a, **k: ran.append(1) or plain(*a, **k))
    v = q_graph.tf.hash_embeddings(spark.read.parquet(d + "/documents.parquet").select("doc_id", F.explode(q_graph.tf.word_tokens("text")).alias("tok")), "doc_id", dim=64)
    x, y = [r["embedding"] for r in v.where("doc_id in (0, 8)").orderBy("doc_id").collect()]
    cosine = sum(a * b for a, b in zip(x, y)) / (sum(a * a for a in x) * sum(b * b for b in y)) ** 0.5
    assert 0.3 < cosine < 0.7                       # apart in the k-NN graph, together after the merge
    joined = lambda **k: q_graph._job_communities(spark, d, **{"threshold": 0.7, "merge_threshold": 0.3, "start": "louvain", "dim": 64, **k})[2]
    assert joined(merge_threshold=0.7).select("community").distinct().count() == 2
    assert joined().select("community").distinct().count() == 1
    ran.clear()
    q_graph.community_price_job(spark, d).collect()
    assert ran                                      # the registered job starts with Louvain


def test_price_overlay_is_the_shifted_count_next_to_close(spark, tmp_path):
    d = _two_groups(tmp_path)
    rows = q_graph.community_price_overlay(spark, d, merge_threshold=0.7, start="singletons").collect()
    assert len({r["community"] for r in rows}) == 2 and len({r["date"] for r in rows}) == 19 and len(rows) == 38
    part = {r["id"]: r["community"] for r in q_graph._job_communities(spark, d, 0.7, 0.7, "singletons", 64)[2].collect()}
    for r in rows:
        i = (r["date"] - datetime.date(1996, 1, 1)).days
        assert r["Close"] == 100.0 + 60 * (i % 4 == 3) and r["label"]
        assert r["n_prev"] == sum(part[k % 16] == r["community"] for k in range(160) if k % 20 == i - 1)


def test_daily_features_count_cleaned_posts_only(spark):
    raw = fixture(spark, SF_SMALL, "raw_dated_posts").orderBy("row_id").collect()
    seen, kept = set(), []
    for r in raw:
        text = r["fullText"]
        if text is None:
            continue
        if r["isRetweet"] == "True":
            text = text.split(": ", 1)[1].strip()
            if text in seen:
                continue
            seen.add(text)
            text = " ".join(text.split())
            if len(text) < 5:
                continue
        if any(c.isascii() and c.isalnum() for c in text):
            kept.append(r)                          # no two rows are equal as a whole: likeCount differs
    want = {}
    for r in kept:
        day = want.setdefault(r["createdAt"], [0, 0])
        day[0] += r["likeCount"]
        day[1] += r["viewCount"]
    got = q_models.daily_features(spark, SF_SMALL).select(F.col("timestamp").cast("string").alias("t"), "likeCount", "viewCount").collect()
    assert {r["t"]: [r["likeCount"], r["viewCount"]] for r in got} == want
    assert len(kept) < len(raw) - 100


def test_cleaned_posts_drop_repeats(spark):
    cols = "row_id long, fullText string, createdAt string, isRetweet string, isReply string, retweetCount long, replyCount long, " \
           "likeCount long, quoteCount long, viewCount long, bookmarkCount long, quote string"
    texts = ["a post", "a post", "...", None, "RT @x: same content", "RT @y: same content", "RT @x: ok", "@x hi there", "@x hi there"]
    rows = [(i, t, "1996-01-02", "False", "False", 1, None, 1, 1, 1, 1, None) for i, t in enumerate(texts)]
    got = q_models.cleaned_posts(spark.createDataFrame(rows, cols)).collect()
    assert {(r["row_id"], r["source"], r["text"]) for r in got} == {
        (0, "tweets", "a post"), (4, "retweets", "same content"), (7, "replies", "@x hi there")}


def test_daily_features_cut_the_texts_once_and_sweep(spark, monkeypatch):
    """Days are not dealt out by ranges, whose sample reads all texts a time more; each step's shuffle files go before the next."""
    from quillspark import session
    from quillspark.operators import text_features as tf
    monkeypatch.setattr(type(spark.range(0)), "repartitionByRange", lambda *a: pytest.fail("a sample of ranges"))
    swept = []
    for where in (q_models, tf):
        monkeypatch.setattr(where, "sweep", lambda s: swept.append(1) or session.sweep(s))
    assert q_models.daily_features(spark, SF_SMALL).count() == 910 and len(swept) >= 4
