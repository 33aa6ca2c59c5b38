"""TF-IDF against a brute-force Python version on the concatenated daily text; sentiment rules; embeddings."""
import math
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from quillspark.functions import lexicon as lx
from quillspark.operators import text_features as tf

POSTS = [(0, 1, "Great rockets fly to Mars. The rockets are great!"), (0, 2, None), (0, 3, "the and of"),
         (0, 4, "Mars base soon"), (1, 5, "Rockets, rockets everywhere"), (1, 6, ""), (1, 7, "Base of the Mars rockets"),
         (2, 8, "nothing here but mars"), (2, 9, "rockets and base")]


def brute_tfidf(stop, max_df=0.95, min_df=2, max_features=1000):
    days = sorted({d for d, _, _ in POSTS})
    docs = {d: " <SEP> ".join((t or "") for dd, _, t in sorted(POSTS, key=lambda r: r[1]) if dd == d) for d in days}
    counts = {}
    for d, text in docs.items():
        toks = [t for t in re.findall(r"(?u)\b\w\w+\b", text.lower()) if t not in stop]
        grams = toks + [f"{a} {b}" for a, b in zip(toks, toks[1:])]
        counts[d] = Counter(grams)
    n = len(days)
    df = Counter(t for c in counts.values() for t in c)
    tot = Counter()
    for c in counts.values():
        tot.update(c)
    vocab = [t for t in df if min_df <= df[t] <= max_df * n]
    vocab = sorted(vocab, key=lambda t: (-tot[t], t))[:max_features]
    w = {}
    for d, c in counts.items():
        v = {t: c[t] * (math.log((1 + n) / (1 + df[t])) + 1) for t in vocab if c[t]}
        nr = math.sqrt(sum(x * x for x in v.values()))
        for t, x in v.items():
            w[(d, t)] = x / nr
    return w


def test_tfidf_matches_brute_force(spark):
    df = spark.createDataFrame(POSTS, "day int, row_id long, text string")
    stop = ["the", "and", "of", "to", "are", "but"]
    w, vocab = tf.tfidf(df, "day", ["row_id"], stop_words=stop, max_df=1.0)
    got = {(r.day, r.term): r.weight for r in w.collect()}
    exp = brute_tfidf(set(stop), max_df=1.0)
    assert set(got) == set(exp)
    for k in exp:
        assert abs(got[k] - exp[k]) < 1e-9, k


def test_sentiment_rules(spark):
    rows = [(0, 1, "good"), (1, 2, "not good"), (2, 3, "very good"), (3, 4, "bad bad bad"), (4, 5, "nothing")]
    df = spark.createDataFrame(rows, "day int, row_id long, text string")
    got = {r.day: r.sentiment_compound for r in tf.sentiment_scores(df, "day").collect()}

    def comp(s):
        return s / math.sqrt(s * s + lx.ALPHA)
    g = lx.SENTIMENT_LEXICON["good"]
    assert abs(got[0] - comp(g)) < 1e-12
    assert abs(got[1] - comp(g * lx.NEGATION_SCALAR)) < 1e-12
    assert abs(got[2] - comp(g + lx.BOOST)) < 1e-12
    assert got[3] < -0.5 and got[4] == 0.0


def test_hash_embeddings_unit_norm(spark):
    df = spark.createDataFrame(POSTS, "day int, row_id long, text string")
    e = tf.hash_embeddings(tf.day_tokens(df, "day", ["row_id"]), "day", dim=16).collect()
    for r in e:
        assert abs(np.linalg.norm(r.embedding) - 1.0) < 1e-9


def test_day_pieces_concatenate_to_daily_text(spark):
    df = spark.createDataFrame(POSTS, "day int, row_id long, text string")
    pieces = tf.day_pieces(df, "day", ["row_id"]).collect()
    for d in {p[0] for p in POSTS}:
        got = "".join(r.piece for r in sorted((r for r in pieces if r.day == d), key=lambda r: r.row_id))
        exp = " <SEP> ".join((t or "") for dd, _, t in POSTS if dd == d)
        assert got == exp


def test_svd_columns_orthogonal(spark):
    rng = np.random.default_rng(0)
    rows = [(d, f"t{j}", float(rng.random())) for d in range(30) for j in range(12) if rng.random() < 0.6]
    w = spark.createDataFrame(rows, "day int, term string, weight double")
    out = tf.truncated_svd(w, "day", "term", "weight", k=4).orderBy("day").toPandas()
    M = out[[f"tfidf_{i}" for i in range(4)]].to_numpy()
    G = M.T @ M
    assert np.allclose(G - np.diag(np.diag(G)), 0, atol=1e-8)
    norms = np.diag(G)
    assert all(norms[i] >= norms[i + 1] - 1e-9 for i in range(3))


def test_encode_with_runs_batch_encoder(spark):
    df = spark.createDataFrame(POSTS, "day int, row_id long, text string")

    def factory():
        def enc(texts):
            return [[float(len(t)), float(t.count(" "))] for t in texts]
        return enc
    out = {r.row_id: r.embedding for r in tf.encode_with(df, "row_id", "text", factory, 2).collect()}
    assert out[1] == [float(len(POSTS[0][2])), float(POSTS[0][2].count(" "))]
    assert out[2] == [0.0, 0.0]          # null text encodes as ''


def test_pruned_bigrams_change_no_vocabulary(spark, monkeypatch):
    """The vocabulary with bigrams counted only where both words are frequent enough equals the unpruned one."""
    import random

    from quillspark.operators import text_features as tf
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    rows = [(i % 6, i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(30)], k=rng.randrange(0, 25)))) for i in range(90)]
    df = spark.createDataFrame(rows, "day int, row_id long, text string")
    for size in (5, 12, 40, 1000):
        found = []
        for most in (50_000, 0):
            monkeypatch.setattr(tf, "MOST_FREQUENT", most)
            w, v = tf.tfidf(df, "day", ["row_id"], stop_words=["w3"], max_df=1.0, max_features=size)
            found.append((sorted(map(tuple, v.collect())), sorted((r[0], r[1], round(r[2], 12)) for r in w.collect())))
        assert found[0] == found[1] and found[0][0]


def test_scan_gives_what_the_single_features_give(spark):
    from quillspark.operators import text_features as tf
    rows = [(d, i, t) for i, (d, t) in enumerate([(1, "not very good, really bad"), (1, None), (1, "great it's Über gut"), (2, ""), (2, "a bb c dd"), (3, "sep sep")])]
    df = spark.createDataFrame(rows, "day int, row_id long, text string")
    s = tf.scan(df, "day", ["row_id"])
    assert sorted(map(tuple, tf.day_sentiment(s, "day").collect())) == sorted(map(tuple, tf.sentiment_scores(df, "day").collect()))
    words = tf.day_words(s, "day", ["row_id"])
    by_words = sorted(map(tuple, tf.hash_embeddings_of(words, "day", 8).collect()))
    assert by_words == sorted(map(tuple, tf.hash_embeddings(tf.day_tokens(df, "day", ["row_id"]), "day", dim=8).collect()))


def test_totals_over_more_days_than_a_mask_holds(spark):
    """Days are bits of 64-day masks: document frequencies and totals are those of a plain count by day."""
    from quillspark.operators import text_features as tf
    rows = [(d, f"t{t}") for d in range(150) for t in range(12) for _ in range(1 + (d * t) % 3) if (d + t) % (t + 1) == 0]
    df = spark.createDataFrame(rows, "day int, term string")
    days = df.select("day").distinct().select("day", F.col("day").cast("long").alias("_di"))
    want = sorted((t, len({d for d, x in rows if x == t}), sum(x == t for _, x in rows)) for t in {x for _, x in rows})
    assert sorted(map(tuple, tf._totals(df, "day", days, 150).collect())) == want
    few = df.where("day < 64")
    assert {(r[0], r[1]) for r in tf._totals(few, "day", days.where("day < 64"), 64).collect()} == {
        (t, len({d for d, x in rows if x == t and d < 64})) for t in {x for d, x in rows if d < 64}}


def test_tfidf_counts_its_own_words_as_given_ones(spark):
    df = spark.createDataFrame(POSTS, "day int, row_id long, text string")
    s = tf.scan(df, "day", ["row_id"])
    found = [tf.tfidf_of(s, words, "day", ["row_id"], max_df=1.0) for words in (None, tf.day_words(s, "day", ["row_id"]))]
    a, b = ([sorted(map(tuple, x.collect())) for x in two] for two in found)
    assert a == b and a[0] and a[1]
