"""Text feature queries (A4, T1-T6) over the ``texts`` view: documents, day = doc_id % 30, order = doc_id."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..operators import text_features as tf
from . import sqlfrag as S
from .common import r6, read_table

N_DAYS = 30
DIM = 64


def texts(spark, d):
    return read_table(spark, d, "documents").select(
        "doc_id", "text", "lang", "source", (F.col("doc_id") % N_DAYS).alias("day"))


TEXTS_CTE = f"WITH texts AS (SELECT doc_id, text, lang, source, doc_id % {N_DAYS} AS day FROM documents)\n"


def _list(vals) -> str:
    return "[" + ", ".join(S.q(v) for v in vals) + "]"


# ----------------------------------------------------------------------------------------------- A4
def daily_text(spark, d):
    """A4 in long form: one piece per post; pieces in doc_id order concatenate to the day's text."""
    return tf.day_pieces(texts(spark, d), "day", ["doc_id"]).select("day", "doc_id", "piece", "is_first")


SQL_DAILY_TEXT = TEXTS_CTE + """SELECT day, doc_id,
 CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY day) THEN coalesce(text, '') ELSE ' <SEP> ' || coalesce(text, '') END AS piece,
 doc_id = min(doc_id) OVER (PARTITION BY day) AS is_first FROM texts"""


def daily_text_stats(spark, d):
    p = tf.day_pieces(texts(spark, d), "day", ["doc_id"])
    return p.groupBy("day").agg(F.count(F.lit(1)).alias("n_posts"),
                                F.sum(F.length("piece")).cast("bigint").alias("n_chars"))


SQL_DAILY_TEXT_STATS = TEXTS_CTE + """SELECT day, count(*) AS n_posts,
 CAST(sum(length(coalesce(text, ''))) + 7 * (count(*) - 1) AS BIGINT) AS n_chars FROM texts GROUP BY day"""


# ----------------------------------------------------------------------------------------------- T2
def _tfidf(spark, d):
    return tf.tfidf(texts(spark, d), "day", ["doc_id"])


def tfidf_top_terms(spark, d):
    _w, vocab = _tfidf(spark, d)
    return vocab.select("term", "df", "total", r6("idf").alias("idf"))


def tfidf_weights(spark, d):
    w, _v = _tfidf(spark, d)
    return w.select("day", "term", r6("weight").alias("weight"))


def _tfidf_sql() -> str:
    stop = _list(lx.TFIDF_STOP_WORDS)
    tok = f"list_filter(regexp_extract_all(lower(coalesce(text, '')), {S.q(tf.TOKEN_PATTERN)}), lambda x: NOT list_contains({stop}, x))"
    return TEXTS_CTE + f""", tk AS (SELECT day, doc_id, {tok} AS tok FROM texts),
tk2 AS (SELECT *, len(tok) AS n, tok[1] AS ft, tok[-1] AS lt, doc_id = min(doc_id) OVER (PARTITION BY day) AS isf FROM tk),
tk3 AS (SELECT *, lag(n) OVER w AS pn, lag(lt) OVER w AS pt, lag(isf) OVER w AS pisf FROM tk2 WINDOW w AS (PARTITION BY day ORDER BY doc_id)),
terms AS (
  SELECT day, unnest(tok) AS term FROM tk3
  UNION ALL SELECT day, 'sep' FROM tk3 WHERE NOT isf
  UNION ALL SELECT day, unnest(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) FROM tk3
  UNION ALL SELECT day, (CASE WHEN pn > 0 THEN pt ELSE 'sep' END) || ' sep' FROM tk3 WHERE NOT isf AND (pn > 0 OR NOT pisf)
  UNION ALL SELECT day, 'sep ' || ft FROM tk3 WHERE NOT isf AND n > 0),
cnt AS (SELECT day, term, count(*) AS n FROM terms GROUP BY 1, 2),
nd AS (SELECT count(DISTINCT day) AS nd FROM texts),
st AS (SELECT term, count(*) AS df, sum(n) AS total FROM cnt GROUP BY term),
vocab AS (SELECT term, df, CAST(total AS BIGINT) AS total, ln((1 + nd) / (1 + df)) + 1 AS idf FROM st, nd
   WHERE df >= 2 AND df <= 0.95 * nd ORDER BY total DESC, term LIMIT 1000),
wt AS (SELECT c.day, c.term, c.n * v.idf AS w FROM cnt c JOIN vocab v ON v.term = c.term),
nrm AS (SELECT day, sqrt(sum(w * w)) AS nr FROM wt GROUP BY day)
"""


SQL_TFIDF_TERMS = _tfidf_sql() + "SELECT term, df, total, round(idf, 6) AS idf FROM vocab"
SQL_TFIDF_WEIGHTS = _tfidf_sql() + "SELECT wt.day, wt.term, round(wt.w / nrm.nr, 6) AS weight FROM wt JOIN nrm ON nrm.day = wt.day"


def svd_features(spark, d, k: int = 10):
    """T3 on the TF-IDF weights (checked by properties: orthogonal columns, descending norms)."""
    w, _v = _tfidf(spark, d)
    return tf.truncated_svd(w, "day", "term", "weight", k)


# ----------------------------------------------------------------------------------------------- T1
def lexicon_sentiment(spark, d):
    s = tf.sentiment_scores(texts(spark, d), "day")
    return s.select("day", r6("sentiment_compound").alias("sentiment_compound"))


def _sentiment_sql() -> str:
    lex = ", ".join(f"({S.q(k)}, {float(v)})" for k, v in sorted(lx.SENTIMENT_LEXICON.items()))
    neg, up, down = _list(lx.NEGATIONS), _list(lx.BOOSTERS_UP), _list(lx.BOOSTERS_DOWN)
    return TEXTS_CTE + f""", lex AS (SELECT * FROM (VALUES {lex}) v(w, val)),
sx AS (SELECT day, doc_id, regexp_extract_all(lower(coalesce(text, '')), {S.q(tf.SENT_TOKEN_PATTERN)}) AS t FROM texts),
tr AS (SELECT day, doc_id, t, unnest(t) AS tok, unnest(range(0, len(t))) AS i FROM sx),
v0 AS (SELECT tr.*, coalesce(lex.val, 0.0) AS v, CASE WHEN i >= 1 THEN t[i] END AS p1,
   CASE WHEN i >= 1 THEN list_has_any(t[greatest(i - 2, 1):i], {neg}) ELSE false END AS negd
   FROM tr LEFT JOIN lex ON lex.w = tr.tok),
v1 AS (SELECT day, v + CASE WHEN v <> 0 AND list_contains({up}, coalesce(p1, '')) THEN sign(v) * {lx.BOOST}
                         WHEN v <> 0 AND list_contains({down}, coalesce(p1, '')) THEN -sign(v) * {lx.BOOST} ELSE 0.0 END AS v, negd FROM v0),
v2 AS (SELECT day, sum(CASE WHEN negd THEN v * {lx.NEGATION_SCALAR} ELSE v END) AS s FROM v1 GROUP BY day),
days AS (SELECT DISTINCT day FROM texts)
SELECT days.day, round(coalesce(s, 0.0) / sqrt(coalesce(s, 0.0) * coalesce(s, 0.0) + {lx.ALPHA}), 6) AS sentiment_compound
FROM days LEFT JOIN v2 ON v2.day = days.day"""


SQL_SENTIMENT = _sentiment_sql()


# ----------------------------------------------------------------------------------------------- T4, T5
def _embeddings(spark, d):
    return tf.hash_embeddings(tf.day_tokens(texts(spark, d), "day", ["doc_id"]), "day", dim=DIM)


def hash_embeddings(spark, d):
    e = _embeddings(spark, d)
    return e.select("day", F.transform("embedding", lambda x: F.round(x, 6)).alias("embedding"))


def embed_features(spark, d, n: int = 8):
    """T5: the first ``n`` components as columns."""
    e = _embeddings(spark, d)
    return e.select("day", *[r6(F.col("embedding")[i]).alias(f"embed_{i}") for i in range(n)])


def _embed_sql() -> str:
    tok = f"regexp_extract_all(lower(coalesce(text, '')), {S.q(tf.TOKEN_PATTERN)})"
    h = "list_reduce(list_prepend(0, list_transform(string_split(tok, ''), lambda c: unicode(c))), lambda a, x: (a * 31 + x) % 1000003)"
    return TEXTS_CTE + f""", tt AS (SELECT day, list_concat({tok}, CASE WHEN doc_id = min(doc_id) OVER (PARTITION BY day) THEN [] ELSE ['sep'] END) AS toks FROM texts),
tk AS (SELECT day, unnest(toks) AS tok FROM tt),
hh AS (SELECT day, {h} AS h FROM tk),
sm AS (SELECT day, CAST(h % {DIM} AS INTEGER) AS d, sum(CASE WHEN floor(h / {DIM}) % 2 = 0 THEN 1.0 ELSE -1.0 END) AS v FROM hh GROUP BY 1, 2),
nm AS (SELECT day, sqrt(sum(v * v)) AS n FROM sm GROUP BY day),
vv AS (SELECT sm.day, sm.d, CASE WHEN nm.n > 0 THEN sm.v / nm.n ELSE 0.0 END AS v FROM sm JOIN nm ON nm.day = sm.day),
grid AS (SELECT day, CAST(r.range AS INTEGER) AS d FROM (SELECT DISTINCT day FROM sm) x, range({DIM}) r),
dense AS (SELECT g.day, g.d, coalesce(vv.v, 0.0) AS v FROM grid g LEFT JOIN vv ON vv.day = g.day AND vv.d = g.d)
"""


SQL_HASH_EMB = _embed_sql() + "SELECT day, list(round(v, 6) ORDER BY d) AS embedding FROM dense GROUP BY day"
SQL_EMBED_FEATURES = _embed_sql() + "SELECT day, " + ", ".join(
    f"round(max(v) FILTER (WHERE d = {i}), 6) AS embed_{i}" for i in range(8)) + " FROM dense GROUP BY day"


# ----------------------------------------------------------------------------------------------- T6 + W10
def community_labels(spark, d):
    """T6 per source, with W10: a repeated label gets `` (1)``, `` (2)``... in order of size (then id)."""
    t = texts(spark, d)
    lab = tf.community_labels(t, "source")
    sizes = t.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"))
    w = Window.partitionBy("label").orderBy(F.col("n_docs").desc(), F.col("source").asc())
    rn = F.row_number().over(w) - 1
    return lab.join(sizes, "source").select(
        "source", "n_docs", "label",
        F.when(rn == 0, F.col("label")).otherwise(F.concat("label", F.lit(" ("), rn.cast("string"), F.lit(")"))).alias("label_unique"))


def _labels_sql() -> str:
    stop = _list(lx.LABEL_STOP_WORDS)
    runs = f"regexp_extract_all(lower(coalesce(text, '')), {S.q(tf.LABEL_RUN_PATTERN)})"
    return TEXTS_CTE + f""", lt AS (SELECT source, unnest(list_filter({runs}, lambda x: regexp_matches(x, {S.q(tf.LABEL_TOKEN)}) AND NOT list_contains({stop}, x))) AS term FROM texts),
lc AS (SELECT source, term, count(*) AS n FROM lt GROUP BY 1, 2),
best AS (SELECT source, term AS label FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS r FROM lc) WHERE r = 1),
sz AS (SELECT source, count(*) AS n_docs FROM texts GROUP BY source),
lab AS (SELECT sz.source, sz.n_docs, coalesce(best.label, 'Comm ' || sz.source) AS label FROM sz LEFT JOIN best ON best.source = sz.source)
"""


SQL_LABELS = _labels_sql() + """SELECT source, n_docs, label,
 CASE WHEN r = 0 THEN label ELSE label || ' (' || CAST(r AS VARCHAR) || ')' END AS label_unique
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n_docs DESC, source) - 1 AS r FROM lab)"""

REGISTRY = {
    "daily_text": (daily_text, SQL_DAILY_TEXT),
    "daily_text_stats": (daily_text_stats, SQL_DAILY_TEXT_STATS),
    "tfidf_top_terms": (tfidf_top_terms, SQL_TFIDF_TERMS),
    "tfidf_weights": (tfidf_weights, SQL_TFIDF_WEIGHTS),
    "svd_features": (svd_features, None),
    "lexicon_sentiment": (lexicon_sentiment, SQL_SENTIMENT),
    "hash_embeddings": (hash_embeddings, SQL_HASH_EMB),
    "embed_features": (embed_features, SQL_EMBED_FEATURES),
    "community_labels": (community_labels, SQL_LABELS),
}
