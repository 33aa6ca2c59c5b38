"""Cleaning jobs Q1-Q6 over the ``posts`` fixture, and the price cleaner Q5."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import numeric as nf
from ..functions import text as tx
from ..operators import cleaning as cl
from ..session import checkpoint_dir, cut_lineage
from ..sources import csv as csv_source
from ..sources import sinks
from . import sqlfrag as S
from .common import COUNT_COLS, fixture, fixture_cte, r6

# What every stage carries along besides text and time: whole-row keys and outputs hold it.
CARRIED = ["quote", *COUNT_COLS]
CNT = ", ".join(CARRIED)


def routed(spark, d):
    return cl.route(fixture(spark, d, "posts").select("row_id", *cl.RAW_COLUMNS))


def route_posts(spark, d):
    return routed(spark, d).select("row_id", "kind", "text", "timestamp", "text_length", *CARRIED)


def route_summary(spark, d, routed_df=None):
    c = cl.class_counts(routed_df if routed_df is not None else routed(spark, d))
    return c.select("kind", "n", "total", r6(nf.safe_pct("n", "total")).alias("share_pct"))


def route_preview(spark, d, n: int = 3, seed: int = 0):
    """A seeded sample of ``n`` rows per class, newline-free and cut to 80 characters."""
    from pyspark.sql import Window
    r = routed(spark, d)
    w = Window.partitionBy("kind").orderBy(F.md5(F.concat(F.col("row_id").cast("string"), F.lit(f":{seed}"))), "row_id")
    return (r.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
             .select("kind", "row_id", F.to_date("timestamp").alias("date"), tx.preview("text", 80).alias("preview")))


def retweet_preview(spark, d, n: int = 3):
    """The first ``n`` cleaned retweets, each cut to 100 characters."""
    t = cl.cleaned(routed(spark, d), "retweet")
    return t.orderBy("row_id").limit(n).select("row_id", "originalAuthor", F.substring("tweet", 1, 100).alias("preview"))


def input_overview(spark, d):
    """Per routed class, rows, first and last timestamp and texts missing after the stage re-read."""
    r = routed(spark, d)
    return r.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.min("timestamp").alias("first_ts"),
                                 F.max("timestamp").alias("last_ts"),
                                 F.count(F.when(tx.null_tokens("text").isNull(), 1)).alias("missing_text"))


def clean_originals(spark, d):
    return cl.cleaned(routed(spark, d), "original").select("row_id", "text", "timestamp", *CARRIED, "text_length")


def clean_replies(spark, d):
    return cl.cleaned(routed(spark, d), "reply").select("row_id", "text", "timestamp", *CARRIED, "text_length")


def clean_retweets(spark, d):
    return cl.cleaned(routed(spark, d), "retweet").select(
        "row_id", "timestamp", *CARRIED, "text_length", "originalAuthor", "tweet", "authorRetweetCount",
        "originalTextLength")


def cleaning_waterfall(spark, d, routed_df=None):
    # three cleaning jobs branch off the routed posts: materialise them once in the checkpoint folder
    r = routed_df if routed_df is not None else cut_lineage(routed(spark, d))
    return cl.waterfall({k: cl.TAGGERS[k](r) for k in cl.KINDS})


def cleaning_report(spark, d):
    """A24 + P14: split shares and per-class retention with a quality bucket."""
    r = cut_lineage(routed(spark, d))
    c = route_summary(spark, d, r)
    split = c.select(F.concat(F.lit("split:"), "kind").alias("step"), F.col("total").alias("initial_count"),
                     F.col("n").alias("final_count"))
    total = c.agg(F.max("total").alias("t")).select(
        F.lit("split").alias("step"), F.coalesce("t", F.lit(0)).alias("initial_count"),
        F.coalesce("t", F.lit(0)).alias("final_count"))
    wf = cleaning_waterfall(spark, d, r)
    cleanrows = wf.groupBy("kind").agg(F.max("rows_in").alias("initial_count"), F.min("rows_out").alias("final_count")) \
        .select(F.concat(F.lit("clean:"), "kind").alias("step"), "initial_count", "final_count")
    rep = total.unionByName(split).unionByName(cleanrows)
    ret = nf.safe_pct("final_count", "initial_count")
    return rep.select("step", F.col("initial_count").cast("bigint"), F.col("final_count").cast("bigint"),
                      r6(ret).alias("retention_pct"), nf.quality_bucket(F.bround(ret, 1)).alias("quality"))


def clean_prices(spark, d):
    """Q5: drop the misplaced row at position 1, strict drop of 'Adj Close', parse date and numbers."""
    raw = fixture(spark, d, "raw_prices")
    cl.require_columns(raw, ["Adj Close"])
    p = raw.where(F.col("pos") != 1).drop("Adj Close")
    num = {c: F.col(c).try_cast("double") for c in ["Open", "High", "Low", "Close"]}
    return p.select(F.col("Date").try_cast("date").alias("Date"), *[num[c].alias(c) for c in num],
                    F.col("Volume").try_cast("double").cast("bigint").alias("Volume"))


def _scratch(spark) -> str:
    return checkpoint_dir(spark).rstrip("/") + f"/quill_tables/{uuid.uuid4().hex}"


def ordered_posts(spark, d):
    """The routed posts written in one order of time over all files, read back with their places in it."""
    path = _scratch(spark)
    sinks.write_ordered(routed(spark, d).select("row_id", "kind", "timestamp"), path, ["timestamp", "row_id"])
    return sinks.read_ordered(spark, path).select("row_id", "kind", "timestamp", "position")


def routed_files(spark, d):
    """S6 with S1 and S2: the routed posts written as CSV, one folder a class in one pass, and each class's stage read back
    with types and null tokens, whole texts with quotes and line ends included: what has come back of it."""
    path = _scratch(spark)
    out = routed(spark, d).select(F.col("row_id").alias("post_id"), "kind", "text", *CARRIED)
    sinks.write_table(out, path, "csv", partition_by=["kind"], compression="gzip")     # whole texts: a third of their size
    back = None
    for kind in cl.KINDS:
        part = csv_source.read_stage_csv(spark, f"{path}/kind={kind}").withColumn("kind", F.lit(kind))
        back = part if back is None else back.unionByName(part)
    return back.groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).cast("bigint").alias("n_chars"),
        F.count(F.when(F.col("text").isNull(), 1)).alias("missing_text"), F.sum(F.col("post_id").cast("bigint")).cast("bigint").alias("id_sum"),
        F.sum("likeCount").cast("bigint").alias("like_sum"), F.count("quote").alias("quoted"))


# ---------------------------------------------------------------------------------------------- oracle
def _routed_sql() -> str:
    rt, rp = S.rlike("text", tx.RT_PATTERN), S.rlike("text", tx.REPLY_PATTERN)
    return f"""routed AS (
 SELECT row_id, text, TRY_CAST(createdAt AS TIMESTAMP) AS timestamp,
   CAST(coalesce(length(text), 0) AS INTEGER) AS text_length, {CNT},
   CASE WHEN coalesce(isRetweet = 'True', false) OR {rt} THEN 'retweet'
        WHEN coalesce(isReply = 'True', false) OR {rp} THEN 'reply' ELSE 'original' END AS kind
 FROM (SELECT row_id, fullText AS text, createdAt, isRetweet, isReply, {CNT} FROM posts))"""


KEYS_ORIG = f"text, timestamp, {CNT}, text_length"


def _orig_sql() -> str:
    return f"""o0 AS (SELECT row_id, {S.null_tokens('text')} AS text, timestamp, {CNT}, text_length
   FROM routed WHERE kind = 'original'),
o1 AS (SELECT row_id, {S.clean('text')} AS text, timestamp, {CNT}, text_length,
   CASE WHEN text IS NULL THEN 'missing_text' WHEN NOT {S.has_alnum(S.clean('text'))} THEN 'non_alnum' END AS rb FROM o0),
otag AS (SELECT row_id, text, timestamp, {CNT}, text_length,
   CASE WHEN rb IS NULL AND row_id <> min(row_id) OVER (PARTITION BY rb IS NULL, {KEYS_ORIG}) THEN 'duplicate'
        ELSE rb END AS removed_by FROM o1)"""


def _reply_sql() -> str:
    fills = "quote, " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in COUNT_COLS)
    return f"""r0 AS (SELECT row_id, {S.null_tokens('text')} AS text, timestamp, {fills}, text_length
   FROM routed WHERE kind = 'reply'),
rtag AS (SELECT *, CASE WHEN row_id <> min(row_id) OVER (PARTITION BY {KEYS_ORIG}) THEN 'duplicate'
   WHEN text IS NULL THEN 'missing_text' WHEN {S.strip('text')} = '' THEN 'blank_text'
   WHEN NOT {S.has_alnum('text')} THEN 'non_alnum' END AS removed_by FROM r0)"""


def _retweet_sql() -> str:
    st = S.strip("text")
    return f"""t0 AS (SELECT row_id, {S.null_tokens('text')} AS text, timestamp, {CNT}, text_length
   FROM routed WHERE kind = 'retweet'),
t1 AS (SELECT *, CASE WHEN a <> '' THEN a END AS originalAuthor, CASE WHEN a <> '' THEN {S.strip('c')} END AS tweet_raw
   FROM (SELECT *, {S.extract(st, tx.RT_EXTRACT, 1)} AS a, {S.extract(st, tx.RT_EXTRACT, 2)} AS c FROM t0)),
t2 AS (SELECT *, CASE WHEN text IS NULL THEN 'missing_text'
   WHEN originalAuthor IS NULL OR tweet_raw IS NULL THEN 'unparseable' END AS rb1 FROM t1),
t3 AS (SELECT *, CASE WHEN rb1 IS NULL AND row_id <> min(row_id) OVER (PARTITION BY rb1 IS NULL, tweet_raw)
   THEN 'duplicate' ELSE rb1 END AS rb2, {S.clean('tweet_raw', final_strip=False)} AS tweet FROM t2),
t4 AS (SELECT *, CASE WHEN rb2 IS NULL AND NOT {S.has_alnum('tweet')} THEN 'non_alnum' ELSE rb2 END AS rb3 FROM t3),
t5 AS (SELECT *, CASE WHEN rb3 IS NULL THEN count(*) OVER (PARTITION BY rb3 IS NULL, originalAuthor) END
   AS authorRetweetCount, CAST(length(tweet) AS INTEGER) AS originalTextLength FROM t4),
ttag AS (SELECT row_id, timestamp, {CNT}, text_length, originalAuthor, tweet, authorRetweetCount, originalTextLength,
   CASE WHEN rb3 IS NULL AND originalTextLength < 5 THEN 'too_short' ELSE rb3 END AS removed_by FROM t5)"""


def _with(*parts: str) -> str:
    return fixture_cte("posts") + ",\n" + ",\n".join(parts) + "\n"


SQL_ROUTE_POSTS = _with(_routed_sql()) + f"SELECT row_id, kind, text, timestamp, text_length, {CNT} FROM routed"

_SUMMARY = """kinds AS (SELECT * FROM (VALUES ('original'), ('reply'), ('retweet')) v(kind)),
cnt AS (SELECT kind, count(*) AS n FROM routed GROUP BY kind),
summary AS (SELECT k.kind, coalesce(c.n, 0) AS n, CAST(coalesce((SELECT sum(n) FROM cnt), 0) AS BIGINT) AS total
  FROM kinds k LEFT JOIN cnt c ON c.kind = k.kind)"""

SQL_ROUTE_SUMMARY = _with(_routed_sql(), _SUMMARY) + """SELECT kind, n, total,
 CASE WHEN total = 0 THEN NULL ELSE round(n / total * 100.0, 6) END AS share_pct FROM summary"""

SQL_CLEAN_ORIGINALS = _with(_routed_sql(), _orig_sql()) + \
    f"SELECT row_id, text, timestamp, {CNT}, text_length FROM otag WHERE removed_by IS NULL"
SQL_CLEAN_REPLIES = _with(_routed_sql(), _reply_sql()) + \
    f"SELECT row_id, text, timestamp, {CNT}, text_length FROM rtag WHERE removed_by IS NULL"
SQL_CLEAN_RETWEETS = _with(_routed_sql(), _retweet_sql()) + \
    f"""SELECT row_id, timestamp, {CNT}, text_length, originalAuthor, tweet, authorRetweetCount, originalTextLength
FROM ttag WHERE removed_by IS NULL"""


def _wf_sql() -> str:
    steps = ", ".join(f"('{k}', {i + 1}, '{s}')" for k in cl.KINDS for i, s in enumerate(cl.STEPS[k]))
    return f"""steps AS (SELECT * FROM (VALUES {steps}) v(kind, step_no, step)),
tags AS (SELECT 'original' AS kind, removed_by FROM otag UNION ALL SELECT 'reply', removed_by FROM rtag
         UNION ALL SELECT 'retweet', removed_by FROM ttag),
tot AS (SELECT k.kind, count(t.kind) AS total FROM (SELECT DISTINCT kind FROM steps) k LEFT JOIN tags t ON t.kind = k.kind GROUP BY k.kind),
rem AS (SELECT kind, removed_by AS step, count(*) AS n FROM tags WHERE removed_by IS NOT NULL GROUP BY 1, 2),
wf0 AS (SELECT s.kind, CAST(s.step_no AS INTEGER) AS step_no, s.step, coalesce(r.n, 0) AS removed, t.total
  FROM steps s LEFT JOIN rem r ON r.kind = s.kind AND r.step = s.step JOIN tot t ON t.kind = s.kind),
wf AS (SELECT kind, step_no, step,
  CAST(total - sum(removed) OVER (PARTITION BY kind ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + removed AS BIGINT) AS rows_in,
  CAST(removed AS BIGINT) AS removed,
  CAST(total - sum(removed) OVER (PARTITION BY kind ORDER BY step_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS rows_out
  FROM wf0)"""


SQL_CLEANING_WATERFALL = _with(_routed_sql(), _orig_sql(), _reply_sql(), _retweet_sql(), _wf_sql()) + \
    "SELECT kind, step_no, step, rows_in, removed, rows_out FROM wf"

SQL_CLEANING_REPORT = _with(_routed_sql(), _orig_sql(), _reply_sql(), _retweet_sql(), _wf_sql(), _SUMMARY) + """,
rep AS (
 SELECT 'split' AS step, max(total) AS initial_count, max(total) AS final_count FROM summary
 UNION ALL SELECT 'split:' || kind, total, n FROM summary
 UNION ALL SELECT 'clean:' || kind, max(rows_in), min(rows_out) FROM wf GROUP BY kind)
SELECT step, CAST(initial_count AS BIGINT) AS initial_count, CAST(final_count AS BIGINT) AS final_count,
 CASE WHEN initial_count = 0 THEN NULL ELSE round(final_count / initial_count * 100.0, 6) END AS retention_pct,
 CASE WHEN round_even(final_count / initial_count * 100.0, 1) >= 95 THEN 'good'
      WHEN round_even(final_count / initial_count * 100.0, 1) >= 80 THEN 'fair' ELSE 'poor' END AS quality
FROM rep"""

SQL_CLEAN_PRICES = fixture_cte("raw_prices") + """SELECT TRY_CAST(Date AS DATE) AS Date,
 TRY_CAST(Open AS DOUBLE) AS Open, TRY_CAST(High AS DOUBLE) AS High, TRY_CAST(Low AS DOUBLE) AS Low,
 TRY_CAST(Close AS DOUBLE) AS Close, CAST(TRY_CAST(Volume AS DOUBLE) AS BIGINT) AS Volume
FROM raw_prices WHERE pos <> 1"""

SQL_INPUT_OVERVIEW = _with(_routed_sql()) + f"""SELECT kind, count(*) AS n_rows, min(timestamp) AS first_ts,
 max(timestamp) AS last_ts, count(*) FILTER (WHERE ({S.null_tokens('text')}) IS NULL) AS missing_text FROM routed GROUP BY kind"""

SQL_ROUTE_PREVIEW = _with(_routed_sql()) + """SELECT kind, row_id, CAST(timestamp AS DATE) AS date,
 substr(replace(text, chr(10), ' '), 1, 80) AS preview
FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY md5(CAST(row_id AS VARCHAR) || ':0'), row_id) AS rn FROM routed) WHERE rn <= 3"""
SQL_RETWEET_PREVIEW = _with(_routed_sql(), _retweet_sql()) + """SELECT row_id, originalAuthor, substr(tweet, 1, 100) AS preview
FROM ttag WHERE removed_by IS NULL ORDER BY row_id LIMIT 3"""

SQL_ORDERED_POSTS = _with(_routed_sql()) + """SELECT row_id, kind, timestamp,
 row_number() OVER (ORDER BY timestamp NULLS FIRST, row_id) AS position FROM routed"""
SQL_ROUTED_FILES = _with(_routed_sql()) + f"""SELECT kind, count(*) AS n_rows, CAST(sum(length(t)) AS BIGINT) AS n_chars,
 count(*) FILTER (WHERE t IS NULL) AS missing_text, CAST(sum(row_id) AS BIGINT) AS id_sum, CAST(sum(likeCount) AS BIGINT) AS like_sum,
 count(quote) AS quoted FROM (SELECT *, {S.null_tokens('text')} AS t FROM routed) GROUP BY kind"""

REGISTRY = {
    "ordered_posts": (ordered_posts, SQL_ORDERED_POSTS),
    "routed_files": (routed_files, SQL_ROUTED_FILES),
    "route_posts": (route_posts, SQL_ROUTE_POSTS),
    "input_overview": (input_overview, SQL_INPUT_OVERVIEW),
    "route_summary": (route_summary, SQL_ROUTE_SUMMARY),
    "route_preview": (route_preview, SQL_ROUTE_PREVIEW),
    "retweet_preview": (retweet_preview, SQL_RETWEET_PREVIEW),
    "clean_originals": (clean_originals, SQL_CLEAN_ORIGINALS),
    "clean_replies": (clean_replies, SQL_CLEAN_REPLIES),
    "clean_retweets": (clean_retweets, SQL_CLEAN_RETWEETS),
    "cleaning_waterfall": (cleaning_waterfall, SQL_CLEANING_WATERFALL),
    "cleaning_report": (cleaning_report, SQL_CLEANING_REPORT),
    "clean_prices": (clean_prices, SQL_CLEAN_PRICES),
}
