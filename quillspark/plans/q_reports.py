"""Reporting queries Q10-Q16 and the series windows over the price table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import numeric as nf
from ..functions import stats as st
from ..operators import aggregates as ag
from ..operators import series
from . import q_cleaning as qc
from .common import COUNT_COLS, fixture, fixture_cte, r6
from .q_series import daily_engagement

HOUR_SPEC = {c: ["mean", "median", "sum", "count"] for c in ["likeCount", "retweetCount", "replyCount", "viewCount"]}
DAY_SPEC = {"likeCount": ["mean", "median", "sum", "count"], "retweetCount": ["mean", "sum"],
            "replyCount": ["mean", "sum"]}
# fixed values: weekday order of the report, and the engagement types with their column names
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
TYPES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
TYPE_COLS = ["t1_urgent", "t2_high", "t3_medium", "t4_not_specified", "t5_low"]
MA_THRESHOLD = 40000.0
SIG_THRESHOLD = 0.2


def _orig_cte() -> str:
    return qc._with(qc._routed_sql(), qc._orig_sql()) + """, corig AS (SELECT * FROM otag WHERE removed_by IS NULL)
"""


def _sql_profile(key_expr: str, key: str, spec: dict) -> str:
    parts = []
    for col, aggs in spec.items():
        for a in aggs:
            e = {"mean": f"round_even(avg({col}), 2)", "median": f"round_even(median(CAST({col} AS DOUBLE)), 2)",
                 "sum": f"CAST(coalesce(sum({col}), 0) AS BIGINT)", "count": f"count({col})"}[a]
            parts.append(f"{e} AS {col}_{a}")
    return f"SELECT {key_expr} AS {key}, " + ", ".join(parts) + f" FROM corig GROUP BY {key_expr}"


# ------------------------------------------------------------------------------------------- Q10
def _likes_merged(spark, d):
    daily = daily_engagement(fixture(spark, d, "engagement")).select(F.col("date").alias("Date"), "likeCount")
    stock = fixture(spark, d, "stock").select("Date", "Close")
    m = stock.join(daily, "Date", "left").withColumn("likeCount", F.coalesce("likeCount", F.lit(0)).cast("bigint"))
    return m.withColumn("likeCount_MA7", series.trailing_mean("likeCount", 7, "Date"))


def likes_ma7_vs_close(spark, d, threshold: float = MA_THRESHOLD):
    """J2 + W1 + F6: prices with daily likes (0 when none), 7-row mean, cut to [first date whose mean
    exceeds the threshold, last posting date]; the two bounds are one-row aggregates."""
    m = _likes_merged(spark, d)
    start = m.where(F.col("likeCount_MA7") > threshold).agg(F.min("Date").alias("_start"))
    last = fixture(spark, d, "engagement").agg(F.max("date").alias("_last"))
    return (m.crossJoin(F.broadcast(start)).crossJoin(F.broadcast(last))
             .where((F.col("Date") >= F.col("_start")) & (F.col("Date") <= F.col("_last")))
             .select("Date", "Close", "likeCount", r6("likeCount_MA7").alias("likeCount_MA7")))


_LIKES_SQL = fixture_cte("engagement", "stock") + """,
dl AS (SELECT date, CAST(sum(coalesce(likeCount, 0)) AS BIGINT) AS likeCount FROM engagement WHERE date IS NOT NULL GROUP BY date),
m AS (SELECT s.Date, s.Close, CAST(coalesce(dl.likeCount, 0) AS BIGINT) AS likeCount FROM stock s LEFT JOIN dl ON dl.date = s.Date),
mm AS (SELECT *, avg(likeCount) OVER (ORDER BY Date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS likeCount_MA7,
        Close - lag(Close) OVER (ORDER BY Date) AS price_change FROM m)
"""

SQL_LIKES_MA7 = _LIKES_SQL + f"""SELECT Date, Close, likeCount, round(likeCount_MA7, 6) AS likeCount_MA7 FROM mm
WHERE Date >= (SELECT min(Date) FROM mm WHERE likeCount_MA7 > {MA_THRESHOLD})
  AND Date <= (SELECT max(date) FROM engagement)"""


def likes_price_corr(spark, d):
    """W3 + A14: correlation of daily likes with the day-over-day price change (pairwise non-null)."""
    m = _likes_merged(spark, d).withColumn("price_change", series.diff("Close", "Date"))
    ok = F.col("price_change").isNotNull()
    return m.agg(r6(F.corr(F.when(ok, F.col("likeCount").cast("double")), "price_change")).alias("correlation"),
                 F.count(F.when(ok, F.lit(1))).alias("n"))


SQL_LIKES_CORR = _LIKES_SQL + """SELECT round(corr(CASE WHEN price_change IS NOT NULL THEN CAST(likeCount AS DOUBLE) END, price_change), 6) AS correlation,
 count(price_change) AS n FROM mm"""


# ------------------------------------------------------------------------------------------- Q11, Q12
def hour_profile(spark, d):
    """A5 + P18 + P19 + P12 over cleaned originals."""
    t = qc.clean_originals(spark, d).withColumn("hour", F.hour("timestamp")).where(F.col("hour").isNotNull())
    p = ag.profile(t, "hour", HOUR_SPEC)
    eng = F.col("likeCount_sum") + F.col("retweetCount_sum") + F.col("replyCount_sum")
    return p.withColumns({"total_engagement": eng, "total_with_views": eng + F.col("viewCount_sum")}) \
            .withColumn("total_engagement_short", nf.human_format("total_engagement"))


SQL_HOUR_PROFILE = _orig_cte() + "SELECT *, total_engagement + viewCount_sum AS total_with_views, " + \
    """CASE WHEN abs(total_engagement) >= 1e9 THEN printf('%.1fB', round_even(total_engagement / 1e9, 1))
 WHEN abs(total_engagement) >= 1e6 THEN printf('%.1fM', round_even(total_engagement / 1e6, 1))
 WHEN abs(total_engagement) >= 1e3 THEN printf('%.1fK', round_even(total_engagement / 1e3, 1))
 ELSE printf('%.0f', round_even(CAST(total_engagement AS DOUBLE), 0)) END AS total_engagement_short
FROM (SELECT *, likeCount_sum + retweetCount_sum + replyCount_sum AS total_engagement FROM (""" + \
    _sql_profile("CAST(hour(timestamp) AS INTEGER)", "hour", HOUR_SPEC).replace("GROUP BY", "WHERE timestamp IS NOT NULL GROUP BY") + "))"


def weekday_profile(spark, d):
    t = qc.clean_originals(spark, d).withColumn("day", F.date_format("timestamp", "EEEE")).where(F.col("day").isNotNull())
    p = ag.profile(t, "day", DAY_SPEC)
    return p.withColumn("total_engagement", F.col("likeCount_sum") + F.col("retweetCount_sum") + F.col("replyCount_sum"))


SQL_WEEKDAY_PROFILE = _orig_cte() + "SELECT *, likeCount_sum + retweetCount_sum + replyCount_sum AS total_engagement FROM (" + \
    _sql_profile("dayname(timestamp)", "day", DAY_SPEC).replace("GROUP BY", "WHERE timestamp IS NOT NULL GROUP BY") + ")"


def peak_hour(spark, d):
    """Arg-max of the mean and of the volume; first key on ties (hours ascending, day names
    alphabetically, as the grouped index is ordered)."""
    h = hour_profile(spark, d).select(F.lpad(F.col("hour").cast("string"), 2, "0").alias("k"), "likeCount_mean", "likeCount_count")
    w = weekday_profile(spark, d).select(F.col("day").alias("k"), "likeCount_mean", "likeCount_count")

    # keys are resolved with an explicit order so ties go to the smallest key
    def first_key(p, dim, val):
        win = Window.orderBy(F.col(val).desc(), F.col("k").asc())
        return p.withColumn("_r", F.row_number().over(win)).where("_r = 1").select(F.lit(dim).alias("dimension"), F.col("k").alias(f"{val}_key"), F.col(val))
    out = []
    for p, dim in ((h, "hour"), (w, "weekday")):
        a = first_key(p, dim, "likeCount_mean").withColumnRenamed("likeCount_mean", "peak_mean").withColumnRenamed("likeCount_mean_key", "peak_mean_key")
        b = first_key(p, dim, "likeCount_count").withColumnRenamed("likeCount_count", "peak_volume").withColumnRenamed("likeCount_count_key", "peak_volume_key")
        out.append(a.join(b, "dimension"))
    return out[0].unionByName(out[1])


SQL_PEAK = _orig_cte() + """, hp AS (SELECT lpad(CAST(hour(timestamp) AS VARCHAR), 2, '0') AS k, round_even(avg(likeCount), 2) AS m, count(likeCount) AS c
   FROM corig WHERE timestamp IS NOT NULL GROUP BY 1),
wp AS (SELECT dayname(timestamp) AS k, round_even(avg(likeCount), 2) AS m, count(likeCount) AS c
   FROM corig WHERE timestamp IS NOT NULL GROUP BY 1),
pk AS (
 SELECT 'hour' AS dimension, (SELECT k FROM hp ORDER BY m DESC NULLS LAST, k LIMIT 1) AS peak_mean_key, (SELECT max(m) FROM hp) AS peak_mean,
        (SELECT k FROM hp ORDER BY c DESC, k LIMIT 1) AS peak_volume_key, (SELECT max(c) FROM hp) AS peak_volume
 UNION ALL
 SELECT 'weekday', (SELECT k FROM wp ORDER BY m DESC NULLS LAST, k LIMIT 1), (SELECT max(m) FROM wp),
        (SELECT k FROM wp ORDER BY c DESC, k LIMIT 1), (SELECT max(c) FROM wp))
SELECT * FROM pk"""


# ------------------------------------------------------------------------------------------- Q13
def top_authors(spark, d, k: int = 20):
    """A8 + P15: most frequent retweeted authors, share of all cleaned retweets (ties: author name)."""
    r = qc.clean_retweets(spark, d)
    counts = r.groupBy("originalAuthor").agg(F.count(F.lit(1)).alias("n"))
    total = r.agg(F.count(F.lit(1)).alias("total"))
    top = ag.top_k(counts, [F.col("n").desc(), F.col("originalAuthor").asc()], k)
    w = Window.orderBy(F.col("n").desc(), F.col("originalAuthor").asc())
    return (top.crossJoin(F.broadcast(total))
               .select(F.row_number().over(w).cast("bigint").alias("rank"), "originalAuthor", "n",
                       r6(nf.safe_pct("n", "total")).alias("share_pct")))


def _rt_cte() -> str:
    return qc._with(qc._routed_sql(), qc._retweet_sql()) + ", crt AS (SELECT * FROM ttag WHERE removed_by IS NULL)\n"


SQL_TOP_AUTHORS = _rt_cte() + """, ac AS (SELECT originalAuthor, count(*) AS n FROM crt GROUP BY 1)
SELECT row_number() OVER (ORDER BY n DESC, originalAuthor) AS rank, originalAuthor, n,
  round(n / (SELECT count(*) FROM crt) * 100.0, 6) AS share_pct
FROM ac ORDER BY n DESC, originalAuthor LIMIT 20"""


def author_summary(spark, d):
    """Distinct authors, rows, average per author, most frequent author."""
    r = qc.clean_retweets(spark, d)
    counts = r.groupBy("originalAuthor").agg(F.count(F.lit(1)).alias("n"))
    first = ag.top_k(counts, [F.col("n").desc(), F.col("originalAuthor").asc()], 1) \
        .select(F.col("originalAuthor").alias("top_author"), F.col("n").alias("top_count"))
    s = counts.agg(F.count(F.lit(1)).alias("n_authors"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_retweets"))
    return s.crossJoin(first).select("n_authors", "n_retweets",
                                     r6(F.when(F.col("n_authors") > 0, F.col("n_retweets") / F.col("n_authors"))).alias("avg_per_author"),
                                     "top_author", "top_count")


SQL_AUTHOR_SUMMARY = _rt_cte() + """, ac AS (SELECT originalAuthor, count(*) AS n FROM crt GROUP BY 1),
top AS (SELECT originalAuthor AS top_author, n AS top_count FROM ac ORDER BY n DESC, originalAuthor LIMIT 1)
SELECT count(*) AS n_authors, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_retweets,
  round(CASE WHEN count(*) > 0 THEN sum(n) / count(*) END, 6) AS avg_per_author,
  (SELECT top_author FROM top) AS top_author, (SELECT top_count FROM top) AS top_count FROM ac"""


# ------------------------------------------------------------------------------------------- Q14
def daily_activity_pivot(spark, d):
    e = fixture(spark, d, "engagement").where(F.col("date").isNotNull())
    return ag.pivot_counts(e, "date", "type", TYPES, TYPE_COLS)


def _pivot_sql() -> str:
    cols = ", ".join(f"count(*) FILTER (WHERE type = '{v}') AS {n}" for v, n in zip(TYPES, TYPE_COLS))
    tot = " + ".join(TYPE_COLS)
    return fixture_cte("engagement") + f""", pv AS (SELECT date, {cols} FROM engagement WHERE date IS NOT NULL GROUP BY date),
piv AS (SELECT *, CAST({tot} AS BIGINT) AS total FROM pv)
"""


SQL_PIVOT = _pivot_sql() + "SELECT * FROM piv"


def top_days(spark, d, k: int = 15):
    """L2: most active days (ties: earlier date)."""
    return ag.top_k(daily_activity_pivot(spark, d), [F.col("total").desc(), F.col("date").asc()], k)


SQL_TOP_DAYS = _pivot_sql() + "SELECT * FROM piv ORDER BY total DESC, date LIMIT 15"


def quiet_days(spark, d, k: int = 730, marks: int = 5):
    """L3: the last k rows of the busiest-first table (the k least active days) with a mark on the
    busiest ``marks`` days."""
    p = daily_activity_pivot(spark, d)
    tail = ag.top_k(p, [F.col("total").asc(), F.col("date").desc()], k)
    top = ag.top_k(p, [F.col("total").desc(), F.col("date").asc()], marks).select("date", F.lit(True).alias("_top"))
    return tail.join(F.broadcast(top), "date", "left").select(
        "date", "total", F.coalesce("_top", F.lit(False)).alias("is_top"))


SQL_QUIET_DAYS = _pivot_sql() + """, t AS (SELECT date, total FROM piv ORDER BY total ASC, date DESC LIMIT 730),
tp AS (SELECT date FROM piv ORDER BY total DESC, date LIMIT 5)
SELECT t.date, t.total, tp.date IS NOT NULL AS is_top FROM t LEFT JOIN tp ON tp.date = t.date"""


def weekday_share(spark, d):
    """Posts per weekday in Monday..Sunday order with their share; missing days stay null."""
    e = fixture(spark, d, "engagement").where(F.col("date").isNotNull())
    days = spark.createDataFrame([(i + 1, n) for i, n in enumerate(WEEKDAYS)], "dow_no int, day_of_week string")
    c = e.groupBy(F.date_format("date", "EEEE").alias("day_of_week")).agg(F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("_t"))
    return (days.join(c, "day_of_week", "left").crossJoin(F.broadcast(tot))
                .select("dow_no", "day_of_week", "n", r6(nf.safe_pct("n", "_t")).alias("share_pct")))


SQL_WEEKDAY_SHARE = fixture_cte("engagement") + """, days AS (SELECT * FROM (VALUES """ + \
    ", ".join(f"({i + 1}, '{n}')" for i, n in enumerate(WEEKDAYS)) + """) v(dow_no, day_of_week)),
c AS (SELECT dayname(date) AS day_of_week, count(*) AS n FROM engagement WHERE date IS NOT NULL GROUP BY 1)
SELECT CAST(dow_no AS INTEGER) AS dow_no, days.day_of_week, c.n, round(c.n / (SELECT sum(n) FROM c) * 100.0, 6) AS share_pct
FROM days LEFT JOIN c ON c.day_of_week = days.day_of_week"""


def activity_stats(spark, d):
    """Mean and sample standard deviation of daily totals, busiest day."""
    p = daily_activity_pivot(spark, d)
    top = ag.top_k(p, [F.col("total").desc(), F.col("date").asc()], 1).select(
        F.col("date").alias("top_date"), F.col("total").alias("top_total"))
    return p.agg(F.count(F.lit(1)).alias("n_days"), r6(F.avg("total")).alias("mean_daily"),
                 r6(F.stddev_samp("total")).alias("std_daily")).crossJoin(top)


SQL_ACTIVITY_STATS = _pivot_sql() + """, top AS (SELECT date AS top_date, total AS top_total FROM piv ORDER BY total DESC, date LIMIT 1)
SELECT count(*) AS n_days, round(avg(total), 6) AS mean_daily, round(stddev_samp(total), 6) AS std_daily,
 (SELECT top_date FROM top) AS top_date, (SELECT top_total FROM top) AS top_total FROM piv"""


# ------------------------------------------------------------------------------------------- Q15
METRICS4 = ["likeCount", "retweetCount", "replyCount", "viewCount"]


def _merged_returns(spark, d):
    """A7 daily sum/mean/max (rounded) joined (inner, J3) with daily returns W4 (x100, pad-filled)."""
    e = fixture(spark, d, "engagement").where(F.col("date").isNotNull())
    spec = {c: ["sum", "mean", "max"] for c in METRICS4}
    daily = ag.profile(e, "date", spec)
    s = fixture(spark, d, "stock").select("Date", "Close", "Volume")
    s = series.add_pct_change(s, "Close", "Date", "price_change", scale=100.0)
    s = series.add_pct_change(s, "Volume", "Date", "volume_change", scale=100.0)
    s = s.withColumnRenamed("Date", "_day")           # column names ignore case: dropping "Date" would drop "date" too
    return daily.join(s, F.col("date") == F.col("_day"), "inner").drop("_day")


def _corr(spark, d):
    """One aggregate: n, and r, slope and intercept of each daily engagement sum against the price change, unrounded."""
    m = _merged_returns(spark, d).where(F.col("price_change").isNotNull())
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in METRICS4:
        x = F.col(f"{c}_sum").cast("double")
        aggs += [F.corr(x, "price_change").alias(f"{c}_r"), F.regr_slope("price_change", x).alias(f"{c}_s"),
                 F.regr_intercept("price_change", x).alias(f"{c}_i")]
    stack = ", ".join(f"'{c}_sum', {c}_r, {c}_s, {c}_i" for c in METRICS4)
    return m.agg(*aggs).selectExpr("n", f"stack({len(METRICS4)}, {stack}) AS (metric, correlation, slope, intercept)").select(
        "metric", "n", "correlation", "slope", "intercept")


def engagement_return_corr(spark, d):
    """A15 (r) + A16 (degree-1 fit) of each daily engagement sum against the price change.
    The first price row has no return; it is left out (pairwise complete rows)."""
    return _corr(spark, d).withColumns({c: r6(c) for c in ("correlation", "slope", "intercept")})


def daily_engagement_returns(spark, d):
    """Daily sum, mean and max of the four counts next to the price and volume changes of the day."""
    return _merged_returns(spark, d).withColumns({c: r6(c) for c in ("price_change", "volume_change")})


def engagement_return_pvalue(spark, d):
    """A15 p-values and P13 stars of the unrounded correlations."""
    r = _corr(spark, d).withColumn("p", st.pearson_p_value("correlation", "n")).withColumn("stars", nf.significance_stars("p"))
    return r.select("metric", "n", r6("correlation").alias("correlation"), r6("slope").alias("slope"), r6("intercept").alias("intercept"),
                    r6("p").alias("p_value"), "stars")


def _merged_sql() -> str:
    aggs = ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}_sum, round_even(avg({c}), 2) AS {c}_mean, max({c}) AS {c}_max"
                     for c in METRICS4)
    return fixture_cte("engagement", "stock") + f""", dly AS (SELECT date, {aggs} FROM engagement WHERE date IS NOT NULL GROUP BY date),
sc AS (SELECT Date, Close, Volume, (Close / lag(Close) OVER (ORDER BY Date) - 1) * 100.0 AS price_change,
   (Volume / lag(Volume) OVER (ORDER BY Date) - 1) * 100.0 AS volume_change FROM stock),
mg AS (SELECT dly.*, sc.Close, sc.Volume, sc.price_change, sc.volume_change FROM dly JOIN sc ON sc.Date = dly.date)
"""


SQL_ENG_RETURNS = _merged_sql() + """SELECT * REPLACE (round(price_change, 6) AS price_change, round(volume_change, 6) AS volume_change) FROM mg"""

SQL_ENG_CORR = _merged_sql() + " UNION ALL ".join(
    f"""SELECT '{c}_sum' AS metric, count(*) AS n, round(corr(CAST({c}_sum AS DOUBLE), price_change), 6) AS correlation,
 round(regr_slope(price_change, CAST({c}_sum AS DOUBLE)), 6) AS slope, round(regr_intercept(price_change, CAST({c}_sum AS DOUBLE)), 6) AS intercept
 FROM mg WHERE price_change IS NOT NULL""" for c in METRICS4)

_RAW_CORR = " UNION ALL ".join(
    f"""SELECT '{c}_sum' AS metric, count(*) AS n, corr(CAST({c}_sum AS DOUBLE), price_change) AS r, regr_slope(price_change, CAST({c}_sum AS DOUBLE)) AS sl,
 regr_intercept(price_change, CAST({c}_sum AS DOUBLE)) AS ic FROM mg WHERE price_change IS NOT NULL""" for c in METRICS4)
SQL_ENG_PVALUE = _merged_sql() + f""", rs AS ({_RAW_CORR}),
ps AS ({st.sql_pearson_p_value("rs", "metric", "r", "n")})
SELECT metric, n, round(r, 6) AS correlation, round(sl, 6) AS slope, round(ic, 6) AS intercept, round(p, 6) AS p_value,
 CASE WHEN p < 0.001 THEN '***' WHEN p < 0.01 THEN '**' WHEN p < 0.05 THEN '*' ELSE '' END AS stars FROM rs JOIN ps USING (metric)"""


def top_decile_days(spark, d, q: float = 0.9):
    """A17 + F9 + A18: interpolated 90th percentile of daily likes; mean price change on days at or above
    it versus below (one-row threshold broadcast to the rows)."""
    m = _merged_returns(spark, d)
    thr = m.agg(F.percentile(F.col("likeCount_sum").cast("double"), q).alias("threshold"))
    t = m.crossJoin(F.broadcast(thr))
    hi = F.col("likeCount_sum") >= F.col("threshold")
    return t.groupBy("threshold").agg(
        F.count(F.when(hi, 1)).alias("n_high"), F.count(F.when(~hi, 1)).alias("n_normal"),
        r6(F.avg(F.when(hi, F.col("price_change")))).alias("mean_change_high"),
        r6(F.avg(F.when(~hi, F.col("price_change")))).alias("mean_change_normal")).select(
        r6("threshold").alias("threshold"), "n_high", "n_normal", "mean_change_high", "mean_change_normal",
        r6(F.col("mean_change_high") - F.col("mean_change_normal")).alias("difference"))


SQL_TOP_DECILE = _merged_sql() + """, th AS (SELECT quantile_cont(CAST(likeCount_sum AS DOUBLE), 0.9) AS threshold FROM mg),
agg AS (SELECT th.threshold, count(*) FILTER (WHERE likeCount_sum >= threshold) AS n_high,
  count(*) FILTER (WHERE likeCount_sum < threshold) AS n_normal,
  round(avg(price_change) FILTER (WHERE likeCount_sum >= threshold), 6) AS mean_change_high,
  round(avg(price_change) FILTER (WHERE likeCount_sum < threshold), 6) AS mean_change_normal
  FROM mg, th GROUP BY th.threshold)
SELECT round(threshold, 6) AS threshold, n_high, n_normal, mean_change_high, mean_change_normal,
  round(mean_change_high - mean_change_normal, 6) AS difference FROM agg"""


# ------------------------------------------------------------------------------------------- Q16
def engagement_mix(spark, d):
    """A20 + P12: total, mean and share of each of the six counts over cleaned originals (long form)."""
    t = qc.clean_originals(spark, d)
    aggs = []
    for c in COUNT_COLS:
        aggs += [F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}__t"), F.avg(c).alias(f"{c}__m")]
    a = t.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}__t`, `{c}__m`" for c in COUNT_COLS)
    long = a.selectExpr(f"stack({len(COUNT_COLS)}, {stack}) AS (metric, total, mean)")
    grand = a.select(sum((F.col(f"{c}__t") for c in COUNT_COLS), F.lit(0)).alias("_g"))
    return long.crossJoin(grand).select(
        "metric", F.col("total").cast("bigint").alias("total"), r6("mean").alias("mean"),
        r6(nf.safe_pct("total", "_g")).alias("share_pct"), nf.human_format("total").alias("total_short"))


SQL_ENGAGEMENT_MIX = _orig_cte() + ", a AS (SELECT " + ", ".join(
    f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}__t, avg({c}) AS {c}__m" for c in COUNT_COLS) + " FROM corig),\n" + \
    "lg AS (" + " UNION ALL ".join(f"SELECT '{c}' AS metric, {c}__t AS total, {c}__m AS mean FROM a" for c in COUNT_COLS) + "),\n" + \
    "g AS (SELECT " + " + ".join(f"{c}__t" for c in COUNT_COLS) + """ AS gt FROM a)
SELECT metric, total, round(mean, 6) AS mean, CASE WHEN gt = 0 THEN NULL ELSE round(total / gt * 100.0, 6) END AS share_pct,
 CASE WHEN abs(total) >= 1e9 THEN printf('%.1fB', round_even(total / 1e9, 1))
 WHEN abs(total) >= 1e6 THEN printf('%.1fM', round_even(total / 1e6, 1))
 WHEN abs(total) >= 1e3 THEN printf('%.1fK', round_even(total / 1e3, 1))
 ELSE printf('%.0f', round_even(CAST(total AS DOUBLE), 0)) END AS total_short
FROM lg, g"""


def histogram30(spark, d):
    """A21 over daily likes."""
    daily = daily_engagement(fixture(spark, d, "engagement"))
    h = ag.equal_width_histogram(daily, "likeCount", 30)
    return h.select("bin", r6("lo").alias("lo"), r6("hi").alias("hi"), "n")


SQL_HIST = fixture_cte("engagement") + """, dl AS (SELECT CAST(sum(coalesce(likeCount, 0)) AS DOUBLE) AS x FROM engagement WHERE date IS NOT NULL GROUP BY date),
rg AS (SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo, CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM dl),
b AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, count(*) AS n FROM dl, rg GROUP BY 1),
g AS (SELECT CAST(range AS INTEGER) AS bin FROM range(30))
SELECT g.bin, round(lo + g.bin * (hi - lo) / 30, 6) AS lo, round(lo + (g.bin + 1) * (hi - lo) / 30, 6) AS hi, coalesce(b.n, 0) AS n
FROM g CROSS JOIN rg LEFT JOIN b ON b.bin = g.bin"""


# ------------------------------------------------------------------------------------------- price windows
def pct_change_1_3(spark, d, threshold: float = SIG_THRESHOLD):
    """1-day change (x100) and 3-day change; significant when |3-day| >= threshold (null -> false)."""
    s = fixture(spark, d, "stock").select("Date", "Close")
    s = series.add_pct_change(s, "Close", "Date", "ret_1", scale=100.0)
    s = series.add_pct_change(s, "Close", "Date", "ret_3", periods=3)
    return s.select("Date", "Close", r6("ret_1").alias("ret_1"), r6("ret_3").alias("ret_3"),
                    F.coalesce(F.abs("ret_3") >= threshold, F.lit(False)).alias("significant"))


SQL_PCT = fixture_cte("stock") + """, s AS (SELECT Date, Close, (Close / lag(Close) OVER (ORDER BY Date) - 1) * 100.0 AS ret_1,
  Close / lag(Close, 3) OVER (ORDER BY Date) - 1 AS ret_3 FROM stock)
SELECT Date, Close, round(ret_1, 6) AS ret_1, round(ret_3, 6) AS ret_3, coalesce(abs(ret_3) >= 0.2, false) AS significant FROM s"""


def centered_mean(spark, d):
    """Centred 7- and 14-row means of Close, full windows only."""
    s = fixture(spark, d, "stock").select("Date", "Close")
    return s.select("Date", "Close", r6(series.centered_mean("Close", 7, "Date")).alias("close_c7"),
                    r6(series.centered_mean("Close", 14, "Date")).alias("close_c14"))


SQL_CENTERED = fixture_cte("stock") + """SELECT Date, Close,
 round(CASE WHEN count(Close) OVER w7 = 7 THEN avg(Close) OVER w7 END, 6) AS close_c7,
 round(CASE WHEN count(Close) OVER w14 = 14 THEN avg(Close) OVER w14 END, 6) AS close_c14
FROM stock WINDOW w7 AS (ORDER BY Date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING),
 w14 AS (ORDER BY Date ROWS BETWEEN 7 PRECEDING AND 6 FOLLOWING)"""


def significant_moves(spark, d):
    p = pct_change_1_3(spark, d)
    return p.agg(F.count(F.when(F.col("significant"), 1)).alias("n_significant"),
                 F.count(F.when(~F.col("significant"), 1)).alias("n_other"),
                 F.count(F.when(F.col("ret_3").isNull(), 1)).alias("n_undefined"))


SQL_SIG = SQL_PCT.replace("SELECT Date, Close, round(ret_1, 6)", "SELECT count(*) FILTER (WHERE coalesce(abs(ret_3) >= 0.2, false)) AS n_significant, count(*) FILTER (WHERE NOT coalesce(abs(ret_3) >= 0.2, false)) AS n_other, count(*) FILTER (WHERE ret_3 IS NULL) AS n_undefined FROM s --").split("--")[0]

REGISTRY = {
    "likes_ma7_vs_close": (likes_ma7_vs_close, SQL_LIKES_MA7),
    "likes_price_corr": (likes_price_corr, SQL_LIKES_CORR),
    "hour_profile": (hour_profile, SQL_HOUR_PROFILE),
    "weekday_profile": (weekday_profile, SQL_WEEKDAY_PROFILE),
    "peak_hour": (peak_hour, SQL_PEAK),
    "top_authors": (top_authors, SQL_TOP_AUTHORS),
    "author_summary": (author_summary, SQL_AUTHOR_SUMMARY),
    "daily_activity_pivot": (daily_activity_pivot, SQL_PIVOT),
    "top_days": (top_days, SQL_TOP_DAYS),
    "quiet_days": (quiet_days, SQL_QUIET_DAYS),
    "weekday_share": (weekday_share, SQL_WEEKDAY_SHARE),
    "activity_stats": (activity_stats, SQL_ACTIVITY_STATS),
    "daily_engagement_returns": (daily_engagement_returns, SQL_ENG_RETURNS),
    "engagement_return_corr": (engagement_return_corr, SQL_ENG_CORR),
    "engagement_return_pvalue": (engagement_return_pvalue, SQL_ENG_PVALUE),
    "top_decile_days": (top_decile_days, SQL_TOP_DECILE),
    "engagement_mix": (engagement_mix, SQL_ENGAGEMENT_MIX),
    "histogram30": (histogram30, SQL_HIST),
    "pct_change_1_3": (pct_change_1_3, SQL_PCT),
    "centered_mean": (centered_mean, SQL_CENTERED),
    "significant_moves": (significant_moves, SQL_SIG),
}
