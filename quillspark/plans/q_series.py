"""Daily engagement joined with prices: as-of join, fills, moving averages, returns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ordered, series
from .common import fixture, fixture_cte, r6

ENG_COUNTS = ["retweetCount", "replyCount", "likeCount", "viewCount"]


def daily_engagement(eng):
    """A3: daily sums of the engagement counts (null counts as 0) and the number of posts."""
    return eng.where(F.col("date").isNotNull()).groupBy("date").agg(
        *[F.sum(F.coalesce(F.col(c), F.lit(0))).cast("bigint").alias(c) for c in ENG_COUNTS],
        F.count(F.lit(1)).alias("n_posts"))


def daily_engagement_vs_close(spark, d):
    """A3 -> J1 (as-of backward) -> W6 (ffill, bfill) -> W1 (7-row mean) -> W3 (first difference)."""
    daily = daily_engagement(fixture(spark, d, "engagement"))
    stock = fixture(spark, d, "stock").select("Date", "Close")
    # daily rows (bounded by the calendar): one ordered window each, no bucket summaries needed
    j = ordered.asof_backward(daily, stock, "date", "Date", ["Close"], matched_key="price_date", bucket_fn=None)
    j = ordered.ffill_bfill(j, "Close", "date", out="close_price", bucket_fn=None).drop("Close")
    return j.select(
        "date", *ENG_COUNTS, "n_posts", "price_date", "close_price",
        r6(series.trailing_mean("likeCount", 7, "date")).alias("likes_ma7"),
        r6(series.diff("close_price", "date")).alias("close_diff"))


_DAILY_SQL = """daily AS (SELECT date, CAST(sum(coalesce(retweetCount, 0)) AS BIGINT) AS retweetCount,
  CAST(sum(coalesce(replyCount, 0)) AS BIGINT) AS replyCount, CAST(sum(coalesce(likeCount, 0)) AS BIGINT) AS likeCount,
  CAST(sum(coalesce(viewCount, 0)) AS BIGINT) AS viewCount, count(*) AS n_posts
  FROM engagement WHERE date IS NOT NULL GROUP BY date)"""

SQL_DAILY_ENGAGEMENT_VS_CLOSE = fixture_cte("engagement", "stock") + "," + _DAILY_SQL + """,
j AS (SELECT d.*, s.Date AS price_date, s.Close FROM daily d ASOF LEFT JOIN stock s ON d.date >= s.Date),
f AS (SELECT *, coalesce(
   last_value(Close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(Close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS close_price
  FROM j)
SELECT date, retweetCount, replyCount, likeCount, viewCount, n_posts, price_date, close_price,
  round(avg(likeCount) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS likes_ma7,
  round(close_price - lag(close_price) OVER (ORDER BY date), 6) AS close_diff
FROM f
"""


def asof_backward_rows(spark, d):
    """J1 on post-grain rows: every engagement row takes the last price on or before its date."""
    eng = fixture(spark, d, "engagement").select("row_id", "date")
    stock = fixture(spark, d, "stock").select("Date", "Close")
    return ordered.asof_backward_by_date(eng, stock, "date", "Date", ["Close"], matched_key="price_date").select(
        "row_id", "date", "price_date", "Close")


SQL_ASOF_BACKWARD = fixture_cte("engagement", "stock") + """
SELECT e.row_id, e.date, s.Date AS price_date, s.Close
FROM (SELECT row_id, date FROM engagement) e ASOF LEFT JOIN stock s ON e.date >= s.Date
"""


def ffill_bfill_close(spark, d):
    """W6 alone: calendar of posting days, price by exact date only, then forward and backward fill."""
    days = fixture(spark, d, "engagement").select("date").where(F.col("date").isNotNull()).distinct()
    stock = fixture(spark, d, "stock").select(F.col("Date").alias("date"), "Close")
    j = days.join(stock, "date", "left")
    return ordered.ffill_bfill(j, "Close", "date", out="close_price").select("date", "Close", "close_price")


SQL_FFILL_BFILL = fixture_cte("engagement", "stock") + """,
j AS (SELECT d.date, s.Close FROM (SELECT DISTINCT date FROM engagement WHERE date IS NOT NULL) d
      LEFT JOIN stock s ON s.Date = d.date)
SELECT date, Close, coalesce(
   last_value(Close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
   first_value(Close IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS close_price
FROM j
"""

REGISTRY = {
    "daily_engagement_vs_close": (daily_engagement_vs_close, SQL_DAILY_ENGAGEMENT_VS_CLOSE),
    "asof_backward": (asof_backward_rows, SQL_ASOF_BACKWARD),
    "ffill_bfill": (ffill_bfill_close, SQL_FFILL_BFILL),
}
