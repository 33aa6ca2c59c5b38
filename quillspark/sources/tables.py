"""Readers for the driver tables and the fixture views that stand in for the reference's inputs.

Fixture views are written once as SQL with ``{table}`` placeholders. Spark runs them through
``spark.sql(text, table=DataFrame)`` (no global temp views are registered); the DuckDB oracle
substitutes plain table names and uses them as CTEs. One text, two engines, so the inputs agree.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Views over the driver tables (FIXTURES.md part B). Placeholders name base tables or other views.
# Texts are whole.
FIXTURES: dict[str, str] = {
    # raw posts: routing, cleaning, hour and weekday reports
    "posts": """
SELECT e.event_id AS row_id,
 CASE WHEN e.event_id % 50 = 0 THEN NULL
      WHEN e.event_id % 53 = 0 THEN '!!! ... ???'
      WHEN e.event_type = 'view'  THEN concat('RT @user', CAST(e.user_id AS STRING), ': ',
           CASE WHEN e.event_id % 59 = 0 THEN 'ok' ELSE d.text END)
      WHEN e.event_type = 'click' THEN concat('@user', CAST(e.user_id AS STRING), ' ', d.text)
      WHEN e.event_id % 47 = 0 THEN concat('  ', substr(d.text, 1, 60), '   ', substr(d.text, 61), ' ')
      ELSE d.text END AS fullText,
 CAST(e.ts AS STRING) AS createdAt,
 CASE WHEN e.event_type = 'purchase' AND e.event_id % 4 = 0 THEN 'True' ELSE 'False' END AS isRetweet,
 CASE WHEN e.event_type = 'error' THEN 'True' ELSE 'False' END AS isReply,
 CAST(floor(e.value) AS BIGINT) AS retweetCount,
 CASE WHEN e.event_id % 7 = 0 THEN NULL ELSE e.event_id % 7 END AS replyCount,
 CAST(floor(e.value * 10) AS BIGINT) AS likeCount,
 e.event_id % 5 AS quoteCount,
 CAST(floor(e.value * 100) AS BIGINT) AS viewCount,
 e.event_id % 3 AS bookmarkCount,
 CASE WHEN e.event_id % 4 = 1 THEN concat('quoted ', CAST(e.event_id % 9 AS STRING)) END AS quote
FROM {events} e
JOIN {documents} d ON d.doc_id = e.event_id % (SELECT count(*) FROM {documents})
""",
    # daily prices
    "stock": """
SELECT CAST(l_shipdate AS DATE) AS Date,
 min_by(l_extendedprice, (l_orderkey * 10 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT)) AS Open,
 max(l_extendedprice) AS High, min(l_extendedprice) AS Low,
 max_by(l_extendedprice, (l_orderkey * 10 + l_linenumber) * 100000000 + CAST(round(l_extendedprice * 100) AS BIGINT)) AS Close,
 CAST(sum(l_quantity) AS BIGINT) AS Volume
FROM {lineitem} GROUP BY CAST(l_shipdate AS DATE)
""",
    # dated posts overlapping the price series
    "engagement": """
SELECT o_orderkey AS row_id, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS type,
 o_custkey % 12 AS community, concat('user', CAST(o_custkey % 40 AS STRING)) AS originalAuthor,
 o_orderkey % 97 AS retweetCount,
 CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey % 13 END AS replyCount,
 CAST(floor(o_totalprice) AS BIGINT) AS likeCount,
 CAST(floor(o_totalprice * 10) AS BIGINT) AS viewCount
FROM {orders}
""",
    # dated posts with text and all six counts (daily feature table, Q7)
    "dated_posts": """
SELECT o.o_orderkey AS row_id, CAST(o.o_orderdate AS DATE) AS date,
 CASE WHEN o.o_orderkey % 3 = 0 THEN 'tweets' WHEN o.o_orderkey % 3 = 1 THEN 'retweets' ELSE 'replies' END AS source,
 CASE WHEN o.o_orderkey % 41 = 0 THEN NULL ELSE d.text END AS text,
 o.o_orderkey % 97 AS retweetCount,
 CASE WHEN o.o_orderkey % 7 = 0 THEN NULL ELSE o.o_orderkey % 13 END AS replyCount,
 CAST(floor(o.o_totalprice) AS BIGINT) AS likeCount,
 o.o_custkey % 5 AS quoteCount,
 CAST(floor(o.o_totalprice * 10) AS BIGINT) AS viewCount,
 o.o_orderkey % 3 AS bookmarkCount
FROM {orders} o
JOIN {documents} d ON d.doc_id = o.o_orderkey % (SELECT count(*) FROM {documents})
""",
    # the dated posts as raw ones: prefixes of replies and retweets, texts without a letter, too short contents
    "raw_dated_posts": """
SELECT row_id,
 CASE WHEN text IS NULL THEN NULL
      WHEN source = 'retweets' THEN concat('RT @user', CAST(row_id % 40 AS STRING), ': ',
           CASE WHEN row_id % 59 = 0 THEN 'ok' WHEN row_id % 53 = 0 THEN '!!! ... ???' ELSE text END)
      WHEN source = 'replies' THEN concat('@user', CAST(row_id % 40 AS STRING), ' ', text)
      WHEN row_id % 53 = 0 THEN '!!! ... ???'
      ELSE text END AS fullText,
 CAST(date AS STRING) AS createdAt,
 CASE WHEN source = 'retweets' THEN 'True' ELSE 'False' END AS isRetweet,
 CASE WHEN source = 'replies' THEN 'True' ELSE 'False' END AS isReply,
 retweetCount, replyCount, likeCount, quoteCount, viewCount, bookmarkCount, CAST(NULL AS STRING) AS quote
FROM {dated_posts}
""",
    # raw price file as strings: position column, a junk second row, an 'Adj Close' column
    "raw_prices": """
SELECT 1 AS pos, '' AS Date, 'TSLA' AS Open, 'TSLA' AS High, 'TSLA' AS Low, 'TSLA' AS Close,
       'TSLA' AS "Adj Close", 'TSLA' AS Volume
UNION ALL
SELECT CASE WHEN rn = 0 THEN 0 ELSE rn + 1 END AS pos, CAST(Date AS STRING) AS Date,
 CAST(Open AS STRING) AS Open, CAST(High AS STRING) AS High, CAST(Low AS STRING) AS Low,
 CASE WHEN rn % 97 = 5 THEN 'n/a' ELSE CAST(Close AS STRING) END AS Close,
 CAST(Close AS STRING) AS "Adj Close", CAST(Volume AS STRING) AS Volume
FROM (SELECT *, row_number() OVER (ORDER BY Date) - 1 AS rn FROM {stock})
""",
}

_PLACEHOLDER = re.compile(r"\{(\w+)\}")


def _deps(name: str) -> list[str]:
    return sorted(set(_PLACEHOLDER.findall(FIXTURES[name])))


def _spark_sql_text(text: str) -> str:
    # Spark quotes identifiers with backticks, DuckDB with double quotes.
    return text.replace('"Adj Close"', "`Adj Close`")


_N_DOCS = "(SELECT count(*) FROM {documents})"


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build a fixture view as a lazy DataFrame.

    The document count used as a join modulus is resolved first (a metadata-only count) and inlined as a
    literal in the join key, so the join stays an equi-join without a cross product.
    """
    text = _spark_sql_text(FIXTURES[name])
    if _N_DOCS in text:
        n = read_table(spark, sf_dir, "documents").count()
        text = text.replace(_N_DOCS, f"CAST({max(n, 1)} AS BIGINT)")
    args = {}
    for dep in _PLACEHOLDER.findall(text):
        if dep not in args:
            args[dep] = fixture(spark, sf_dir, dep) if dep in FIXTURES else read_table(spark, sf_dir, dep)
    return spark.sql(text, **args)


def fixture_cte(*names: str) -> str:
    """``WITH`` clause defining the named fixture views (and their dependencies) for DuckDB."""
    order: list[str] = []

    def visit(n: str) -> None:
        for d in _deps(n):
            if d in FIXTURES:
                visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({_PLACEHOLDER.sub(lambda m: m.group(1), FIXTURES[n]).strip()})" for n in order]
    return "WITH " + ",\n".join(parts) + "\n"
