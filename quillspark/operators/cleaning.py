"""Routing, cleaning rules, skew-safe de-duplication and the removal waterfall.

Every cleaning job tags each input row with the first rule that removes it (``removed_by``; null = kept).
The cleaned table and the waterfall are two projections of the same tagged frame, so counts always
reconcile: rows in = sum(removed) + rows out.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx

# The columns of the raw post files.
COUNT_COLS = ["retweetCount", "replyCount", "likeCount", "quoteCount", "viewCount", "bookmarkCount"]
RAW_COLUMNS = ["fullText", "createdAt", "isRetweet", "isReply"] + COUNT_COLS + ["quote"]
# Formats of timestamps tried in turn after the ISO ones.
TIMESTAMP_FORMATS = ["EEE MMM dd HH:mm:ss XX yyyy", "MM/dd/yyyy HH:mm:ss", "MM/dd/yyyy HH:mm", "MM/dd/yyyy",
                     "dd MMM yyyy HH:mm:ss", "MMM dd, yyyy", "yyyyMMdd"]

# Step order of each cleaning job (fixed: it decides which rule a row is charged to).
STEPS = {
    "original": ["missing_text", "non_alnum", "duplicate"],
    "reply": ["duplicate", "missing_text", "blank_text", "non_alnum"],
    "retweet": ["missing_text", "unparseable", "duplicate", "non_alnum", "too_short"],
}
KINDS = ["original", "reply", "retweet"]


def require_columns(df: DataFrame, cols: Sequence[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"missing columns: {missing}")


def parse_timestamp(c) -> Column:
    """``to_datetime(errors='coerce')``: unparsable -> null (no ANSI error), wall-clock timestamp."""
    col = F.col(c) if isinstance(c, str) else c
    more = [F.try_to_timestamp(F.regexp_replace(col, "^(Mon|Tue|Wed|Thu|Fri|Sat|Sun) ", "") if f.startswith("EEE") else col,
                               F.lit(f.removeprefix("EEE "))).cast("timestamp_ntz") for f in TIMESTAMP_FORMATS]
    return F.coalesce(col.try_cast("timestamp_ntz"), *more)


def standardize(raw: DataFrame) -> DataFrame:
    """P1 strict rename, P2 timestamp parse, P3 text length (null -> 0)."""
    require_columns(raw, ["fullText", "createdAt"])
    d = raw.withColumnsRenamed({"fullText": "text", "createdAt": "timestamp"})
    return (d.withColumn("timestamp", parse_timestamp("timestamp"))
             .withColumn("text_length", F.coalesce(F.length("text"), F.lit(0)).cast("int")))


def route_kind(text="text", is_retweet="isRetweet", is_reply="isReply") -> Column:
    """retweet (flag or ``RT @x:`` prefix) > reply (flag or ``@x`` prefix) > original."""
    rt = F.coalesce(F.col(is_retweet) == "True", F.lit(False)) | tx.is_retweet_text(text)
    rp = F.coalesce(F.col(is_reply) == "True", F.lit(False)) | tx.is_reply_text(text)
    return F.when(rt, "retweet").when(rp, "reply").otherwise("original")


def route(raw: DataFrame) -> DataFrame:
    """Q1 core: standardise, tag ``kind``, drop the two flags (P5)."""
    d = standardize(raw)
    return d.withColumn("kind", route_kind()).drop("isRetweet", "isReply")


FINGERPRINT = ["_print", "_proof"]


def fingerprint(keys: Sequence[str]) -> dict[str, Column]:
    """Two unrelated digests of the ``keys`` of a row, 192 bits together, as columns: a 64-bit hash, and an MD5 of the
    values with their lengths (nulls apart from empty strings) that proves equal hashes equal rows. They stand for the
    values in exchanges and sorts, where whole texts must not be keys."""
    told = [F.coalesce(F.concat(F.length(F.col(k).cast("string")).cast("string"), F.lit(":"), F.col(k).cast("string")), F.lit("-")) for k in keys]
    return {"_print": F.xxhash64(*keys, *[F.col(k).isNull() for k in keys]), "_proof": F.md5(F.concat(*told))}


def keep_first_ids(df: DataFrame, keys: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """Ids of the first row (smallest ``order_col``) of each ``keys`` group.

    A grouped ``min`` on the fingerprint is combined map-side, so a key holding a third of all rows is collapsed before
    the shuffle; no window ever holds a whole duplicate group, and only ids and digests are moved.
    """
    prints = df.withColumns(fingerprint(keys)).select(order_col, *FINGERPRINT)
    return prints.groupBy(*FINGERPRINT).agg(F.min(order_col).alias(order_col)).select(order_col)


def keep_first(df: DataFrame, keys: Sequence[str], order_col: str = "row_id") -> DataFrame:
    """The first row of each ``keys`` group. The rank filter becomes a group limit in front of the shuffle, so each
    task sends one row of a key and no window holds a whole duplicate group. The keys are fingerprints: texts are only
    payload, and columns that nothing reads later don't move at all."""
    w = Window.partitionBy(*FINGERPRINT).orderBy(order_col)
    rows = df.withColumns(fingerprint(keys)).withColumn("_rn", F.row_number().over(w))
    return rows.where(F.col("_rn") == 1).drop("_rn", *FINGERPRINT)


class Rules:
    """Applies the steps of a cleaning job in order. With ``tag`` every row stays and ``removed_by`` names the first
    rule that removes it; without, the rows go in one pass and only the kept ones are left."""

    def __init__(self, df: DataFrame, tag: bool):
        self.tag = tag
        self.df = df.withColumn("removed_by", F.lit(None).cast("string")) if tag else df

    def alive(self) -> Column:
        return F.col("removed_by").isNull() if self.tag else F.lit(True)

    def set(self, **columns: Column) -> None:
        self.df = self.df.withColumns(columns)

    def remove(self, cond: Column, name: str) -> None:
        cond = F.coalesce(cond, F.lit(False))
        if self.tag:
            self.df = self.df.withColumn("removed_by", F.when(self.alive() & cond, F.lit(name)).otherwise(F.col("removed_by")))
        else:
            self.df = self.df.where(~cond)

    def duplicates(self, keys: Sequence[str] | None = None, order_col: str = "row_id") -> None:
        """Removes rows that repeat an earlier one on ``keys`` (default: the whole row)."""
        keys = keys or [c for c in self.df.columns if c not in (order_col, "removed_by")]
        if not self.tag:
            self.df = keep_first(self.df, keys, order_col)
            return
        first = keep_first_ids(self.df.where(self.alive()), keys, order_col).withColumn("_first", F.lit(True))
        self.df = self.df.join(first, order_col, "left")
        self.remove(F.col("_first").isNull(), "duplicate")
        self.df = self.df.drop("_first")


def _stage_reread(df: DataFrame) -> DataFrame:
    """What re-reading a stage file does: whole-field null tokens in text become null."""
    return df.withColumn("text", tx.null_tokens("text"))


def tag_originals(routed: DataFrame, tag: bool = True) -> DataFrame:
    """Q2: F2 missing text -> P7 clean -> F3 no letter/digit -> U2 whole-row duplicate (keep first)."""
    r = Rules(_stage_reread(routed.where(F.col("kind") == "original").drop("kind")), tag)
    r.remove(F.col("text").isNull(), "missing_text")
    # cleaning changes no letter or digit: the rule is asked of the raw text, which is not cleaned twice for it
    r.remove(~tx.has_alnum("text"), "non_alnum")
    r.set(text=tx.clean_text("text"))
    r.duplicates()
    return r.df


def tag_replies(routed: DataFrame, tag: bool = True) -> DataFrame:
    """Q3: P6 counts null -> 0, U2 whole-row duplicate first, then F2 / F4 / F3 on the raw text."""
    d = _stage_reread(routed.where(F.col("kind") == "reply").drop("kind"))
    r = Rules(d.na.fill(0, subset=[c for c in d.columns if "Count" in c]), tag)
    keys = [c for c in r.df.columns if c not in ("row_id", "removed_by")]
    # what the rules ask of the text is told before the duplicates are: a job that needs no text doesn't move it
    r.set(_blank=tx.py_strip("text") == "", _alnum=tx.has_alnum("text"), _none=F.col("text").isNull())
    r.duplicates(keys)
    r.remove(F.col("_none"), "missing_text")
    r.remove(F.col("_blank"), "blank_text")
    r.remove(~F.col("_alnum"), "non_alnum")
    return r.df.drop("_none", "_blank", "_alnum")


def tag_retweets(routed: DataFrame, tag: bool = True) -> DataFrame:
    """Q4: F2, P8 parse ``RT @author: content``, W8 dedupe on raw content, P7, F3, W7 author count, F5."""
    r = Rules(_stage_reread(routed.where(F.col("kind") == "retweet").drop("kind")), tag)
    r.remove(F.col("text").isNull(), "missing_text")
    author, content = tx.retweet_parts("text")
    r.set(originalAuthor=author, tweet=content)
    r.df = r.df.drop("text")
    r.remove(F.col("originalAuthor").isNull() | F.col("tweet").isNull(), "unparseable")
    # as for replies; the fingerprint is that of the raw content
    r.set(_alnum=tx.has_alnum("tweet"), _clean=tx.clean_text("tweet", final_strip=False))
    r.set(originalTextLength=F.length("_clean"))
    r.duplicates(["tweet"])
    r.remove(~F.col("_alnum"), "non_alnum")
    r.df = r.df.drop("tweet", "_alnum").withColumnRenamed("_clean", "tweet")
    # Author frequency among rows still alive here (after F3, before F5); grouped count joined back
    # on the author key (partial aggregation; AQE splits a hot author on the join side).
    counts = r.df.where(r.alive()).groupBy("originalAuthor").agg(F.count(F.lit(1)).alias("_arc"))
    r.df = r.df.join(counts, "originalAuthor", "left")
    r.set(authorRetweetCount=F.when(r.alive(), F.col("_arc")))
    r.df = r.df.drop("_arc")
    r.remove(F.col("originalTextLength") < 5, "too_short")
    return r.df


TAGGERS = {"original": tag_originals, "reply": tag_replies, "retweet": tag_retweets}


def kept(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col("removed_by").isNull()).drop("removed_by")


def cleaned(routed: DataFrame, kind: str) -> DataFrame:
    """The kept rows of a class, in one pass over it."""
    return TAGGERS[kind](routed, tag=False)


def waterfall(tagged: dict, spark=None) -> DataFrame:
    """A2: (kind, step_no, step, rows_in, removed, rows_out) for each class in rule order, zero rows kept.

    ``tagged`` maps kind -> tagged frame. The tags of all classes are unioned and counted in one grouped
    aggregate; the running totals are a window over at most a handful of step rows per class.
    """
    spark = spark or next(iter(tagged.values())).sparkSession
    steps = spark.createDataFrame([(k, i + 1, s) for k in tagged for i, s in enumerate(STEPS[k])],
                                  "kind string, step_no int, step string")
    tags = None
    for k, t in tagged.items():
        part = t.select(F.lit(k).alias("kind"), F.col("removed_by").alias("step"))
        tags = part if tags is None else tags.unionByName(part)
    counts = tags.groupBy("kind", "step").agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy("kind").agg(F.sum("n").alias("total"))
    removed = steps.join(counts, ["kind", "step"], "left").select(
        "kind", "step_no", "step", F.coalesce("n", F.lit(0)).alias("removed"))
    w = Window.partitionBy("kind").orderBy("step_no").rowsBetween(Window.unboundedPreceding, 0)
    return (removed.join(total, "kind", "left")
            .withColumn("rows_out", F.coalesce(F.col("total"), F.lit(0)) - F.sum("removed").over(w))
            .withColumn("rows_in", F.col("rows_out") + F.col("removed"))
            .select("kind", "step_no", "step", F.col("rows_in").cast("bigint"),
                    F.col("removed").cast("bigint"), F.col("rows_out").cast("bigint")))


def class_counts(routed: DataFrame) -> DataFrame:
    """A1: rows per class and share of the routed input, all three classes present."""
    spark = routed.sparkSession
    kinds = spark.createDataFrame([(k,) for k in KINDS], "kind string")
    n = routed.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return (kinds.join(n, "kind", "left").crossJoin(total)
            .select("kind", F.coalesce("n", F.lit(0)).alias("n"),
                    F.coalesce("total", F.lit(0)).cast("bigint").alias("total")))
