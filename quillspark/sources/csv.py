"""CSV readers for the reference's file inputs.

Row order matters to several operators (keep-first, concatenation order, positions), so readers can add a
``row_id`` that follows file order: (file path, split start offset, row within the split). Spark packs
splits by size, so partition order alone is not file order.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx

POST_COLUMNS = ["fullText", "createdAt", "isRetweet", "isReply", "retweetCount", "replyCount", "likeCount",
                "quoteCount", "viewCount", "bookmarkCount", "quote"]
COUNT_COLUMNS = ["retweetCount", "replyCount", "likeCount", "quoteCount", "viewCount", "bookmarkCount"]


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                     multiline: bool = True, row_id: bool = True) -> DataFrame:
    """Header CSV, every column a string, quoted multi-line fields; ``columns`` are required
    (KeyError when one is missing) and projected. Adds ``row_id`` in file order."""
    df = (spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
               .option("inferSchema", False).option("mode", "PERMISSIVE")
               .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    if columns is not None:
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise KeyError(f"missing columns in {path}: {missing}")
    if row_id:
        df = with_row_position(df)
    keep = (["row_id"] if row_id else []) + (list(columns) if columns is not None else [c for c in df.columns if c != "row_id"])
    return df.select(*keep)


def with_row_position(df: DataFrame, out: str = "row_id") -> DataFrame:
    """Position of each row in file order, 0-based, across files in path order."""
    d = df.select("*", F.col("_metadata.file_path").alias("_fp"), F.col("_metadata.file_block_start").alias("_fb"),
                  F.monotonically_increasing_id().alias("_mi"))
    # rows of one split are consecutive; the low 33 bits of the id count rows within the partition
    # one small summary row per split gives each split's starting offset; rows are then numbered locally
    splits = d.groupBy("_fp", "_fb").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_fp", "_fb").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_off", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    local = F.col("_mi").bitwiseAND(F.lit((1 << 33) - 1))
    first = d.groupBy("_fp", "_fb").agg(F.min(local).alias("_lo"))
    out_df = d.join(F.broadcast(splits.join(first, ["_fp", "_fb"])), ["_fp", "_fb"])
    return out_df.withColumn(out, F.col("_off") + local - F.col("_lo")).drop("_fp", "_fb", "_mi", "_n", "_off", "_lo")


def read_stage_csv(spark: SparkSession, path: str, counts: Sequence[str] = COUNT_COLUMNS) -> DataFrame:
    """A stage file re-read with types: whole-field null tokens become null in every string column and
    count columns are coerced to numbers (bad values -> null)."""
    df = read_csv_strings(spark, path)
    cols = []
    for c in df.columns:
        if c == "row_id":
            cols.append(F.col(c))
        elif c in counts:
            cols.append(tx.null_tokens(c).try_cast("double").cast("long").alias(c))
        else:
            cols.append(tx.null_tokens(c).alias(c))
    return df.select(*cols)


def read_csv_columns(spark: SparkSession, path: str, columns: Sequence[str], dates: Sequence[str] = (),
                     rename: dict | None = None) -> DataFrame:
    """S3: column subset (pruned at the scan) with date parsing (bad -> null) and a lax rename."""
    df = read_csv_strings(spark, path, columns)
    df = df.withColumns({c: F.col(c).try_cast("timestamp_ntz") for c in dates})
    return df.withColumnsRenamed(rename or {})


def drop_positions(df: DataFrame, positions: Sequence[int], pos_col: str = "row_id") -> DataFrame:
    """Drop rows by file position (e.g. a misplaced second header line)."""
    return df.where(~F.col(pos_col).isin(list(positions)))


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns, raising when one is absent."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"cannot drop missing columns {missing}")
    return df.drop(*cols)
