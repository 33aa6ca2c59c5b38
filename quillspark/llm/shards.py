"""Hilbert-curve sharding (operator 9): DataFrame functions only.

Each row's metadata dimensions are quantised to ``bits`` bits; the cell's index on the Hilbert curve orders the rows,
and the curve is cut into runs, the shards. Neighbouring cells are near in every dimension, so a shard's ranges of all
dimensions are narrow and a reader prunes by any of them (``manifest``).

Positions on the curve are counted in three levels (cell, salt, row): the cells are at most 2^(dims x bits), the salt
splits a cell that holds many rows, and only the smallest level is a window over rows. Texts are never shuffled.

Laws: ``rows`` (counts at most one apart) and ``bytes`` (each shard ends at the row that reaches its part of all
bytes, so sizes differ by at most two rows). Nulls in a dimension are a value of their own; a null text has no bytes.
Equal rows have places next to each other; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALTS = 64


def hilbert_index(point: Sequence[int], bits: int) -> int:
    """Index on the curve of a point with ``bits`` bits in each dimension: Gray code of the transposed coordinates."""
    x = list(point)
    q = 1 << (bits - 1)
    while q > 1:                               # undo the rotations from the top level down
        for i in range(len(x)):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0] ^= t
                x[i] ^= t
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            t ^= q - 1
        q >>= 1
    out = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            out = out << 1 | ((v ^ t) >> b & 1)
    return out


def curve(dims: Sequence[Column], bits: int) -> Column:
    """The Hilbert index of quantised dimensions. The curve is a table made from the rule, one entry for each cell."""
    n = len(dims)
    if n * bits > 16:
        raise ValueError("at most 2^16 cells")
    table = [str(hilbert_index([c >> (bits * (n - 1 - i)) & ((1 << bits) - 1) for i in range(n)], bits)) for c in range(1 << (n * bits))]
    cell = dims[0].cast("int")
    for d in dims[1:]:
        cell = cell * (1 << bits) + d.cast("int")
    return F.element_at(F.split(F.lit(",".join(table)), ",").cast("array<int>"), cell + 1)


def by_category(column: str, bits: int) -> Column:
    """A category's place: a hash, null first."""
    top = (1 << bits) - 1
    return F.when(F.col(column).isNull(), 0).otherwise(F.pmod(F.xxhash64(F.col(column).cast("string")), F.lit(top)) + 1).cast("int")


def by_magnitude(column: Column, bits: int, least: int) -> Column:
    """A size's place: its power of two above ``least``."""
    return F.least(F.lit((1 << bits) - 1), F.greatest(F.lit(0), F.floor(F.log2(F.greatest(column, F.lit(1)) / least)))).cast("int")


def size_of(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 16


def assign(df: DataFrame, key: str, size: str, dims: Sequence[Column], shards: int = 40, law: str = "rows", bits: int = 4) -> DataFrame:
    """Append ``curve``, ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard)."""
    if law not in ("rows", "bytes"):
        raise ValueError(f"law {law!r}")
    salt = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(SALTS))
    rows = df.withColumn("curve", curve(dims, bits)).withColumn("_salt", salt)
    unit = F.lit(1).cast("bigint") if law == "rows" else F.col(size)
    block = rows.groupBy("curve", "_salt").agg(F.count(F.lit(1)).alias("n"), F.sum(unit).alias("w"))
    cell = block.groupBy("curve").agg(F.sum("n").alias("cell_n"), F.sum("w").alias("cell_w"))
    before = Window.orderBy("curve").rowsBetween(Window.unboundedPreceding, -1)     # over at most 2^(dims x bits) rows
    cell = cell.select("curve", F.coalesce(F.sum("cell_n").over(before), F.lit(0)).alias("cell_at"),
                       F.coalesce(F.sum("cell_w").over(before), F.lit(0)).alias("cell_wat"))
    inner = Window.partitionBy("curve").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    block = block.select("curve", "_salt", F.coalesce(F.sum("n").over(inner), F.lit(0)).alias("in_at"),
                         F.coalesce(F.sum("w").over(inner), F.lit(0)).alias("in_wat")).join(cell, "curve")
    block = block.select("curve", "_salt", (F.col("cell_at") + F.col("in_at")).alias("_at"), (F.col("cell_wat") + F.col("in_wat")).alias("_wat"))
    here = Window.partitionBy("curve", "_salt").orderBy(key, size)
    ranked = rows.withColumn("_rank", F.row_number().over(here).cast("bigint") - 1)
    if law == "bytes":
        ranked = ranked.withColumn("_run", F.coalesce(F.sum(size).over(here.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = ranked.join(block, ["curve", "_salt"]).withColumn("_pos", F.col("_at") + F.col("_rank"))
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(unit).alias("w")).first()
    n, w = total["n"], total["w"] or 0
    if law == "rows":
        # shard k holds the positions from ceil(k n / shards) on: counts are at most one apart
        out = placed.withColumn("shard", F.expr(f"CAST((_pos * {shards}) DIV {max(n, 1)} AS INT)"))
        first = F.expr(f"(CAST(shard AS BIGINT) * {n} + {shards - 1}) DIV {shards}")
        out = out.withColumn("slot", (F.col("_pos") - first).cast("bigint"))
    else:
        out = placed.withColumn("shard", F.expr(f"CAST(least({shards - 1}, ((_wat + _run) * {shards}) DIV {max(w, 1)}) AS INT)"))
        starts = out.groupBy("shard").agg(F.min("_pos").alias("_first"))
        out = out.join(F.broadcast(starts), "shard").withColumn("slot", F.col("_pos") - F.col("_first")).drop("_first")
    return out.drop("_salt", "_rank", "_at", "_wat", "_pos", "_run")


def manifest(assigned: DataFrame, dims: Sequence[str], size: str) -> DataFrame:
    """One row for each shard: rows, bytes, and the least and greatest value of each dimension."""
    ranges = [f(c).alias(f"{n}_{c}") for c in dims for n, f in (("min", F.min), ("max", F.max))]
    return assigned.groupBy("shard").agg(F.count(F.lit(1)).alias("rows"), F.sum(size).alias("bytes"), *ranges)


def write(df: DataFrame, assigned: DataFrame, key: str, path: str) -> None:
    """Write the rows of ``df`` as Parquet, a folder for each shard, in curve order inside it."""
    (df.join(assigned.select(key, "curve", "shard", "slot"), key)
       .repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
       .write.mode("overwrite").partitionBy("shard").parquet(path))
