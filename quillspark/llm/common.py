"""Helpers shared by the operators: Arrow kernels over text columns, UTF-8 views, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage, drop_table

#: Bytes of text that a kernel holds at a time; larger single texts are processed alone.
SLICE_BYTES = 1 << 20
#: ...and a kernel whose arrays are tens of times as large as the text.
SMALL_SLICE = 1 << 18


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column laid end to end, and the n+1 offsets of its rows. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.large_binary()
    column = pc.fill_null(column.cast(wide) if column.type != wide else column, b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]: offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows of about ``size`` bytes of text, at least one row each."""
    _, offsets = utf8(batch.column(column))
    n, at = batch.num_rows, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        end = min(max(end, at + 1), n)
        yield batch.slice(at, end - at)
        at = end


def with_kernel(df: DataFrame, column: str, new: T.StructType,
                kernel: Callable[[], Callable[[pa.RecordBatch], list]], size: int = SLICE_BYTES) -> DataFrame:
    """Append the columns ``new`` that ``kernel`` computes from slices of ``df`` (of about ``size`` bytes); columns of the same name go.

    ``kernel()`` runs once in each task (it may build tables) and returns the function of a slice."""
    df = df.drop(*[f.name for f in new if f.name in df.columns])
    out = T.StructType(list(df.schema) + list(new))

    def run(batches):
        f = kernel()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for part in slices(batch, column, size):
                yield pa.RecordBatch.from_arrays([*part.columns, *f(part)], names=[*part.schema.names, *[x.name for x in new]])

    return df.mapInArrow(run, out)


def schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the maximal runs of word bytes in each row, and each run's row."""
    m = is_word[data]
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    before = np.empty_like(m)
    before[0], before[1:] = False, m[:-1]
    inner = offsets[:-1]
    before[inner[inner < len(m)]] = False
    after = np.empty_like(m)
    after[-1], after[:-1] = False, m[1:]
    last = offsets[1:] - 1
    after[last[last >= 0]] = False
    starts = np.flatnonzero(m & ~before)
    ends = np.flatnonzero(m & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def powers(n: int, base: np.uint64 = np.uint64(0x100000001B3)) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(lowered: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of every run of bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    flag = np.zeros(len(lowered) + 1, np.int32)
    flag[starts] = 1
    word = np.cumsum(flag[:-1]) - 1
    pos = np.arange(len(lowered)) - starts[np.maximum(word, 0)]
    long_by = ends - starts
    inside = (word >= 0) & (pos < long_by[np.maximum(word, 0)])
    p = powers(int(long_by.max()) + 1)
    value = np.where(inside, (lowered.astype(np.uint64) + np.uint64(1)) * p[np.minimum(pos, len(p) - 1)], np.uint64(0))
    return mixed(np.add.reduceat(value, starts) * _ODD + long_by.astype(np.uint64))


def list_column(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column of rows with ``counts`` values each."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Connected components of ``edges (a, b)`` (longs): rows ``(id, component_id)``, the smallest id reachable.

    Alternating large-star and small-star steps: every row links a node to a smaller one, the number of rows
    never exceeds the number of edges, and a few logarithmic rounds suffice. A hub's neighbours are only ever
    aggregated by ``min`` and joined back, never gathered. Raises if ``max_rounds`` doesn't suffice."""
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    e = cut_lineage(e)
    for _ in range(max_rounds):
        # every node's smallest neighbour, itself included
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low2, "u").select(
            F.explode(F.array(F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("p")).select("p.u", "p.v")
        nxt = cut_lineage(small.where("u <> v").distinct())
        # a fixpoint: every node has one link, and what it links to has none
        ends = nxt.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("up")),
                                            F.struct(F.col("v").alias("id"), F.lit(0).alias("up")))).alias("p")).select("p.id", "p.up")
        unfinished = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).where("ups > 1 or (ups = 1 and least = 0)")
        settled = not unfinished.limit(1).count()
        drop_table(e)
        e = nxt
        if settled:
            return e.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
                e.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct())
    raise RuntimeError(f"components: no fixpoint after {max_rounds} rounds")
