"""Near-duplicate vectors by randomised-rotation binary codes (operator 4).

1. Equal vectors are one group (map-side combined), whose least id stands for all.
2. A group's vector is normalised, padded and rotated by a random orthogonal matrix; the signs are its binary code and
   the product of code and vector its stored correction factor.
3. Disjoint runs of code bits are the keys of hash tables. There are so many tables that a pair at the threshold misses
   all of them with a probability of at most ``miss``. Rows of a table with the same key meet; keys of many rows are cut
   into blocks whose pairs of blocks are tasks of their own. The first round ships only codes, and keeps the rows with
   a partner whose angle can reach the threshold by the codes' distance; a pair belongs to the first table it shares.
4. The second round ships these rows' vectors. The code, divided by its factor, gives an unbiased estimate of each
   pair's inner product with a confidence bound. Pairs that the bound rules out end there; all others are recomputed
   exactly in double precision. A task returns counts and one link for each row, never pairs.

Null vectors, zero vectors and those with null or non-finite components link with nothing, nor do vectors of different
lengths. Rows that repeat an id count as further vectors under that id. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import components, list_column

#: Rows of a block, and pairs that a kernel holds at a time.
BLOCK, PAIRS = 1024, 1 << 17


def vectors_of(column) -> list:
    """float64 vector or None (null, empty, zero, null or non-finite components) of every row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out = []
    flat = pc.cast(column.flatten(), pa.float64())
    values = pc.fill_null(flat, math.nan).to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    for a, b in zip(ends - sizes, ends):
        v = values[a:b]
        with np.errstate(over="ignore", invalid="ignore"):
            ok = b > a and np.isfinite(v).all() and 0 < v @ v < math.inf
        out.append(v if ok else None)
    return out


def keyed(df: DataFrame, vec: str) -> DataFrame:
    """Append ``key``: a digest of the vector's values, null if it links with nothing."""
    from pyspark.sql import types as T
    out = T.StructType(list(df.schema) + [T.StructField("key", T.BinaryType())])

    def run(batches):
        for batch in batches:
            keys = [None if v is None else hashlib.blake2b((v + 0.0).tobytes(), digest_size=16).digest() for v in vectors_of(batch.column(vec))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], names=[*batch.schema.names, "key"])

    return df.mapInArrow(run, out)


class Plan:
    """Sizes of the codes and tables for a threshold, a number of vectors and their length."""

    def __init__(self, threshold: float, rows: int, dims: int, miss: float, epsilon: float, seed: int):
        self.threshold, self.epsilon, self.seed, self.dims = threshold, epsilon, seed, dims
        agree = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
        self.bits = min(24, max(8, math.ceil(math.log2(max(rows, 2) / 8))))
        hit = agree ** self.bits
        self.tables = math.ceil(math.log(miss) / math.log(1 - hit)) if hit < 1 else 1
        self.width = -(-max(dims, self.bits * self.tables) // 64) * 64
        # the share of differing bits that a pair at the threshold exceeds with a probability of about miss / 100
        p = 1 - agree
        z = 4.5
        self.most_differing = int(self.width * min(1.0, p + z * math.sqrt(p * (1 - p) / self.width) + z * z / (3 * self.width)))

    def rotation(self) -> np.ndarray:
        """The first ``dims`` columns of a random orthogonal matrix, as rows: dims x width."""
        q, r = np.linalg.qr(np.random.default_rng(self.seed).standard_normal((self.width, self.width)))
        return np.ascontiguousarray((q * np.sign(np.diag(r)))[:, : self.dims].T)

    def keys(self, signs: np.ndarray) -> np.ndarray:
        """Table keys of rows of sign bits: rows x tables."""
        use = signs[:, : self.bits * self.tables].reshape(len(signs), self.tables, self.bits)
        return use @ (1 << np.arange(self.bits, dtype=np.int64))


def coded(groups: DataFrame, plan: Plan) -> DataFrame:
    """``(id, n, code, factor, keys)`` of every group of the plan's length."""
    sent = groups.sparkSession.sparkContext.broadcast(plan.rotation())     # dims x width, from the parameters

    def run(batches):
        p = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            v = np.array(vectors_of(batch.column("v")))
            x = (v / np.linalg.norm(v, axis=1, keepdims=True)) @ p
            signs = x > 0
            code = np.packbits(signs, axis=1)
            factor = np.abs(x).sum(1) / math.sqrt(plan.width)
            keys = plan.keys(signs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(factor),
                 list_column(np.full(len(keys), plan.tables), pa.array(keys.ravel()))],
                names=["id", "n", "code", "factor", "keys"])

    return groups.mapInArrow(run, "id bigint, n bigint, code binary, factor double, keys array<bigint>")


def placed(codes: DataFrame, block: int) -> DataFrame:
    """A row for each table and, in a key of more than ``block`` rows, for each pair of its blocks; keys of one row go.

    ``side`` is the row's block in the pair: 0 or 1, or 2 where the blocks are the same."""
    rows = codes.select("id", F.posexplode("keys").alias("t", "k"))
    sizes = rows.groupBy("t", "k").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    met = rows.join(sizes, ["t", "k"])
    blocks = F.ceil(F.col("size") / block).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    side = F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1)
    return met.select("id", "t", F.xxhash64("t", "k", F.least("own", "other"), F.greatest("own", "other")).alias("bucket"), side.cast("int").alias("side"))


def runs_of_pairs(bucket: np.ndarray, side: np.ndarray):
    """Pairs of rows of the same bucket, in portions: rows are sorted by bucket and side."""
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    left, right, held = [], [], 0
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a < 2:
            continue
        if side[a] == 2:
            step = max(1, PAIRS // (b - a))
            for s in range(a, b, step):
                i = np.arange(s, min(b, s + step))
                n = b - 1 - i
                left.append(np.repeat(i, n))
                right.append(np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(i + 1, n))
                held += int(n.sum())
                if held >= PAIRS:
                    yield np.concatenate(left), np.concatenate(right)
                    left, right, held = [], [], 0
        else:
            m = a + int(np.searchsorted(side[a:b], 1))
            step = max(1, PAIRS // max(1, b - m))
            for s in range(a, m, step):
                i = np.arange(s, min(m, s + step))
                left.append(np.repeat(i, b - m))
                right.append(np.tile(np.arange(m, b), len(i)))
                held += len(i) * (b - m)
                if held >= PAIRS:
                    yield np.concatenate(left), np.concatenate(right)
                    left, right, held = [], [], 0
    if held:
        yield np.concatenate(left), np.concatenate(right)


def whole_buckets(batches):
    """Batches of rows sorted by bucket, cut so that a bucket's rows are together. A bucket has at most two blocks."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        b = t.column("bucket").to_numpy()
        last = int(np.searchsorted(b, b[-1]))
        if last:
            yield t.slice(0, last)
        held = t.slice(last).combine_chunks()
    if held is not None and held.num_rows:
        yield held


def code_matrix(column, width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return raw.reshape(-1, width // 8)


def candidate_pairs(t: pa.Table, plan: Plan):
    """Pairs that meet first in this table's bucket and whose codes are near enough: (left, right) row numbers."""
    table = t.column("t").to_numpy()
    code = code_matrix(t.column("code"), plan.width)
    words = code.view(np.uint64)
    keys = plan.keys(np.unpackbits(code, axis=1).astype(np.int64))
    for i, j in runs_of_pairs(t.column("bucket").to_numpy(), t.column("side").to_numpy()):
        near = np.bitwise_count(words[i] ^ words[j]).sum(1) <= plan.most_differing
        i, j = i[near], j[near]
        first = (keys[i] == keys[j])
        own = first.argmax(1) == table[i]
        own &= first.any(1)
        yield i[own], j[own]


def _ordered(rows: DataFrame) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", "side", "id")


def promising(rows: DataFrame, codes: DataFrame, plan: Plan) -> DataFrame:
    """Rows of ``placed`` with a candidate in their bucket; only codes are shipped."""
    def run(batches):
        for t in whole_buckets(batches):
            mark = np.zeros(t.num_rows, bool)
            for i, j in candidate_pairs(t, plan):
                mark[i] = True
                mark[j] = True
            for b in t.select(["id", "t", "bucket", "side"]).filter(pa.array(mark)).to_batches():
                yield b

    source = _ordered(rows.join(codes.select("id", "code"), "id"))
    return source.select("id", "t", "bucket", "side", "code").mapInArrow(run, "id bigint, t int, bucket bigint, side int")


def decided(rows: DataFrame, codes: DataFrame, groups: DataFrame, plan: Plan) -> DataFrame:
    """``(id, links, root)`` for rows with a link in their bucket: the vectors linked there, and the least id among
    the rows reachable in the bucket."""
    sent = groups.sparkSession.sparkContext.broadcast(plan.rotation())

    def run(batches):
        p = sent.value
        for t in whole_buckets(batches):
            v = np.array(vectors_of(t.column("v")))
            unit = v / np.linalg.norm(v, axis=1, keepdims=True)
            rotated = (unit @ p).astype(np.float32)
            code = np.where(np.unpackbits(code_matrix(t.column("code"), plan.width), axis=1)[:, : plan.width] > 0, 1, -1).astype(np.float32) / math.sqrt(plan.width)
            factor, n, ids = (t.column(c).to_numpy() for c in ("factor", "n", "id"))
            bound = plan.epsilon * np.sqrt(np.maximum(0, 1 - factor ** 2) / factor ** 2 / (plan.width - 1))
            links, root, linked = np.zeros(len(v)), np.arange(len(v)), []
            for i, j in candidate_pairs(t, plan):
                for s in range(0, len(i), 1 << 14):
                    a, b = i[s: s + (1 << 14)], j[s: s + (1 << 14)]
                    estimate = np.einsum("ij,ij->i", code[a], rotated[b]) / factor[a]
                    open_ = estimate + bound[a] >= plan.threshold
                    a, b = a[open_], b[open_]
                    exact = np.einsum("ij,ij->i", v[a], v[b]) / (np.linalg.norm(v[a], axis=1) * np.linalg.norm(v[b], axis=1))
                    yes = exact >= plan.threshold
                    a, b = a[yes], b[yes]
                    links += np.bincount(a, weights=n[b], minlength=len(v)) + np.bincount(b, weights=n[a], minlength=len(v))
                    linked.append((a, b))
            if not any(len(a) for a, _ in linked):
                continue
            a, b = (np.concatenate(x) for x in zip(*linked))
            place = np.empty(len(ids), np.int64)
            place[np.argsort(ids, kind="stable")] = np.arange(len(ids))
            low = place.copy()                                   # least place reachable
            while True:
                was = low.copy()
                m = np.minimum(low[a], low[b])
                np.minimum.at(low, a, m)
                np.minimum.at(low, b, m)
                if (low == was).all():
                    break
            by_place = np.argsort(place)
            hit = np.flatnonzero(links > 0)
            yield pa.RecordBatch.from_arrays([pa.array(ids[hit]), pa.array(links[hit].astype(np.int64)), pa.array(ids[by_place[low[hit]]])],
                                             names=["id", "links", "root"])

    source = _ordered(rows.join(codes.select("id", "n", "code", "factor"), "id").join(groups.select("id", "v"), "id"))
    return source.select("id", "t", "bucket", "side", "n", "code", "factor", "v").mapInArrow(run, "id bigint, links bigint, root bigint")


def find(df: DataFrame, vec_id: str, vec: str, threshold: float = 0.95, miss: float = 1e-4, epsilon: float = 5.0,
         block: int = BLOCK, seed: int = 17) -> DataFrame:
    """One row for each row of ``df``: its id, ``n_links`` (other vectors with a cosine of at least ``threshold``),
    ``component_id`` (least id reachable by links) and ``kept`` (it is that id).

    ``epsilon``: width of the confidence bound in standard errors; ``miss``: chance that no table shows a pair that
    lies exactly at the threshold (nearer pairs are missed much less)."""
    rows = cut_lineage(keyed(df.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(vec).alias("v")), "v"))
    groups = cut_lineage(rows.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("v").alias("v")))
    found = None
    lengths = groups.groupBy(F.size("v").alias("dims")).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").collect()  # one row a length
    for r in sorted(lengths, key=lambda r: r["dims"]):
        plan = Plan(threshold, r["rows"], r["dims"], miss, epsilon, seed)
        own = groups.where(F.size("v") == r["dims"])
        codes = cut_lineage(coded(own, plan))
        marked = cut_lineage(promising(placed(codes, block), codes, plan))
        part = decided(marked, codes, own, plan)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = groups.select("id", F.lit(0).cast("bigint").alias("links"), F.col("id").alias("root")).where("false")
    found = cut_lineage(found)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    near = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    whole = groups.select("key", "id", "n").join(links, "id", "left").join(near, "id", "left").select(
        "key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))
    out = rows.select("vec_id", "key").join(whole, "key", "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.coalesce("component_id", "vec_id").alias("component_id")).withColumn("kept", F.col("vec_id") == F.col("component_id"))
