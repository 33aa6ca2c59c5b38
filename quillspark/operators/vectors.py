"""Vector operators: normalisation, centroids, blocked similarity joins (G1, J6, J7, A25, M2), PCA.

Similarity joins are exact and blocked: rows are hashed into B blocks, each packed into one row of a table (ids and a
matrix) by one shuffle. Every pair of blocks meets in a cartesian product, whose tasks read the packed blocks again
instead of having them copied through an exchange: what is shuffled and written grows with the rows, only the
multiplications with their square. numpy keeps of a pair what the operator needs (top-k per query row, or pairs above a
threshold). Per-block top-k lists are merged with ``row_number() <= k`` (partial WindowGroupLimit before the shuffle).
"""

from __future__ import annotations

import math
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .aggregates import top_k_per_group


def l2_normalize(vec) -> Column:
    v = F.col(vec) if isinstance(vec, str) else vec
    nrm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    return F.transform(v, lambda x: F.when(nrm > 0, x.cast("double") / nrm).otherwise(F.lit(0.0)))


def centroids(df: DataFrame, group: str, vec: str, out: str = "centroid") -> DataFrame:
    """Element-wise mean vector and size per group (posexplode + grouped mean; dims are bounded)."""
    e = df.select(group, F.posexplode(vec).alias("_p", "_x"))
    m = e.groupBy(group, "_p").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    arr = m.groupBy(group).agg(F.array_sort(F.collect_list(F.struct("_p", "_m"))).alias("_a"))
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    return arr.join(sizes, group).select(group, "size", F.transform("_a", lambda s: s["_m"]).alias(out))


def _n_blocks(n: int, block_rows: int) -> int:
    return max(1, int(math.ceil(n / max(1, block_rows))))


def _packed(df: DataFrame, id_col: str, vec: str, n_blocks: int, more: Sequence[str] = (), by: str | None = None) -> DataFrame:
    """``(block, ids, mat, <more>)``: a row for each block, its vectors as the bytes of a matrix of doubles, in the order
    of falling ``by``. Written once, for the tasks of a product read it again and again."""
    base = df.select(F.pmod(F.xxhash64(F.col(id_col)), F.lit(n_blocks)).cast("int").alias("_b"), F.col(id_col).cast("long").alias("_id"), F.col(vec).alias("_v"),
                     *[F.col(c).cast("long").alias(c) for c in more])

    def pack(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if by:
            pdf = pdf.sort_values(by, ascending=False)
        mat = np.vstack([np.asarray(v, dtype=np.float64) for v in pdf["_v"]])
        return pd.DataFrame({"block": [key[0]], "ids": [pdf["_id"].to_numpy()], "mat": [mat.tobytes()], **{c: [pdf[c].to_numpy()] for c in more}})

    schema = "block int, ids array<long>, mat binary" + "".join(f", {c} array<long>" for c in more)
    return cut_lineage(base.groupBy("_b").applyInPandas(pack, schema))


def _pairs_of_blocks(blocks: DataFrame, work, schema: str, ordered: bool = True) -> DataFrame:
    """``work(left, right)`` of every pair of packed blocks (``ordered``: both ways), each a dict of arrays with ``mat`` as a matrix."""
    names = blocks.columns
    left = blocks.select(*[F.col(c).alias("l_" + c) for c in names])
    right = blocks.select(*[F.col(c).alias("r_" + c) for c in names])
    pairs = left.hint("shuffle_replicate_nl").join(right, how="cross")
    if not ordered:
        pairs = pairs.where(F.col("l_block") <= F.col("r_block"))

    def side(row, mark):
        got = {c: row[mark + c] for c in names if c != "mat"}
        ids = got["ids"] = np.asarray(got["ids"])
        got["mat"] = np.frombuffer(row[mark + "mat"], dtype=np.float64).reshape(len(ids), -1)
        return got

    def run(batches):
        for pdf in batches:
            for row in pdf.to_dict("records"):
                yield work(side(row, "l_"), side(row, "r_"))

    return pairs.mapInPandas(run, schema)


def knn(df: DataFrame, id_col: str, vec: str, k: int, metric: str = "cosine", threshold: float | None = None,
        block_rows: int = 4096, n_rows: int | None = None) -> DataFrame:
    """Exact k nearest other rows of every row: (src, dst, score, rank). ``cosine``: higher is nearer;
    ``euclidean``: score = distance, lower is nearer. Self is excluded by id; ties go to the smaller id.
    ``threshold`` keeps cosine >= t, already inside each block: ranking first and filtering then gives the same."""
    n = n_rows if n_rows is not None else df.count()
    nb = _n_blocks(n, block_rows)
    d = df.select(id_col, (l2_normalize(vec) if metric == "cosine" else F.transform(vec, lambda x: x.cast("double"))).alias(vec))
    blocks = _packed(d, id_col, vec, nb)

    def block_topk(q: dict, c: dict) -> pd.DataFrame:
        # some query rows at a time: their scores stay in the processor's cache between the steps
        return pd.concat([rows_topk(q["mat"][at: at + 256], q["ids"][at: at + 256], c["mat"], c["ids"]) for at in range(0, len(q["ids"]), 256)])

    def rows_topk(A, qi, B, ci) -> pd.DataFrame:
        if metric == "cosine":
            s = A @ B.T
            key = -s                     # a new array: the mark for self below leaves s as it is
        else:
            s = np.sqrt(np.maximum((A * A).sum(1)[:, None] + (B * B).sum(1)[None, :] - 2 * A @ B.T, 0.0))
            key = s.copy()
        # self: the block's rows of the query's id
        by = np.argsort(ci, kind="stable")
        lo, hi = np.searchsorted(ci[by], qi, "left"), np.searchsorted(ci[by], qi, "right")
        for r in np.flatnonzero(hi > lo):
            key[r, by[lo[r]: hi[r]]] = np.inf
        kk = min(k, B.shape[0])
        near = key <= -threshold if threshold is not None and metric == "cosine" else None
        if near is None or np.count_nonzero(near) > near.size // 16:
            # all that reach the k-th key of their row, ties included; the merge over blocks settles these by id
            worst = np.partition(key, kk - 1, axis=1)[:, kk - 1]
            best = (key <= worst[:, None]) & np.isfinite(key)
            near = best if near is None else near & best
        # else few pairs reach the threshold: no row needs its k-th key, the places below keep its first k
        rows, cols = np.nonzero(near)
        by = np.lexsort((ci[cols], key[rows, cols], rows))
        rows, cols = rows[by], cols[by]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, cols = rows[place < kk], cols[place < kk]
        # the expansion |a|^2 + |b|^2 - 2ab ranks well but cancels; report exact distances of the picks
        score = s[rows, cols] if metric == "cosine" else np.linalg.norm(A[rows] - B[cols], axis=1)
        return pd.DataFrame({"src": qi[rows], "dst": ci[cols], "score": score})

    cand = _pairs_of_blocks(blocks, block_topk, "src long, dst long, score double")
    order = [F.col("score").desc() if metric == "cosine" else F.col("score").asc(), F.col("dst").asc()]
    return top_k_per_group(cand, ["src"], order, k)


def similarity_pairs(df: DataFrame, id_col: str, vec: str, threshold: float, block_rows: int = 4096,
                     n_rows: int | None = None, pair_filter=None) -> DataFrame:
    """All pairs (a < b) with cosine >= threshold (J7 theta-join), exact and blocked."""
    n = n_rows if n_rows is not None else df.count()
    nb = _n_blocks(n, block_rows)
    d = df.select(id_col, l2_normalize(vec).alias(vec))
    blocks = _packed(d, id_col, vec, nb)

    def block_pairs(x: dict, y: dict) -> pd.DataFrame:
        hit = x["mat"] @ y["mat"].T
        near = (hit >= threshold) & (x["ids"][:, None] < y["ids"][None, :])
        r, c = np.nonzero(near)
        return pd.DataFrame({"a": x["ids"][r], "b": y["ids"][c], "sim": hit[r, c]})

    return _pairs_of_blocks(blocks, block_pairs, "a long, b long, sim double")


def last_similar(df: DataFrame, id_col: str, vec: str, size: str, pos: str, small: int, threshold: float, block_rows: int = 4096) -> DataFrame:
    """``(node, target)``: of the rows with cosine >= ``threshold`` that ``node`` may merge into, the one of the greatest
    ``pos``. One side is smaller than ``small``; the smaller merges into the larger, at equal sizes the earlier into the
    later. A pair of blocks gives at most one partner a row, so the similar pairs, which can be nearly all, are not kept."""
    nb = _n_blocks(df.count(), block_rows)
    blocks = _packed(df.select(id_col, l2_normalize(vec).alias(vec), size, pos), id_col, vec, nb, [size, pos], by=pos)

    def last(x: dict, y: dict) -> pd.DataFrame:
        sx, sy, px, py = (np.asarray(v)[:, None] if k else np.asarray(v)[None, :] for v, k in ((x[size], 1), (y[size], 0), (x[pos], 1), (y[pos], 0)))
        ok = (x["mat"] @ y["mat"].T >= threshold) & ((sx < small) | (sy < small)) & ((sy > sx) | ((sy == sx) & (py > px)))
        at = ok.argmax(axis=1)                       # rows lie in the order of falling positions
        has = np.flatnonzero(ok[np.arange(len(at)), at])
        return pd.DataFrame({"node": x["ids"][has], "target": y["ids"][at[has]], "p": np.asarray(y[pos])[at[has]]})

    found = _pairs_of_blocks(blocks, last, "node long, target long, p long")
    return found.groupBy("node").agg(F.max_by("target", "p").alias("target"))


def undirected_edges(top: DataFrame, src: str = "src", dst: str = "dst", w: str = "score") -> DataFrame:
    """An edge exists if either end picked the other: (least, greatest) with the larger weight."""
    return (top.select(F.least(src, dst).alias("src"), F.greatest(src, dst).alias("dst"), F.col(w).alias("weight"))
               .groupBy("src", "dst").agg(F.max("weight").alias("weight")))


def pca_2d(df: DataFrame, id_col: str, vec: str, k: int = 2) -> DataFrame:
    """Projection on the top-k principal components (spark.ml PCA)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array
    v = df.select(id_col, array_to_vector(F.transform(vec, lambda x: x.cast("double"))).alias("_f"))
    model = PCA(k=k, inputCol="_f", outputCol="_p").fit(v)
    out = model.transform(v).select(id_col, vector_to_array("_p").alias("_a"))
    return out.select(id_col, *[F.col("_a")[i].alias(f"pc{i}") for i in range(k)])
