"""Toxicity by maximum-scoring segments (operator 7).

1. Word statistics: for every hashed word the numbers of toxic and of other training documents that hold it give a
   log-odds ratio with an informative Dirichlet prior (the words' shares in all documents), shrunk by its standard
   error. Every token scores that much, less a constant, so that an ordinary text has a negative mean.
2. Scan: one linear pass over the token scores of a whole text finds all maximal scoring segments; those above a
   significance threshold are the toxic passages.
3. Extreme-value calibration: under the score distribution of ordinary documents, lambda solves E[exp(lambda s)] = 1
   and K follows from the best segments of ordinary calibration documents, so a segment of score S in n tokens has
   an expected number of K n exp(-lambda S) chance equals. A logistic curve fitted on all calibration documents turns
   that into the probability of the label.

Counts cover all labelled documents, as sums over a fixed number of word buckets. Word counts and calibration come
from different documents. Null and empty texts score the curve's value for no segment. Every input row gives a row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import list_column, schema, slices, utf8, with_kernel, word_hashes, words_of

BUCKET_BITS = 18
IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 or b == 39 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
SEGMENTS = "array<struct<byte_start:int,byte_end:int,score:double>>"


def tokens(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, first byte in the row, end byte in the row) of every word."""
    data, offsets = utf8(column)
    starts, ends, row = words_of(data, offsets, IS_WORD)
    bucket = (word_hashes(LOWER[data], starts, ends) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    base = offsets[row] if len(row) else starts
    return row, bucket, starts - base, ends - base


def document_counts(labelled: DataFrame, text: str, label: str) -> DataFrame:
    """``(bucket, toxic, other)``: documents of each label that hold a word of the bucket; bucket -1 counts documents."""
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                row, bucket, _, _ = tokens(part.column("text"))
                y = np.asarray(part.column("label").to_numpy(zero_copy_only=False), np.int64)
                seen = np.unique(row.astype(np.int64) << BUCKET_BITS | bucket)
                toxic = y[seen >> BUCKET_BITS] == 1
                bucket = seen & ((1 << BUCKET_BITS) - 1)
                keys, at = np.unique(bucket, return_inverse=True)
                a = np.bincount(at, weights=toxic, minlength=len(keys)).astype(np.int64)
                n = np.bincount(at, minlength=len(keys))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.append(keys, -1)), pa.array(np.append(a, (y == 1).sum())), pa.array(np.append(n - a, (y != 1).sum()))],
                    names=["bucket", "toxic", "other"])

    source = labelled.select(F.col(text).alias("text"), F.col(label).cast("int").alias("label"))
    return source.mapInArrow(run, "bucket bigint, toxic bigint, other bigint").groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def log_odds(counts: list, prior: float, shrink: float) -> np.ndarray:
    """Shrunk log-odds ratio of every bucket."""
    size = 1 << BUCKET_BITS
    a, b, total = np.zeros(size), np.zeros(size), (0, 0)
    for r in counts:
        if r["bucket"] < 0:
            total = (r["toxic"], r["other"])
        else:
            a[r["bucket"]], b[r["bucket"]] = r["toxic"], r["other"]
    if not total[0] or not total[1]:
        return np.zeros(size)
    share = (a + b) / sum(total)
    pa_, pb = prior * share + 0.01, prior * share + 0.01
    xa, xb = a + pa_, b + pb
    na, nb = total[0] + prior + 0.02, total[1] + prior + 0.02
    delta = np.log(xa / np.maximum(na - xa, 0.5)) - np.log(xb / np.maximum(nb - xb, 0.5))
    sd = np.sqrt(1 / xa + 1 / xb)
    return np.sign(delta) * np.maximum(0, np.abs(delta) - shrink * sd)


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)`` of a sequence, in one linear pass (Ruzzo and Tompa).

    A candidate keeps the sums before its start (l) and at its end (r). A new one joins the last candidate with a
    smaller l if its own r is greater than that one's; every step of the search drops or keeps a candidate for good."""
    stack: list[list] = []              # [start, end, l, r, index of the last candidate with a smaller l]
    total = 0.0
    for i, s in enumerate(scores):
        before, total = total, total + s
        if s <= 0:
            continue
        new = [i, i + 1, before, total, -1]
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= new[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= new[3]:
                new[4] = j
                stack.append(new)
                break
            new = [stack[j][0], new[1], stack[j][2], new[3], -1]
            del stack[j:]
    return [(a, b, r - l) for a, b, l, r, _ in stack]


@dataclass
class Model:
    score: np.ndarray           # of every word bucket
    lam: float
    k: float
    slope: float
    shift: float

    def evidence(self) -> Column:
        """Of ``(n_tokens, best)``: minus the log of the expected number of chance segments as good as the best."""
        e = F.lit(self.lam) * F.col("best") - F.log(F.lit(self.k) * F.greatest(F.col("n_tokens"), F.lit(1)))
        return F.greatest(F.lit(-20.0), F.least(F.lit(200.0), F.when(F.col("best") > 0, e).otherwise(-20.0)))

    def probability(self) -> Column:
        return 1 / (1 + F.exp(-(F.lit(self.slope) * self.evidence() + F.lit(self.shift))))


def _lambda(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(lambda s)] = 1."""
    if (scores * weights).sum() >= 0 or scores.max() <= 0:
        return 1.0
    low, high = 1e-6, 1.0
    f = lambda x: (weights * np.exp(np.minimum(x * scores, 500))).sum() - 1
    while f(high) < 0 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if f(mid) < 0 else (low, mid)
    return (low + high) / 2


def best_segments(df: DataFrame, text: str, score: np.ndarray, least: float | None = None) -> DataFrame:
    """Append ``n_tokens``, ``best`` (the greatest segment score, 0 without one) and, of score ``least`` or more,
    ``segments`` by place."""
    sent = df.sparkSession.sparkContext.broadcast(score.astype(np.float32))     # 2^BUCKET_BITS floats

    def kernel():
        table = sent.value.astype(np.float64)

        def f(batch):
            row, bucket, start, end = tokens(batch.column(text))
            s = table[bucket]
            # neighbours of one sign are one step of the scan: no maximal segment ends inside them
            up = s > 0
            cut = np.flatnonzero(np.concatenate(([True], (up[1:] != up[:-1]) | (row[1:] != row[:-1])))) if len(s) else np.zeros(0, np.int64)
            sums = np.add.reduceat(s, cut) if len(cut) else np.zeros(0)
            stop = np.append(cut[1:], len(s))
            per_row = np.searchsorted(row[cut] if len(cut) else row, np.arange(batch.num_rows + 1))
            best, found = np.zeros(batch.num_rows), []
            for i in range(batch.num_rows):
                a, b = per_row[i], per_row[i + 1]
                segs = segments(sums[a:b].tolist()) if b > a else []
                best[i] = max((x[2] for x in segs), default=0.0)
                found.append([(a + x, a + y - 1, z) for x, y, z in segs if z >= least] if least is not None else [])
            flat = [x for y in found for x in y]
            col = pa.StructArray.from_arrays(
                [pa.array([int(start[cut[a]]) for a, _, _ in flat], pa.int32()), pa.array([int(end[stop[b] - 1]) for _, b, _ in flat], pa.int32()),
                 pa.array([z for _, _, z in flat], pa.float64())], names=["byte_start", "byte_end", "score"])
            n = np.bincount(row, minlength=batch.num_rows)
            return [pa.array(n.astype(np.int64)), pa.array(best), list_column(np.array([len(x) for x in found], np.int64), col)]

        return f

    return with_kernel(df, text, schema(f"n_tokens bigint, best double, segments {SEGMENTS}"), kernel)


def word_scores(labelled: DataFrame, text: str, label: str, prior: float = 50.0, shrink: float = 1.0,
                cost: float = 1.0) -> tuple[np.ndarray, float]:
    """The score of every word bucket, and lambda of the scores in the ordinary documents among ``labelled``."""
    counts = document_counts(labelled, text, label).collect()           # 2^BUCKET_BITS rows at most
    score = log_odds(counts, prior, shrink) - cost
    other = [r for r in counts if r["bucket"] >= 0]
    w = np.array([r["other"] for r in other], float)
    return score, _lambda(score[[r["bucket"] for r in other]], w / w.sum()) if len(w) and w.sum() else 1.0


def calibrated(score: np.ndarray, lam: float, found: DataFrame, label: str) -> Model:
    """K and the logistic curve from calibration documents ``found (n_tokens, best, label)``."""
    cal = found.select("n_tokens", "best", F.col(label).cast("int").alias("_y")).persist()
    r = cal.where("_y <> 1").agg(F.avg(F.col("n_tokens") * F.exp(-lam * F.col("best"))).alias("m")).first()
    model = Model(score, lam, 1 / max(r["m"] or 1.0, 1e-9), 1.0, -3.0)
    # the logistic curve on counts by evidence, in steps of a tenth: all calibration documents, a bounded table
    bins = cal.groupBy(F.round(model.evidence(), 1).alias("x")).agg(
        F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).alias("pos"), F.count(F.lit(1)).alias("n")).collect()
    cal.unpersist()
    if bins and 0 < sum(b["pos"] for b in bins) < sum(b["n"] for b in bins):
        model.slope, model.shift = _logistic(*(np.array([float(b[c]) for b in bins]) for c in ("x", "pos", "n")))
    return model


def fit(labelled: DataFrame, text: str, label: str, calibrate: Column, **options) -> Model:
    """Learn from ``labelled``: word scores from the rows where ``calibrate`` is false, the rest from the others."""
    marked = labelled.withColumn("_cal", calibrate)
    score, lam = word_scores(marked.where("not _cal"), text, label, **options)
    held = marked.where("_cal").select(text, F.col(label).alias("_label"))
    return calibrated(score, lam, best_segments(held, text, score), "_label")


def _logistic(x, pos, n) -> tuple[float, float]:
    """Slope and shift by Newton steps; a weak ridge keeps separable data finite."""
    a, b = 0.1, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-(a * x + b)))
        g = np.array([((pos - n * p) * x).sum() - 1e-2 * a, (pos - n * p).sum() - 1e-2 * b])
        v = n * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-2, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-2]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(max(a, 1e-6)), float(b)


def predict(df: DataFrame, text: str, model: Model, significance: float = 0.05) -> DataFrame:
    """Append ``score`` (0 to 1) and ``passages``: segments with an expected number of chance equals in their text
    below ``significance``, as UTF-8 byte ranges with that number."""
    found = best_segments(df, text, model.score, least=0.0)
    expected = lambda s, n: F.lit(model.k) * n * F.exp(-F.lit(model.lam) * s)
    passages = F.filter(F.transform("segments", lambda x: F.struct(x["byte_start"].alias("byte_start"), x["byte_end"].alias("byte_end"),
                                                                  x["score"].alias("score"), expected(x["score"], F.col("n_tokens")).alias("expected"))),
                        lambda x: x["expected"] < significance)
    return found.withColumn("score", model.probability()).withColumn("passages", passages).drop("n_tokens", "best", "segments")
