"""Language identification (operator 3).

A text is the average of the hashed embeddings of its subwords (runs of two to four bytes over folded letters and
word borders); a linear softmax reads the language from it. Embeddings and softmax are trained together by stochastic
gradient descent in numpy on a bounded sample of labelled rows. Held-back rows of the sample calibrate a temperature
and the confidence below which a prediction is rejected.

Because the text's vector is an average and the output is linear, scoring averages the products of the two tables:
the same numbers, one gather for each subword. Counting and scoring cover whole texts.

Null texts and texts without a letter get ``und`` with score 0 and are rejected; without labelled rows every text is
``und``. Every input row gives a row; language, source and id are never read when predicting.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SMALL_SLICE, schema, utf8, with_kernel

BUCKET_BITS = 15
SIZES = (2, 3, 4)
#: Letters stay (A-Z in lower case), all else becomes a word border.
FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)
NO_LANGUAGE = "und"
#: Held-back rows whose vectors are averaged at a time on the driver.
HELD_ROWS = 32


def subwords(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every subword: byte runs inside a row, of which at most the first or last is a border."""
    data, offsets = utf8(column)
    low = FOLD[data].astype(np.uint32)
    border = low == 32
    row = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    rows, buckets = [], []
    for n in SIZES:
        if len(low) < n:
            continue
        m = len(low) - n + 1
        h = np.zeros(m, np.uint32)
        ok = row[:m] == row[n - 1:]
        for k in range(n):
            h = h * np.uint32(0x01000193) + low[k: m + k]
            if 0 < k < n - 1:
                ok &= ~border[k: m + k]
        ok &= ~(border[:m] & border[n - 1:]) if n > 1 else True
        h = ((h ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)
        rows.append(row[:m][ok])
        buckets.append(h[ok])
    if not rows:
        return np.zeros(0, np.int32), np.zeros(0, np.uint32)
    return np.concatenate(rows), np.concatenate(buckets)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass
class Model:
    langs: list[str]
    embedding: np.ndarray          # buckets x dims
    softmax: np.ndarray            # dims x languages
    temperature: float
    reject_below: float

    def table(self) -> np.ndarray:
        return (self.embedding @ self.softmax).astype(np.float32)


def packed_numbers(x: np.ndarray) -> bytes:
    """32-bit integers as their compressed steps: what the driver gets of a text, a fraction of its counts."""
    return zlib.compress(np.diff(x, prepend=x.dtype.type(0)).tobytes(), 1)


def unpacked_numbers(packed: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(packed), "<i4"), dtype="<i4")


def sample_counts(labelled: DataFrame, doc_id: str, text: str, lang: str, sample_rows: int) -> list:
    """Bucket counts of about ``sample_rows`` labelled rows picked by a hash of the id (never more); the rest of the
    rows isn't read beyond that pick."""
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    n = known.count()
    if n == 0:
        return []
    place = F.xxhash64(F.col(doc_id).cast("string"), F.lit("language sample"))
    share = min(1.0, 1.1 * sample_rows / n)
    picked = known.withColumn("_h", place).where(F.pmod("_h", F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    picked = picked.select("_h", F.col(text).alias("text"), F.col(lang).alias("lang"))

    def kernel():
        def f(batch):
            row, bucket = subwords(batch.column("text"))
            keys, n = np.unique(row.astype(np.int64) << BUCKET_BITS | bucket, return_counts=True)
            cuts = np.searchsorted(keys >> BUCKET_BITS, np.arange(batch.num_rows + 1)).tolist()
            bucket = (keys & ((1 << BUCKET_BITS) - 1)).astype("<i4")
            packed = [[packed_numbers(x[a:b]) for a, b in zip(cuts[:-1], cuts[1:])] for x in (bucket, n.astype("<i4"))]
            return [pa.array(p, pa.binary()) for p in packed]
        return f

    counted = with_kernel(picked, "text", schema("bucket binary, n binary"), kernel, SMALL_SLICE).drop("text")
    # bounded by sample_rows x buckets, packed
    rows = counted.orderBy("_h", "lang").limit(sample_rows).collect()
    return [(r["lang"], unpacked_numbers(r["bucket"]), unpacked_numbers(r["n"])) for r in rows]


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample_rows: int = 3000,
        dims: int = 16, epochs: int = 12, rate: float = 0.5, batch: int = 16, reject_share: float = 0.001, seed: int = 11) -> Model | None:
    """Train on ``labelled``; None without a labelled row. ``sample_rows`` bounds the training sample."""
    rows = [r for r in sample_counts(labelled, doc_id, text, lang, sample_rows) if len(r[1])]
    if not rows:
        return None
    langs = sorted({r[0] for r in rows})
    y = np.array([langs.index(r[0]) for r in rows])
    idx = [r[1] for r in rows]
    wgt = [(r[2] / r[2].sum()).astype(np.float32) for r in rows]
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(rows))
    held, train = order[: len(rows) // 5], order[len(rows) // 5:]
    emb = rng.uniform(-1 / dims, 1 / dims, (1 << BUCKET_BITS, dims)).astype(np.float32)
    soft = np.zeros((dims, len(langs)), np.float32)

    def averages(which):
        flat = np.concatenate([idx[i] for i in which])
        w = np.concatenate([wgt[i] for i in which])
        cuts = np.cumsum([0, *[len(idx[i]) for i in which]])
        return np.add.reduceat(emb[flat] * w[:, None], cuts[:-1]), flat, w, np.diff(cuts)

    steps, total = 0, epochs * -(-len(train) // batch)
    for _ in range(epochs):
        rng.shuffle(train)
        for s in range(0, len(train), batch):
            some = train[s: s + batch]
            lr = rate * batch * (1 - steps / total)
            steps += 1
            x, flat, w, size = averages(some)
            z = x @ soft
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(some)), y[some]] -= 1
            p /= len(some)
            grad = p @ soft.T
            soft -= lr * (x.T @ p)
            by = np.argsort(flat, kind="stable")
            f = flat[by]
            cuts = np.flatnonzero(np.concatenate(([True], f[1:] != f[:-1])))
            emb[f[cuts]] -= lr * np.add.reduceat((w[:, None] * np.repeat(grad, size, 0))[by], cuts)
    if not len(held):
        return Model(langs, emb, soft, 1.0, 0.0)
    z = np.concatenate([averages(held[s: s + HELD_ROWS])[0] for s in range(0, len(held), HELD_ROWS)]) @ soft

    def calibrated(t):
        p = np.exp((z - z.max(1, keepdims=True)) / t)
        return p / p.sum(1, keepdims=True)

    grid = np.exp(np.linspace(-2, 3, 41))
    losses = [-np.log(calibrated(t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in grid]
    t = float(grid[int(np.argmin(losses))])
    p = calibrated(t)
    right = p.argmax(1) == y[held]
    # the confidence that all but reject_share of the right predictions reach; a prediction more likely than not stays
    low = float(np.quantile(p.max(1)[right], reject_share, method="lower")) if right.any() else 0.0
    return Model(langs, emb, soft, t, min(low, 0.5))


def predict(df: DataFrame, text: str, model: Model | None) -> DataFrame:
    """Append ``lang_pred``, ``score`` (calibrated probability) and ``rejected`` (boolean)."""
    langs = model.langs if model else []
    table = model.table() if model else np.zeros((1 << BUCKET_BITS, 0), np.float32)
    sent = df.sparkSession.sparkContext.broadcast(table)       # 2^15 buckets x languages
    heat, low = (model.temperature, model.reject_below) if model else (1.0, 1.0)

    def kernel():
        w = sent.value

        def f(batch):
            n = batch.num_rows
            spoken = np.array([has_letter(t) for t in batch.column(text).to_pylist()], bool)
            if not langs:
                return [pa.array([NO_LANGUAGE] * n), pa.array(np.zeros(n)), pa.array(np.ones(n, bool))]
            row, bucket = subwords(batch.column(text))
            count = np.bincount(row, minlength=n)
            z = np.empty((n, len(langs)))
            for k in range(len(langs)):
                z[:, k] = np.bincount(row, weights=w[:, k][bucket], minlength=n) / np.maximum(count, 1)
            z /= heat
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            best = p.argmax(1)
            score = np.where(spoken, p.max(1), 0.0)
            names = [langs[b] if s else NO_LANGUAGE for b, s in zip(best.tolist(), spoken.tolist())]
            return [pa.array(names), pa.array(score), pa.array((score < low) | ~spoken)]

        return f

    return with_kernel(df, text, schema("lang_pred string, score double, rejected boolean"), kernel, SMALL_SLICE)
