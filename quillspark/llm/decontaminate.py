"""Benchmark decontamination (operator 2).

Texts are lower-cased (A-Z) and cut into words; a window is ``n`` consecutive words of a benchmark item, or a whole
item of fewer. The windows' 64-bit hashes are a broadcast set; document tokens are scanned window by window with
vectorised hashing, every hash hit is verified against the window's words, and the words inside verified windows
are hit. Benchmarks of more than ``max_windows`` windows are cut by window hash into several sets, and the scan goes
over the rows once for each set, so that no broadcast grows beyond that bound and no window is left out.

Null and empty texts have no words and are never hit; an empty benchmark hits nothing; items without words have no
window. Windows of items with a null id hit like all others, but add no item. Every input row gives a row; equal rows give equal results.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import list_column, schema, utf8, with_kernel, word_hashes, words_of

#: Word bytes of UTF-8: digits, letters, everything outside ASCII. Fixed by the contract.
IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
HITS = "array<struct<word_start:int,word_end:int,byte_start:int,byte_end:int>>"


def tokenized(column) -> tuple:
    data, offsets = utf8(column)
    starts, ends, row = words_of(data, offsets, IS_WORD)
    lowered = LOWER[data]
    return lowered, offsets, starts, ends, row, word_hashes(lowered, starts, ends)


def window_hashes(words: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First words of the windows of ``n`` words inside one row, and the windows' hashes."""
    if len(words) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.full(len(words) - n + 1, np.uint64(n))
    for k in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[k: len(words) - n + 1 + k]
    h ^= h >> np.uint64(32)
    at = np.flatnonzero(row[: len(h)] == row[n - 1:])
    return at, h[at]


def joined(lowered, starts, ends) -> bytes:
    return b" ".join(lowered[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist()))


def benchmark_windows(items: DataFrame, item_id: str, text: str, n: int) -> DataFrame:
    """Rows ``(item, size, hash, words)``, one for each window of each item."""
    def run(batches):
        for batch in batches:
            lowered, _, starts, ends, row, h = tokenized(batch.column("text"))
            count = np.bincount(row, minlength=batch.num_rows)
            first = np.cumsum(count) - count
            ids = batch.column("item").to_pylist()
            out = []
            for i in np.flatnonzero(count).tolist():
                a, size = int(first[i]), min(n, int(count[i]))
                words = slice(a, a + int(count[i]))
                at, wh = window_hashes(h[words], row[words], size)
                for k, x in zip(at.tolist(), wh.tolist()):
                    w = slice(a + k, a + k + size)
                    out.append((ids[i], size, int(np.uint64(x).astype(np.int64)), joined(lowered, starts[w], ends[w])))
            cols = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()),
                                              pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.binary())],
                                             names=["item", "size", "hash", "words"])

    source = items.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
    return source.mapInArrow(run, "item string, size int, hash bigint, words binary").distinct()


def scan(docs: DataFrame, text: str, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text",
         n: int = 10, max_windows: int = 500_000) -> DataFrame:
    """Append ``n_words`` (long), ``hits`` (the ranges of hit words, merged where they touch, by word and UTF-8 byte)
    and ``items`` (distinct ids of the items with an occurring window, as sorted strings)."""
    windows = benchmark_windows(benchmark, item_id, item_text, n)
    parts = max(1, -(-windows.count() // max_windows))
    df = docs.drop("n_words", "hits", "items").withColumns({"hits": F.lit(None).cast(HITS), "items": F.lit(None).cast("array<string>")})
    for part in range(parts):
        rows = windows.where(F.pmod("hash", F.lit(parts)) == part).collect()   # at most about max_windows
        df = _scan_set(df, text, [(r["item"], r["size"], r["hash"], bytes(r["words"])) for r in rows])
    return df.withColumns({"hits": F.coalesce("hits", F.array().cast(HITS)),
                           "items": F.array_sort(F.coalesce("items", F.array().cast("array<string>")))})


def _scan_set(df: DataFrame, text: str, rows: list[tuple]) -> DataFrame:
    found: dict[bytes, list[str]] = {}
    hashes: dict[int, set] = {}
    for item, size, h, words in rows:
        found.setdefault(words, []).extend([item] if item is not None else [])
        hashes.setdefault(size, set()).add(h)
    sent = df.sparkSession.sparkContext.broadcast(
        (found, {k: np.sort(np.array(list(v), np.int64).astype(np.uint64)) for k, v in hashes.items()}))

    def kernel():
        items_of, sets = sent.value
        sieve = {}
        for size, s in sets.items():
            sieve[size] = np.zeros(1 << 20, bool)
            sieve[size][s >> np.uint64(44)] = True

        def f(batch):
            lowered, offsets, starts, ends, row, h = tokenized(batch.column(text))
            step = np.zeros(len(starts) + 1, np.int64)
            items: dict[int, set] = {}
            for i, x in enumerate(batch.column("items").to_pylist()):
                if x:
                    items[i] = set(x)
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            for i, x in enumerate(batch.column("hits").to_pylist()):        # of earlier sets
                for r in x or []:
                    step[first[i] + r["word_start"]] += 1
                    step[first[i] + r["word_end"]] -= 1
            for size, s in sets.items():
                at, wh = window_hashes(h, row, size)
                maybe = np.flatnonzero(sieve[size][wh >> np.uint64(44)])
                at, wh = at[maybe], wh[maybe]
                place = np.minimum(np.searchsorted(s, wh), len(s) - 1)
                for k in at[s[place] == wh].tolist():
                    got = items_of.get(joined(lowered, starts[k: k + size], ends[k: k + size]))
                    if got is not None:             # empty: a window of items without an id only
                        step[k] += 1
                        step[k + size] -= 1
                        items.setdefault(int(row[k]), set()).update(got)
            hit = np.cumsum(step[:-1]) > 0
            # runs of hit words; a run ends with its row
            edge = np.diff(np.concatenate(([False], hit, [False])).astype(np.int8))
            new_row = np.concatenate(([True], row[1:] != row[:-1])) if len(row) else np.zeros(0, bool)
            begin = np.flatnonzero((edge[:-1] == 1) | (hit & new_row))
            stop = np.flatnonzero((edge[1:] == -1) | (hit & np.concatenate((new_row[1:], [True])))) if len(row) else begin
            own = row[begin]
            base = first[own]
            counts = np.bincount(own, minlength=batch.num_rows)
            ranges = pa.StructArray.from_arrays(
                [pa.array(x.astype(np.int32)) for x in (begin - base, stop + 1 - base, starts[begin] - offsets[own], ends[stop] - offsets[own])],
                names=["word_start", "word_end", "byte_start", "byte_end"])
            return [pa.array(np.diff(first).astype(np.int64)), list_column(counts, ranges),
                    pa.array([sorted(items.get(i, ())) for i in range(batch.num_rows)], pa.list_(pa.string()))]

        return f

    # the former hits and items are inputs of the kernel, so its results come under other names first
    out = with_kernel(df.drop("n_words"), text, schema(f"n_words bigint, _hits {HITS}, _items array<string>"), kernel)
    return out.drop("hits", "items").withColumnsRenamed({"_hits": "hits", "_items": "items"})


def n_hit(hits: str = "hits") -> Column:
    """Hit words of a row of ``scan``."""
    return F.aggregate(hits, F.lit(0).cast("bigint"), lambda a, x: a + (x["word_end"] - x["word_start"]))


def remove_documents(docs: DataFrame, text: str, benchmark: DataFrame, **options) -> DataFrame:
    """Only the rows without a hit word, with the columns of ``docs``."""
    kept = scan(docs.withColumns({"_w": F.lit(0)}), text, benchmark, **options).where(F.size("hits") == 0)
    return kept.select(*docs.columns)


def remove_spans(docs: DataFrame, text: str, benchmark: DataFrame, **options) -> DataFrame:
    """All rows, each text without the bytes from the first to the last word of each hit range."""
    found = scan(docs, text, benchmark, **options)
    raw = F.encode(F.col(text), "UTF-8")
    keep = F.aggregate(
        "hits", F.struct(F.lit(0).alias("at"), F.lit("").cast("binary").alias("b")),
        lambda a, x: F.struct(x["byte_end"].alias("at"), F.concat(a["b"], F.substring(raw, a["at"] + 1, x["byte_start"] - a["at"])).alias("b")),
        lambda a: F.decode(F.concat(a["b"], F.substring(raw, a["at"] + 1, F.length(raw))), "UTF-8"))
    return found.withColumn(text, F.when(F.size("hits") > 0, keep).otherwise(F.col(text))).select(*docs.columns)
