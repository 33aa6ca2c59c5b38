"""Byte-level BPE encoding and decoding (operator 1).

Texts are cut by the vocabulary's pattern; each distinct piece of a slice of rows is merged once. Pieces are
grouped by length into padded matrices of token ids. In each round every row of a matrix merges its leftmost pair
of minimum rank: ranks of neighbouring pairs stand in a second matrix, whose row minimum names the pair; a merge
touches two entries of it, looked up in a hash table of id pairs. Finished rows are compacted away. Pieces above
``LONG`` bytes are merged by the same rule with a heap over the same pair table, so that they cost n log n.

Null and empty texts have no tokens. Every input row gives a row; columns other than those named are kept by the
operators and never read. Any byte string decodes back exactly.
"""

from __future__ import annotations

import base64
import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import list_column, schema, utf8, with_kernel

NONE = np.int32(2**31 - 1)
WIDTHS = (2, 4, 8, 16, 32, 64, 128, 256, 512, 1024)
LONG = WIDTHS[-1]
#: Distinct pieces a task remembers between slices; then it forgets them all (memory, not results).
REMEMBER = 300_000


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a file of ``base64 rank`` lines. Read on the driver; its size is the vocabulary's."""
    tokens: dict[int, bytes] = {}
    with open(path, "rb") as f:
        for line in f:
            if line.strip():
                token, rank = line.split()
                tokens[int(rank)] = base64.b64decode(token)
    return [tokens.get(i, b"") for i in range(max(tokens) + 1)]


def pair_table(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All id pairs whose joined bytes are a token: keys ``left * len(tokens) + right`` and the ranks."""
    rank = {t: i for i, t in enumerate(tokens) if t}
    keys, vals = [], []
    for t, r in rank.items():
        for k in range(1, len(t)):
            a, b = rank.get(t[:k]), rank.get(t[k:])
            if a is not None and b is not None:
                keys.append(a * len(tokens) + b)
                vals.append(r)
    return np.array(keys, np.int64), np.array(vals, np.int32)


class PairHash:
    """Open addressing in numpy: key -> rank, ``NONE`` where absent."""

    def __init__(self, keys: np.ndarray, vals: np.ndarray):
        self.bits = max(4, int(len(keys)).bit_length() + 1)
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.vals = np.full(1 << self.bits, NONE, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]      # of several takers of a slot the last one has it
            had = self.keys[slot] == keys[left]
            self.vals[slot[had]] = vals[left[had]]
            left, slot = left[~had], (slot[~had] + 1) & self.mask

    def _slot(self, keys):
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self._slot(keys)
        seen = self.keys[slot]
        out = np.where(seen == keys, self.vals[slot], NONE)
        left = np.flatnonzero((seen != keys) & (seen != -1))
        slot = slot[left]
        while len(left):
            slot = (slot + 1) & self.mask
            seen = self.keys[slot]
            hit = seen == keys[left]
            out[left[hit]] = self.vals[slot[hit]]
            on = ~hit & (seen != -1)
            left, slot = left[on], slot[on]
        return out


class Merger:
    def __init__(self, tokens: list[bytes], keys: np.ndarray, vals: np.ndarray):
        self.tokens, self.n = tokens, len(tokens)
        self.rank = {t: i for i, t in enumerate(tokens) if t}
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        self.pairs, self.raw, self.slow = PairHash(keys, vals), (keys, vals), None

    def _ranks(self, a, b):
        return self.pairs.get(a.astype(np.int64) * self.n + b)

    def merge_matrix(self, ids: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of byte ids, padded: (tokens of all rows end to end, tokens in each row)."""
        rows, width = ids.shape
        col = np.arange(width, dtype=np.int32)
        alive = col < length[:, None]
        pair = np.full((rows, width), NONE, np.int32)
        r, c = np.nonzero(col[:-1] < length[:, None] - 1)
        pair[r, c] = self._ranks(ids[r, c], ids[r, c + 1])
        nxt = np.broadcast_to(col + 1, (rows, width)).copy()
        prv = np.broadcast_to(col - 1, (rows, width)).copy()
        at, cut = np.arange(rows), length.astype(np.int32)
        while len(at):
            j = pair.argmin(1)
            i = np.arange(len(at))
            best = pair[i, j]
            live = np.flatnonzero(best != NONE)
            if not len(live):
                break
            if len(live) < 0.8 * len(at):            # compaction: finished rows go
                at, pair, nxt, prv, cut = at[live], pair[live], nxt[live], prv[live], cut[live]
                j, best, i = j[live], best[live], i[: len(live)]
            else:
                i, j, best = live, j[live], best[live]
            row = at[i]
            k = nxt[i, j]                            # the pair's right token goes
            ids[row, j] = best
            alive[row, k] = False
            pair[i, k] = NONE
            after = nxt[i, k]
            nxt[i, j] = after
            has = after < cut[i]
            prv[i[has], after[has]] = j[has]
            pair[i, j] = NONE
            pair[i[has], j[has]] = self._ranks(best[has], ids[row[has], after[has]])
            left = prv[i, j]
            has = left >= 0
            pair[i[has], left[has]] = self._ranks(ids[row[has], left[has]], best[has])
        return ids[alive], alive.sum(1)

    def merge_long(self, piece: bytes) -> np.ndarray:
        """One long piece: the same rule with a heap of (rank, position)."""
        if self.slow is None:
            self.slow = dict(zip(self.raw[0].tolist(), self.raw[1].tolist()))
        get, n = self.slow.get, self.n
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        end = len(ids)
        nxt, prv = list(range(1, end + 1)), list(range(-1, end - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(end - 1) if (r := get(ids[i] * n + ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            k = nxt[i]
            if ids[i] != a or k >= end or ids[k] != b:
                continue                             # one of the two has merged meanwhile
            ids[i], ids[k] = r, -1
            nxt[i] = nxt[k]
            if nxt[i] < end:
                prv[nxt[i]] = i
                if (x := get(r * n + ids[nxt[i]])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[nxt[i]]))
            if prv[i] >= 0 and (x := get(ids[prv[i]] * n + r)) is not None:
                heapq.heappush(heap, (x, prv[i], ids[prv[i]], r))
        return np.array([x for x in ids if x >= 0], np.int32)

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Token ids of each piece as little-endian unsigned 32-bit integers."""
        out: list = [None] * len(pieces)
        groups: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.rank.get(p)                 # a piece that is a token is that token
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > LONG:
                out[i] = self.merge_long(p).astype("<u4").tobytes()
            else:
                groups.setdefault(int(np.searchsorted(WIDTHS, len(p))), []).append(i)
        for g, members in groups.items():
            width = WIDTHS[g]
            step = max(1, (1 << 21) // width)
            for s in range(0, len(members), step):
                some = members[s: s + step]
                raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in some), np.uint8)
                length = np.array([len(pieces[i]) for i in some])
                flat, counts = self.merge_matrix(self.byte[raw].reshape(len(some), width), length)
                flat, ends = flat.astype("<u4").tobytes(), (np.cumsum(counts) * 4).tolist()
                for i, a, b in zip(some, [0, *ends], ends):
                    out[i] = flat[a:b]
        return out


def encode(df: DataFrame, text: str, ranks_path: str, pattern: str, out: str = "ids", packed: bool = False) -> DataFrame:
    """Append ``out``: token ids of the whole text as ``array<int>``, or packed as little-endian unsigned 32-bit
    integers in a binary column; and ``n_tokens`` (long). Special tokens are ordinary text.

    The vocabulary (a fixed file, not the data) is read on the driver and broadcast with its pair table."""
    tokens = load_ranks(ranks_path)
    sent = df.sparkSession.sparkContext.broadcast((tokens, *pair_table(tokens)))

    def kernel():
        import regex
        split, merger, known = regex.compile(pattern).findall, Merger(*sent.value), {}

        def f(batch):
            nonlocal known
            if len(known) > REMEMBER:
                known = {}
            cut = [split(t) if t else [] for t in batch.column(text).to_pylist()]
            fresh = list(set().union(*cut) - known.keys())
            known.update(zip(fresh, merger.encode([p.encode() for p in fresh])))
            ids = [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
            counts = np.array([len(x) // 4 for x in ids], np.int64)
            if packed:
                col = pa.array(ids, pa.binary())
            else:
                col = list_column(counts, pa.array(np.frombuffer(b"".join(ids), "<u4").astype(np.int32)))
            return [col, pa.array(counts)]

        return f

    return with_kernel(df, text, schema(f"`{out}` {'binary' if packed else 'array<int>'}, n_tokens bigint"), kernel)


def decode(df: DataFrame, ids: str, ranks_path: str, out: str = "decoded") -> DataFrame:
    """Append ``out`` (binary): the bytes of the tokens in the packed or ``array<int>`` column ``ids``.
    An id outside the vocabulary raises."""
    tokens = load_ranks(ranks_path)
    sent = df.sparkSession.sparkContext.broadcast(tokens)
    is_array = dict(df.dtypes)[ids].startswith("array")

    def kernel():
        table = np.frombuffer(b"".join(sent.value), np.uint8)
        size = np.array([len(t) for t in sent.value], np.int64)
        start = np.cumsum(size) - size

        def gather(x):
            n = size[x]
            ends = np.cumsum(n)
            return table[np.repeat(start[x] - (ends - n), n) + np.arange(int(ends[-1]) if len(ends) else 0)].tobytes()

        def f(batch):
            col = batch.column(ids)
            if is_array:
                rows = [np.asarray(x or [], np.int64) for x in col.to_pylist()]
            else:
                data, at = utf8(col)
                flat = np.frombuffer(data.tobytes(), "<u4").astype(np.int64)
                rows = [flat[a:b] for a, b in zip(at[:-1] // 4, at[1:] // 4)]
            return [pa.array([gather(x) for x in rows], pa.binary())]

        return f

    if is_array:                                     # slices are cut by bytes, which a list column hasn't
        from pyspark.sql import functions as F
        return with_kernel(df.withColumn("_cut", F.lit("")), "_cut", schema(f"`{out}` binary"), kernel).drop("_cut")
    return with_kernel(df, ids, schema(f"`{out}` binary"), kernel)
