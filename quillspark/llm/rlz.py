"""Substring dedup by relative Lempel-Ziv parsing: words that a long factor of an earlier document covers go.

Documents are parsed, in the order of their ids, against reference blocks, and what a block's index holds is the first
place of every window of ``window`` words. A factor follows its reference from the place where the index finds it for as
long as the reference goes on alike; where it ends, the next window is looked up anew, so windows that lie across the
border of two factors are found as well. Factors of a window or more, taken from a document with a smaller id, are the
duplicate spans.

There are two kinds of blocks, and every document is parsed against all that can hold one of its windows:

* the documents that a task reads together (``BLOCK_WORDS``): what repeats inside them is found without a shuffle, and
  only first places go on, so a passage in a third of all documents leaves a task once for each of its blocks;
* a block for each anchor. The anchor of a window is the least hash of its ``ANCHOR``-word shingles; neighbouring windows
  mostly share it and travel as one run of window hashes. Equal windows have equal anchors, so all of them meet there.

An anchor of very many documents (a common line whose neighbours differ) would be one hot block. Such anchors are
recognised on a sample of documents, which decides on nothing but the place of work, and their runs are dealt out
window by window.

Windows are compared by 64-bit hashes inside a task and by anchor and 48 bits of their hash across tasks.

Null and empty texts have no words. Rows whose id is null neither lose words nor serve as reference. Rows that repeat an
id are one document in that none of them is a smaller one to the other. An empty table gives an empty result. Columns
that clash with the appended ones are replaced. Texts of any length are parsed whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import mixed, powers, schema, slices, utf8, with_kernel, word_hashes, words_of
from .line_dedup import sieve, sifted

#: Words of a shingle that can be an anchor.
ANCHOR = 5
#: Words of the documents that a task parses against each other.
BLOCK_WORDS = 1 << 20
#: One document in so many is looked at for hot anchors; an anchor is hot if it stands in this share of them.
SAMPLE, HOT_SHARE, HOT_LEAST = 16, 0.005, 40
#: Bytes of a window's hash that travel with its anchor.
CARRIED = 6

RUN = "key long, doc_id long, crc int, start int, n int, prints binary"

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, 9, 10, 11, 12, 13]] = False


def _rolling(values: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of every ``k`` consecutive values."""
    n, p = len(values) - k + 1, powers(k, np.uint64(0x9E3779B97F4A7C15))
    out = values[:n] * p[0]
    for j in range(1, k):
        out += values[j: n + j] * p[j]
    return mixed(out)


def _windows(words: np.ndarray, doc: np.ndarray, window: int):
    """Places of all windows that lie in one document, their hashes and anchors. ``words`` are hashes."""
    n = len(words) - window + 1
    if n <= 0:
        z = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), z, z
    at = np.flatnonzero(doc[:n] == doc[window - 1:])
    shingles = _rolling(words, ANCHOR)
    anchors = shingles[:n].copy()
    for j in range(1, window - ANCHOR + 1):
        np.minimum(anchors, shingles[j: n + j], out=anchors)
    return at, _rolling(words, window)[at], anchors[at]


def _first_places(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """For every item the first item with its keys; ``order`` is a stable sort by the keys."""
    if not len(order):
        return order
    new = np.zeros(len(order), bool)
    new[0] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.empty(len(order), np.int64)
    out[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return out


def _factors(taken: np.ndarray, follows: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Greedy factors: first windows and numbers of windows. ``taken``: the window stands in an earlier document,
    ``follows``: it begins a word after the window before it in the same document, ``first``: its place in the index."""
    if not len(taken):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    goes_on = np.zeros(len(taken), bool)
    goes_on[1:] = taken[1:] & taken[:-1] & follows[1:] & (first[1:] == first[:-1] + 1)
    begins = np.flatnonzero(taken & ~goes_on)
    return begins, np.add.reduceat(taken, begins, dtype=np.int64) if len(begins) else begins


def _ends(begins: np.ndarray, lengths: np.ndarray, window: int, start: np.ndarray):
    return start[begins].astype(np.int32), (lengths + window - 1).astype(np.int32)


def _cut(at: np.ndarray, doc: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """First items of the runs of neighbouring windows of one document with one anchor."""
    if not len(at):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (anchor[1:] != anchor[:-1])]))


def _block(parts: list, window: int, hot: np.ndarray) -> pa.RecordBatch:
    """Parse the documents of a block against each other. Out go the factors (``prints`` null) and the runs of windows
    that stand in the block for the first time."""
    ids = np.concatenate([p[0] for p in parts])
    crc = np.concatenate([p[1] for p in parts])
    counts = np.concatenate([p[2] for p in parts])
    words = np.concatenate([p[3] for p in parts])
    by_id = np.argsort(ids, kind="stable")
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    ids, crc, counts, begin = ids[by_id], crc[by_id], counts[by_id], begin[by_id]
    place = np.concatenate([[0], np.cumsum(counts)])
    doc = np.repeat(np.arange(len(ids)), counts)
    words = words[np.repeat(begin - place[:-1], counts) + np.arange(len(doc))]
    at, prints, anchors = _windows(words, doc, window)
    d = doc[at]
    first = _first_places(np.argsort(prints, kind="stable"), prints)
    taken = ids[d[first]] < ids[d]
    follows = np.zeros(len(at), bool)
    follows[1:] = (at[1:] == at[:-1] + 1) & (d[1:] == d[:-1])
    begins, lengths = _factors(taken, follows, first)
    f_start, f_words = _ends(begins, lengths, window, at - place[d])
    f_doc = d[begins]
    left = ~taken
    at, prints, anchors, d = at[left], prints[left], anchors[left], d[left]
    key = anchors.copy()
    if len(hot):
        is_hot = hot[np.minimum(np.searchsorted(hot, anchors), len(hot) - 1)] == anchors
        key[is_hot] = mixed(anchors[is_hot] ^ prints[is_hot])     # a key of its own for each different window
    heads = _cut(at, d, key)
    sizes = np.diff(np.concatenate([heads, [len(at)]]))
    packed = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8)[:, :CARRIED].tobytes()
    offsets = np.concatenate([[0], np.cumsum(sizes) * CARRIED]).astype(np.int32)
    blobs = pa.Array.from_buffers(pa.binary(), len(heads), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(packed)])
    rd = d[heads]
    columns = [
        pa.array(np.concatenate([key[heads].view(np.int64), mixed(ids[f_doc].view(np.uint64)).view(np.int64)])),
        pa.array(np.concatenate([ids[rd], ids[f_doc]])), pa.array(np.concatenate([crc[rd], crc[f_doc]])),
        pa.array(np.concatenate([(at[heads] - place[rd]).astype(np.int32), f_start])),
        pa.array(np.concatenate([sizes.astype(np.int32), f_words])),
        pa.concat_arrays([blobs, pa.nulls(len(f_doc), pa.binary())])]
    return pa.RecordBatch.from_arrays(columns, names=["key", "doc_id", "crc", "start", "n", "prints"])


def _read(batches):
    """Ids, text digests, word counts and word hashes of slices of documents."""
    for batch in batches:
        for part in slices(batch, "text") if batch.num_rows else ():
            data, offsets = utf8(part.column("text"))
            starts, ends, row = words_of(data, offsets, _IS_WORD)
            yield (part.column("doc_id").to_numpy(), part.column("crc").to_numpy(), np.bincount(row, minlength=part.num_rows), word_hashes(data, starts, ends))


def _crc(text: str):
    return (F.crc32(F.col(text)) - F.lit(1 << 31)).cast("int")


def _hot_anchors(rows: DataFrame, window: int) -> np.ndarray:
    """Anchors of more than ``HOT_SHARE`` of the sampled documents: at most that share's inverse times the anchors of a
    document, whatever the size of the table."""
    few = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0)

    def run(batches):
        for _, _, counts, words in _read(batches):
            doc = np.repeat(np.arange(len(counts)), counts)
            at, _, anchors = _windows(words, doc, window)
            pairs = np.unique(np.stack([doc[at].astype(np.uint64), anchors]), axis=1)
            found, n = np.unique(pairs[1], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], names=["anchor", "n"])

    counts = few.mapInArrow(run, schema("anchor long, n long")).groupBy("anchor").agg(F.sum("n").alias("n"))
    least = max(HOT_LEAST, int(few.count() * HOT_SHARE))
    hot = counts.where(F.col("n") >= least).select("anchor").collect()
    return np.sort(np.array([r[0] for r in hot], np.int64).view(np.uint64))


def factors(docs: DataFrame, doc_id: str, text: str, window: int = 13) -> DataFrame:
    """Rows ``(doc_id, crc, start, n)``: the ``n`` words from number ``start`` of the document (``crc`` tells rows of one id
    apart) stand in a document with a smaller id. Factors of one document may overlap."""
    rows = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("long").alias("doc_id"), _crc(text).alias("crc"), F.col(text).alias("text"))
    rows = rows.where("text is not null")
    hot = _hot_anchors(rows, window)

    def parse(batches):
        parts, held = [], 0
        for part in _read(batches):
            parts.append(part)
            held += len(part[3])
            if held >= BLOCK_WORDS:
                yield _block(parts, window, hot)
                parts, held = [], 0
        if parts:
            yield _block(parts, window, hot)

    def meet(batches):
        kept = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            kept = t if kept is None else pa.concat_tables([kept, t])
            keys = kept.column("key").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1], "left"))    # the last key may go on in the next batch
            if whole:
                yield from _meeting(kept.slice(0, whole), window)
                kept = kept.slice(whole)
        if kept is not None and kept.num_rows:
            yield from _meeting(kept, window)

    runs = rows.mapInArrow(parse, schema(RUN)).repartition("key").sortWithinPartitions("key", "doc_id", "crc", "start")
    return runs.mapInArrow(meet, schema("doc_id long, crc int, start int, n int"))


def _meeting(table: pa.Table, window: int):
    """Parse the runs of whole anchor blocks, in the order of ids; factors of the first stage pass."""
    runs = table.filter(pc.is_valid(table.column("prints"))).combine_chunks()
    passed = table.filter(pc.is_null(table.column("prints"))).select(["doc_id", "crc", "start", "n"])
    yield from passed.to_batches()
    if not runs.num_rows:
        return
    key, ids, crc, start, n = (runs.column(c).to_numpy() for c in ("key", "doc_id", "crc", "start", "n"))
    data, _ = utf8(runs.column("prints"))
    prints = np.zeros((len(data) // CARRIED, 8), np.uint8)
    prints[:, :CARRIED] = data.reshape(-1, CARRIED)
    prints = prints.view(np.uint64).ravel()
    run = np.repeat(np.arange(len(n)), n)
    pos = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    keys = key[run]
    first = _first_places(np.lexsort((prints, keys)), keys, prints)
    taken = ids[run[first]] < ids[run]
    begins, lengths = _factors(taken, pos > 0, first)
    if len(begins):
        f_start, f_words = _ends(begins, lengths, window, start[run] + pos)
        at = run[begins]
        yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(crc[at]), pa.array(f_start), pa.array(f_words)], names=["doc_id", "crc", "start", "n"])


def _kept(text: str):
    """Kernel: words, words that go, and the words that stay, joined by one space."""

    def f(part: pa.RecordBatch) -> list:
        data, offsets = utf8(part.column(text))
        starts, ends, row = words_of(data, offsets, _IS_WORD)
        counts = np.bincount(row, minlength=part.num_rows)
        place = np.concatenate([[0], np.cumsum(counts)])
        spans = part.column("spans")
        per_row = np.array(pc.fill_null(pc.list_value_length(spans), 0))
        flat = spans.flatten()
        s, n = (f.to_numpy(zero_copy_only=False).astype(np.int64) for f in flat.flatten())
        base = np.repeat(place[:-1], per_row)
        depth = np.zeros(len(starts) + 1, np.int64)
        np.add.at(depth, base + s, 1)
        np.add.at(depth, base + s + n, -1)
        stays = np.cumsum(depth[:-1]) == 0
        starts, ends, row = starts[stays], ends[stays], row[stays]
        left = np.bincount(row, minlength=part.num_rows)
        size = ends - starts
        spaced = size.copy()
        spaced[:-1] += row[1:] == row[:-1]                        # a space behind all but a row's last word
        to = np.concatenate([[0], np.cumsum(spaced)])
        at = np.repeat(starts - to[:-1], spaced) + np.arange(to[-1])
        out = data[np.minimum(at, len(data) - 1)] if len(data) else data
        out[(to[:-1] + size)[spaced > size]] = 0x20
        ends_of = to[np.concatenate([[0], np.cumsum(left)])]
        kept = pa.Array.from_buffers(pa.large_string(), part.num_rows, [None, pa.py_buffer(ends_of.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])
        return [pa.array(counts.astype(np.int64)), pa.array((counts - left).astype(np.int64)), kept.cast(pa.string())]

    return f


def dedup(docs: DataFrame, doc_id: str, text: str, window: int = 13) -> DataFrame:
    """``docs`` with ``spans`` (start and number of words of the factors found, null: none), ``n_words``, ``n_removed`` and
    ``kept`` (the words that no factor covers, joined by one space). Only documents with a factor are shuffled."""
    found = factors(docs, doc_id, text, window)
    spans = cut_lineage(found.groupBy(F.col("doc_id").alias("_id"), F.col("crc").alias("_crc")).agg(F.array_sort(F.collect_list(F.struct("start", "n"))).alias("_spans")))
    rows = docs.drop("spans", "n_words", "n_removed", "kept").withColumns({"_id": F.col(doc_id).cast("long"), "_crc": _crc(text)})
    rows = sifted(rows, sieve(spans, "_id"), "_id")
    with_some = rows.where("_in").join(spans.hint("merge"), ["_id", "_crc"], "left")
    without = rows.where("not _in").withColumn("_spans", F.lit(None).cast(dict(spans.dtypes)["_spans"]))
    every = with_some.unionByName(without).drop("_id", "_crc", "_in").withColumnRenamed("_spans", "spans")
    return with_kernel(every, text, schema("n_words long, n_removed long, kept string"), lambda: _kept(text))
