"""N-gram Jaccard join with adaptive multi-match prefixes (operator 10).

A document's set is its distinct word shingles, as 64-bit hashes. All sets are sorted by one global order, rare shingles
first: the order of a count sketch over the whole corpus, then of the hash. If two sets are similar enough, the first
``n - ceil(t n) + l`` shingles of both share at least ``l``. Each document picks its own ``l``: it lengthens its
prefix where the sketch foretells many candidates, and its pairs must then share as many prefix shingles (the smaller
``l`` of the two holds).

1. Documents with equal sets are one class (map-side combined digests), whose least id stands for all.
2. Classes write their prefixes; shingles that only one class has go.
3. Two rounds compare each class with one centre: of the centres of its shingles (first the class with the most
   frequent prefix, then one by hash) the one it shares most with. Classes that link join components. Large groups of
   near copies melt into one here, in a number of comparisons that is linear in them.
4. Classes in different components meet at a shingle only if what stands behind it in both sets still reaches the
   overlap they need, as it does at the first shingle that a linked pair shares. Of these pairs, those that share enough prefix
   shingles, and can reach the overlap behind the last of them, are verified, so that no link between components is
   lost, and the components are taken again.

Verification intersects the full sets, made again from the texts of the pairs, which compress better than hashes and
stream past their centre; centres of many members are salted. The sketch has a fixed
size and only steers the order: results never depend on it. Equal hashes stand for equal shingles.

Joins whose sides follow the corpus are sort-merge joins by hint, so that the plan is the same at every size.

Documents without words, and null texts, have no shingles and link with nothing. Rows that repeat an id count as one
document. Rows without an id take no part: their component is null, and nothing links with or through them. An empty table gives no row.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import SMALL_SLICE, components, drop_table, list_column, schema, slices, utf8, with_kernel, word_hashes, words_of

IS_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: The sketch has 2^SKETCH_BITS counters, sent in chunks.
SKETCH_BITS, CHUNK = 21, 1 << 16
MOST_MATCHES = 4
#: Rounds that compare classes with centres only.
STARS = 2
#: Members of a centre that one salt holds.
MEMBERS = 256


def shingle_sets(column, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every row; a row of fewer than ``k`` words, but not none, has one shingle."""
    data, offsets = utf8(column)
    starts, ends, row = words_of(data, offsets, IS_WORD)
    h = word_hashes(LOWER[data], starts, ends)
    first = np.searchsorted(row, np.arange(len(offsets)))
    if len(h) >= k:
        g = np.full(len(h) - k + 1, np.uint64(k))
        for j in range(k):
            g = g * np.uint64(0xD6E8FEB86659FD93) + h[j: len(h) - k + 1 + j]
            g ^= g >> np.uint64(29)
    else:
        g = np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            out.append(np.unique(g[a: b - k + 1]))
        elif b > a:
            x = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in h[a:b]:
                    x = x * np.uint64(0xD6E8FEB86659FD93) + w
                    x ^= x >> np.uint64(29)
            out.append(np.array([x], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def counter(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def digests_and_sketch(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents ``(doc_id, n, digest)``, and of each task's sketch ``(chunk, counts)``, in one pass."""
    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
        names = ["doc_id", "n", "digest", "chunk", "counts"]
        for batch in batches:
            for part in slices(batch, "text", SMALL_SLICE):
                sets = shingle_sets(part.column("text"), k)
                if any(map(len, sets)):
                    np.add.at(sketch, counter(np.concatenate(sets)), np.uint32(1))
                m = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                     pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names=names)
        for c in range(0, 1 << SKETCH_BITS, CHUNK):
            some = sketch[c: c + CHUNK]
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([c // CHUNK], pa.int32()),
                     pa.array([zlib.compress(some.tobytes(), 1)], pa.binary())], names=names)

    return docs.mapInArrow(run, "doc_id bigint, n bigint, digest binary, chunk int, counts binary")


def summed_sketch(parts: DataFrame) -> np.ndarray:
    """The tasks' sketches added up, chunk by chunk; the driver gets 2^SKETCH_BITS counters of 32 bits, whatever the corpus."""
    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, x in zip(batch.column("chunk").to_pylist(), batch.column("counts").to_pylist()):
                x = np.frombuffer(zlib.decompress(x), np.uint32).astype(np.int64)
                total[c] = total[c] + x if c in total else x
        for c, x in total.items():
            x = np.minimum(x, np.iinfo(np.uint32).max).astype(np.uint32)
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], names=["chunk", "counts"])

    out = np.zeros(1 << SKETCH_BITS, np.uint32)
    for r in parts.repartition("chunk").mapInArrow(run, "chunk int, counts binary").collect():
        out[r["chunk"] * CHUNK: (r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.uint32)
    return out


def least_overlap(n, percent: int):
    """Shared shingles that any partner of a set of ``n`` needs at least."""
    return -(-percent * n // 100)


def prefix(s: np.ndarray, sketch: np.ndarray, noise: float, percent: int) -> tuple[np.ndarray, int]:
    """The set's prefix in the global order and its number of matches, which makes the expected cost least."""
    freq = sketch[counter(s)]
    order = np.lexsort((s, freq))
    need = least_overlap(len(s), percent)
    base = len(s) - need
    best, cost = 1, None
    for m in range(1, min(MOST_MATCHES, need) + 1):
        f = freq[order[: base + m]]
        # writing the prefix, and verifying those that share m of its shingles: at most a share 1/m of all that share one
        now = (base + m) + 0.5 * np.maximum(0, f - noise).sum() / (m * m)
        if cost is None or now < cost:
            best, cost = m, now
    return s[order[: base + best]], best


def prefixes(docs: DataFrame, k: int, sketch: np.ndarray, percent: int) -> DataFrame:
    """``(doc_id, n, matches, common, tokens)``: prefix of every document with shingles, and how many of its shingles
    the sketch knows as frequent."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch)
    middle = float(np.median(sketch))
    noise = middle + 3 * float(np.sqrt(middle + 1))

    def kernel():
        counts = sent.value

        def f(batch):
            n, m, common, tokens = [], [], [], []
            for s in shingle_sets(batch.column("text"), k):
                p, l = prefix(s, counts, noise, percent) if len(s) else (s, 0)
                n.append(len(s))
                m.append(l)
                common.append(int((counts[counter(p)] > noise).sum()))
                tokens.append(p.astype(np.int64))
            size = np.array([len(t) for t in tokens], np.int64)
            return [pa.array(n, pa.int64()), pa.array(m, pa.int32()), pa.array(common, pa.int32()), list_column(size, pa.array(np.concatenate(tokens)))]

        return f

    return with_kernel(docs, "text", schema("n bigint, matches int, common int, tokens array<bigint>"), kernel, SMALL_SLICE).drop("text")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` whose id is in ``ids``, and few others: a bitmap of the ids' hashes, of a fixed size, thins the rows
    before anything is shuffled."""
    bits = 24
    place = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)
    # at most 2^18 rows, as columns: 4 MB on the driver
    filled = ids.select(place.alias("bit")).groupBy(F.expr("bit >> 6").alias("w")).agg(F.bit_or(F.expr("1L << CAST(bit & 63 AS INT)")).alias("b")).toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[filled["w"].to_numpy()] = filled["b"].to_numpy()
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        flags = np.unpackbits(sent.value.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            yield batch.filter(pa.array(flags[batch.column("bit").to_numpy()])).select(["doc_id", "text"])

    return docs.where("doc_id is not null").withColumn("bit", place).mapInArrow(run, "doc_id bigint, text string")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def verified(pairs: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """The ``pairs (a, b)`` whose full sets are similar enough. Texts of the members stream past the set of their
    centre ``a``; a centre of many members has a copy for each ``MEMBERS`` of them."""
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("m"))
    salts = sizes.select("a", F.ceil(F.col("m") / MEMBERS).cast("int").alias("salts"))
    members = pairs.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("doc_id"))
    centres = salts.select("a", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.col("a").alias("doc_id"))
    wanted = members.withColumn("role", F.lit(1)).unionByName(centres.withColumn("role", F.lit(0)))
    rows = wanted.hint("merge").join(texts_of(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))), "doc_id")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", "role")

    def run(batches):
        at, centre = None, None
        for batch in batches:
            out = ([], [])
            for part in slices(batch, "text", SMALL_SLICE):
                cols = [part.column(c).to_pylist() for c in ("a", "salt", "role", "doc_id")]
                for a, salt, role, doc, s in zip(*cols, shingle_sets(part.column("text"), k)):
                    if role == 0:
                        at, centre = (a, salt), s
                    elif at == (a, salt) and similar(s, centre, percent):
                        out[0].append(a)
                        out[1].append(doc)
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64())], names=["a", "b"])

    return rows.select("a", "salt", "role", "doc_id", "text").mapInArrow(run, "a bigint, b bigint")


def candidate_pairs(t: DataFrame, last: bool, round_: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of classes in different components from ``t (token, pos, doc_id, n, matches, common,
    comp)``, all of whose tokens are in several components: in the last round all that can be similar enough, before
    with one centre a class. ``pos`` is the token's place in its set."""
    enough = F.col("m") >= F.least("am", "bm")
    sizes = 100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")

    def reaches(overlap):
        return overlap * (100 + percent) >= percent * (F.col("an") + F.col("bn"))

    if last:
        # the first shingle that a pair shares has all others of both sides behind it, so a token is met only where
        # the rest of both sets, itself included, reaches the overlap; one such row at least is left of every link
        names = {"doc_id": "", "n": "n", "matches": "m", "comp": "c", "pos": "pos"}
        front = t.where(100 * (F.col("pos") - 1) <= (100 - percent) * F.col("n"))
        x, y = (front.select("token", *[F.col(c).alias(side + as_) for c, as_ in names.items()]) for side in "ab")
        rest = 1 + F.least(F.col("an") - F.col("apos"), F.col("bn") - F.col("bpos"))
        met = x.join(y.hint("merge"), "token").where("a < b and ac <> bc").where(sizes & reaches(rest))
        pairs = cut_lineage(met.select("a", "an", "am", "b", "bn", "bm").distinct())
        # their matches are counted on the prefixes; in the global order the last shared shingle is the last of both
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        sets = t.join(ids.hint("merge"), "doc_id", "left_semi").groupBy("doc_id", "n").agg(
            F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("s"))
        for side in "ab":
            own = sets.select(F.col("doc_id").alias(side), F.col("n").alias(side + "n"), F.col("s.token").alias(side + "s"), F.col("s.pos").alias(side + "at"))
            pairs = pairs.join(own.hint("merge"), [side, side + "n"])
        pairs = pairs.withColumn("both", F.array_intersect("as", "bs")).withColumn("m", F.size("both")).where(enough)
        pairs = pairs.withColumn("end", F.element_at("both", -1))
        for side in "ab":
            pairs = pairs.withColumn(side + "pos", F.element_at(side + "at", F.array_position(side + "s", F.col("end")).cast("int")))
        left = F.col("m") + F.least(F.col("an") - F.col("apos"), F.col("bn") - F.col("bpos"))
        return pairs.where(reaches(left)).select("a", "b").distinct()
    # a token's centre, first: the class with most frequent shingles in its prefix. Of a family of near copies that is
    # one with few shingles of its own, the nearest to all others. Later: the class of the greatest hash
    lead = F.col("common") if round_ == 0 else F.lit(0)
    t = t.withColumn("h", lead.cast("bigint") * (1 << 40) + F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(round_)), 24))
    centre = t.groupBy("token").agg(F.max("h").alias("z"))
    own = {"n": "n", "matches": "m", "comp": "c"}
    met = t.join(centre.hint("merge"), "token").where("h <> z").groupBy("z", F.col("doc_id").alias("b")).agg(
        F.count(F.lit(1)).alias("m"), *[F.first(c).alias("b" + as_) for c, as_ in own.items()])
    of = t.groupBy("h").agg(F.first("doc_id").alias("a"), *[F.first(c).alias("a" + as_) for c, as_ in own.items()])
    pairs = met.join(of, met["z"] == of["h"]).where("ac <> bc").where(sizes).where(enough)
    return pairs.groupBy("b").agg(F.max_by("a", F.struct("m", "a")).alias("a")).select("a", "b")


def find(df: DataFrame, doc_id: str, text: str, k: int = 5, percent: int = 80) -> DataFrame:
    """One row for each row of ``df``: ``doc_id``, ``n_shingles`` and ``component_id`` (least id reachable by links;
    two documents link when 100 x intersection >= ``percent`` x union of their shingles of ``k`` words)."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    table = cut_lineage(digests_and_sketch(docs, k))
    rows = table.where("chunk is null").select("doc_id", "n", "digest")
    classes = rows.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    sketch = summed_sketch(table.where("chunk is not null").select("chunk", "counts"))
    own = cut_lineage(prefixes(docs, k, sketch, percent).where("n > 0").join(
        classes.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"))
    tokens = own.select("doc_id", F.col("n").cast("int").alias("n"), "matches", "common",
                        F.posexplode("tokens").alias("pos", "token")).withColumn("pos", F.col("pos") + 1)
    # only shingles of two classes or more matter from here on
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("token")
    t = cut_lineage(tokens.join(shared.hint("merge"), "token").withColumn("comp", F.col("doc_id")), replaces=own)
    links, near = None, None
    for round_ in range(STARS + 1):
        pairs = cut_lineage(candidate_pairs(t, round_ == STARS, round_, percent))
        new = cut_lineage(verified(pairs, docs, k, percent))
        links = new if links is None else links.unionByName(new)
        near = cut_lineage(components(links))
        if round_ < STARS:
            # the next round needs the tokens that are still in several components
            now = t.drop("comp").join(near.select(F.col("id").alias("doc_id"), "component_id").hint("merge"), "doc_id", "left").withColumn(
                "comp", F.coalesce("component_id", "doc_id")).drop("component_id")
            mixed = now.groupBy("token").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi")).where("_lo <> _hi").select("token")
            rest = cut_lineage(now.join(mixed.hint("merge"), "token"))
            drop_table(t)
            t = rest
    reps = classes.join(near.withColumnRenamed("id", "doc_id"), "doc_id", "left").select(
        "digest", F.coalesce("component_id", "doc_id").alias("component_id"))
    return rows.join(reps, "digest", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
