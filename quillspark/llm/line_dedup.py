"""Line dedup by a segment-partition edit join (operator 5): DataFrame functions only.

Lines are the trimmed parts of a text between newlines; only lines of ``min_chars`` characters or more take part.
Equal lines are one row, and two different lines link when their edit distance is at most ``threshold`` (k):

1. A line is split into k + 1 even segments. A line within k edits holds at least one of them unchanged, shifted by at
   most k places. So each line's segments are an index under (length, segment number, text), and each line probes the
   index for every length from its own down to k less, only at the start positions that an alignment with the edits
   left and right of the segment allows. With k = 1, a segment that more than ``GROUP`` lines share is not joined: the
   rest of its lines is split into two segments again, and so on (``refined``), so that the work follows the number of
   lines in a group, not its square. With k > 1 a hot segment is joined as it is.
2. Each pair that meets is verified by bit-parallel edit distance in a band of 2k + 1 diagonals: one word of bits holds
   the band, and a fold over the characters moves it down the diagonal. Equal ends are cut off before.
3. Linked lines are classes (transitively). A class keeps its first place, by doc_id, then by line; all its other
   occurrences are removed, wherever they are.

Joins whose sides follow the corpus are sort-merge joins by hint, so that the plan is the same at every size; only the
sieves, of a fixed size, are broadcast.

Shorter lines and blank lines always stay. Null and empty texts stay as they are. A text of which no line is left
becomes empty. Rows that repeat an id count as one document; rows without an id stay as they are and take no part.
Other columns aren't read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import components

NEWLINE = "\n"


#: A sieve has 2^SIEVE_BITS bits, in 2^(SIEVE_BITS - 6) words: its broadcast is that large at most, whatever the data.
SIEVE_BITS = 24


def _bit(*columns: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - SIEVE_BITS)


def sieve(keys: DataFrame, *columns: str) -> DataFrame:
    """A bitmap of the hashes of ``keys``: ``(_w, _b)``, a row for each word with a bit."""
    bits = keys.select(_bit(*columns).alias("bit"))
    return bits.groupBy(F.expr("bit >> 6").alias("_w")).agg(F.bit_or(F.expr("1L << CAST(bit & 63 AS INT)")).alias("_b"))


def sifted(df: DataFrame, words: DataFrame, *columns: str) -> DataFrame:
    """Append ``_in``: true for all rows whose key is in the sieve, and for a few others. Nothing is shuffled."""
    rows = df.withColumn("_bit", _bit(*columns)).withColumn("_w", F.expr("_bit >> 6"))
    rows = rows.join(F.broadcast(words), "_w", "left")
    return rows.withColumn("_in", F.expr("coalesce((_b >> CAST(_bit & 63 AS INT)) & 1 = 1, false)")).drop("_bit", "_w", "_b")


def lines_of(df: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """``(doc_id, pos, line, h1, h2)`` of the lines that take part; ``pos`` counts all lines of the text from 0, and
    the two hashes stand for the line."""
    parts = F.posexplode(F.split(F.col(text), NEWLINE, -1)).alias("pos", "line")
    return (df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), parts).withColumn("line", F.trim("line"))
              .where(F.char_length("line") >= min_chars)
              .withColumns({"h1": F.xxhash64("line"), "h2": F.xxhash64(F.lit(1), "line")}))


def segment(length: Column, number: int, k: int) -> tuple[Column, Column]:
    """Start (from 1) and length of a segment of a line: the last segments are longer by one where it doesn't divide."""
    each = F.floor(length / (k + 1)).cast("int")
    short = (k + 1) - (length - each * (k + 1))     # so many segments have `each` characters
    start = F.lit(1) + each * number + F.greatest(F.lit(number) - short, F.lit(0))
    return start, each + F.when(F.lit(number) >= short, 1).otherwise(0)


def _keys(line: str, n: Column, length: Column, number: int, shifts: list[int], k: int) -> list[Column]:
    start, size = segment(length, number, k)
    out = []
    for x in shifts:
        at = start + x
        inside = (length > k) & (at >= 1) & (at + size - 1 <= n)
        out.append(F.when(inside, F.xxhash64(length, F.lit(number), F.substring(F.col(line), at, size))))
    return out


def segment_keys(line: str, n: Column, k: int) -> dict[str, Column]:
    """Hashes of (length, segment number, text): ``own``, the line's index entries; ``even`` and ``less``, the other
    entries under which a line within k edits and of the same length, or shorter, can stand.

    Against a line shorter by d, segment s starts at its own place p there and at p + x here. The x left of it and
    the d - x right of it are edits: |x| + |d - x| <= k, and |x| <= s and |d - x| <= k - s, as otherwise a segment
    before or behind it matches too."""
    def at(d):
        return [c for s in range(k + 1) for c in _keys(line, n, n - d, s, [
            x for x in range(-k, k + 1) if (d or x) and abs(x) + abs(d - x) <= k and abs(x) <= s and abs(d - x) <= k - s], k)]

    none = F.array().cast("array<bigint>")
    even, less = at(0), [c for d in range(1, k + 1) for c in at(d)]
    return {"own": F.array(*[c for s in range(k + 1) for c in _keys(line, n, n, s, [0], k)]),
            "even": F.array(*even) if even else none, "less": F.array(*less) if less else none}


def candidates(lines: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """Pairs ``(a, b)`` of line ids that meet in the index; of lines in hot segments, those that ``refined`` finds."""
    if k > 1:
        index = lines.select(F.col("lid").alias("a"), F.explode("own").alias("key"))
        equal = lines.select(F.col("lid").alias("b"), F.explode(F.concat("own", "even")).alias("key")).where("key is not null")
        less = lines.select(F.col("lid").alias("b"), F.explode("less").alias("key")).where("key is not null")
        same = index.join(equal.hint("merge"), "key").where("a < b").select("a", "b")
        shorter = index.join(less.hint("merge"), "key").where("a <> b").select("a", "b")
        return same.unionByName(shorter).distinct()
    entries = lines.select("lid", "h1", "h2", F.explode(F.array(*[
        F.struct(F.lit(longer).alias("longer"), F.lit(s).alias("s"), F.get(F.col(c), s).alias("key"))
        for longer, c in ((0, "own"), (1, "less")) for s in (0, 1)])).alias("e")).select("lid", "h1", "h2", "e.*").where("key is not null")
    # a table, as every plan below reads it again
    hot = cut_lineage(sieve(hot_keys(lines.select(F.lit(0).alias("longer"), F.explode("own").alias("key"))), "key"))
    entries = sifted(entries, hot, "key")
    pairs = met(entries.where("not _in"))
    if hot.limit(1).count():
        pairs = pairs.unionByName(refined(entries.where("_in").select("lid", "h1", "h2", "longer", "s"), found))
    return pairs.distinct()


#: A key of more index entries than this is hot.
GROUP = 8


def hot_keys(entries: DataFrame) -> DataFrame:
    return entries.where("longer = 0").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select("key")


def met(entries: DataFrame) -> DataFrame:
    """Pairs of entries ``(lid, longer, key)`` of one key, of which at least one is an index entry (``longer`` 0)."""
    index = entries.where("longer = 0").select("key", F.col("lid").alias("a"))
    every = entries.select("key", F.col("lid").alias("b"), "longer")
    return index.join(every.hint("merge"), "key").where("a < b or longer = 1").select("a", "b")


def refined(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of the lines in hot segments, for one edit: a group of m lines costs work in proportion to m.

    Lines that share a segment can differ only in the gap that is left, from ``lo`` up to ``hi`` by the places of the
    shorter line (``longer`` is 1 where a line probes for lines shorter by one). The gap is split again into two
    segments, one of which matches; so the key is all that matched so far, and keys that are still hot are split on.
    Pairs meet at keys of at most ``GROUP`` index entries. A hot gap of one character ends it: all index entries there
    are one edit apart, so each links with the least of them, and a longer line with the entries that hold, in the
    gap, one of its own two characters there (one for each character)."""
    ids = entries.select("h1", "h2").distinct()
    near = sifted(found.select("h1", "h2", "line"), sieve(ids, "h1", "h2"), "h1", "h2").where("_in").drop("_in")
    texts = cut_lineage(near.groupBy("h1", "h2").agg(F.first("line").alias("line")))
    n = F.char_length("line") - F.col("longer")
    middle = (F.lit(1) + F.floor(n / 2)).cast("int")
    state = entries.join(texts.hint("merge"), ["h1", "h2"]).select(
        "lid", "longer", "line", F.when(F.col("s") == 0, middle).otherwise(1).alias("lo"),
        F.when(F.col("s") == 0, n + 1).otherwise(middle).cast("int").alias("hi"))
    pairs = []                                                   # a table for each level: at most log2 of a line's length
    while True:
        matched = [F.char_length("line") - F.col("longer"), F.col("lo"), F.col("hi"), F.expr("substring(line, 1, lo - 1)"),
                   F.expr("substring(line, hi + longer, char_length(line))")]
        middle = F.expr("CAST(lo + (hi - lo) DIV 2 AS INT)")
        ends = state.where("hi - lo = 1").withColumn("key", F.xxhash64(*matched))
        if ends.limit(1).count():
            pairs.append(cut_lineage(one_apart(ends)))
        halves = F.explode(F.array(F.struct(middle.alias("lo"), F.col("hi").alias("hi")), F.struct(F.col("lo").alias("lo"), middle.alias("hi"))))
        split = state.where("hi - lo > 1").select("lid", "longer", "line", halves.alias("g")).select("lid", "longer", "line", "g.*")
        split = cut_lineage(split.withColumn("key", F.xxhash64(*matched)))
        hot = cut_lineage(sieve(hot_keys(split), "key"))
        parts = sifted(split, hot, "key")
        pairs.append(cut_lineage(met(parts.where("not _in"))))
        if not hot.limit(1).count():
            return reduce(DataFrame.unionByName, pairs)
        state = parts.where("_in").select("lid", "longer", "line", "lo", "hi")


def one_apart(ends: DataFrame) -> DataFrame:
    """Pairs of the entries whose gap is one character, as stated in ``refined``."""
    index = ends.where("longer = 0")
    least = index.groupBy("key").agg(F.min("lid").alias("a"))
    equal = index.join(least.hint("merge"), "key").where("a < lid").select("a", F.col("lid").alias("b"))
    own = index.select(F.xxhash64("key", F.expr("substring(line, lo, 1)")).alias("key"), F.col("lid").alias("a"))
    probes = ends.where("longer = 1").select(F.explode(F.array_distinct(F.array(
        *[F.xxhash64("key", F.expr(f"substring(line, lo + {x}, 1)")) for x in (0, 1)]))).alias("key"), F.col("lid").alias("b"))
    return equal.unionByName(own.join(probes.hint("merge"), "key").select("a", "b"))


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def edit_distance(a: Column, b: Column, k: int) -> Column:
    """Edit distance of two strings of more than ``k`` characters, or ``k + 1`` if it is greater: bit-parallel in a
    band of 2k + 1 diagonals (k <= 30). ``vp`` and ``vn`` hold the vertical steps of the band, up and down."""
    mask = (1 << (2 * k + 1)) - 1
    big = lambda x: F.lit(x).cast("bigint")
    inv = lambda x: x.bitwiseXOR(big(mask))

    def distance(chars):
        pattern, text = chars["p"], chars["t"]
        m, n = F.size(pattern), F.size(text)

        def step(acc, j):
            c = F.get(text, j)
            match = big(0)
            for d in range(2 * k + 1):             # bit 2k - d is row j + k - d
                match = match.bitwiseOR(F.when(F.get(pattern, j + (k - d)) == c, big(1 << (2 * k - d))).otherwise(big(0)))
            vp, vn = acc["vp"], acc["vn"]

            def diagonal(x):
                return (x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(big(mask))

            def columns(d0):
                def use(h):
                    hp, hn, low = h["hp"], h["hn"], F.shiftright(d0, 1)
                    # down the lowest diagonal first; once it has left the pattern, along its last row
                    falling = j < m - k
                    shift = (F.lit(2 * k) + (m - k) - j - 1).cast("int")
                    bit = lambda v: F.pmod(F.call_function("shiftright", v, shift), F.lit(2))
                    moved = F.when(falling, 1 - F.pmod(F.shiftright(d0, 2 * k), F.lit(2))).otherwise(bit(hp) - bit(hn))
                    return F.struct(hn.bitwiseOR(inv(low.bitwiseOR(hp))).bitwiseAND(big(mask)).alias("vp"), low.bitwiseAND(hp).alias("vn"),
                                    (acc["dist"] + moved).alias("dist"))
                return let(F.struct(vn.bitwiseOR(inv(d0.bitwiseOR(vp))).bitwiseAND(big(mask)).alias("hp"), d0.bitwiseAND(vp).alias("hn")), use)

            return let(match, lambda x: let(diagonal(x), columns))

        start = F.struct(big(((1 << (k + 1)) - 1) << k).alias("vp"), big(0).alias("vn"), big(k).alias("dist"))
        whole = F.aggregate(F.sequence(F.lit(0), n - 1), start, step, lambda acc: acc["dist"])
        return F.when(whole <= k, whole).otherwise(big(k + 1))

    def guarded(c):                                 # a common guard on both sides keeps every pattern longer than the band
        g = F.array_repeat(F.lit(""), 2 * k + 1)
        return let(F.struct(F.concat(g, c["p"], g).alias("p"), F.concat(g, c["t"], g).alias("t")), distance)

    def without_equal_end(c):
        return let(_equal_steps(c["p"], c["t"], True), lambda m: let(F.struct(
            F.slice(c["p"], F.lit(1), F.size(c["p"]) - m).alias("p"), F.slice(c["t"], F.lit(1), F.size(c["t"]) - m).alias("t")), guarded))

    def without_equal_start(c):
        return let(_equal_steps(c["p"], c["t"], False), lambda m: let(F.struct(
            F.slice(c["p"], m + 1, F.size(c["p"])).alias("p"), F.slice(c["t"], m + 1, F.size(c["t"])).alias("t")), without_equal_end))

    near = let(F.struct(F.split(a, "").alias("p"), F.split(b, "").alias("t")), without_equal_start)
    return F.when(F.abs(F.char_length(a) - F.char_length(b)) > k, big(k + 1)).otherwise(near)


def _equal_steps(p: Column, t: Column, end: bool, step: int = 16) -> Column:
    """How many characters, in whole steps, two arrays of characters have in common at the start or at the end."""
    n = F.floor(F.least(F.size(p), F.size(t)) / step).cast("int")

    def same(i):
        if end:
            return F.slice(p, F.size(p) - (i + 1) * step + 1, F.lit(step)) == F.slice(t, F.size(t) - (i + 1) * step + 1, F.lit(step))
        return F.slice(p, i * step + 1, F.lit(step)) == F.slice(t, i * step + 1, F.lit(step))

    equal = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i < n, same(i)).otherwise(F.lit(False)))
    return (F.array_position(equal, False) - 1).cast("int") * step


def verified(pairs: DataFrame, lines: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The pairs of lines within ``k`` edits. ``lines (lid, h1, h2)`` of the pairs fetch their texts from ``found``."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("lid")).distinct()
    wanted = cut_lineage(lines.select("lid", "h1", "h2").join(ids.hint("merge"), "lid", "left_semi"))
    near = sifted(found.select("h1", "h2", "line"), sieve(wanted, "h1", "h2"), "h1", "h2").where("_in")
    texts = cut_lineage(near.groupBy("h1", "h2").agg(F.first("line").alias("line")).join(wanted, ["h1", "h2"]).select("lid", "line"))
    x = texts.select(F.col("lid").alias("a"), F.col("line").alias("s"))
    y = texts.select(F.col("lid").alias("b"), F.col("line").alias("t"))
    rows = pairs.join(x, "a").join(y, "b")
    return rows.where(edit_distance(F.col("s"), F.col("t"), k) <= k).select("a", "b")


def removals(df: DataFrame, doc_id: str, text: str, threshold: int = 1, min_chars: int = 20) -> DataFrame:
    """``(doc_id, removed)``: the sorted positions of the lines that go, for the documents that lose any."""
    if min_chars <= threshold:
        raise ValueError("min_chars must exceed threshold")
    found = lines_of(df, doc_id, text, min_chars)
    occurrences = found.withColumn("n", F.char_length("line"))
    occurrences = occurrences.select("doc_id", "pos", "h1", "h2", *[c.alias(k) for k, c in segment_keys("line", F.col("n"), threshold).items()])
    distinct = occurrences.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "pos")).alias("head"), F.count(F.lit(1)).alias("n"), *[F.first(k).alias(k) for k in ("own", "even", "less")])
    lines = cut_lineage(distinct.withColumn("lid", F.monotonically_increasing_id()))
    pairs = cut_lineage(candidates(lines, found, threshold))
    near = cut_lineage(components(verified(pairs, lines, found, threshold)))
    # the first place of every line that has more than one occurrence or belongs to a class of more than one line
    classed = lines.select("lid", "h1", "h2", "head", "n").join(near.withColumnRenamed("id", "lid").hint("merge"), "lid", "left")
    heads = classed.where("component_id is not null").groupBy("component_id").agg(F.min("head").alias("first"))
    known = cut_lineage(classed.where("component_id is not null or n > 1").join(heads, "component_id", "left")
                        .select("h1", "h2", F.coalesce("first", "head").alias("head")))
    places = sifted(found.select("doc_id", "pos", "h1", "h2"), sieve(known, "h1", "h2"), "h1", "h2").where("_in")
    gone = places.join(known.hint("merge"), ["h1", "h2"]).where("doc_id <> head.doc_id or pos <> head.pos")
    return gone.groupBy("doc_id").agg(F.array_sort(F.collect_set("pos")).alias("removed"))   # at most a document's lines


def apply(df: DataFrame, doc_id: str, text: str, gone: DataFrame) -> DataFrame:
    """Append ``removed`` (positions, empty without) and take those lines out of ``text``. Only the rows of documents
    that lose a line, and a few others, are shuffled."""
    none = F.array().cast("array<int>")
    rows = sifted(df.withColumn("_id", F.col(doc_id)), sieve(gone, "doc_id"), "_id").drop("_id")
    hit = rows.where("_in").join(gone.withColumnRenamed("doc_id", doc_id).hint("merge"), doc_id, "left").withColumn("removed", F.coalesce("removed", none))
    kept = F.array_join(F.transform(
        F.filter(F.transform(F.split(F.col(text), NEWLINE, -1), lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
                 lambda z: ~F.array_contains("removed", z["i"])), lambda z: z["x"]), NEWLINE)
    hit = hit.withColumn(text, F.when(F.size("removed") > 0, kept).otherwise(F.col(text)))
    return hit.drop("_in").unionByName(rows.where("not _in").drop("_in").withColumn("removed", none))


def dedup(df: DataFrame, doc_id: str, text: str, **options) -> DataFrame:
    """``df`` with ``removed`` appended and its texts without the removed lines."""
    return apply(df.drop("removed"), doc_id, text, cut_lineage(removals(df, doc_id, text, **options)))
