"""Spelling variant grouping by a relational trie frontier.

``word_counts`` finds the letter runs of whole texts, lower-cases A-Z, damages the runs that the contract names and
counts the words of a length and a number of occurrences. ``near_pairs`` finds all pairs of words that differ by exactly
one inserted, deleted or replaced code point: states (word, node, rest, edits) are joined, level by level, with the edge
table of a path-compressed trie. The edge table of a level is an aggregate of the words that pass through its nodes (the
label is what the least and the greatest rest have in common), so it is distributed and built as the frontier moves. A
state without edits meets all edges of its node and spends its edit inside one label; a state with one edit follows the
one edge that its rest starts with; a state that has used up its word at the end of another word is a neighbour. A subtree
of a few words (``BUCKET``) is one edge that holds their rests, and ends the states that reach it; a larger one's edge
tells how its words may end.

One edit leaves the first half or the second half of a word as it was. So there are two tries in the one table, of the
words and of the words reversed, and a state may spend its edit only behind its exact half: the frontier stays where the
tries are sparse. The first ``STEM`` code points are walked at once, as no edit may lie in them. A pair is looked for from
one side only, by deleting a code point or putting a greater one in its place, and is then written both ways round.

``groups`` adds each word's form (its near word of most occurrences, if that is ten times its own) and root.

Null texts have no runs; a null id is written as nothing in front of the colon. Repeated rows count as further
occurrences, ties between forms go to the least in code-point order, an empty table gives an empty result, and columns
other than the two named ones are not read. Long runs are ordinary words: levels count branchings, not letters.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_table
from .common import schema, slices, utf8, words_of

#: Code points of a word that both halves' searches walk in one step; words have at least twice as many.
STEM = 3
#: Words of a subtree that is not cut into further edges.
BUCKET = 16
#: Distinct words that a task holds before it passes their counts on.
HELD = 200_000
#: Runs longer than this are digested one by one.
LONG_RUN = 64

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[list(range(65, 91)) + list(range(97, 123)) + [0xC3]] = True


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1)
    return t


def _runs(data: np.ndarray, offsets: np.ndarray):
    """Letter runs of UTF-8 rows: A-Z, a-z and U+00C0 to U+00FF (the bytes C3 80 to C3 BF), lower-cased in A-Z."""
    marked = np.where(_IS_LETTER[data], np.uint8(1), np.uint8(0))
    if len(data):
        marked[1:] |= data[:-1] == 0xC3
    starts, ends, row = words_of(marked, offsets, np.array([False, True] + [False] * 254))
    lowered = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return lowered, starts, ends, row


def _digests(lowered, starts, ends, row, prefixes, table) -> np.ndarray:
    """Unsigned crc32 of ``<prefix>:<run>`` for every run, byte by byte over all runs at once."""
    seed = np.array([zlib.crc32(p) for p in prefixes], np.uint32)
    reg = seed[row] ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    many = np.searchsorted(-size[order], -np.arange(0, LONG_RUN), "left")     # runs longer than k
    long_runs = order[: np.searchsorted(-size[order], -LONG_RUN, "left")]
    for k in range(min(LONG_RUN, int(size.max(initial=0)))):
        at = order[: many[k]]
        reg[at] = table[(reg[at] ^ lowered[starts[at] + k]) & np.uint32(255)] ^ (reg[at] >> np.uint32(8))
    out = reg ^ np.uint32(0xFFFFFFFF)
    for i in long_runs:
        out[i] = zlib.crc32(lowered[starts[i]: ends[i]].tobytes(), zlib.crc32(prefixes[row[i]]))
    return out


def word_counts(docs: DataFrame, doc_id: str, text: str, least_length: int = 7, least_count: int = 2, damage: int = 31) -> DataFrame:
    """Rows ``(word, n)`` of the words with ``least_length`` code points and ``least_count`` occurrences, after the damage:
    a run whose crc32 with its document's id is divisible by ``damage`` loses its code point number crc32 % length."""

    def run(batches):
        table, held = _crc_table(), []

        def counted():
            t = pa.concat_tables(held).group_by("word").aggregate([("n", "sum")])
            return pa.table({"word": t["word"], "n": t["n_sum"]})

        for batch in batches:
            for part in slices(batch, "text") if batch.num_rows else ():
                data, offsets = utf8(part.column("text"))
                lowered, starts, ends, row = _runs(data, offsets)
                if not len(starts):
                    continue
                leads = np.concatenate([[0], np.cumsum(lowered == 0xC3)])
                points = (ends - starts) - (leads[ends] - leads[starts])
                some = points >= least_length
                starts, ends, row, points = starts[some], ends[some], row[some], points[some]
                if not len(starts):
                    continue
                prefixes = [b"%s:" % (b"" if v is None else str(v).encode()) for v in part.column("doc_id").to_pylist()]
                h = _digests(lowered, starts, ends, row, prefixes, table)
                hit = h % np.uint32(damage) == 0
                words = [lowered[starts[i]: ends[i]].tobytes().decode() for i in np.flatnonzero(hit)]
                gone = [int(v) for v in h[hit].astype(np.int64) % points[hit]]
                damaged = [w[:k] + w[k + 1:] for w, k in zip(words, gone) if len(w) > least_length]
                s, e = starts[~hit], ends[~hit]
                size = e - s
                at = np.repeat(s - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum()) if len(s) else s
                spans = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                whole = pa.StringArray.from_buffers(len(s), pa.py_buffer(spans.tobytes()), pa.py_buffer(lowered[at].tobytes()))
                found = pa.chunked_array([whole, pa.array(damaged, pa.string())]).combine_chunks().value_counts()
                held.append(pa.table({"word": found.field("values"), "n": found.field("counts")}))
                if sum(t.num_rows for t in held) > 2 * HELD:
                    held = [counted()]
                    if held[0].num_rows > HELD:
                        yield from held.pop().to_batches()
        if held:
            yield from counted().to_batches()

    pairs = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text"))
    return (pairs.mapInArrow(run, schema("word string, n long")).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


def _common_prefix(a: str, b: str):
    """What two strings that share their first code point have in common at their starts."""
    return F.expr(f"""case when {a} = {b} then {a} else substring({a}, 1, cast(
        array_max(filter(sequence(1, least(length({a}), length({b}))), i -> startswith({b}, substring({a}, 1, i)))) as int)) end""")


#: Look-ahead: an edge has ``MARKS`` words of 64 bits in which the ends (last code points and length) of the words below it
#: are marked, so that a state whose word no word below can equal ends at once.
MARKS, END = 4, 3
_END = "xxhash64(substring({word}, -" + str(END) + ", " + str(END) + "), {length})"
_MARKED = [f"m{i}" for i in range(MARKS)]
_MAY_END = " and ".join(f"shiftright(m{i}, cast(shiftright({{end}}, {6 * i}) & 63 as int)) & 1 = 1" for i in range(MARKS))


def _edges(states: DataFrame) -> DataFrame:
    """Edges out of the nodes that the words of a level have reached: ``(e_node, e_ch, label, child, child_n, tails)``. A
    subtree of at most ``BUCKET`` words has no further edges: its words' rests (``tails``) are its one edge."""
    rest = states.where("edits = 0 and rest <> ''").select("node", "rest", "n", F.substring("rest", 1, 1).alias("e_ch"),
                                                          F.expr(_END.format(word="concat(node, rest)", length="length(node) + length(rest)")).alias("end"))
    marks = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftright(end, {6 * i}) & 63 as int))")).alias(f"m{i}") for i in range(MARKS)]
    found = rest.groupBy("node", "e_ch").agg(F.count(F.lit(1)).alias("words"), F.min(F.struct("rest", "n")).alias("least"), F.max("rest").alias("high"), *marks)
    found = found.select("node", "e_ch", "words", F.col("least.rest").alias("low"), F.col("least.n").alias("low_n"), "high", *_MARKED)
    small = found.where(F.col("words") <= BUCKET).select("node", "e_ch")
    tails = rest.join(small.hint("merge"), ["node", "e_ch"]).groupBy("node", "e_ch").agg(F.collect_list(F.struct("rest", "n")).alias("tails"))
    large = found.where(F.col("words") > BUCKET).withColumn("label", _common_prefix("low", "high")).select(
        F.col("node").alias("e_node"), "e_ch", "label", F.concat("node", "label").alias("child"), F.expr("case when low = label then low_n end").alias("child_n"), *_MARKED)
    return large.unionByName(tails.withColumnRenamed("node", "e_node"), allowMissingColumns=True)


#: States of the next level or, with ``edits`` 2, pairs: ``node`` is then the near word and ``near_n`` its occurrences.
_STATE = ["word", "n", "half", "node", "rest", "edits", "near_n"]
#: The words of a bucket that end a state, and the state behind an edge that has (with this) used its edit.
_ENDS = "transform(filter(tails, t -> {cond}), t -> named_struct('node', concat(node, t.rest), 'rest', '', 'edits', 2, 'near_n', t.n))"
_BEHIND = """named_struct('node', child, 'rest', substring(rest, {cut} + 1), 'edits',
    case when {cut} = length(rest) then case when child_n is not null then 2 end
         when length(rest) - {cut} < """ + str(END) + " or " + _MAY_END.format(end=_END.format(word="rest", length="length(child) + length(rest) - {cut}")) + """ then 1 end, 'near_n', child_n)"""
#: One edit between a bucket's word and the rest, or between a label and as much of the rest: the word has one code point
#: more, or the lesser of the two replaced ones. The other word of such a pair doesn't look for this one.
_NEAR = "(length(t.rest) = length(rest) - 1 or length(t.rest) = length(rest) and rest < t.rest) and levenshtein(t.rest, rest, 1) = 1"
_CUTS = """transform(filter(sequence(length(label), length(label) + 1), c -> c >= exact and c <= length(rest)
    and (c > length(label) or substring(rest, 1, c) < label) and levenshtein(substring(rest, 1, c), label, 1) = 1), c -> """ + _BEHIND.format(cut="c") + ")"
_NONE = "array()"


def _step(states: DataFrame) -> DataFrame:
    edges = _edges(states).hint("merge")
    ahead = states.where("edits < 2").withColumn("exact", F.expr("greatest(half - length(node) + 1, 0)"))
    # a state goes along the edge that its rest begins with; before the end of its exact half it spends its edit there only
    begins = "substring(rest, 1, exact) = substring({x}, 1, exact)"
    along = ahead.withColumn("ch", F.substring("rest", 1, 1)).join(edges, (F.col("node") == F.col("e_node")) & (F.col("ch") == F.col("e_ch")))
    walked = "array(named_struct('node', child, 'rest', substring(rest, length(label) + 1), 'edits', 0, 'near_n', cast(null as long)))"
    went = F.expr(f"""case when edits = 1 and tails is not null then {_ENDS.format(cond="t.rest = rest")}
        when edits = 1 then if(startswith(rest, label), array({_BEHIND.format(cut="length(label)")}), {_NONE})
        when tails is not null then if(exact > 0, {_ENDS.format(cond=begins.format(x="t.rest") + " and " + _NEAR)}, {_NONE})
        when exact > 0 and length(label) >= exact and {begins.format(x="label")} then concat({walked}, {_CUTS})
        else {walked} end""")
    # behind it any edge of its node will do
    free = ahead.where("edits = 0 and exact = 0").join(edges, F.col("node") == F.col("e_node"))
    spent = F.expr(f"case when tails is not null then {_ENDS.format(cond=_NEAR)} else {_CUTS} end")
    kept = ["word", "n", "half"]
    out = along.select(*kept, F.inline(went)).unionByName(free.select(*kept, F.inline(spent)))
    return out.where("edits is not null").select(*_STATE)


def near_pairs(words: DataFrame) -> DataFrame:
    """Rows ``(word, near, near_n)``: for every word of ``words (word, n)`` all others at one edit, both ways round.
    The longer word of a pair, or of two as long the one that comes first, looks for the other. Words need ``2 * STEM`` code points or more."""
    ways = []
    for mark, spelt, half in ((">", F.col("word"), "floor(length(word) / 2)"), ("<", F.reverse("word"), "length(word) - floor(length(word) / 2)")):
        ways.append(words.select("word", "n", F.expr(half).cast("int").alias("half"), F.concat(F.lit(mark), F.substring(spelt, 1, STEM)).alias("node"),
                                 F.expr(f"substring({'word' if mark == '>' else 'reverse(word)'}, {STEM + 1})").alias("rest"),
                                 F.lit(0).alias("edits"), F.lit(None).cast("long").alias("near_n")))
    level = cut_lineage(ways[0].unionByName(ways[1]).select(*_STATE))
    found, levels = None, []
    while True:
        levels.append(level)
        pairs = level.where("edits = 2").select("word", "n", F.expr(
            "case when startswith(node, '>') then substring(node, 2) else reverse(substring(node, 2)) end").alias("near"), "near_n")
        found = pairs if found is None else found.unionByName(pairs)
        if not level.where("edits < 2").limit(1).count():
            break
        level = cut_lineage(_step(level))
    # each pair was looked for from one side
    both = found.distinct().select(F.expr("inline(array(struct(word, near, near_n), struct(near as word, word as near, n as near_n)))"))
    out = cut_lineage(both)
    for table in levels:
        drop_table(table)
    return out


def groups(words: DataFrame, factor: int = 10) -> DataFrame:
    """Rows ``(word, form, root, n, n_near, form_n)`` for ``words (word, n)``. Occurrences grow by ``factor`` from a word to
    its form, so chains of forms end after a few steps; each round doubles the steps that a root has taken."""
    pairs = near_pairs(words)
    best = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best"))
    best = words.join(best.hint("merge"), "word", "left").withColumn("takes", F.expr(f"coalesce(-best.less >= {factor} * n, false)"))
    base = cut_lineage(best.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                   F.expr("case when takes then best.near end").alias("form"), F.expr("case when takes then -best.less end").alias("form_n")), pairs)
    links = cut_lineage(base.where("form is not null").select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = links.join(ahead.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        joined = cut_lineage(joined)
        drop_table(links)
        links = joined
        if not links.where("moved").limit(1).count():
            break
    roots = links.select("word", "root")
    return base.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
