"""Personal data by bootstrapped contextual extraction (operator 6).

Base identifiers (e-mail, IP, card, phone) come from fixed patterns. They seed a pattern-instance graph: a pattern is
the pair of words before a mention, an instance the value mentioned. Spark scores the graph in rounds: a pattern's
confidence for a kind is the summed score of its mentions over all its occurrences in the corpus, also those before
ordinary words; an unseen value scores as the most confident pattern that precedes it. Patterns of at least
``support`` distinct values and ``confidence`` then discover identifiers that the base patterns don't know: tokens
with a digit that no base span touches. Found values strengthen their other contexts in the next round.

The rows are scanned once for mentions (a small table, written to the shared folder) and once for the totals of the
contexts; a fixed bitmap of context hashes limits what the second scan counts, and an exact join removes its false
hits. Null and empty texts have no spans. Every input row gives a row; equal rows give equal results.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import list_column, schema, slices, utf8, with_kernel, word_hashes, words_of
from .spans import SPANS, ordered

KINDS = ["email", "ip", "card", "phone"]
#: Kinds of spans that contexts discover.
FOUND = ["ctx_" + k for k in KINDS]

# The base patterns of the contract. A run of digits is entered at its start only, and an e-mail at its
# "@", which finds the same leftmost matches in linear time.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"

#: Words that a context may discover have a digit and five characters without these marks around them.
WORD = re.compile(r"\S+")
MARKS = ".,;:!?\"'()[]{}<>"
DIGIT = re.compile(r"[0-9]")
#: Bytes that end a context word: white space.
IS_CONTEXT = np.array([b > 32 for b in range(256)])
_FOLD = np.array([b + 32 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256)], np.uint8)
BITS = 24


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        if i % 2:
            x = x * 2 - 9 * (x > 4)
        total += x
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    start, at = 0, text.find("@")
    while at >= 0:
        m = DOMAIN.match(text, at + 1)
        left = text[start:at]
        begin = at - (len(left) - len(left.rstrip(LOCAL)))
        if m and begin < at:
            yield begin, m.end()
            start = m.end()
        else:
            start = at + 1
        at = text.find("@", start)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then by kind as listed."""
    out = [(a, b, 0) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), m.end(), 1) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                out.append((m.start(), m.end(), 2))
        out += [(m.start(), m.end(), 3) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    out.sort(key=lambda s: (s[0], s[2]))
    return [(a, b, KINDS[k]) for a, b, k in out]


def other_tokens(text: str, base: list) -> list[tuple[int, int]]:
    """Words with a digit, five characters or more without the marks around them, that touch no base span."""
    out, spans, i = [], sorted((a, b) for a, b, _ in base), 0
    if not DIGIT.search(text):
        return out
    for m in WORD.finditer(text):
        word = m[0]
        if len(word) < 5 or not DIGIT.search(word):
            continue
        core = word.strip(MARKS)
        begin = m.start() + len(word) - len(word.lstrip(MARKS))
        while i < len(spans) and spans[i][1] <= m.start():
            i += 1
        if len(core) >= 5 and not any(a < m.end() and begin < b for a, b in spans[i: i + 4]):
            out.append((begin, begin + len(core)))
    return out


def context_hashes(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the words of a column: start (byte), row, and the hash of the two words before it (0 without two)."""
    data, offsets = utf8(column)
    starts, ends, row = words_of(data, offsets, IS_CONTEXT)
    h = word_hashes(_FOLD[data], starts, ends)
    ctx = np.zeros(len(h), np.uint64)
    if len(h) > 2:
        pair = (h[:-2] * np.uint64(0x9E3779B97F4A7C15)) ^ h[1:-1]
        ctx[2:] = np.where(row[2:] == row[:-2], pair | np.uint64(1), np.uint64(0))
    return starts - offsets[row] if len(row) else starts, row, ctx


def mentions(df: DataFrame, text: str) -> DataFrame:
    """Append ``mentions``: base spans and other tokens (kind null) with the hash of the context before and the value."""
    kind = "array<struct<kind:string,start:int,end:int,context:bigint,value:string>>"

    def kernel():
        def f(batch):
            values = batch.column(text).to_pylist()
            starts, row, ctx = context_hashes(batch.column(text))
            first = np.searchsorted(row, np.arange(batch.num_rows + 1))
            rows, counts = [], np.zeros(len(values), np.int64)
            for i, t in enumerate(values):
                if not t:
                    continue
                base = base_spans(t)
                found = base + [(a, b, None) for a, b in other_tokens(t, base)]
                counts[i] = len(found)
                if not found:
                    continue
                own, ascii_only = starts[first[i]: first[i + 1]], t.isascii()
                for a, b, k in found:
                    at = a if ascii_only else len(t[:a].encode())
                    w = int(np.searchsorted(own, at, "right")) - 1     # the word that holds the mention's start
                    c = int(ctx[first[i] + w].astype(np.int64)) if w >= 0 else 0
                    rows.append((k, a, b, c, t[a:b]))
            cols = list(zip(*rows)) or [[]] * 5
            types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.string())
            return [list_column(counts, pa.StructArray.from_arrays([pa.array(c, x) for c, x in zip(cols, types)],
                                                                   names=["kind", "start", "end", "context", "value"]))]
        return f

    return with_kernel(df, text, schema(f"mentions {kind}"), kernel)


def context_totals(df: DataFrame, text: str, contexts: DataFrame) -> DataFrame:
    """``(context, total)``: how often each of ``contexts`` stands before any word of the corpus."""
    # a bitmap of 2^24 bits, whatever the number of contexts: 2^18 longs at most come to the driver
    filled = (contexts.withColumn("bit", F.shiftrightunsigned("context", 64 - BITS)).groupBy(F.expr("bit >> 6").alias("w"))
              .agg(F.bit_or(F.expr("1L << CAST(bit & 63 AS INT)")).alias("b")).collect())
    bitmap = np.zeros(1 << (BITS - 6), np.int64)
    for r in filled:
        bitmap[r["w"]] = r["b"]
    sent = df.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        flags = np.unpackbits(sent.value.view(np.uint8), bitorder="little").astype(bool)
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, ctx = context_hashes(part.column("text"))
                ctx = ctx[flags[ctx >> np.uint64(64 - BITS)] & (ctx != 0)]
                keys, n = np.unique(ctx, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["context", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(run, "context bigint, n bigint")
    return counted.groupBy("context").agg(F.sum("n").alias("total")).join(contexts, "context", "left_semi")


def find(df: DataFrame, text: str, support: int = 5, confidence: float = 0.5, rounds: int = 3, keep_text: bool = False) -> DataFrame:
    """Append ``spans``: the base spans and, as kinds ``ctx_...``, the discovered ones. The text itself goes, so that
    the table of mentions stays small, unless ``keep_text``.

    ``rounds`` is how far found values carry to further contexts (a parameter of the method, not a limit on rows)."""
    named = df.withColumn("_row", F.monotonically_increasing_id())
    found = mentions(named, text)
    table = cut_lineage(found if keep_text else found.drop(text))
    m = table.select("_row", F.explode("mentions").alias("m")).select("_row", "m.*").where("context <> 0")
    seen = m.groupBy("context", "value").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n"))
    wide = seen.groupBy("context").agg(F.count(F.lit(1)).alias("values"), F.count("kind").alias("seeds"))
    contexts = wide.where((F.col("values") >= support) & (F.col("values") > 0)).select("context")
    totals = context_totals(df, text, contexts)
    graph = cut_lineage(seen.join(totals, "context"))
    scores = graph.where("kind is not null").select("value", "kind", F.lit(1.0).alias("score")).distinct()
    for _ in range(rounds):
        patterns = (graph.drop("kind").join(scores, "value").groupBy("context", "kind")
                    .agg((F.sum(F.col("n") * F.col("score")) / F.first("total")).alias("conf"), F.count(F.lit(1)).alias("known"))
                    .where((F.col("conf") >= confidence) & (F.col("known") >= support))
                    .groupBy("context").agg(F.max_by(F.struct("kind", "conf"), F.struct("conf", "kind")).alias("p"))
                    .select("context", "p.kind", "p.conf"))
        unseen = graph.where("kind is null").select("context", "value").join(patterns, "context")
        best = unseen.groupBy("value").agg(F.max_by(F.struct("kind", F.col("conf").alias("score")), F.struct("conf", "kind")).alias("p"))
        scores = cut_lineage(graph.where("kind is not null").select("value", "kind", F.lit(1.0).alias("score")).distinct()
                             .unionByName(best.select("value", "p.kind", "p.score")))
    # mentions of unseen values in a confident context
    accepted = (m.where("kind is null").drop("kind").join(patterns, "context")
                .select("_row", F.struct(F.concat(F.lit("ctx_"), "kind").alias("kind"), "start", "end").alias("s"))
                .groupBy("_row").agg(F.collect_list("s").alias("_more")))     # spans of one row
    base = F.transform(F.filter("mentions", lambda x: x["kind"].isNotNull()),
                       lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    joined = table.join(accepted, "_row", "left")
    spans = ordered(F.concat(base.cast(SPANS), F.coalesce("_more", F.array().cast(SPANS))), KINDS + FOUND)
    return joined.withColumn("spans", spans).drop("_row", "_more", "mentions")
