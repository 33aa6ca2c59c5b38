"""Conversation structure repair: the cheapest edits that make a conversation's roles legal.

Roles are legal if their initials match ``(s?(ua)+)?``. A row is kept (0), given another role (1) or deleted (2); blank
and repeated rows must be deleted, a truncated row that stays costs 5 more, and an empty row may be inserted anywhere
(5). These choices span a lattice of (rows consumed, state of the role pattern). ``cheapest`` runs Dijkstra on it from
both ends: the forward and the reverse heap meet, all crossings of the least cost are finished, and of these the least
concatenated audit (the edits' initials in order) is taken. Two prefixes of one cost that end at one node have consumed
the same rows, so neither is a prefix of the other, and the lesser one stays the lesser whatever follows; the same holds
for suffixes. So one label a node and direction is enough.

On Spark: rows shrink to a letter each (role and fault), sorted by (conversation, turn) in range partitions. A
conversation that lies in one partition is solved there. One that lies across borders, or that is long, is cut into
pieces of at most ``PIECE`` rows; a piece gives its cheapest edits between every two states, and the same search runs
over these. So neither a task nor a group holds more of a conversation than letters. The texts are moved once, in a
second pass that streams a conversation's rows past its audit. (A digest of a whole conversation, as the query asks for,
is a running one over its sorted rows: that stream is not split.)

Null ids, roles and texts count as one space, so rows without an id are one conversation; null turns come first. Rows of
one turn are ordered by role and by a digest of the text; equal rows are interchangeable. A role that is empty or begins
with another letter than s, u and a cannot be kept. Columns other than the four named are not read. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from heapq import heappop, heappush

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_table
from .common import schema, slices

#: Rows of a piece of a long conversation.
PIECE = 1024
#: Solved conversations that a task remembers; many are alike.
KNOWN = 1 << 14
#: Costs of the edits, and of leaving a truncated row in.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States of the role pattern: nothing yet, after s, after u, after a. Where each initial leads; the first and last are final.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
FINAL = (0, 3)
STATES = range(4)
#: A row's letter: place of its initial in this string times four, plus place of its fault.
INITIALS, FAULTS = "sua?", ["", "blank", "duplicate", "truncated"]
LETTERS = "ABCDEFGHIJKLMNOP"
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

_START = (0, 0, "", None)


class Moves:
    """Edges ``(state, next state, cost, audit)`` of one layer of the lattice, by either end."""

    def __init__(self, edges):
        self.edges = list(edges)
        self.out = [[(t, c, a) for s, t, c, a in self.edges if s == q] for q in STATES]
        self.into = [[(s, c, a) for s, t, c, a in self.edges if t == q] for q in STATES]


def _row_moves(initial: str, fault: str) -> Moves:
    edges = [(q, q, DELETE, "D") for q in STATES]
    if fault in ("", "truncated"):
        extra = TRUNCATED if fault else 0
        edges += [(q, t, extra, "K") for q, t in NEXT.get(initial, {}).items()]
        edges += [(q, t, extra + REROLE, "R") for r in "ua" for q, t in NEXT[r].items()]
    return Moves(edges)


MOVES = {letter: _row_moves(INITIALS[i // 4], FAULTS[i % 4]) for i, letter in enumerate(LETTERS)}
INSERTS = Moves([(q, t, INSERT, "I") for r in "ua" for q, t in NEXT[r].items()])
NO_INSERTS = Moves([])


def _apart(a, b) -> tuple[list, list]:
    """Audits of two chains of labels, from their heads to where they join."""
    left, right = [], []
    while a is not b:
        deep = (a[1] if a else -1) - (b[1] if b else -1)
        if deep >= 0:
            left.append(a[2])
            a = a[3]
        if deep <= 0:
            right.append(b[2])
            b = b[3]
    return left, right


def _lesser(new, old, forward: bool) -> bool:
    """Whether a label of one cost has the lesser audit."""
    left, right = _apart(new, old)
    if forward:
        left.reverse()
        right.reverse()
    return "".join(left) < "".join(right)


def _spelt(label, forward: bool) -> str:
    parts = []
    while label is not None:
        parts.append(label[2])
        label = label[3]
    return "".join(reversed(parts) if forward else parts)


def cheapest(layers: list[Moves], inserts: Moves, start: int, finals) -> tuple[int, str] | None:
    """Least cost from ``(0, start)`` to ``(len(layers), one of finals)`` and the least audit at that cost.

    A label is (cost, edits, last audit, label before). Heaps order by cost and then by layer, as edges within a layer
    are never free: a popped node's label is the last word on it."""
    n = len(layers)
    labels = ({(0, start): _START}, {(n, q): (0, 0, "", None) for q in finals})
    heaps = ([(0, 0, start)], [(0, 0, q) for q in finals])
    done = (set(), set())
    least = None

    def around(side, i, q):
        if side == 0:
            if i < n:
                yield from ((i + 1, t, c, a) for t, c, a in layers[i].out[q])
            yield from ((i, t, c, a) for t, c, a in inserts.out[q])
        else:
            if i > 0:
                yield from ((i - 1, s, c, a) for s, c, a in layers[i - 1].into[q])
            yield from ((i, s, c, a) for s, c, a in inserts.into[q])

    while heaps[0] and heaps[1] and (least is None or heaps[0][0][0] + heaps[1][0][0] <= least):
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        mine, other = labels[side], labels[1 - side]
        cost, layer, q = heappop(heaps[side])
        node = (layer if side == 0 else n - layer, q)
        if node in done[side]:
            continue
        done[side].add(node)
        here = mine[node]
        if node in done[1 - side]:
            least = min(x for x in (least, cost + other[node][0]) if x is not None)
        for i, t, c, audit in around(side, *node):
            to = (i, t)
            if to in done[1 - side]:
                least = min(x for x in (least, cost + c + other[to][0]) if x is not None)
            if to in done[side]:
                continue
            new, old = (cost + c, here[1] + 1, audit, here), mine.get(to)
            if old is None or new[0] < old[0] or new[0] == old[0] and _lesser(new, old, side == 0):
                mine[to] = new
                if old is None or new[0] < old[0]:
                    heappush(heaps[side], (new[0], i if side == 0 else n - i, t))
    # a cheapest path leaves the forward side's settled nodes once, into a node that the reverse side has settled
    found = [(labels[0][v][0], v, None, None) for v in done[0] if v[0] == n and v[1] in finals]
    for v in done[0]:
        for i, t, c, audit in around(0, *v):
            if (i, t) not in done[0] and (i, t) in done[1]:
                found.append((labels[0][v][0] + c + labels[1][(i, t)][0], v, audit, (i, t)))
    if not found:
        return None
    cost = min(x[0] for x in found)
    return cost, min(_spelt(labels[0][v], True) + (audit + _spelt(labels[1][w], False) if w else "")
                     for x, v, audit, w in found if x == cost)


def solved(letters: str) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return cheapest([MOVES[x] for x in letters], INSERTS, 0, FINAL)


def transfers(letters: str) -> list[tuple[int, str] | None]:
    """Cost and audit of a piece for every state at its start and at its end."""
    layers = [MOVES[x] for x in letters]
    return [cheapest(layers, INSERTS, q, (t,)) for q in STATES for t in STATES]


def joined(pieces: list[list]) -> tuple[int, str]:
    """The same search over pieces: an edge of a layer is a piece's way between two states. Inserts are in the pieces."""
    layers = [Moves((k // 4, k % 4, *way) for k, way in enumerate(piece) if way is not None) for piece in pieces]
    return cheapest(layers, NO_INSERTS, 0, FINAL)


def counts(letters: str) -> tuple[int, int, int, int]:
    """Blank, repeated and truncated rows, and neighbours whose initials may not follow each other."""
    at = [LETTERS.index(x) for x in letters]
    faults = [x % 4 for x in at]
    illegal = sum((INITIALS[a // 4], INITIALS[b // 4]) not in LEGAL for a, b in zip(at, at[1:]))
    return faults.count(1), faults.count(2), faults.count(3), illegal


def prepared(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """``(key, turn, role, text, h1, h2)``: nulls as one space, and the digests of the text that order rows of a turn."""
    space = F.lit(" ")
    out = rows.select(F.coalesce(F.col(conv_id).cast("string"), space).alias("key"), F.col(turn).cast("long").alias("turn"),
                      F.coalesce(F.col(role), space).alias("role"), F.coalesce(F.col(text), space).alias("text"))
    return out.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(1), "text")})


ORDER = ["turn", "role", "h1", "h2"]
_BLANKS = r"[\x20\x09-\x0D]"


def _letter(fault: Column) -> Column:
    place = F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1))
    initial = F.when((F.length("role") == 0) | (place == 0), F.lit(3)).otherwise(place - 1)
    return F.substring(F.lit(LETTERS), (initial * 4 + fault + 1).cast("int"), F.lit(1))


def lettered(rows: DataFrame) -> DataFrame:
    """``(key, turn, role, h1, h2, letters)``: equal rows of a turn together, one letter each."""
    bare = F.regexp_replace("text", _BLANKS + "+$", "")
    light = rows.withColumns({"blank": F.length(bare) == 0, "ends": F.substring(bare, -1, 1).isin(".", "!", "?")})
    light = light.groupBy("key", *ORDER, "blank", "ends").agg(F.count(F.lit(1)).cast("int").alias("n"))
    said = light.where("not blank").groupBy("key", "role", "h1", "h2").agg(F.max(F.col("turn").isNull()).alias("untimed"), F.min("turn").alias("low"))
    said = said.select("key", "role", "h1", "h2", F.expr("case when not untimed then low end").alias("first_turn"))
    light = light.join(said.hint("merge"), ["key", "role", "h1", "h2"], "left")
    own = F.when(F.col("blank"), 1).when(~F.col("turn").eqNullSafe(F.col("first_turn")), 2).when(~F.col("ends"), 3).otherwise(0)
    more = F.when(F.col("blank"), 1).otherwise(2)
    return light.select("key", *ORDER, F.concat(_letter(own), F.repeat(_letter(more), F.col("n") - 1)).alias("letters"))


_PIECE = ("key string, part int, seq int, whole boolean, cost long, audit string, blank long, duplicate long, truncated long, "
          "illegal long, head string, tail string, ways array<struct<cost:long,audit:string>>")


def _pieces(batches):
    """Solve the conversations that lie within the partition; cut those at its borders, and long ones, into pieces."""
    part = TaskContext.get().partitionId()
    out, seq, known = [], 0, {}

    def remembered(letters):
        if letters not in known:
            if len(known) >= KNOWN:
                known.clear()
            known[letters] = solved(letters)
        return known[letters]

    def put(key, letters, whole):
        nonlocal seq
        seq += 1
        cost, audit = remembered(letters) if whole else (None, None)
        ways = None if whole else [None if w is None else {"cost": w[0], "audit": w[1]} for w in transfers(letters)]
        out.append((key, part, seq, whole, cost, audit, *counts(letters), letters[0], letters[-1], ways))

    def batch_of():
        rows = [dict(zip(_ARROW_PIECE.names, r)) for r in out]
        out.clear()
        return pa.RecordBatch.from_pylist(rows, schema=_ARROW_PIECE)

    key, held, at_border = None, "", True
    for batch in batches:
        for k, letters in zip(batch.column("key").to_pylist(), batch.column("letters").to_pylist()):
            if k != key:
                if key is not None and held:
                    put(key, held, not at_border)
                at_border = key is None
                key, held = k, ""
            held += letters
            while len(held) > PIECE:
                put(key, held[:PIECE], False)
                held, at_border = held[PIECE:], True
        if len(out) > 1000:
            yield batch_of()
    if key is not None:
        put(key, held, False)
    if out:
        yield batch_of()


_ARROW_PIECE = pa.schema([("key", pa.string()), ("part", pa.int32()), ("seq", pa.int32()), ("whole", pa.bool_()), ("cost", pa.int64()),
                          ("audit", pa.string()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                          ("illegal", pa.int64()), ("head", pa.string()), ("tail", pa.string()),
                          ("ways", pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])))])

PLAN = "key string, cost long, audit string, blank long, duplicate long, truncated long, illegal long"
_PLAN_NAMES = [x.split()[0] for x in PLAN.split(", ")]


def _merged(table: pa.Table) -> pa.Table:
    """One conversation from its pieces."""
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["seq"]))
    cost, audit = joined([[None if w is None else (w["cost"], w["audit"]) for w in r["ways"]] for r in rows])
    total = [sum(r[c] for r in rows) for c in ("blank", "duplicate", "truncated", "illegal")]
    total[3] += sum(counts(a["tail"] + b["head"])[3] for a, b in zip(rows, rows[1:]))
    values = [rows[0]["key"], cost, audit, *total]
    return pa.table({c: pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for c, v in zip(_PLAN_NAMES, values)})


def plans(rows: DataFrame) -> DataFrame:
    """``prepared`` rows -> ``(key, cost, audit, blank, duplicate, truncated, illegal, gaps)``, one row a conversation."""
    light = cut_lineage(lettered(rows))
    found = cut_lineage(light.repartitionByRange("key", *ORDER).sortWithinPartitions("key", *ORDER).select("key", "letters")
                        .mapInArrow(_pieces, schema(_PIECE)))
    solved_rows = found.where("whole").select(*_PLAN_NAMES)
    cut_rows = found.where("not whole").groupBy("key").applyInArrow(_merged, schema(PLAN))
    turns = light.groupBy("key").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    out = cut_lineage(solved_rows.unionByName(cut_rows).join(turns.hint("merge"), "key"))
    drop_table(found)
    drop_table(light)
    return out


def repaired(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The conversations after their edits: ``(key, place, role, text, edit)``. A conversation's rows lie in one partition
    and in their order; they stream past the audit, nothing is collected."""
    none = F.lit(None)
    edits = plan.select("key", F.lit(0).alias("tag"), none.cast("long").alias("turn"), none.cast("string").alias("role"),
                        none.cast("long").alias("h1"), none.cast("long").alias("h2"), F.col("audit").alias("text"))
    every = edits.unionByName(rows.withColumn("tag", F.lit(1)).select(*edits.columns))
    every = every.repartition("key").sortWithinPartitions("key", "tag", *ORDER).select("key", "tag", "role", "text")

    def run(batches):
        key, audit, at, state, place, out = None, "", 0, 0, 0, []

        def inserts():
            nonlocal at, state
            while at < len(audit) and audit[at] == "I":
                put(None, "", "I")

        def put(role, text, edit):
            nonlocal at, state, place
            at += 1
            if edit == "D":
                return
            if edit != "K":
                role = "assistant" if state == 2 else "user"
            state = NEXT[role[0]][state]
            out.append((key, place, role, text, edit))
            place += 1

        def batch_of():
            columns = list(zip(*out)) if out else [[]] * 5
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["key", "place", "role", "text", "edit"])
            out.clear()
            return done

        for batch in batches:
            for part in slices(batch, "text") if batch.num_rows else ():
                for k, tag, role, text in zip(*(part.column(c).to_pylist() for c in ("key", "tag", "role", "text"))):
                    if tag == 0:
                        inserts()
                        key, audit, at, state, place = k, text, 0, 0, 0
                    else:
                        inserts()
                        put(role, text, audit[at])
                yield batch_of()
        inserts()
        yield batch_of()

    return every.mapInArrow(run, schema("key string, place long, role string, text string, edit string"))


def digests(out: DataFrame) -> DataFrame:
    """``(key, repaired_sha256)`` of ``repaired`` rows as ``role:text``, joined by newlines: a running digest."""

    def run(batches):
        key, running, done = None, None, []
        for batch in batches:
            for k, place, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "place", "role", "text"))):
                if place == 0:
                    if running is not None:
                        done.append((key, running.hexdigest()))
                    key, running = k, hashlib.sha256()
                else:
                    running.update(b"\n")
                running.update(f"{role}:{text}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in done], pa.string()) for i in (0, 1)], names=["key", "repaired_sha256"])
            done = []
        if running is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.string()), pa.array([running.hexdigest()], pa.string())], names=["key", "repaired_sha256"])

    return out.mapInArrow(run, schema("key string, repaired_sha256 string"))
