"""Secret scans with a trigram index (operator 8).

Each rule's regex gives a Boolean query over trigrams that any match must contain (on text in lower case). Rows are
indexed in segments, one for each slice of a task: an inverted index from the trigrams that some rule asks for to the
sorted rows that hold them. A rule's query is evaluated by intersecting and uniting postings, and only its candidate
rows are verified with the regex; rules without a mandatory trigram scan every row. Segments stay with their rows, so
nothing is shuffled and the work grows with the text.

Null and empty texts have no spans. Every input row gives a row.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as _c
from re import _parser as _parse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import list_column, schema, utf8, with_kernel
from .spans import SPANS


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``regex``; those whose ``group`` is shorter than ``at_least`` are dropped
    without another try. ASCII letters match either case if ``any_case``."""
    kind: str
    regex: str
    at_least: int = 1
    group: int = 0
    any_case: bool = False

    def compiled(self):
        return re.compile(self.regex, re.ASCII | (re.IGNORECASE if self.any_case else 0))


# The base rules of the contract. A run that `hex` or `access` would drop holds no longer match, so
# their least lengths stand in the regex; `assign` may drop a match that holds the start of another.
BASE = [
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2, True),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
]
MORE = [
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("url_password", r"://[^\s:/@]+:[^\s:/@]+@"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[sr]k_live_[0-9A-Za-z]{16,}"),
]

#: A trigram query: True (any text), a trigram, or ("and" | "or", queries).
Query = object
MOST = 64


def _both(kind: str, parts: list) -> Query:
    """Join queries, dropping what says nothing."""
    flat: list = []
    for p in parts:
        if p is True:
            if kind == "or":
                return True
            continue
        for x in (p[1] if isinstance(p, tuple) and p[0] == kind else [p]):
            if x not in flat:
                flat.append(x)
    return True if not flat else flat[0] if len(flat) == 1 else (kind, flat)


def _of_strings(strings: set[str]) -> Query:
    """Any text that holds one of these strings."""
    return _both("or", [_both("and", [s[i: i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)])


def _exact(item) -> set[str] | None:
    """The few strings that a parsed item stands for, or None."""
    op, arg = item
    if op is _c.LITERAL:
        return {chr(arg).lower()} if arg < 128 else None
    if op is _c.IN:
        out = set()
        for kind, x in arg:
            if kind is _c.LITERAL and x < 128:
                out.add(chr(x).lower())
            elif kind is _c.RANGE and x[1] - x[0] < 8 and x[1] < 128:
                out |= {chr(y).lower() for y in range(x[0], x[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is _c.SUBPATTERN:
        return _sequence_exact(arg[3])
    if op is _c.BRANCH:
        parts = [_sequence_exact(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op is _c.MAX_REPEAT and arg[1] <= 4 and arg[1] is not _c.MAXREPEAT:
        one = _sequence_exact(arg[2])
        if one is None or len(one) ** arg[1] > MOST:
            return None
        out, now = set(), {""}
        for k in range(arg[1] + 1):
            if k >= arg[0]:
                out |= now
            now = {a + b for a in now for b in one}
        return out
    if op in (_c.AT, _c.ASSERT, _c.ASSERT_NOT):
        return {""}
    return None


def _sequence_exact(items) -> set[str] | None:
    now = {""}
    for item in items:
        one = _exact(item)
        if one is None or len(one) * len(now) > MOST:
            return None
        now = {a + b for a in now for b in one}
    return now


def _sequence(items) -> Query:
    """What every match of a sequence must hold: strings of neighbouring exact items, and the queries of the others."""
    parts, now = [], {""}
    for item in items:
        one = _exact(item)
        if one is not None and len(one) * len(now) <= MOST:
            now = {a + b for a in now for b in one}
            continue
        parts.append(_of_strings(now))
        now = one if one is not None else {""}
        if one is None:
            op, arg = item
            if op is _c.SUBPATTERN:
                parts.append(_sequence(arg[3]))
            elif op is _c.BRANCH:
                parts.append(_both("or", [_sequence(x) for x in arg[1]]))
            elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT) and arg[0] > 0:
                parts.append(_sequence(arg[2]))
    parts.append(_of_strings(now))
    return _both("and", parts)


def trigram_query(regex: str) -> Query:
    """The Boolean trigram query that every text with a match of ``regex`` satisfies."""
    return _sequence(_parse.parse(regex))


def trigrams(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _code(t: str) -> int:
    a, b, c = t.encode("ascii")
    return a << 16 | b << 8 | c


_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint32)


class Segment:
    """Inverted index of a slice of rows over the given trigrams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, place: np.ndarray, n: int):
        rows = len(offsets) - 1
        self.rows = rows
        low = _LOWER[data]
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        t = place[code]
        at = np.flatnonzero(t)
        row = np.searchsorted(offsets, at, "right") - 1
        inside = at + 3 <= offsets[row + 1]
        keys = np.unique((t[at[inside]].astype(np.int64) - 1) * rows + row[inside])
        cuts = np.searchsorted(keys, np.arange(n + 1) * rows)
        self.postings = [keys[a:b] % rows for a, b in zip(cuts[:-1], cuts[1:])]

    def find(self, query: Query, index: dict[str, int]) -> np.ndarray:
        if query is True:
            return np.arange(self.rows)
        if isinstance(query, str):
            return self.postings[index[query]]
        found = sorted((self.find(x, index) for x in query[1]), key=len)
        out = found[0]
        for x in found[1:]:
            out = np.intersect1d(out, x, assume_unique=True) if query[0] == "and" else np.union1d(out, x)
        return out


def find(df: DataFrame, text: str, rules: list[Rule] | None = None) -> DataFrame:
    """Append ``spans``: all verified matches, by start, then by the rule's place in the list."""
    rules = BASE + MORE if rules is None else rules
    queries = [trigram_query(r.regex) for r in rules]
    asked = sorted(set().union(*map(trigrams, queries)))

    def kernel():
        patterns = [r.compiled() for r in rules]
        index = {t: i for i, t in enumerate(asked)}
        place = np.zeros(1 << 24, np.uint16)
        place[[_code(t) for t in asked]] = np.arange(1, len(asked) + 1)

        def f(batch):
            segment = Segment(*utf8(batch.column(text)), place, len(asked))
            values = batch.column(text).to_pylist()
            spans: list[list] = [[] for _ in values]
            for k, (rule, pattern, query) in enumerate(zip(rules, patterns, queries)):
                for i in segment.find(query, index).tolist():
                    for m in pattern.finditer(values[i] or ""):
                        if m.end(rule.group) - m.start(rule.group) >= rule.at_least:
                            spans[i].append((m.start(), k, m.end()))
            flat = [s for x in spans for s in sorted(x)]
            col = pa.StructArray.from_arrays(
                [pa.array([rules[k].kind for _, k, _ in flat], pa.string()), pa.array([a for a, _, _ in flat], pa.int32()),
                 pa.array([b for _, _, b in flat], pa.int32())], names=["kind", "start", "end"])
            return [list_column(np.array([len(x) for x in spans], np.int64), col)]

        return f

    return with_kernel(df, text, schema(f"spans {SPANS}"), kernel)
