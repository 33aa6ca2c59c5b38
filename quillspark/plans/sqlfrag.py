"""DuckDB SQL fragments mirroring ``quillspark.functions.text`` (used by the oracle queries only).

The regex text is the same constant in both engines; DuckDB needs the 'g' flag to replace every match.
"""

from __future__ import annotations

from ..functions import text as tx


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + tx.WS_CLASS + '+|' + tx.WS_CLASS + '+$')}, '', 'g')"


def collapse(x: str) -> str:
    return strip(f"regexp_replace({x}, {q(tx.WS_CLASS + '+')}, ' ', 'g')")


def clean(x: str, final_strip: bool = True) -> str:
    out = f"regexp_replace({collapse(x)}, {q(tx.ZW_CLASS)}, '', 'g')"
    return strip(out) if final_strip else out


def null_tokens(x: str) -> str:
    toks = ", ".join(q(t) for t in tx.NULL_TOKENS)
    return f"CASE WHEN {x} IN ({toks}) THEN NULL ELSE {x} END"


def has_alnum(x: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(tx.ALNUM_PATTERN)}), false)"


def rlike(x: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({x}, {q(pattern)}), false)"


def extract(x: str, pattern: str, group: int) -> str:
    return f"regexp_extract({x}, {q(pattern)}, {group})"
