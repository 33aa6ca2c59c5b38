"""Column expressions for text: whitespace, zero-width marks, null tokens, post prefixes.

Python's ``str.split()`` / ``str.strip()`` treat a wider set of characters as blanks than Java's or RE2's
``\\s``; the class below spells the set out so Spark (Java regex) and the DuckDB oracle (RE2) agree.
``\\x{...}`` escapes are understood by both engines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -------------------------------------------------------------------------------------
# Characters Python's str.split()/str.strip() treat as whitespace (str.isspace()).
WS_CLASS = (r"[\t\n\x{0B}\x{0C}\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# Zero-width space, non-joiner, joiner (removed after whitespace collapse).
ZW_CLASS = r"[\x{200B}\x{200C}\x{200D}]"
# Word characters as Python's Unicode \w: letters, numbers, underscore.
WORD_CLASS = r"[\pL\pN_]"
# Whole-field strings pandas.read_csv reads as missing by default.
NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]
# Routing patterns (retweet prefix, reply prefix).
RT_PATTERN = r"^RT" + WS_CLASS + "+@" + WORD_CLASS + "+:"
REPLY_PATTERN = r"^@" + WORD_CLASS
RT_EXTRACT = r"(?s)^RT" + WS_CLASS + "+@(" + WORD_CLASS + "+):" + WS_CLASS + "*(.*)$"
ALNUM_PATTERN = r"[a-zA-Z0-9]"
# ------------------------------------------------------------------------------------------------------

# The same whitespace set written with Java's White_Space property (verified equal to str.isspace over the
# BMP): two character predicates instead of fifteen ranges, so Spark's regexes run faster. The explicit
# class above stays for engines without Unicode properties (the DuckDB oracle).
WS_CHARS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
ZW_CHARS = "\u200b\u200c\u200d"
WS_JAVA = r"[\p{IsWhite_Space}\x{1C}-\x{1F}]"
RT_PATTERN_J = RT_PATTERN.replace(WS_CLASS, WS_JAVA)
RT_EXTRACT_J = RT_EXTRACT.replace(WS_CLASS, WS_JAVA)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: drop leading/trailing Python whitespace."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def collapse_ws(c) -> Column:
    """``' '.join(s.split())``: runs of whitespace become one blank, ends trimmed. One table look-up a character, then
    only runs of blanks meet a regex."""
    blanks = F.translate(_c(c), WS_CHARS, " " * len(WS_CHARS))
    return F.trim(F.when(F.contains(blanks, F.lit("  ")), F.regexp_replace(blanks, " {2,}", " ")).otherwise(blanks))


def drop_zero_width(c) -> Column:
    some = F.contains(_c(c), F.lit(ZW_CHARS[0])) | F.contains(_c(c), F.lit(ZW_CHARS[1])) | F.contains(_c(c), F.lit(ZW_CHARS[2]))
    return F.when(some, F.translate(_c(c), ZW_CHARS, "")).otherwise(_c(c))


def clean_text(c, final_strip: bool = True) -> Column:
    """Whitespace collapse, then zero-width removal, then (optionally) strip. Null stays null."""
    out = drop_zero_width(collapse_ws(c))
    return F.trim(out) if final_strip else out


def null_tokens(c) -> Column:
    """Whole-field missing markers become null (what a pandas CSV re-read does to a stage file)."""
    col = _c(c)
    return F.when(col.isin(NULL_TOKENS), F.lit(None).cast("string")).otherwise(col)


def has_alnum(c) -> Column:
    return F.coalesce(_c(c).rlike(ALNUM_PATTERN), F.lit(False))


def is_retweet_text(c) -> Column:
    return F.coalesce(_c(c).rlike(RT_PATTERN_J), F.lit(False))


def is_reply_text(c) -> Column:
    return F.coalesce(_c(c).rlike(REPLY_PATTERN), F.lit(False))


def retweet_parts(c) -> tuple[Column, Column]:
    """(author, content) of ``RT @author: content`` after a strip; both null when the text does not match."""
    s = py_strip(c)
    author = F.regexp_extract(s, RT_EXTRACT_J, 1)
    content = py_strip(F.regexp_extract(s, RT_EXTRACT_J, 2))
    matched = author != F.lit("")
    return (F.when(matched, author), F.when(matched, content))


def preview(c, n: int = 80) -> Column:
    """Newlines to blanks, first ``n`` characters."""
    return F.substring(F.regexp_replace(_c(c), "\n", " "), 1, n)
