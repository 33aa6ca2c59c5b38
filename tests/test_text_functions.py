"""Edge tables for the text expressions: Python whitespace semantics, zero-width marks, null tokens,
retweet parsing and routing precedence (compared with the Python behaviour they mirror)."""
import re

from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.operators import cleaning as cl

SAMPLES = [
    "plain text", "  lead and trail  ", "a b", "a　b", "a b", "a\u001cb", "a ​ b",
    "​x‌‍y​", "emoji 😀 here", "", "   ", "tab\tand\nnewline", "x  y",
]


def py_clean(t, final_strip=True):
    t = " ".join(t.split())
    t = t.replace("​", "").replace("‌", "").replace("‍", "")
    return t.strip() if final_strip else t


def test_clean_text_matches_python(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "i int, t string")
    got = {r.i: (r.a, r.b, r.c) for r in df.select("i", tx.clean_text("t").alias("a"),
                                                     tx.clean_text("t", final_strip=False).alias("b"),
                                                     tx.py_strip("t").alias("c")).collect()}
    for i, s in enumerate(SAMPLES):
        assert got[i][0] == py_clean(s), (s, got[i][0])
        assert got[i][1] == py_clean(s, False), (s, got[i][1])
        assert got[i][2] == s.strip(), (s, got[i][2])


def test_null_tokens(spark):
    vals = ["NULL", "NA", "None", "nan", "n/a", "<NA>", "", "none", "ok", None]
    df = spark.createDataFrame([(v,) for v in vals], "t string")
    out = [r[0] for r in df.select(tx.null_tokens("t")).collect()]
    assert out == [None] * 7 + ["none", "ok", None]


def py_rt(text):
    if text is None:
        return None, None
    m = re.match(r"^RT\s+@(\w+):\s*(.*)", str(text).strip(), re.DOTALL)
    return (m.group(1), m.group(2).strip()) if m else (None, None)


def test_retweet_parts_match_python(spark):
    cases = ["RT @alice: hello", "RT @bob:\nline one\nline two  ", "RT @carl:", "  RT @dan:   spaced",
             "RT @eve no colon", "RT  @józef: accented", "@x hi", "RT @a: @b", None, "rt @low: case"]
    df = spark.createDataFrame([(c,) for c in cases], "t string")
    a, c = tx.retweet_parts("t")
    got = [(r[0], r[1]) for r in df.select(a, c).collect()]
    assert got == [py_rt(x) for x in cases]


def test_routing_precedence(spark):
    rows = [("x", "True", "False"), ("RT @a: x", "False", "False"), ("@a hi", "False", "False"),
            ("RT @a: @b", "False", "True"), (None, "False", "False"), ("plain", "False", "True"),
            ("@é hi", "False", "False")]
    df = spark.createDataFrame(rows, "text string, isRetweet string, isReply string")
    kinds = [r[0] for r in df.select(cl.route_kind()).collect()]
    assert kinds == ["retweet", "retweet", "reply", "retweet", "original", "reply", "reply"]
