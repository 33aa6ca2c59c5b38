"""Span lists shared by the two span finders: ``array<struct<kind,start,end>>``, code points, end exclusive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPANS = "array<struct<kind:string,start:int,end:int>>"


def ordered(spans, kinds: list[str]) -> Column:
    """By start, then by the kind's place in ``kinds``, then by end."""
    place = F.create_map(*[x for i, k in enumerate(kinds) for x in (F.lit(k), F.lit(i))])
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), place[s["kind"]].alias("k"), s["end"].alias("e"), s["kind"].alias("n")))
    return F.transform(F.array_sort(keyed), lambda s: F.struct(s["n"].alias("kind"), s["a"].alias("start"), s["e"].alias("end")))


def of_kinds(spans, kinds: list[str]) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def count(spans, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def as_text(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(df: DataFrame, text: str, spans: str, mark: str = "[{}]") -> DataFrame:
    """Replace each span, from left to right, by its kind in ``mark``; spans that overlap a former one only extend it."""
    a, b = mark.split("{}")
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    out = F.aggregate(
        F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), s["end"].alias("e"), s["kind"].alias("k")))), state,
        lambda acc, s: F.when(s["s"] >= acc["at"], F.struct(s["e"].alias("at"), F.concat(
            acc["out"], F.substring(F.col(text), acc["at"] + 1, s["s"] - acc["at"]), F.lit(a), s["k"], F.lit(b)).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["e"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return df.withColumn(text, F.when(F.size(spans) > 0, out).otherwise(F.col(text)))
