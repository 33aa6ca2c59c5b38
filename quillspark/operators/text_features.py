"""Text features over an ordered day of posts.

The reference concatenates each day's posts with `` <SEP> `` into one string and runs tokenizers over
it. A day is an unbounded group, so nothing here builds that string: every operator works on per-post
token arrays (row-local expressions), derives the few tokens that the concatenation adds at post borders
from the previous post (a two-level ordered scan, no per-day window), and aggregates per (day, term) with
map-side combining. Results equal those on the concatenated text.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import lexicon as lx
from ..functions import text as tx
from ..session import cut_lineage, sweep
from . import ordered

SEP = " <SEP> "
SEP_TOKEN = "sep"          # what the tokenizer makes of the separator
TOKEN_PATTERN = tx.WORD_CLASS + "{2,}"   # (?u)\b\w\w+\b: maximal word runs of length >= 2
SENT_TOKEN_PATTERN = "[\\pL\\pN_']+"
LABEL_RUN_PATTERN = tx.WORD_CLASS + "+"
LABEL_TOKEN = "^[a-z_]{2,}$"


def _arr_lit(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def _day_starts(posts: DataFrame, day: str, order: Sequence[str], max_days: int = 1 << 18) -> DataFrame:
    """``(day, _first)``: the order key of each day's first post; broadcast up to ``max_days`` days."""
    first = posts.groupBy(day).agg(F.min(F.struct(*[F.col(c) for c in order])).alias("_first"))
    return F.broadcast(first) if first.count() <= max_days else first


def day_pieces(posts: DataFrame, day: str, order: Sequence[str], text: str = "text") -> DataFrame:
    """A4 in long form: each post becomes one piece of its day's concatenation (null text -> ''), the
    separator prefixed to every piece but the day's first. Concatenating pieces in ``order`` gives the
    reference's daily string; no day is gathered in one row."""
    p = posts.join(_day_starts(posts, day, order), day, "left")
    is_first = F.struct(*[F.col(c) for c in order]) == F.col("_first")
    piece = F.when(is_first, F.coalesce(F.col(text), F.lit(""))).otherwise(
        F.concat(F.lit(SEP), F.coalesce(F.col(text), F.lit(""))))
    return p.select(day, *order, piece.alias("piece"), is_first.alias("is_first"))


def word_tokens(c, stop_words: Sequence[str] = ()) -> Column:
    """Lower-cased ``\\w\\w+`` tokens with stop words removed (array, order kept)."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(c if isinstance(c, Column) else F.col(c), F.lit(""))),
                                F.lit(TOKEN_PATTERN), 0)
    if stop_words:
        # isin on a literal list becomes a hash InSet; array_contains would scan the list per token
        stop_list = list(stop_words)
        toks = F.filter(toks, lambda t: ~t.isin(stop_list))
    return toks


def bigrams(arr: Column) -> Column:
    return F.transform(F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0))),
                       lambda x, i: F.concat(x, F.lit(" "), arr[i + 1]))


def scan(posts: DataFrame, day: str, order: Sequence[str], text: str = "text", **sentiment) -> DataFrame:
    """One pass over the texts for all daily features: ``(day, *order, _s, _tok)`` with each post's summed valence (T1) and
    its word tokens, stop words included. What follows reads tokens, never texts."""
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    first = posts.select(day, *order, body.alias("_body"))
    first = first.select(day, *order, F.regexp_extract_all("_body", F.lit(SENT_TOKEN_PATTERN), 0).alias("_toks"),
                         F.regexp_extract_all("_body", F.lit(TOKEN_PATTERN), 0).alias("_tok"))
    return first.select(day, *order, _valences(**sentiment).alias("_s"), "_tok")


def day_words(tokens: DataFrame, day: str, order: Sequence[str]) -> DataFrame:
    """``(day, term, n)``: single tokens of each day's concatenation, stop words and separators included."""
    return _word_rows(tokens, day, order).groupBy(day, "term").agg(F.count(F.lit(1)).alias("n"))


def _word_rows(tokens, day, order, chosen=None):
    """(day, term), a row for every single token of each day's concatenation, or for the ``chosen`` ones."""
    me = F.struct(*[F.col(c) for c in order])
    seps = tokens.select(day, *order).join(_day_starts(tokens, day, order), day, "left").where(me != F.col("_first"))
    found = F.col("_tok") if chosen is None else F.filter("_tok", lambda t: t.isin(chosen))
    out = tokens.select(day, F.explode(found).alias("term"))
    return out.unionByName(seps.select(day, F.lit(SEP_TOKEN).alias("term")))


def tfidf(posts: DataFrame, day: str, order: Sequence[str], text: str = "text", **options):
    """T2 over texts: see ``tfidf_of``."""
    tokens = cut_lineage(posts.select(day, *order, word_tokens(F.col(text)).alias("_tok")))
    return tfidf_of(tokens, None, day, order, **options)


#: Words that are told from the others by a literal set; more of them are not worth it.
MOST_FREQUENT = 50_000


def tfidf_of(tokens: DataFrame, words: DataFrame | None, day: str, order: Sequence[str], stop_words: Sequence[str] = lx.TFIDF_STOP_WORDS,
             min_df: int = 2, max_df: float = 0.95, max_features: int = 1000, bucket_rows: int = 1 << 16):
    """T2 over ``scan``'s tokens and ``day_words`` (None: they are counted from the tokens). Returns (weights[day, term, weight], vocabulary[term, df, total, idf]).

    Vocabulary: 2 <= df <= max_df * n_days, then the ``max_features`` terms of highest total count
    (ties: term). idf = ln((1 + n) / (1 + df)) + 1; weights are count * idf, L2-normalised per day.

    Nearly all bigrams are rare, and a bigram occurs at most as often as its rarer word. If ``max_features`` single words
    have a total of t or more, a bigram of a word below t is not in the vocabulary: such bigrams are never counted.
    The others are first counted over all days, a day being one bit of a mask, so that the exchange holds a term once
    a task and 64 days; counts by day are made of the vocabulary's terms only.
    """
    stop_list = list(stop_words)
    stopped = lambda df: df.where(~F.col("term").isin(stop_list)) if stop_list else df
    days = tokens.select(day).distinct().withColumn("_di", (F.row_number().over(Window.orderBy(day)) - 1).cast("long"))   # the calendar bounds them
    n_days = days.count()

    def fit(found):
        return found.where((F.col("df") >= min_df) & (F.col("df") <= max_df * n_days))

    def best(found):
        return found.orderBy(F.col("total").desc(), F.col("term").asc()).limit(max_features)

    if words is None:
        every = _totals(stopped(_word_rows(tokens, day, order)), day, days, n_days)
    else:
        every = stopped(words).groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("total"))
    every = cut_lineage(every)
    sweep(tokens.sparkSession)
    floor = best(fit(every)).agg(F.count(F.lit(1)).alias("k"), F.min("total").alias("t")).first()
    least = max(min_df, floor["t"] if floor["k"] == max_features else 0)
    frequent = [r[0] for r in every.where(F.col("total") >= least).select("term").limit(MOST_FREQUENT + 1).collect()]
    border = cut_lineage(_border_pairs(tokens, day, order, stop_list, bucket_rows))
    pairs = _inner_pairs(tokens, day, stop_list, frequent if len(frequent) <= MOST_FREQUENT else None).unionByName(border)
    found = fit(_totals(pairs, day, days, n_days)).where(F.col("total") >= least)
    vocab = cut_lineage(best(fit(every).unionByName(found)).withColumn("idf", F.log((1 + F.lit(n_days)) / (1 + F.col("df"))) + 1.0))
    sweep(tokens.sparkSession)
    # the vocabulary is at most max_features rows: collecting and broadcasting it is bounded by a parameter
    chosen = [r[0] for r in vocab.select("term").collect()]
    alone, chosen = [t for t in chosen if " " not in t], [t for t in chosen if " " in t]
    inner = _inner_pairs(tokens, day, stop_list, sorted({w for t in chosen for w in t.split(" ")}), chosen)
    if words is None:
        inner = inner.unionByName(_word_rows(tokens, day, order, alone))
    counts = inner.unionByName(border.where(F.col("term").isin(chosen))).groupBy(day, "term").agg(F.count(F.lit(1)).alias("n"))
    if words is not None:
        counts = stopped(words).select(day, "term", "n").unionByName(counts)
    w = counts.join(F.broadcast(vocab.select("term", "idf")), "term").withColumn("w", F.col("n") * F.col("idf"))
    norm = w.groupBy(day).agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("_norm"))
    weights = w.join(norm, day).select(day, "term", (F.col("w") / F.col("_norm")).alias("weight"))
    return weights, vocab


def _totals(terms, day, days, n_days):
    """(term, df, total) of the rows ``(day, term)``; days are told by masks of 64."""
    d = F.broadcast(days.withColumnRenamed(day, "_day"))
    rows = terms.join(d, F.col(day).eqNullSafe(F.col("_day"))).select("term", F.floor(F.col("_di") / 64).alias("_w"), F.expr("shiftleft(1L, cast(_di % 64 as int))").alias("_bit"))
    keys = ["term"] if n_days <= 64 else ["term", "_w"]
    seen = rows.groupBy(*keys).agg(F.bit_or("_bit").alias("_mask"), F.count(F.lit(1)).alias("total"))
    seen = seen.select("term", F.bit_count("_mask").cast("long").alias("df"), "total")
    return seen if n_days <= 64 else seen.groupBy("term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def _kept_tokens(stop_list):
    return F.filter("_tok", lambda t: ~t.isin(stop_list)) if stop_list else F.col("_tok")


def _inner_pairs(tokens, day, stop_list, frequent, chosen=None):
    """(day, term), a row for every bigram inside a post: those of two ``frequent`` words (None: all), or the ``chosen``."""
    d = tokens.select(day, _kept_tokens(stop_list).alias("_tok"))
    arr = F.col("_tok")
    if frequent is None:
        own = bigrams(arr)
    else:
        known = lambda x: x.isin(frequent) if frequent else F.lit(False)
        both = F.transform(F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0))),
                           lambda x, i: F.when(known(x) & known(arr[i + 1]), F.concat(x, F.lit(" "), arr[i + 1])))
        own = F.filter(both, lambda x: x.isNotNull() if chosen is None else x.isin(chosen) if chosen else F.lit(False))
    return d.select(day, F.explode(own).alias("term"))


def _border_pairs(tokens, day, order, stop_list, bucket_rows):
    """(day, term), a row for every bigram of the concatenation that a post's border makes: of each post only its first
    and last token and their number take part in the ordered scan that finds what stands before it."""
    d = tokens.select(day, *order, _kept_tokens(stop_list).alias("_tok"))
    d = d.select(day, *order, F.size("_tok").alias("_n"), F.try_element_at(F.col("_tok"), F.lit(1)).alias("_first_tok"),
                 F.try_element_at(F.col("_tok"), F.lit(-1)).alias("_last_tok"))
    me = F.struct(*[F.col(c) for c in order])
    d = d.join(_day_starts(tokens, day, order), day, "left").withColumn("_isf", me == F.col("_first")).drop("_first")
    bucket = F.struct(*[F.col(c) for c in order[:-1]], F.floor(F.col(order[-1]) / bucket_rows))
    d = ordered.carry_last(d, F.struct(F.col("_n").alias("n"), F.col("_last_tok").alias("t"), F.col("_isf").alias("f")),
                           list(order), "_pv", by=[day], bucket=bucket, inclusive=False)
    # token just before this post's separator: the previous post's last token; if it had none, the
    # separator before it (absent when the previous post was the day's first)
    tail = F.when(F.col("_pv.n") > 0, F.col("_pv.t")).when(~F.col("_pv.f"), F.lit(SEP_TOKEN))
    added = F.array(F.concat(tail, F.lit(" " + SEP_TOKEN)),
                    F.when(F.col("_n") > 0, F.concat(F.lit(SEP_TOKEN + " "), F.col("_first_tok"))))
    return d.where(~F.col("_isf")).select(day, F.explode(added).alias("term")).where(F.col("term").isNotNull())


def _valences(lexicon: dict | None = None, negations: Sequence[str] = lx.NEGATIONS, boost_up: Sequence[str] = lx.BOOSTERS_UP,
              boost_down: Sequence[str] = lx.BOOSTERS_DOWN) -> Column:
    """Summed valence of the tokens in ``_toks``.

    Per token: lexicon valence; +/-0.293 toward its sign when the previous token is an intensifier /
    softener; x(-0.74) when one of the three previous tokens is a negation (all within the post)."""
    lex = lexicon or lx.SENTIMENT_LEXICON
    lex_map = F.create_map(*[x for k, v in sorted(lex.items()) for x in (F.lit(k), F.lit(float(v)))])
    lex_keys, neg, up, down = sorted(lex), list(negations), list(boost_up), list(boost_down)
    # the token array is materialised as a column first: referenced inside the per-token lambda, an
    # inline expression would be re-evaluated for every token
    toks = F.col("_toks")

    def valence(t, i):
        # membership via isin (hash InSet); the map is read only for lexicon words
        v = F.when(t.isin(lex_keys), F.try_element_at(lex_map, t)).otherwise(F.lit(0.0))
        prev1 = F.coalesce(F.when(i >= 1, F.try_element_at(toks, i)), F.lit(""))
        sgn = F.signum(v)
        v = (v + F.when((v != 0) & prev1.isin(up), sgn * lx.BOOST)
               .when((v != 0) & prev1.isin(down), -sgn * lx.BOOST)
               .otherwise(F.lit(0.0)))
        negated = F.exists(F.slice(toks, F.greatest(i - 2, F.lit(1)), F.least(i, F.lit(3))), lambda p: p.isin(neg))
        return F.when((v != 0) & (i >= 1) & negated, v * lx.NEGATION_SCALAR).otherwise(v)

    return F.aggregate(F.transform(toks, valence), F.lit(0.0), lambda acc, x: acc + x)


def day_sentiment(scanned: DataFrame, day: str) -> DataFrame:
    """The day score s / sqrt(s^2 + 15) of the posts' summed valences (``_s``), in [-1, 1]."""
    return scanned.groupBy(day).agg(F.sum("_s").alias("_S")).select(
        day, (F.col("_S") / F.sqrt(F.col("_S") * F.col("_S") + lx.ALPHA)).alias("sentiment_compound"))


def sentiment_scores(posts: DataFrame, day: str, text: str = "text", **options) -> DataFrame:
    """Lexicon sentiment per day. Per-post work is row-local array code (``_valences``); one grouped sum per day."""
    # the token array is materialised as a column first: inline, it would be evaluated anew for every token
    toks = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(SENT_TOKEN_PATTERN), 0)
    return day_sentiment(posts.select(day, toks.alias("_toks")).select(day, _valences(**options).alias("_s")), day)


def poly_hash(tok: Column, mod: int = 1000003) -> Column:
    """Rolling hash h = (31*h + codepoint) mod p over the token's characters (same rule in the oracle)."""
    cps = F.transform(F.split(tok, ""), lambda ch: F.ascii(ch).cast("long"))
    return F.aggregate(cps, F.lit(0).cast("long"), lambda a, x: (a * 31 + x) % mod)


def day_tokens(posts: DataFrame, day: str, order: Sequence[str], text: str = "text") -> DataFrame:
    """(day, tok): word tokens of each day's concatenated text, separators included."""
    me = F.struct(*[F.col(c) for c in order])
    p = posts.join(_day_starts(posts, day, order), day, "left")
    sep = F.when(me != F.col("_first"), F.array(F.lit(SEP_TOKEN))).otherwise(F.array().cast("array<string>"))
    return p.select(day, F.explode(F.concat(word_tokens(F.col(text)), sep)).alias("tok"))


def hash_embeddings(tokens: DataFrame, key: str, tok: str = "tok", dim: int = 64) -> DataFrame:
    """T4 default encoder: signed feature hashing of word tokens, L2-normalised, ``dim`` floats per key.
    Bucket = h mod dim, sign = + when (h div dim) is even. A learned encoder can replace it through
    ``encode_with`` (mapInPandas)."""
    # count each (key, token) first (combined map-side), then hash once per distinct pair
    return hash_embeddings_of(tokens.groupBy(key, F.col(tok).alias("term")).agg(F.count(F.lit(1)).alias("n")), key, dim)


def hash_embeddings_of(counts: DataFrame, key: str, dim: int = 64) -> DataFrame:
    """``hash_embeddings`` of tokens that are already counted: rows ``(key, term, n)``."""
    tf_ = counts.select(key, F.col("term").alias("_tok"), F.col("n").alias("_n"))
    h = poly_hash(F.col("_tok"))
    contrib = tf_.select(key, (h % dim).cast("int").alias("d"),
                         (F.when(F.floor(h / dim) % 2 == 0, 1.0).otherwise(-1.0) * F.col("_n")).alias("s"))
    sums = contrib.groupBy(key, "d").agg(F.sum("s").alias("v"))
    norm = sums.groupBy(key).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("_n"))
    v = sums.join(norm, key).select(key, "d", F.when(F.col("_n") > 0, F.col("v") / F.col("_n")).otherwise(0.0).alias("v"))
    # dim is a parameter (tens to hundreds): one row per key with a dense array
    dense = v.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct("d", "v"))).alias("_m"))
    arr = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.coalesce(F.try_element_at(F.col("_m"), i), F.lit(0.0)))
    return dense.select(key, arr.alias("embedding"))


def encode_with(posts: DataFrame, key: str, text: str, encoder_factory, dim: int) -> DataFrame:
    """T4 with any batch encoder (e.g. a sentence-embedding model): ``encoder_factory()`` is called once
    per Python worker and must return ``f(list[str]) -> array (n, dim)``. Arrow batches via mapInPandas."""
    import pandas as pd

    def run(it):
        enc = encoder_factory()
        for pdf in it:
            vecs = enc(pdf[text].fillna("").astype(str).tolist())
            yield pd.DataFrame({key: pdf[key], "embedding": [list(map(float, v)) for v in vecs]})
    return posts.select(key, text).mapInPandas(run, f"{key} {dict(posts.dtypes)[key]}, embedding array<double>")


def community_labels(docs: DataFrame, community: str, text: str = "text",
                     stop_words: Sequence[str] = lx.LABEL_STOP_WORDS) -> DataFrame:
    """Most frequent label token per community (count desc, then token); fallback ``Comm {id}``.
    Tokens: maximal word runs made only of ASCII letters/underscore, length >= 2, lower-cased."""
    runs = F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(LABEL_RUN_PATTERN), 0)
    stop_list = list(stop_words)
    toks = F.filter(runs, lambda t: t.rlike(LABEL_TOKEN) & ~t.isin(stop_list))
    counts = docs.select(community, F.explode(toks).alias("term")).groupBy(community, "term").agg(F.count(F.lit(1)).alias("n"))
    # highest count, ties to the smaller term
    best = counts.groupBy(community).agg(F.min_by("term", F.struct(-F.col("n"), F.col("term"))).alias("label"))
    comms = docs.select(community).distinct()
    return comms.join(best, community, "left").select(
        community, F.coalesce(F.col("label"), F.concat(F.lit("Comm "), F.col(community).cast("string"))).alias("label"))


def truncated_svd(weights: DataFrame, row: str, term: str, value: str, k: int = 10, prefix: str = "tfidf_") -> DataFrame:
    """X.V for the top-``k`` right singular vectors of the (row x term) matrix, sign fixed so each
    component's largest-magnitude loading is positive.

    The Gram matrix (terms x terms, bounded by the vocabulary size) is summed in two steps: each task multiplies
    its rows' blocks with numpy over Arrow batches, then the partial rows are added per term. Its eigenvectors are
    V. Projection is a join of the long weight table with V (terms x k rows) and a grouped sum.
    """
    import numpy as np
    import pandas as pd

    spark = weights.sparkSession
    weights = cut_lineage(weights.select(row, term, value))
    terms = weights.select(term).distinct()
    idx = terms.withColumn("_i", F.row_number().over(Window.orderBy(term)) - 1)
    n_terms = idx.count()
    if n_terms == 0:
        return weights.select(row).distinct().select(row, *[F.lit(0.0).alias(f"{prefix}{i}") for i in range(k)])
    w = weights.join(F.broadcast(idx), term)
    rows = w.groupBy(row).agg(F.collect_list("_i").alias("i"), F.collect_list(F.col(value).cast("double")).alias("x"))

    def partial_gram(batches):
        total = np.zeros((n_terms, n_terms))
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at: at + 512]
                m = np.zeros((len(part), n_terms))
                for r, (i, x) in enumerate(zip(part["i"], part["x"])):
                    m[r, np.asarray(i)] = x
                total += m.T @ m
        hit = np.flatnonzero(total.any(axis=1))
        yield pd.DataFrame({"i": hit, "g": [total[i] for i in hit]})

    def added(batches):
        total: dict = {}
        for b in batches:
            for i, g in zip(b["i"], b["g"]):
                total[i] = total[i] + g if i in total else np.array(g)
        yield pd.DataFrame({"i": list(total), "g": list(total.values())})

    parts = rows.select("i", "x").mapInPandas(partial_gram, "i int, g array<double>")
    gram = np.zeros((n_terms, n_terms))
    for r in parts.repartition("i").mapInPandas(added, "i int, g array<double>").collect():   # n_terms rows
        gram[r["i"]] = r["g"]
    vals, vecs = np.linalg.eigh(gram)
    order = np.argsort(-vals, kind="stable")[:k]
    V = vecs[:, order]
    for j in range(V.shape[1]):
        piv = int(np.argmax(np.abs(V[:, j])))
        if V[piv, j] < 0:
            V[:, j] = -V[:, j]
    vrows = [(int(i), int(j), float(V[i, j])) for i in range(V.shape[0]) for j in range(V.shape[1])]
    vdf = spark.createDataFrame(vrows, "_i int, _c int, _v double")
    proj = (w.join(F.broadcast(vdf), "_i").groupBy(row, "_c").agg(F.sum(F.col(value) * F.col("_v")).alias("_p")))
    wide = proj.groupBy(row).pivot("_c", list(range(V.shape[1]))).agg(F.first("_p"))
    out = wide.select(row, *[F.coalesce(F.col(str(j)), F.lit(0.0)).alias(f"{prefix}{j}") for j in range(V.shape[1])])
    for j in range(V.shape[1], k):
        out = out.withColumn(f"{prefix}{j}", F.lit(0.0))
    return out
