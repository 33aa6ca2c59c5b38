"""The operators' queries over the given tables, and their DuckDB twins where SQL can express them."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_lineage
from ..sources.tables import read_table
from . import bpe, conversations, decontaminate, langid, line_dedup, pii, rlz, secrets, shards, shingle_join, spans, spelling, toxicity, vector_dups

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def remainder(column: str, n: int):
    """crc32 of an id as text, modulo n."""
    return F.pmod(F.crc32(F.col(column).cast("string")), F.lit(n))


def sha256(column):
    return F.sha2(column.cast("binary") if not isinstance(column, str) else F.col(column).cast("binary"), 256)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenized(docs)


def tokenized(docs: DataFrame) -> DataFrame:
    """Encode the whole texts, decode the ids again, and digest both."""
    path = public_tokenizers.path(VOCABULARY)
    ids = bpe.encode(docs.select("doc_id", "text"), "text", path, public_tokenizers.PATTERN, packed=True).drop("text")
    back = bpe.decode(ids, "ids", path)
    return back.select("doc_id", "n_tokens", sha256("ids").alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, "text", read_table(spark, sf_dir, "benchmark")).drop("text")
    return found.select("doc_id", "n_words", decontaminate.n_hit().alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        sha256(F.array_join("items", ",")).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


OP2_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w FROM benchmark),
win AS (SELECT DISTINCT item, least(10, len(w)) n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') g
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) k FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, n, k, array_to_string(w[k:k + n - 1], ' ') g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) k FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT o.doc_id, o.n, o.k, b.item FROM occ o JOIN win b ON o.n = b.n AND o.g = b.g),
pos AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) n_items, string_agg(DISTINCT item, ',' ORDER BY item) items FROM hit GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
       sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(remainder("doc_id", 3) != 1))
    found = langid.predict(docs.select("doc_id", "text"), "text", model).drop("text")
    return found.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "rejected")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    base = spans.of_kinds("spans", pii.KINDS)
    return pii.find(docs, "text").select(
        "doc_id", *[spans.count("spans", k).alias(f"n_{k}") for k in pii.KINDS],
        sha256(spans.as_text(base)).alias("base_sha256"), spans.as_text("spans").alias("spans"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where("toxic is not null")
    rest = remainder("doc_id", 4)
    # only labelled texts are shuffled, once; calibration joins the labels to what the scan of all documents found
    counted = labels.where((rest != 2) & (rest != 3))
    texts = shingle_join.texts_of(docs, counted.select("doc_id"))
    score, lam = toxicity.word_scores(texts.join(counted.hint("merge"), "doc_id"), "text", "toxic")
    found = cut_lineage(toxicity.best_segments(docs, "text", score).select("doc_id", "n_tokens", "best"))
    model = toxicity.calibrated(score, lam, found.join(labels.where(rest == 3).hint("merge"), "doc_id"), "toxic")
    scored = found.withColumn("score", model.probability())
    return scored.select("doc_id", (rest == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    kinds = [r.kind for r in secrets.BASE]
    return secrets.find(docs, "text").select(
        "doc_id", *[spans.count("spans", k).alias(f"n_{k}") for k in kinds],
        sha256(spans.as_text(spans.of_kinds("spans", kinds))).alias("base_sha256"), spans.as_text("spans").alias("spans"))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", "lang", "source", shards.size_of("text").alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"))
    dims = [shards.by_category("lang", 4), shards.by_category("source", 4), shards.by_magnitude(F.col("size"), 4, 16)]
    out = shards.assign(docs, "doc_id", "size", dims, 40, "rows")
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_dups.find(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 0.95)


OP4_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
link AS (SELECT a.vec_id a, b.vec_id b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
         WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.95),
reach AS (SELECT vec_id id, vec_id too FROM v UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.too = l.a),
n AS (SELECT a, count(*) n FROM link GROUP BY a), c AS (SELECT id, min(too) component_id FROM reach GROUP BY id)
SELECT vec_id, coalesce(n.n, 0) n_links, c.component_id, vec_id = c.component_id kept
FROM v LEFT JOIN n ON n.a = vec_id JOIN c ON c.id = vec_id
"""


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup(docs, "doc_id", "text").select(
        "doc_id", F.size("removed").cast("bigint").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"),
        sha256(F.coalesce("text", F.lit(""))).alias("text_sha256"))


#: Two lines within one edit: of one length and equal but for one place, or one is the other without one character.
OP5_SQL = """
WITH RECURSIVE p AS (SELECT doc_id, unnest(string_split(text, chr(10))) raw, unnest(range(len(string_split(text, chr(10))))) pos FROM documents),
o AS (SELECT doc_id, pos, trim(raw, ' ') line FROM p WHERE length(trim(raw, ' ')) >= 20),
d AS (SELECT line, length(line) n, row_number() OVER (ORDER BY line) id, min(CAST(doc_id AS HUGEINT) * 100000000 + pos) f FROM o GROUP BY line),
cut AS (SELECT id, n, i, hash(substr(line, 1, i - 1) || substr(line, i + 1)) h FROM (SELECT id, n, line, unnest(range(1, n + 1)) i FROM d)),
pair AS (SELECT a.id a, b.id b FROM cut a JOIN cut b ON a.n = b.n AND a.i = b.i AND a.h = b.h AND a.id < b.id
         UNION SELECT d.id, cut.id FROM cut JOIN d ON cut.n = d.n + 1 AND cut.h = hash(d.line)),
both_ways AS (SELECT a, b FROM pair UNION SELECT b, a FROM pair),
reach AS (SELECT id, id too FROM d UNION SELECT r.id, l.b FROM reach r JOIN both_ways l ON r.too = l.a),
head AS (SELECT r.id, min(d.f) f FROM reach r JOIN d ON d.id = r.too GROUP BY r.id),
gone AS (SELECT o.doc_id, o.pos FROM o JOIN d USING (line) JOIN head ON head.id = d.id WHERE CAST(o.doc_id AS HUGEINT) * 100000000 + o.pos <> head.f),
g AS (SELECT doc_id, count(*) n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) r FROM gone GROUP BY doc_id),
k AS (SELECT p.doc_id, string_agg(raw, chr(10) ORDER BY p.pos) t FROM p LEFT JOIN gone USING (doc_id, pos) WHERE gone.pos IS NULL GROUP BY p.doc_id)
SELECT doc_id, coalesce(g.n, 0) n_removed, coalesce(g.r, '') removed,
       sha256(CASE WHEN g.n > 0 THEN coalesce(k.t, '') ELSE coalesce(text, '') END) text_sha256
FROM documents LEFT JOIN g USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.find(read_table(spark, sf_dir, "documents"), "doc_id", "text", 4, 85)


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + least(4, len(w)) - 1], ' ') g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) k FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM s GROUP BY doc_id),
both_in AS (SELECT a.doc_id a, b.doc_id b, count(*) m FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM both_in JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 85 * (x.n + y.n - m)),
reach AS (SELECT doc_id id, doc_id too FROM documents UNION SELECT r.id, l.b FROM reach r JOIN link l ON r.too = l.a),
c AS (SELECT id, min(too) component_id FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n.n, 0) n_shingles, c.component_id FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.id = d.doc_id
"""


def damaged(rows: DataFrame) -> DataFrame:
    """The contract's damage: by crc32 of ``conv_id:turn`` a row goes, is emptied, loses its sentence ends, stands twice or
    becomes the user's."""
    space = F.lit(" ")
    case = F.pmod(F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))), F.lit(20))
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = rows.withColumn("case", case).where("case <> 0")
    return out.select("conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                      F.explode(F.when(F.col("case") == 3, F.expr("array(0, 1)")).otherwise(F.expr("array(0)"))).alias("copy")).drop("copy")


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = conversations.prepared(damaged(given), "conv_id", "turn", "role", "text")
    plan = conversations.plans(rows)
    digest = conversations.digests(conversations.repaired(rows, plan.select("key", "audit")))
    every = given.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(plan.hint("merge"), "key", "left").join(digest.hint("merge"), "key", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", sha256(F.lit(""))).alias("repaired_sha256"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    words = cut_lineage(spelling.word_counts(docs, "doc_id", "text"))
    return spelling.groups(words)


def _crc32_sql(numbers: str) -> str:
    """crc32 over a list of byte values, with the table of the polynomial's remainders (made by zlib's rule)."""
    table = [zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)]
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {numbers}), lambda c, b: xor(c >> 8, "
            f"(CAST({table} AS BIGINT[]))[(xor(c, b) & 255) + 1])), 4294967295)")


OP12_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) r FROM documents),
low AS (SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' p, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') r FROM runs WHERE length(r) >= 7),
h AS (SELECT r, {_crc32_sql("flatten(list_transform(string_split(p || r, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))")} h FROM low),
cut AS (SELECT CASE WHEN h % 31 = 0 THEN substr(r, 1, CAST(h % length(r) AS INT)) || substr(r, CAST(h % length(r) AS INT) + 2) ELSE r END w FROM h),
words AS (SELECT w, count(*) n FROM cut WHERE length(w) >= 7 GROUP BY w HAVING count(*) >= 2),
del AS (SELECT w, n, i, substr(w, 1, i - 1) || substr(w, i + 1) d FROM (SELECT w, n, unnest(range(1, length(w) + 1)) i FROM words)),
near AS (SELECT a.w, a.n, b.w v, b.n m FROM del a JOIN del b ON a.i = b.i AND a.d = b.d AND a.w <> b.w
         UNION SELECT del.w, del.n, words.w, words.n FROM del JOIN words ON del.d = words.w
         UNION SELECT words.w, words.n, del.w, del.n FROM del JOIN words ON del.d = words.w),
best AS (SELECT w, count(*) n_near, arg_max(v, (m, -k)) v, max(m) m, any_value(n) n
         FROM (SELECT *, row_number() OVER (PARTITION BY w ORDER BY v) k FROM near) GROUP BY w),
form AS (SELECT w, v form, m form_n FROM best WHERE m >= 10 * n),
chain AS (SELECT w, w r, 0 d FROM words UNION ALL SELECT c.w, f.form, c.d + 1 FROM chain c JOIN form f ON f.w = c.r),
root AS (SELECT w, arg_max(r, d) root FROM chain GROUP BY w)
SELECT w word, form, root, n, coalesce(n_near, 0) n_near, form_n FROM words LEFT JOIN (SELECT w, n_near FROM best) USING (w) LEFT JOIN form USING (w) JOIN root USING (w)
"""


def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return rlz.dedup(docs, "doc_id", "text", 13).select("doc_id", "n_words", "n_removed", sha256("kept").alias("kept_sha256"))


OP13_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w FROM documents),
win AS (SELECT doc_id, k, array_to_string(w[k:k + 12], ' ') g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) k FROM w WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) m FROM win GROUP BY g HAVING min(doc_id) <> max(doc_id)),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + 13)) p FROM win JOIN f USING (g) WHERE m < doc_id),
word AS (SELECT doc_id, unnest(w) x, unnest(range(1, len(w) + 1)) p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) t, count(*) n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) n_words, len(w) - coalesce(n, 0) n_removed, sha256(coalesce(t, '')) kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


REGISTRY = {
    "op1_byte_bpe": (op1_byte_bpe, None),
    "op2_decontaminate": (op2_decontaminate, OP2_SQL),
    "op3_language": (op3_language, None),
    "op4_vector_dups": (op4_vector_dups, OP4_SQL),
    "op5_line_dedup": (op5_line_dedup, OP5_SQL),
    "op6_personal_data": (op6_personal_data, None),
    "op7_toxicity": (op7_toxicity, None),
    "op8_secrets": (op8_secrets, None),
    "op9_hilbert_shards": (op9_hilbert_shards, None),
    "op10_shingle_join": (op10_shingle_join, OP10_SQL),
    "op11_conversations": (op11_conversations, None),
    "op12_spelling": (op12_spelling, OP12_SQL),
    "op13_substrings": (op13_substrings, OP13_SQL),
}
