"""Vector, graph and community queries (G1-G8, J6, J7, A25) and community x price."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import aggregates as ag
from ..operators import community_price as cp
from ..operators import graph as gx
from ..operators import text_features as tf
from ..operators import vectors as vx
from ..session import cut_lineage
from .common import fixture, fixture_cte, r6, read_table

K = 10
THRESHOLD = 0.3            # the driver's vectors peak near cosine 0.5, so the 0.7 default gives no edge
MERGE_MOD = 40             # partition vec_id % 40 gives communities below the small-size limit


def vectors(spark, d):
    return read_table(spark, d, "embeddings").select("vec_id", "embedding", "label")


def _knn_edges(spark, d):
    v = vectors(spark, d)
    top = vx.knn(v, "vec_id", "embedding", K, threshold=THRESHOLD)
    return vx.undirected_edges(top)


def knn_graph(spark, d):
    """G1: cosine top-10 neighbours, kept at >= threshold, as undirected edges."""
    return _knn_edges(spark, d).select("src", "dst", r6("weight").alias("weight"))


_KNN_SQL = """v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings),
nv AS (SELECT vec_id, e, label, sqrt(list_dot_product(e, e)) AS n FROM v),
pr AS (SELECT a.vec_id AS src, b.vec_id AS dst,
   CASE WHEN a.n > 0 AND b.n > 0 THEN list_dot_product(a.e, b.e) / (a.n * b.n) ELSE 0.0 END AS sim
   FROM nv a JOIN nv b ON a.vec_id <> b.vec_id),
tk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY src ORDER BY sim DESC, dst) AS r FROM pr)
   WHERE r <= 10 AND sim >= 0.3),
edges AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, max(sim) AS weight FROM tk GROUP BY 1, 2)"""

SQL_KNN = "WITH " + _KNN_SQL + "\nSELECT src, dst, round(weight, 6) AS weight FROM edges"


def modularity(spark, d):
    """G3 of the given partition (``label``) on the k-NN graph."""
    part = vectors(spark, d).select(F.col("vec_id").alias("id"), F.col("label").alias("community"))
    m = gx.modularity(_knn_edges(spark, d), part)
    return m.select(r6("modularity").alias("modularity"), r6("total_weight").alias("total_weight"), "n_communities")


SQL_MODULARITY = "WITH " + _KNN_SQL + """,
part AS (SELECT vec_id AS id, label AS community FROM embeddings),
mm AS (SELECT sum(weight) AS m FROM edges),
deg AS (SELECT community, sum(k) AS d FROM (SELECT src AS id, weight AS k FROM edges UNION ALL SELECT dst, weight FROM edges) x
        JOIN part USING (id) GROUP BY community),
ins AS (SELECT p1.community, sum(weight) AS l FROM edges e JOIN part p1 ON p1.id = e.src JOIN part p2 ON p2.id = e.dst
        WHERE p1.community = p2.community GROUP BY 1)
SELECT round(sum(coalesce(l, 0) / m - pow(d / (2 * m), 2)), 6) AS modularity, round(max(m), 6) AS total_weight,
 (SELECT count(DISTINCT community) FROM part) AS n_communities
FROM deg LEFT JOIN ins USING (community), mm"""


def community_centroids(spark, d):
    """A25 per given community (``label``)."""
    c = vx.centroids(vectors(spark, d), "label", "embedding")
    return c.select("label", "size", F.transform("centroid", lambda x: F.round(x, 6)).alias("centroid"))


SQL_CENTROIDS = """WITH x AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS v, unnest(range(0, len(embedding))) AS i FROM embeddings),
m AS (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2),
s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1)
SELECT m.label, s.size, list(round(m.m, 6) ORDER BY m.i) AS centroid FROM m JOIN s USING (label) GROUP BY m.label, s.size"""


def merge_pass(spark, d, small: int = 20, threshold: float = 0.3):
    """G4, one pass, on the partition vec_id % 40: each community's final target after following chains."""
    v = vectors(spark, d)
    part = v.select(F.col("vec_id").alias("id"), (F.col("vec_id") % MERGE_MOD).alias("community"), "embedding")
    cen = vx.centroids(part, "community", "embedding")
    pos = part.groupBy("community").agg(F.min("id").alias("pos"))
    comms = cen.join(pos, "community")
    pairs = vx.similarity_pairs(comms.select("community", "centroid"), "community", "centroid", threshold)
    roots = gx.resolve_pointers(gx.merge_targets(comms, pairs, small, threshold))
    return comms.join(roots.withColumnRenamed("node", "community"), "community", "left").select(
        "community", "size", "pos", F.coalesce("target", "community").alias("root"))


SQL_MERGE_PASS = f"""WITH RECURSIVE part AS (SELECT vec_id AS id, vec_id % {MERGE_MOD} AS community, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
xx AS (SELECT community, unnest(e) AS v, unnest(range(0, len(e))) AS i FROM part),
cen AS (SELECT community, list(m ORDER BY i) AS c FROM (SELECT community, i, avg(v) AS m FROM xx GROUP BY 1, 2) GROUP BY 1),
cm AS (SELECT community, count(*) AS size, min(id) AS pos FROM part GROUP BY 1),
cn AS (SELECT cen.community, c, sqrt(list_dot_product(c, c)) AS n, size, pos FROM cen JOIN cm USING (community)),
pr AS (SELECT x.community AS x, y.community AS y, x.size AS sx, y.size AS sy, x.pos AS px, y.pos AS py,
   CASE WHEN x.n > 0 AND y.n > 0 THEN list_dot_product(x.c, y.c) / (x.n * y.n) ELSE 0.0 END AS sim
   FROM cn x JOIN cn y ON x.community <> y.community),
q AS (SELECT * FROM pr WHERE sim >= 0.3 AND (sx < 20 OR sy < 20) AND (sy > sx OR (sy = sx AND py > px))),
tg AS (SELECT x AS node, arg_max(y, py) AS target FROM q GROUP BY x),
ch(node, target, depth) AS (SELECT node, target, 0 FROM tg UNION ALL
   SELECT ch.node, tg.target, ch.depth + 1 FROM ch JOIN tg ON tg.node = ch.target),
roots AS (SELECT node, arg_max(target, depth) AS target FROM ch GROUP BY node)
SELECT cm.community, cm.size, cm.pos, coalesce(roots.target, cm.community) AS root
FROM cm LEFT JOIN roots ON roots.node = cm.community"""


def _docs_for_vectors(spark, d, n_vectors: int):
    """Every document belongs to one vector: doc_id modulo their number."""
    return read_table(spark, d, "documents").select((F.col("doc_id") % max(n_vectors, 1)).alias("vec_id"), "text")


def community_summary(spark, d):
    """G5 nodes: size, mean 2-D position (given coordinates: the first two components) and T6 label from
    the members' texts (every document, by doc_id modulo the number of vectors)."""
    v = vectors(spark, d).select("vec_id", "label", F.col("embedding")[0].cast("double").alias("x"),
                                 F.col("embedding")[1].cast("double").alias("y"))
    pos = v.groupBy("label").agg(F.count(F.lit(1)).alias("size"), r6(F.avg("x")).alias("mx"), r6(F.avg("y")).alias("my"))
    members = v.select("vec_id", F.col("label").alias("community")).join(_docs_for_vectors(spark, d, v.count()), "vec_id", "left")
    names = tf.community_labels(members, "community").select(F.col("community").alias("label"), F.col("label").alias("name"))
    return pos.join(names, "label")


def _summary_sql() -> str:
    from . import sqlfrag as S
    from ..functions import lexicon as lx
    stop = "[" + ", ".join(S.q(w) for w in lx.LABEL_STOP_WORDS) + "]"
    runs = f"regexp_extract_all(lower(coalesce(d.text, '')), {S.q(tf.LABEL_RUN_PATTERN)})"
    return f"""WITH m AS (SELECT e.label, d.text
   FROM embeddings e JOIN (SELECT doc_id % (SELECT count(*) FROM embeddings) AS vec_id, text FROM documents) d USING (vec_id)),
pos AS (SELECT label, count(*) AS size, round(avg(CAST(embedding[1] AS DOUBLE)), 6) AS mx, round(avg(CAST(embedding[2] AS DOUBLE)), 6) AS my
   FROM embeddings GROUP BY label),
lt AS (SELECT label, unnest(list_filter(regexp_extract_all(lower(coalesce(text, '')), {S.q(tf.LABEL_RUN_PATTERN)}),
   lambda x: regexp_matches(x, {S.q(tf.LABEL_TOKEN)}) AND NOT list_contains({stop}, x))) AS term FROM m),
lc AS (SELECT label, term, count(*) AS n FROM lt GROUP BY 1, 2),
best AS (SELECT label, term FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY n DESC, term) AS r FROM lc) WHERE r = 1)
SELECT pos.label, pos.size, pos.mx, pos.my, coalesce(best.term, 'Comm ' || CAST(pos.label AS VARCHAR)) AS name
FROM pos LEFT JOIN best ON best.label = pos.label"""


SQL_SUMMARY = _summary_sql()


def community_links(spark, d, threshold: float = 0.6):
    """G5 edges: community pairs whose mean 2-D positions have cosine >= 0.6."""
    v = vectors(spark, d).select("label", F.col("embedding")[0].cast("double").alias("x"),
                                 F.col("embedding")[1].cast("double").alias("y"))
    pos = v.groupBy("label").agg(F.array(F.avg("x"), F.avg("y")).alias("p"))
    pairs = vx.similarity_pairs(pos, "label", "p", threshold, n_rows=None)
    return pairs.select(F.col("a").alias("c1"), F.col("b").alias("c2"), r6("sim").alias("sim"))


SQL_LINKS = """WITH pos AS (SELECT label, avg(CAST(embedding[1] AS DOUBLE)) AS x, avg(CAST(embedding[2] AS DOUBLE)) AS y FROM embeddings GROUP BY label),
pr AS (SELECT a.label AS c1, b.label AS c2,
  CASE WHEN sqrt(a.x * a.x + a.y * a.y) > 0 AND sqrt(b.x * b.x + b.y * b.y) > 0
       THEN (a.x * b.x + a.y * b.y) / (sqrt(a.x * a.x + a.y * a.y) * sqrt(b.x * b.x + b.y * b.y)) ELSE 0.0 END AS sim
  FROM pos a JOIN pos b ON a.label < b.label)
SELECT CAST(c1 AS BIGINT) AS c1, CAST(c2 AS BIGINT) AS c2, round(sim, 6) AS sim FROM pr WHERE sim >= 0.6"""


def louvain(spark, d):
    """G2 on the k-NN graph: (id, community); checked by properties (planted groups, Q not below singletons)."""
    v = vectors(spark, d)
    return gx.louvain(_knn_edges(spark, d), v.select(F.col("vec_id").alias("id")))


def merge_communities(spark, d):
    """G4 to its fixpoint from single vectors: passes go on until no community merges (``stop_at=0``)."""
    v = vectors(spark, d)
    part = v.select(F.col("vec_id").alias("id"), F.col("vec_id").alias("community"))
    return gx.merge_similar_communities(v, part, "vec_id", "embedding", stop_at=0)


def pca_2d(spark, d):
    return vx.pca_2d(vectors(spark, d), "vec_id", "embedding")


# ------------------------------------------------------------------------------------------- G6, G7
def community_before_moves(spark, d, top_n: int = 14):
    """Communities whose posting rises before large 3-day price moves (positive differences, top 14),
    labelled (no text in this view: fallback names) with W10 suffixes for repeats."""
    eng = fixture(spark, d, "engagement").select("date", "community")
    sig = cp.significant_days(fixture(spark, d, "stock"))
    diff = cp.activity_difference(eng, sig).where(F.col("diff") > 0)
    top = ag.top_k(diff, [F.col("diff").desc(), F.col("community").asc()], top_n)
    w = Window.orderBy(F.col("diff").desc(), F.col("community").asc())
    lab = F.concat(F.lit("Comm "), F.col("community").cast("string"))
    wl = Window.partitionBy(lab).orderBy(F.col("diff").desc(), F.col("community").asc())
    rn = F.row_number().over(wl) - 1
    return top.select(F.row_number().over(w).cast("bigint").alias("rank"), "community", r6("diff").alias("diff"), lab.alias("base_label")) \
              .withColumn("label", F.when(rn == 0, F.col("base_label")).otherwise(F.concat("base_label", F.lit(" ("), rn.cast("string"), F.lit(")")))) \
              .drop("base_label")


def _g6_sql() -> str:
    return fixture_cte("engagement", "stock") + """, cnt AS (SELECT date, community, count(*) AS n FROM engagement WHERE date IS NOT NULL GROUP BY 1, 2),
days AS (SELECT DISTINCT date FROM engagement WHERE date IS NOT NULL),
nx AS (SELECT date AS prev_date, lead(date) OVER (ORDER BY date) AS date FROM days),
sg AS (SELECT Date, Close, coalesce(abs(Close / lag(Close, 3) OVER (ORDER BY Date) - 1) >= 0.2, false) AS sig FROM stock),
md AS (SELECT nx.prev_date, nx.date, sg.sig, sg.Close FROM nx JOIN sg ON sg.Date = nx.date),
ns AS (SELECT count(*) FILTER (WHERE sig) AS n_sig, count(*) FILTER (WHERE NOT sig) AS n_non FROM md),
comms AS (SELECT DISTINCT community FROM engagement WHERE date IS NOT NULL),
sums AS (SELECT c.community, sum(c.n) FILTER (WHERE md.sig) AS s_sig, sum(c.n) FILTER (WHERE NOT md.sig) AS s_non
   FROM cnt c JOIN md ON md.prev_date = c.date GROUP BY 1),
res AS (SELECT comms.community, coalesce(s_sig, 0) / n_sig - coalesce(s_non, 0) / n_non AS diff FROM comms LEFT JOIN sums USING (community), ns)
"""


SQL_G6 = _g6_sql() + """SELECT row_number() OVER (ORDER BY diff DESC, community) AS rank, community, round(diff, 6) AS diff,
 'Comm ' || CAST(community AS VARCHAR) AS label FROM res WHERE diff > 0 ORDER BY diff DESC, community LIMIT 14"""


def community_overlay(spark, d, top_n: int = 5):
    """The ``top_n`` communities by absolute difference, with their shifted daily counts next to Close."""
    eng = fixture(spark, d, "engagement").select("date", "community")
    stock = fixture(spark, d, "stock")
    diff = cp.activity_difference(eng, cp.significant_days(stock))
    top = ag.top_k(diff.where(F.col("diff").isNotNull()), [F.abs("diff").desc(), F.col("community").asc()], top_n)
    return cp.overlay_series(eng, stock, top)


SQL_G7 = _g6_sql() + """, tp AS (SELECT community FROM res WHERE diff IS NOT NULL ORDER BY abs(diff) DESC, community LIMIT 5),
sh AS (SELECT nx.date, c.community, c.n FROM cnt c JOIN nx ON nx.prev_date = c.date)
SELECT md.date, md.Close, tp.community, coalesce(sh.n, 0) AS n_prev
FROM md CROSS JOIN tp LEFT JOIN sh ON sh.date = md.date AND sh.community = tp.community"""

# ------------------------------------------------------------------------------------------- Q9
def _job_communities(spark, d, threshold: float, merge_threshold: float, start: str, dim: int):
    """Q9 up to the communities: texts, k-NN edges and the merged partition ``(id, community)``."""
    if start not in ("louvain", "singletons"):
        raise ValueError(f"start: {start}")
    docs = read_table(spark, d, "documents").select("doc_id", "text").where("text is not null")
    tokens = docs.select("doc_id", F.explode(tf.word_tokens("text")).alias("tok"))
    v = cut_lineage(tf.hash_embeddings(tokens, "doc_id", dim=dim))
    edges = cut_lineage(vx.undirected_edges(vx.knn(v, "doc_id", "embedding", K, threshold=threshold)))
    ids = v.select(F.col("doc_id").alias("id"))
    part = gx.louvain(edges, ids) if start == "louvain" else ids.withColumn("community", F.col("id"))
    return docs, edges, cut_lineage(gx.merge_similar_communities(v, part, "doc_id", "embedding", threshold=merge_threshold))


def _job_activity(spark, d, docs, part):
    """Dated posts of the communities (a post belongs to the text it carries), prices, and each community's difference."""
    n_docs = max(read_table(spark, d, "documents").count(), 1)
    posts = fixture(spark, d, "engagement").select("date", (F.col("row_id") % n_docs).alias("doc_id"))
    posts = posts.join(part.withColumnRenamed("id", "doc_id"), "doc_id").select("date", "community")
    stock = fixture(spark, d, "stock")
    return posts, stock, cp.activity_difference(posts, cp.significant_days(stock))


def _job_names(docs, part):
    """T6 label of each community: (community, base)."""
    return tf.community_labels(docs.join(part.withColumnRenamed("id", "doc_id"), "doc_id"), "community").withColumnRenamed("label", "base")


def community_price_job(spark, d, threshold: float = 0.7, top_n: int = 14, start: str = "louvain", dim: int = 64, merge_threshold: float = 0.3):
    """Q9 as one job over texts: T4 text vectors, G1 k-NN graph, communities (G2 Louvain, or single texts with
    ``start="singletons"``, then G4 merging to its end), G3 modularity of the result, T6 labels, G6 activity before large
    price moves, W10 suffixes in order of impact. ``threshold`` is that of the k-NN graph, ``merge_threshold`` that of G4.
    G7 over the same communities is ``community_price_overlay``.

    One row for each of the ``top_n`` communities that post more before large moves."""
    docs, edges, part = _job_communities(spark, d, threshold, merge_threshold, start, dim)
    quality = gx.modularity(edges, part).select(r6("modularity").alias("modularity"), "n_communities")
    names = _job_names(docs, part)
    sizes = part.groupBy("community").agg(F.count(F.lit(1)).alias("size"))
    _posts, _stock, diff = _job_activity(spark, d, docs, part)
    top = ag.top_k(diff.where(F.col("diff") > 0), [F.col("diff").desc(), F.col("community").asc()], top_n)
    impact = [F.col("diff").desc(), F.col("community").asc()]
    again = F.row_number().over(Window.partitionBy("base").orderBy(*impact)) - 1       # over top_n rows
    out = top.join(names, "community").join(sizes, "community").crossJoin(F.broadcast(quality))
    return out.select(F.row_number().over(Window.orderBy(*impact)).cast("bigint").alias("rank"), "community", r6("diff").alias("diff"), "size",
                      F.when(again == 0, F.col("base")).otherwise(F.concat("base", F.lit(" ("), again.cast("string"), F.lit(")"))).alias("label"),
                      "modularity", "n_communities")


def community_price_singletons(spark, d):
    """Q9 from single texts instead of Louvain: the deterministic variant."""
    return community_price_job(spark, d, start="singletons")


def community_price_overlay(spark, d, threshold: float = 0.7, top_n: int = 5, start: str = "louvain", dim: int = 64, merge_threshold: float = 0.3):
    """G7 of Q9's job: the ``top_n`` communities by absolute difference, labelled, with their shifted daily counts next
    to Close."""
    docs, _edges, part = _job_communities(spark, d, threshold, merge_threshold, start, dim)
    posts, stock, diff = _job_activity(spark, d, docs, part)
    top = cut_lineage(ag.top_k(diff.where(F.col("diff").isNotNull()), [F.abs("diff").desc(), F.col("community").asc()], top_n))
    named = top.join(_job_names(docs, part), "community").select("community", r6("diff").alias("diff"), F.col("base").alias("label"))
    return cp.overlay_series(posts, stock, top).join(F.broadcast(named), "community").select("date", "Close", "community", "label", "diff", "n_prev")


REGISTRY = {
    "community_price_job": (community_price_job, None),
    "community_price_singletons": (community_price_singletons, None),
    "community_price_overlay": (community_price_overlay, None),
    "knn_graph": (knn_graph, SQL_KNN),
    "modularity": (modularity, SQL_MODULARITY),
    "community_centroids": (community_centroids, SQL_CENTROIDS),
    "merge_pass": (merge_pass, SQL_MERGE_PASS),
    "community_summary": (community_summary, SQL_SUMMARY),
    "community_links": (community_links, SQL_LINKS),
    "louvain": (louvain, None),
    "merge_communities": (merge_communities, None),
    "pca_2d": (pca_2d, None),
    "community_before_moves": (community_before_moves, SQL_G6),
    "community_overlay": (community_overlay, SQL_G7),
}
