"""The methods behind the queries: exact against plain versions, round trips, held-out accuracy, and the pipeline."""
import os
import random
import re
import sys
import tempfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import data  # noqa: E402
import public_tokenizers  # noqa: E402
from conftest import SF_MID  # noqa: E402

import corpus_pipeline  # noqa: E402
from quillspark import session  # noqa: E402
from quillspark.llm import bpe, common, decontaminate, langid, line_dedup, pii, queries, secrets, shards, shingle_join, spans, toxicity, vector_dups  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def test_merges_of_every_width_equal_tiktoken():
    tokens = bpe.load_ranks(PATH)
    merger, enc, rng = bpe.Merger(tokens, *bpe.pair_table(tokens)), brute.encoding(), random.Random(1)
    pieces = ["".join(rng.choice("aeinrstthñéß ") for _ in range(n)).strip() or "a" for n in [*range(1, 70), 130, 300, 900, 1024, 1025, 3000]]
    pieces = [p for p in (x.replace(" ", "") for x in pieces) if p]
    got = merger.encode([p.encode() for p in pieces])
    for p, ids in zip(pieces, got):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(p), len(p)


def test_encode_decode_round_trip_as_arrays(spark):
    df = spark.createDataFrame([(0, "héllo  wörld\n\n 12 'tis"), (1, ""), (2, None), (3, "\u0000\U0001f600 ok")], "id int, text string")
    ids = bpe.encode(df, "text", PATH, public_tokenizers.PATTERN)
    assert dict(ids.dtypes)["ids"] == "array<int>"
    back = {r["id"]: bytes(r["decoded"]).decode() for r in bpe.decode(ids, "ids", PATH).collect()}
    assert back == {0: "héllo  wörld\n\n 12 'tis", 1: "", 2: "", 3: "\u0000\U0001f600 ok"}


def test_decontamination_in_several_sets_equals_one(spark):
    docs = data.texts()[:-1]
    bench = [(i, docs[i]) for i in range(10, 20)] + [(99, "word")]
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(bench, "item_id long, text string")
    one = {r["doc_id"]: r for r in decontaminate.scan(d, "text", b).collect()}
    many = {r["doc_id"]: r for r in decontaminate.scan(d, "text", b, max_windows=40).collect()}
    for i, t in enumerate(docs):
        assert one[i]["items"] == many[i]["items"]
        words = [sum(x["word_end"] - x["word_start"] for x in r["hits"]) for r in (one[i], many[i])]
        assert words[0] == words[1] == brute.op2(t, bench)[1]
    kept = decontaminate.remove_documents(d, "text", b).collect()
    assert {r["doc_id"] for r in kept} == {i for i in one if not one[i]["hits"]}


def test_remove_spans_cuts_only_the_hit_words(spark):
    d = spark.createDataFrame([(0, "Vor dem é: one two three four five six seven eight nine ten, danach Ü."), (1, "clean text"), (2, None)], "doc_id long, text string")
    b = spark.createDataFrame([(0, "ONE two three four five six seven eight nine TEN")], "item_id long, text string")
    got = {r["doc_id"]: r["text"] for r in decontaminate.remove_spans(d, "text", b).collect()}
    assert got == {0: "Vor dem é: , danach Ü.", 1: "clean text", 2: None}


def test_language_held_out_accuracy(spark):
    got = queries.op3_language(spark, SF_MID).join(spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out and lang is not null").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("acc"),
                                                      F.avg(F.col("rejected").cast("int")).alias("rej")).first()
    assert r["acc"] > 0.97 and r["rej"] < 0.02


def test_language_without_labels_rejects_all(spark):
    d = spark.createDataFrame([(0, "some text", None)], "doc_id long, text string, lang string")
    assert langid.fit(d) is None
    assert langid.predict(d, "text", None).first()["lang_pred"] == "und"


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    rng = random.Random(k)
    rows = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(8, 50)))
        b = list(a)
        for _ in range(rng.randrange(5)):
            i = rng.randrange(len(b))
            b[i: i + rng.randrange(2)] = rng.choice(["", "z", "ab"])
        rows.append((a, "".join(b) or "a" * 8))
    df = spark.createDataFrame([r for r in rows if len(r[1]) > k], "a string, b string")
    for r in df.select("a", "b", line_dedup.edit_distance(F.col("a"), F.col("b"), k).alias("d")).collect():
        assert r["d"] == min(brute.distance(r["a"], r["b"]), k + 1), r


@pytest.mark.parametrize("k", [1, 2, 3])
def test_segment_join_misses_no_pair(spark, k):
    rng = random.Random(k)
    lines = []
    for _ in range(25):
        a = "".join(rng.choice("abc ") for _ in range(rng.randrange(20, 40))).strip().ljust(20, "x")
        lines.append(a)
        for _ in range(4):
            b = list(a)
            for _ in range(rng.randrange(k + 2)):
                i = rng.randrange(len(b))
                b[i: i + rng.randrange(2)] = rng.choice(["", "z", "y"])
            lines.append("".join(b).strip().ljust(20, "x"))
    docs = list(enumerate(lines))
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.dedup(df, "doc_id", "text", threshold=k).collect()}
    assert got == {i: removed for i, (removed, _) in brute.op5(docs, k).items()}


def test_hot_segments_are_refined(spark):
    rng = random.Random(9)
    base = "the shared opening of every line, then number 000000 and the shared end"
    lines = [base.replace("000000", f"{rng.randrange(10**6):06d}"[: rng.choice([4, 5, 6])]) for _ in range(90)]
    for i in range(0, len(base), 6):                          # all at one place, and at many
        lines += [base[:i] + c + base[i + 1:] for c in "QZ"] + [base[:i] + base[i + 1:], base[:i] + "Q" + base[i:]]
    lines = [x.strip() for x in lines]
    docs = [(i, x) for i, x in enumerate(lines)] + [(None, base)]
    rng.shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["removed"] for r in line_dedup.dedup(df, "doc_id", "text").collect()}
    assert got.pop(None) == []
    assert got == {i: removed for i, (removed, _) in brute.op5([d for d in docs if d[0] is not None], 1).items()}


def test_a_family_of_copies_meets_in_few_pairs(spark):
    base = "an opening that all of them have in common, and an ending"
    n = 2000
    lines = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit(base), F.format_string(" %07d", F.col("id") * 4999)).alias("text"))
    found = line_dedup.lines_of(lines, "doc_id", "text", 20)
    keyed = found.withColumn("n", F.char_length("line")).select(
        F.col("doc_id").alias("lid"), "h1", "h2", *[c.alias(k) for k, c in line_dedup.segment_keys("line", F.col("n"), 1).items()])
    assert line_dedup.candidates(session.cut_lineage(keyed), found, 1).count() < 2 * line_dedup.GROUP * n


def test_line_dedup_is_native(spark):
    df = spark.createDataFrame([(0, "a line of twenty characters or so\nshort")], "doc_id long, text string")
    plan = line_dedup.dedup(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_discovers_identifiers_by_context(spark):
    rng = random.Random(4)
    rows = [f"{data.prose(rng, 6)} my phone +1 (269) 555-{1000 + i} and {data.prose(rng, 5)}" for i in range(30)]
    rows += [f"{data.prose(rng, 6)} my phone 0269/555-{100 + i} and" for i in range(4)]
    rows += [f"{data.prose(rng, 6)} seen in room B{100 + i} and" for i in range(20)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], rows[r["doc_id"]][s["start"]: s["end"]]) for s in r["spans"]] for r in pii.find(df, "text").collect()}
    for i in range(30):
        assert got[i] == [("phone", f"+1 (269) 555-{1000 + i}")]
    for i in range(4):
        assert got[30 + i] == [("ctx_phone", f"0269/555-{100 + i}")]
    assert all(not got[i] for i in range(34, 54))


def test_redaction(spark):
    df = spark.createDataFrame([(0, "é mail a@b.co now"), (1, None), (2, "none")], "doc_id long, text string")
    out = spans.redact(pii.find(df, "text", keep_text=True), "text", "spans")
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {0: "é mail [email] now", 1: None, 2: "none"}


def test_trigram_queries():
    assert secrets.trigram_query(r"AKIA[A-Z0-9]{16,}") == ("and", ["aki", "kia"])
    assert secrets.trigram_query(r"[0-9a-f]{24,}") is True
    assert secrets.trigram_query(r"(abc|xyz)+d") == ("or", ["abc", "xyz"])
    q = secrets.trigram_query(secrets.BASE[0].regex)
    assert q[0] == "or" and {"tok", "ken", "pik", "i_k"} <= secrets.trigrams(q)


def test_segment_index_finds_what_holds_the_trigrams():
    rows = ["abc abd", "", "xab", "c", "zzabcabd"]
    asked = ["abc", "abd"]
    place = np.zeros(1 << 24, np.uint16)
    place[[secrets._code(t) for t in asked]] = [1, 2]
    s = secrets.Segment(*common.utf8(pa.array(rows)), place, 2)
    assert s.find(("and", asked), {"abc": 0, "abd": 1}).tolist() == [0, 4]
    assert s.find("abc", {"abc": 0, "abd": 1}).tolist() == [0, 4] and s.find(True, {}).tolist() == [0, 1, 2, 3, 4]


def test_maximal_segments_equal_definition():
    """Maximal segments: take the best-scoring one, go on left and right of it."""
    def plain(x, off=0):
        best, at = 0, None
        for a in range(len(x)):
            for b in range(a + 1, len(x) + 1):
                s = sum(x[a:b])
                if s > best or (at and s == best and b - a < at[1] - at[0]):
                    best, at = s, (a, b)
        if not at:
            return []
        return plain(x[: at[0]], off) + [(at[0] + off, at[1] + off, best)] + plain(x[at[1]:], off + at[1])

    rng = random.Random(6)
    for _ in range(200):
        x = [rng.choice([-3, -2, -1, 1, 2, 4]) + rng.random() / 8 for _ in range(rng.randrange(14))]
        got = toxicity.segments(x)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain(x)]
        assert np.allclose([s for *_, s in got], [s for *_, s in plain(x)])


def test_toxic_passages_and_held_out_ranking(spark):
    rng = random.Random(8)
    rows = []
    for i in range(600):
        w = data.prose(rng, rng.randrange(10, 80)).replace("stupid", "calm").split()
        bad = i % 5 == 0
        for _ in range(3 * bad):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "rotten", "nasty", "foul"]))
        rows.append((i, " ".join(w), int(bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(df.where("doc_id < 400"), "text", "toxic", F.col("doc_id") % 3 == 1)
    got = toxicity.predict(df.where("doc_id >= 400"), "text", model).collect()
    toxic, clean = [r["score"] for r in got if r["toxic"]], [r["score"] for r in got if not r["toxic"]]
    assert np.mean([a > b for a in toxic for b in clean]) > 0.97
    words = {w for r in got for p in r["passages"] for w in r["text"].encode()[p["byte_start"]: p["byte_end"]].decode().split()}
    assert words and {"vile", "rotten", "nasty", "foul"} & words


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (3, 4)])
def test_hilbert_curve_is_continuous(dims, bits):
    n = 1 << (dims * bits)
    point = {}
    for c in range(n):
        p = [c >> (bits * i) & ((1 << bits) - 1) for i in range(dims)]
        point[shards.hilbert_index(p, bits)] = p
    assert sorted(point) == list(range(n))
    assert all(sum(abs(a - b) for a, b in zip(point[i], point[i + 1])) == 1 for i in range(n - 1))


def test_shards_by_bytes_and_files(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumn("size", shards.size_of("text"))
    dims = [shards.by_category("lang", 4), shards.by_category("source", 4), shards.by_magnitude(F.col("size"), 4, 16)]
    out = shards.assign(docs, "doc_id", "size", dims, 10, "bytes").select("doc_id", "lang", "source", "size", "curve", "shard", "slot")
    assert not re.search("Python|Arrow", out._jdf.queryExecution().executedPlan().toString())
    m = {r["shard"]: r for r in shards.manifest(out, ["lang", "source"], "size").collect()}
    most = docs.agg(F.max("size")).first()[0]
    mean = sum(r["bytes"] for r in m.values()) / 10
    assert len(m) == 10 and all(abs(r["bytes"] - mean) <= 2 * most for r in m.values())
    slots = out.groupBy("shard").agg(F.min("slot").alias("a"), F.max("slot").alias("b"), F.countDistinct("slot").alias("n")).collect()
    assert all(r["a"] == 0 and r["b"] == r["n"] - 1 for r in slots)
    path = tempfile.mkdtemp(prefix="quill-run-") + "/shards"
    shards.write(docs, out, "doc_id", path)
    back = spark.read.parquet(path)
    assert back.count() == docs.count() and back.where("shard = 3").select("doc_id").exceptAll(out.where("shard = 3").select("doc_id")).count() == 0


def test_hot_cells_of_vectors_are_cut_into_blocks(spark):
    """A bucket of many near copies is cut into block pairs and still counts every link once."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=32)
    rows = [(i, [float(x) for x in base + rng.normal(scale=.05, size=32)]) for i in range(150)] + [(1000 + i, [float(x) for x in rng.normal(size=32)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dups.find(df, "vec_id", "embedding", block=16).collect()}
    assert got == brute.op4(rows)


def test_code_estimates_hold_their_bound():
    rng = np.random.default_rng(1)
    plan = vector_dups.Plan(0.9, 1000, 64, 1e-3, 3.0, 5)
    x = rng.normal(size=(400, 64))
    y = x + rng.normal(scale=0.4, size=x.shape)
    x, y = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (x, y))
    p = plan.rotation()
    assert np.allclose(np.linalg.norm(x @ p, axis=1), 1)
    code = np.where(x @ p > 0, 1, -1) / np.sqrt(plan.width)
    factor = (code * (x @ p)).sum(1)
    error = (code * (y @ p)).sum(1) / factor - (x * y).sum(1)
    assert abs(error.mean()) < 0.01
    assert (np.abs(error) <= 3 * np.sqrt((1 - factor ** 2) / factor ** 2 / (plan.width - 1))).mean() > 0.99


def test_components_of_long_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    got = {r["id"]: r["component_id"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{1000 + i: 1000 for i in range(300)}}


def test_longer_prefixes_keep_every_similar_pair():
    """Two sets that are similar enough share at least the smaller number of matches in their prefixes."""
    rng = np.random.default_rng(2)
    sketch = rng.integers(0, 50, 1 << shingle_join.SKETCH_BITS)
    for _ in range(300):
        a = rng.integers(0, 2**63, int(rng.integers(1, 60))).astype(np.uint64)
        b = np.unique(np.concatenate((a[int(rng.integers(0, 5)):], rng.integers(0, 2**63, int(rng.integers(0, 6))).astype(np.uint64))))
        a = np.unique(a)
        both = len(np.intersect1d(a, b))
        if len(b) and 100 * both >= 80 * (len(a) + len(b) - both):
            (pa_, la), (pb, lb) = (shingle_join.prefix(s, sketch, 1.0, 80) for s in (a, b))
            assert len(np.intersect1d(pa_, pb)) >= min(la, lb)


def test_pipeline_equals_brute_force(spark, tmp_path):
    docs = [(i, t) for i, t in enumerate(data.texts()[:-1]) if t is None or len(t) < 4000]
    bench = [(0, " ".join((docs[14][1]).split()[2:16]))]
    path = data.write(tmp_path, docs=docs, benchmark=bench)
    got = {r["doc_id"]: tuple(r)[:4] for r in corpus_pipeline.run(spark, path).collect()}
    # the language stage's own predictions; everything after it in plain Python
    table = spark.read.parquet(f"{path}/documents.parquet")
    model = langid.fit(table.where(queries.remainder("doc_id", 3) != 1))
    stays = {r["doc_id"] for r in langid.predict(table.select("doc_id", "text"), "text", model).where("not rejected").collect()}
    now = {i: x for i, x in brute.op5([(i, t) for i, t in docs if i in stays]).items()}
    now = {i: t for i, (removed, t) in now.items() if not removed or t.strip(" \n")}
    c = brute.op10(list(now.items()), 5, 80)
    now = {i: t for i, t in now.items() if c[i][1] == i and not brute.op2(t, bench)[4]}
    enc = brute.encoding()
    assert got == {i: (i, *brute.op1(t, enc)) for i, t in now.items()}
    assert 20 < len(got) < len(docs)


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    path = data.write(tmp_path, docs=data.texts()[:30], benchmark=[(0, "no hit at all here")])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, path)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert corpus_pipeline.run(spark, data.write(tempfile.mkdtemp(prefix="quill-run-"), docs=[])).count() == 0


@pytest.mark.parametrize("stage", [f for name, f in corpus_pipeline.STAGES if name != "line_dedup"])
def test_stages_send_texts_in_small_batches(spark, stage):
    """A split of several MB isn't one batch; a longer text is one of its own; a size that the session names stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    path = data.write(tempfile.mkdtemp(prefix="quill-run-"), docs=["word other " * 1000] * 400 + ["long text " * 300_000, "end"])
    docs = spark.read.parquet(path + "/documents.parquet").coalesce(1)

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["n", "bytes"])

    try:
        stage(spark, docs, path)
        got = docs.select("text").mapInArrow(sizes, "n long, bytes long").collect()
        assert sum(r["n"] for r in got) == 402 and len(got) >= 4
        assert max(r["bytes"] for r in got if r["bytes"] < 3_000_000) < 1_200_000
        spark.conf.set(key, "64m")
        stage(spark, docs, path)
        assert spark.conf.get(key) == "64m" and docs.select("text").mapInArrow(sizes, "n long, bytes long").count() == 1
    finally:
        spark.conf.unset(key)


def test_windows_of_items_without_id_hit(spark, tmp_path):
    """A benchmark row with a null id counts its windows as hits and adds no item, as OP2_SQL does."""
    import duckdb
    w = [f"w{i}" for i in range(40)]
    docs = [" ".join(w[:20]), " ".join(w[5:35]), "nothing of it", " ".join(w[28:40]), None]
    path = data.write(tmp_path, docs=docs, benchmark=[(None, " ".join(w[2:14])), (1, " ".join(w[20:32])), (None, " ".join(w[20:32]))])
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}/{t}.parquet')")
    want = con.execute(queries.OP2_SQL)
    names = [c[0] for c in want.description]
    rows = sorted(want.fetchall())
    got = queries.op2_decontaminate(spark, path).select(*names).collect()
    assert sorted(map(tuple, got)) == rows
    assert (rows[0][2], rows[0][3], rows[0][5]) == (12, 0, True)


def test_shingle_kernel_holds_little():
    """8 MB of text in one batch: the kernel's arrays are bounded by its slices, and the sketch counts every shingle."""
    import tracemalloc

    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, 10**6, 300))) for _ in range(4000)]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})

    class Rows:
        def mapInArrow(self, run, schema):
            return run

    run = shingle_join.digests_and_sketch(Rows(), 5)
    n = total = 0
    tracemalloc.start()
    for out in run([batch]):
        for r in out.to_pylist():
            n += r["n"] or 0
            total += int(np.frombuffer(zlib.decompress(r["counts"]), np.uint32).sum()) if r["counts"] is not None else 0
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == total == 4000 * 296
    assert most < 50e6


def test_language_fit_holds_few_vectors_at_a_time(monkeypatch):
    """Held-back rows are averaged some at a time: the driver never holds a vector for each of all their subwords."""
    import tracemalloc
    rng = np.random.default_rng(2)
    rows = [("ab"[i % 2], np.sort(rng.choice(1 << langid.BUCKET_BITS, 4000, replace=False)).astype("<i4"), np.ones(4000, "<i4")) for i in range(600)]
    for _, bucket, n in rows[:5]:
        for x in (bucket, n, bucket[::-1].copy()):
            assert (langid.unpacked_numbers(langid.packed_numbers(x)) == x).all()
    monkeypatch.setattr(langid, "sample_counts", lambda *a: rows)
    tracemalloc.start()
    langid.fit(None, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45e6                                            # 600 x 4000 weights are 9.6 MB of it


def test_ids_reach_the_driver_as_columns(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id bigint, text string")
    ids = docs.where("doc_id % 3 = 0").select("doc_id")
    with monkeypatch.context() as m:
        m.setattr(type(ids), "collect", lambda self: pytest.fail("rows as Python objects"))
        some = shingle_join.texts_of(docs, ids)
    got = {r["doc_id"] for r in some.collect()}
    assert set(range(0, 300, 3)) <= got and len(got) < 150


def test_sieves_of_hot_segments_are_tables(spark, monkeypatch):
    """A level's sieve is read by several plans: it is made once, not by each of them."""
    made, plain = [], line_dedup.sifted
    monkeypatch.setattr(line_dedup, "sifted", lambda df, words, *c: made.append((c, words)) or plain(df, words, *c))
    lines = [f"the one shared start of lines {c}{d} and end" for c in "abcdefgh" for d in "0123456"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id bigint, text string")
    assert line_dedup.dedup(df, "doc_id", "text").where("size(removed) = 0").count() == 1
    plans = [w._jdf.queryExecution().executedPlan().toString() for c, w in made if c == ("key",)]
    assert len(plans) > 1 and not any("Exchange" in p for p in plans)
