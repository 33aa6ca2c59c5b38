"""Every query against a plain Python version on a fixture of awkward rows, and on empty tables."""
import os
import random
import sys
import zlib

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
import data  # noqa: E402

from quillspark.llm.queries import REGISTRY  # noqa: E402


def query(name):
    return next(f for k, (f, _) in REGISTRY.items() if k.startswith(name + "_"))


@pytest.fixture(scope="module")
def table(tmp_path_factory):
    docs = data.texts()
    bench = [(0, " ".join(docs[10].split()[3:18])), (1, "Two WORDS"), (2, None), (3, ""), (4, " ".join(docs[12].split()[:10]).upper()),
             (5, docs[20]), (10, docs[20]), (6, "no such thing anywhere")]
    labels = [(i, int("stupid" in (t or ""))) for i, t in enumerate(docs)]
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 16)).astype(np.float32)
    vecs = [list(map(float, v)) for v in base] + [list(map(float, base[0]))] * 5 + [list(map(float, base[1] * 2))]
    vecs += [list(map(float, base[2] + rng.normal(scale=s, size=16))) for s in (.02, .1, .2, .3, .4)]
    vecs += [None, [], [0.0] * 16, [None] * 16, [float("nan")] + [1.0] * 15, [float("inf")] * 16, [1.0] * 8, [1.0] * 8]
    path = data.write(tmp_path_factory.mktemp("awkward"), docs, bench, labels, list(enumerate(vecs)))
    return path, docs, bench, list(enumerate(vecs))


def rows(spark, name, path):
    return {r[0]: r for r in query(name)(spark, path).collect()}


def test_encode_like_tiktoken(spark, table):
    enc, got = brute.encoding(), rows(spark, "op1", table[0])
    assert len(got) == len(table[1])
    for i, t in enumerate(table[1]):
        assert tuple(got[i])[1:4] == brute.op1(t, enc), i


def test_decontaminate(spark, table):
    got = rows(spark, "op2", table[0])
    for i, t in enumerate(table[1][:-1]):
        assert tuple(got[i])[1:6] == brute.op2(t, table[2]), i
    assert got[len(table[1]) - 1]["n_words"] == 25_000


def test_language(spark, table):
    got = rows(spark, "op3", table[0])
    for i, t in enumerate(table[1]):
        letters = any(c.isalpha() for c in t or "")
        assert (got[i]["lang_pred"] == "und") == (not letters)
        assert 0 <= got[i]["score"] <= 1 and got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)


def test_vectors(spark, table):
    want = brute.op4(table[3])
    got = rows(spark, "op4", table[0])
    assert {i: (r["n_links"], r["component_id"]) for i, r in got.items()} == want
    assert all(r["kept"] == (i == r["component_id"]) for i, r in got.items())


def test_lines(spark, table):
    docs = list(enumerate(table[1][:-1]))
    import tempfile
    path = data.write(tempfile.mkdtemp(prefix="quill-run-"), docs)
    want, got = brute.op5(docs), rows(spark, "op5", path)
    for i, (removed, text) in want.items():
        assert (got[i]["removed"], got[i]["text_sha256"]) == (",".join(map(str, removed)), brute.sha(text or "")), i
    assert sum(r["n_removed"] for r in got.values()) > 10


@pytest.mark.parametrize("name,kinds", [("op6", ["email", "ip", "card", "phone"]), ("op8", ["assign", "access", "hex"])])
def test_spans(spark, table, name, kinds):
    got = rows(spark, name, table[0])
    for i, t in enumerate(table[1]):
        base = getattr(brute, name)(t)
        assert got[i]["base_sha256"] == brute.sha(",".join(base)), (i, got[i]["spans"], base)
        assert [got[i][f"n_{k}"] for k in kinds] == [sum(s.startswith(k + ":") for s in base) for k in kinds]
        assert set(base) <= set(got[i]["spans"].split(",")) | {""}
    assert any(got[i]["base_sha256"] != brute.sha("") for i in got)


def test_toxicity(spark, table):
    got = rows(spark, "op7", table[0])
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)


def test_shards(spark, table):
    got = rows(spark, "op9", table[0])
    for i, t in enumerate(table[1]):
        raw = (t or "").encode()
        assert got[i]["size"] == len(raw) + 16 and got[i]["text_crc32"] == zlib.crc32(raw) and got[i]["grown_shard"] is None
    by = {}
    for r in got.values():
        by.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(by.get(s, [])) for s in range(40)]
    assert max(sizes) - min(sizes) <= 1 and all(sorted(s) == list(range(len(s))) for s in by.values())


def test_jaccard(spark, table):
    want, got = brute.op10(list(enumerate(table[1])), 4, 85), rows(spark, "op10", table[0])
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == want


def test_shingle_join_rows_without_id(spark, tmp_path):
    """Rows with a null id link with nothing: neither with equal texts nor as a bridge between two that are not similar."""
    w = [f"w{i}" for i in range(80)]
    a, bridge, b = w[:40] + w[46:], w, w[:20] + w[26:]
    docs = [(7, " ".join(a)), (None, " ".join(bridge)), (8, " ".join(b)), (None, " ".join(a)), (9, " ".join(a)), (None, None)]
    got = query("op10")(spark, data.write(tmp_path, docs=docs)).collect()
    n = lambda x: len(x) - 3
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == sorted(
        [(7, n(a), 7), (0, n(bridge), 0), (8, n(b), 8), (0, n(a), 0), (9, n(a), 7), (0, 0, 0)])


@pytest.mark.parametrize("name", [f"op{n}" for n in range(1, 11)])
def test_empty_tables(spark, tmp_path, name):
    assert query(name)(spark, data.write(tmp_path, docs=[])).collect() == []


@pytest.mark.parametrize("name", [f"op{n}" for n in range(1, 11)])
def test_only_empty_texts_and_repeated_rows(spark, tmp_path, name):
    docs = [(0, None), (1, ""), (1, ""), (2, "same words here for all of you"), (2, "same words here for all of you"), (3, "same words here for all of you")]
    vecs = [(0, None), (1, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0])]
    got = query(name)(spark, data.write(tmp_path, docs=docs, labels=[(0, 1), (1, 0), (2, None)], embeddings=vecs)).collect()
    assert len(got) == (4 if name == "op4" else 6)
    if name == "op10":
        assert {(r["doc_id"], r["component_id"]) for r in got} == {(0, 0), (1, 1), (2, 2), (3, 2)}
    if name == "op4":
        assert {(r["vec_id"], r["component_id"]) for r in got} == {(0, 0), (1, 1), (2, 1)}


@pytest.mark.parametrize("seed", [9, 10])
def test_random_shingle_joins(spark, tmp_path, seed):
    """Large groups of near copies with borderline pairs: components equal brute force."""
    rng = random.Random(seed)
    docs = []
    for _ in range(6):
        w = data.prose(rng, rng.randrange(40, 160)).split()
        for _ in range(40):
            v = list(w)
            for _ in range(rng.randrange(6)):
                v[rng.randrange(len(v))] = f"new{rng.randrange(10**6)}"
            docs.append(" ".join(v))
    got = rows(spark, "op10", data.write(tmp_path, docs=docs))
    assert {i: (r["n_shingles"], r["component_id"]) for i, r in got.items()} == brute.op10(list(enumerate(docs)), 4, 85)
