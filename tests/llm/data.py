"""Small tables with the awkward rows: nulls, empty and very long texts, ties, repeats, clashing extra columns."""
import random

import pyarrow as pa
import pyarrow.parquet as pq

WORDS = "der die und the of and thion reble stupid lantern river café niño über größe été forêt quick jump over lazy dogs".split()


def prose(rng, n, sep=" "):
    return sep.join(rng.choice(WORDS) + str(rng.randrange(40)) * (rng.random() < 0.3) for _ in range(n))


def texts(seed=3):
    rng = random.Random(seed)
    base = [prose(rng, rng.randrange(12, 60)) + "\n" + prose(rng, rng.randrange(6, 20)) for _ in range(30)]
    out = [None, "", " \n\t ", "!!! ... ???", "12 34", "word", "two words", "\n\n", "a" * 5000, "é" * 3000 + " ü"]
    out += base + base[:6]                                            # exact copies
    for t in base[:12]:                                               # near copies
        w = t.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out.append(" ".join(w))
    shared = "This shared line stands in many documents."
    out += [prose(rng, 8) + "\n" + shared + "\n" + prose(rng, 9) for _ in range(5)]
    out += [prose(rng, 7) + "\n" + shared[:-1] + "!\n" + "tail"]
    out += ["mail a.b@c.example.com and x@y@z.org, 10.0.0.1 999.1.1.1 1.2.3.4.5 card 4111 1111 1111 1111 or 4111111111111111 "
            "phone +1 (269) 555-3296 +12 é +44 20 7946 0958.",
            "Token = 'abc123def' password:short1 PASSWD=abc secret:token:abcdefgh api-key=zzzzzz apikey=\"qwerty12\" "
            "AKIA" + "A1" * 9 + " AKIASHORT " + "0f" * 14 + " deadbeef -----BEGIN RSA PRIVATE KEY-----",
            prose(rng, 25_000)]
    return out


def write(path, docs=None, benchmark=None, labels=None, embeddings=None, extra=True):
    """Tables under ``path``; ``docs`` are texts (ids from 0) or (id, text) rows. Extra columns clash on purpose."""
    docs = texts() if docs is None else docs
    rows = [d if isinstance(d, tuple) else (i, d) for i, d in enumerate(docs)]
    rng = random.Random(5)
    cols = {"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string()),
            "lang": pa.array([rng.choice(["en", "de", None]) for _ in rows], pa.string()),
            "source": pa.array([rng.choice(["s0", "s0", "s1", None]) for _ in rows], pa.string()),
            "n_chars": pa.array([len(t or "") for _, t in rows], pa.int64())}
    if extra:
        for c in ("score", "spans", "removed", "hits", "key", "n_tokens", "ids", "curve", "digest", "rejected"):
            cols[c] = pa.array(["x"] * len(rows), pa.string())
    pq.write_table(pa.table(cols), f"{path}/documents.parquet")
    benchmark = benchmark if benchmark is not None else []
    pq.write_table(pa.table({"item_id": pa.array([i for i, _ in benchmark], pa.int64()), "text": pa.array([t for _, t in benchmark], pa.string()),
                             "hits": pa.array(["x"] * len(benchmark), pa.string())}), f"{path}/benchmark.parquet")
    labels = labels if labels is not None else []
    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in labels], pa.int64()), "quality": pa.array([1] * len(labels), pa.int32()),
                             "toxic": pa.array([y for _, y in labels], pa.int32())}), f"{path}/labels.parquet")
    embeddings = embeddings if embeddings is not None else []
    pq.write_table(pa.table({"vec_id": pa.array([i for i, _ in embeddings], pa.int64()), "embedding": pa.array([v for _, v in embeddings], pa.list_(pa.float32())),
                             "label": pa.array([0] * len(embeddings), pa.int32()), "key": pa.array(["x"] * len(embeddings), pa.string())}), f"{path}/embeddings.parquet")
    return str(path)
