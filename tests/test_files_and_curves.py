"""The ordered sink, fingerprints, the JVM p-value and the nested forest curve against plain versions."""
import math
import random

from pyspark.sql import functions as F

from quillspark.functions import text as tx
from quillspark.functions.stats import pearson_p_value, pearson_p_value_scalar
from quillspark.operators import cleaning as cl
from quillspark.operators import regression as rg
from quillspark.sources import sinks


def test_ordered_table_has_one_order_over_all_files(spark, scratch_dir):
    rng = random.Random(1)
    rows = [(i, rng.choice([None, 1, 2, 3, 50]), "x" * rng.randrange(5)) for i in range(4000)]
    path = scratch_dir + "/ordered"
    sinks.write_ordered(spark.createDataFrame(rows, "id long, k long, t string").repartition(7), path, ["k", "id"], partitions=9)
    got = {r["id"]: r["position"] for r in sinks.read_ordered(spark, path).collect()}
    want = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    assert got == {r[0]: i + 1 for i, r in enumerate(want)}
    files = sinks.manifest(spark, path).orderBy("file").collect()
    assert len(files) > 1 and sum(f["rows"] for f in files) == 4000
    key = lambda s: (s["k"] is not None, s["k"] or 0, s["id"])
    assert all(key(a["last"]) < key(b["first"]) for a, b in zip(files, files[1:]))


def test_ordered_table_of_no_rows(spark, scratch_dir):
    path = scratch_dir + "/none"
    sinks.write_ordered(spark.createDataFrame([], "id long, k long"), path, ["k"])
    assert sinks.read_ordered(spark, path).count() == 0


def test_p_value_column_equals_the_incomplete_beta(spark):
    rows = [(r, n) for r in (0.0, 0.001, -0.05, 0.3, -0.77, 0.999, 1.0, None, float("nan")) for n in (1, 2, 3, 4, 5, 6, 31, 200, 1201, 2400)]
    got = spark.createDataFrame(rows, "r double, n long").withColumn("p", pearson_p_value("r", "n")).collect()
    for row in got:
        want = pearson_p_value_scalar(row["r"], row["n"])
        assert row["p"] is None if want is None else math.isclose(row["p"], want, abs_tol=1e-12, rel_tol=1e-9), row


def test_fingerprints_tell_nulls_empty_texts_and_borders_apart(spark):
    rows = [(0, "ab", "c"), (1, "a", "bc"), (2, None, "abc"), (3, "abc", None), (4, "", "abc"), (5, "ab", "c"), (6, "2:ab", "c"), (7, None, None), (8, None, None)]
    df = spark.createDataFrame(rows, "row_id int, a string, b string")
    assert sorted(r[0] for r in cl.keep_first(df, ["a", "b"]).collect()) == [0, 1, 2, 3, 4, 6, 7]
    assert sorted(r[0] for r in cl.keep_first_ids(df, ["a", "b"]).collect()) == [0, 1, 2, 3, 4, 6, 7]


def test_no_text_is_a_key_of_an_exchange_or_sort(spark):
    df = spark.createDataFrame([(0, "t", "x")], "row_id int, text string, kind string")
    plan = cl.keep_first(df, ["text", "kind"])._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line or "Sort [" in line]
    assert keys and not any("text#" in line.split("ENSURE")[0] for line in keys)


def test_whitespace_of_every_kind(spark):
    blanks = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    texts = ["".join(blanks) + "a" + "".join(blanks) + "b" + b + b for b in blanks] + ["a​ ​ b", "​", "  ", "", None, "a b", " ‍ a ‌"]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", tx.clean_text("t").alias("c"), tx.py_strip("t").alias("s"), tx.collapse_ws("t").alias("w")).collect()
    for r in got:
        t = texts[r["i"]]
        if t is None:
            assert r["c"] is None and r["s"] is None and r["w"] is None
            continue
        plain = " ".join(t.split())
        for z in "​‌‍":
            plain = plain.replace(z, "")
        assert (r["c"], r["s"], r["w"]) == (plain.strip(), t.strip(), " ".join(t.split()))


def test_nested_forests(spark):
    from pyspark.ml.regression import RandomForestRegressor
    rng = random.Random(3)
    df = rg.assemble(spark.createDataFrame([(rng.random(), rng.random(), i % 3 == 0) for i in range(200)], "a double, b double, held boolean"), ["a", "b"])
    df = df.withColumn("y", F.col("a") * 3 + F.sin(F.col("b") * 9))
    m = RandomForestRegressor(labelCol="y", numTrees=6, maxDepth=4, seed=1).fit(df.where("not held"))
    got = {(r["held"], r["trees"]): r["rmse"] for r in rg.forest_curve(m, df, "y", "held", (1, 3, 6)).collect()}
    assert set(got) == {(h, t) for h in (True, False) for t in (1, 3, 6)}
    rows = df.collect()
    for k in (1, 3, 6):
        for held in (True, False):
            errors = [(sum(t.predict(r["features"]) for t in m.trees[:k]) / k - r["y"]) ** 2 for r in rows if r["held"] == held]
            assert math.isclose(got[held, k], (sum(errors) / len(errors)) ** 0.5, rel_tol=1e-9)
