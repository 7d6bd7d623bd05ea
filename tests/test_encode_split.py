"""Encoding (P1-P6) and hash splits."""

import hashlib
import math

from pyspark.sql import functions as F

from tabmine.operators.encode import fit_encoder, minmax_scale
from tabmine.operators.split import hash_uniform, stratified_sample, stratified_split, uniform_sample


def test_encoder(spark):
    df = spark.createDataFrame([(1, 1.0, "b", 0), (2, 2.0, "a", 1), (3, 3.0, "a", 0), (4, 10.0, None, 1),
                                (5, None, "b", 0)], "id long, x double, c string, y int")
    enc = fit_encoder(df.drop("id"), target="y", numeric=["x"], categorical=["c"])
    assert enc.modes == {"c": "a"}                                  # tie a/b -> smallest
    long = {(r["row_id"], r["feature"]): r["value"] for r in enc.transform_long(df, "id").collect()}
    vals = [1.0, 2.0, 3.0, 10.0, 2.5]                               # median 2.5 imputed
    m = sum(vals) / 5
    sd = math.sqrt(sum((v - m) ** 2 for v in vals) / 5)             # population std
    assert math.isclose(long[(5, "x")], (2.5 - m) / sd)
    assert long[(4, "c_a")] == 1.0 and (1, "c_a") not in long
    assert enc.feature_names() == ["x", "c_a", "c_b"]
    unseen = spark.createDataFrame([(9, 1.0, "zzz", 0)], "id long, x double, c string, y int")
    assert [r["feature"] for r in enc.transform_long(unseen, "id").collect()] == ["x"]   # unseen level -> zeros
    wide = enc.transform_wide(df, keep=["id"]).orderBy("id").collect()
    assert wide[3]["c_a"] == 1.0 and wide[3]["c_b"] == 0.0
    assert enc.group_counts().first()["n_encoded"] == 2


def test_minmax(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (2.0, 5.0)], "a double, b double")
    out = minmax_scale(df, ["a", "b"]).collect()
    assert [r["a"] for r in out] == [0.0, 1.0, 0.5] and all(r["b"] == 0.0 for r in out)


def test_hash_uniform_matches_md5(spark):
    df = spark.range(5).select(F.col("id"), hash_uniform("id", 42).alias("u"))
    for r in df.collect():
        h = int(hashlib.md5(f"42:{r['id']}".encode()).hexdigest()[:8], 16)
        assert r["u"] == h / 2 ** 32


def test_stratified_split_exact(spark):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    a = {r["id"]: r["split"] for r in stratified_split(df, "id", "y", 0.2, 42).collect()}
    b = {r["id"]: r["split"] for r in stratified_split(df.repartition(1), "id", "y", 0.2, 42).collect()}
    assert a == b
    test = [i for i, s in a.items() if s == "test"]
    assert len(test) == 200 and sum(1 for i in test if i % 10 == 0) == 20
    # brute force: smallest (u, id) per class
    u = {i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) for i in range(1000)}
    pos = sorted((u[i], i) for i in range(1000) if i % 10 == 0)[:20]
    assert {i for _, i in pos} == {i for i in test if i % 10 == 0}


def test_samples(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") < 30).cast("int").alias("y"))
    s = stratified_sample(df, "id", "y", 10, 7).collect()
    assert len(s) == 10 and sum(r["y"] for r in s) == 3
    assert stratified_sample(df, "id", "y", 500).count() == 100
    u = [r["id"] for r in uniform_sample(df, "id", 5, 42).collect()]
    ref = sorted(range(100), key=lambda i: (int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16), i))[:5]
    assert sorted(u) == sorted(ref)
