"""Skew: one key holds a third of all rows.  Results must stay exact (checked
against plain Python) when the data are spread over many partitions."""

from collections import Counter

from pyspark.sql import functions as F

from tabmine.operators import audit, clean, profile
from tabmine.operators.runs import run_history
from tabmine.operators.split import stratified_split

N = 3000


def _skewed(spark):
    # key 7 holds every third row; the rest are spread over 200 keys
    rows = [(i, 7 if i % 3 == 0 else i % 200 + 100, "hot" if i % 3 == 0 else f"v{i % 5}", i % 2) for i in range(N)]
    return spark.createDataFrame(rows, "oid long, cust long, cat string, y int").repartition(16)


def test_first_per_key_and_audit_with_hot_key(spark):
    df = _skewed(spark)
    firsts = {r["cust"]: r["oid"] for r in clean.first_per_key(df, "cust", "oid").collect()}
    exp = {}
    for i in range(N):
        c = 7 if i % 3 == 0 else i % 200 + 100
        exp[c] = min(exp.get(c, i), i)
    assert firsts == exp
    t = audit.tag_deletions(df, "cust", "oid", "cat", ["zzz"], None, "cat", "none")
    dups = t.where("_dup").count()
    assert dups == N - len(exp)


def test_profile_split_history_with_hot_value(spark):
    df = _skewed(spark)
    nzv = {r["column"]: r for r in profile.nzv_metrics(df, ["cat"]).collect()}
    cnt = Counter("hot" if i % 3 == 0 else f"v{i % 5}" for i in range(N))
    top, second = sorted(cnt.values(), reverse=True)[:2]
    assert nzv["cat"]["fr"] == round(top / second, 2)
    s = stratified_split(df.withColumn("cls", (F.col("cust") == 7).cast("int")), "oid", "cls", 0.2, 42)
    sizes = {(r["cls"], r["split"]): r["n"] for r in s.groupBy("cls", "split").agg(F.count("*").alias("n")).collect()}
    assert sizes[(1, "test")] == 200 and sizes[(0, "test")] == 400
    runs = df.select(F.col("cust").alias("algorithm"), F.col("cat").alias("signature"), F.col("oid").alias("ts"))
    h = run_history(runs, ts="ts", keep=12)
    hot = [r for r in h.collect() if r["algorithm"] == 7]
    assert len(hot) == 1 and hot[0]["ts"] == N - 3          # one signature on the hot key, newest row kept
