"""The store against the history of all batches: order, retries, crashes, streams."""

import random

import pytest
from pyspark.sql import functions as F

from tabmine.operators.runs import run_history
from tabmine.streaming.run_store import RunStore

SCHEMA = "algorithm string, signature string, ts timestamp, run_id bigint, value double"


def make(spark, n, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]) if rng.random() < 0.6 else "hot", f"s{rng.randrange(30)}", rng.randrange(10**6), i, rng.random())
            for i in range(n)]
    return spark.createDataFrame(rows, "algorithm string, signature string, t long, run_id bigint, value double").select(
        "algorithm", "signature", F.timestamp_seconds("t").alias("ts"), "run_id", "value")


def rows_of(df):
    return sorted(map(str, df.select("algorithm", "signature", "ts", "run_id", "value", "rank").collect()))


def test_equals_the_history_of_all_batches(spark, tmpdir_path):
    whole = make(spark, 600, 1).withColumn("part", F.pmod(F.xxhash64("run_id"), F.lit(4))).cache()
    store = RunStore(spark, tmpdir_path, tiebreak="run_id", buckets=5)
    schema = whole.drop("part").schema
    assert store.history(schema).collect() == []
    for n in range(4):
        batch = whole.where(F.col("part") == n).drop("part")                     # late and early runs mixed
        assert store.upsert(batch, n)
        assert not store.upsert(batch, n)                                        # a retry changes nothing
        want = run_history(whole.where(F.col("part") <= n).drop("part"), tiebreak="run_id")
        assert rows_of(store.history(schema)) == rows_of(want)
    assert not store.upsert(whole.where("part = 0").drop("part"), 1)
    before = rows_of(store.history(schema))
    assert store.vacuum() > 0 and rows_of(store.history(schema)) == before and store.committed() == [3]


def test_a_batch_that_failed_half_way_is_not_seen(spark, tmpdir_path, monkeypatch):
    store = RunStore(spark, tmpdir_path, tiebreak="run_id", buckets=3)
    a, b = make(spark, 80, 2), make(spark, 80, 3).withColumn("run_id", F.col("run_id") + 100)
    store.upsert(a, 0)
    before = rows_of(store.history(a.schema))
    create = spark.createDataFrame

    def lost(rows, schema=None, **kw):
        if isinstance(schema, str) and schema.startswith("bucket"):
            raise RuntimeError("executor lost")
        return create(rows, schema, **kw)

    monkeypatch.setattr(spark, "createDataFrame", lost)
    with pytest.raises(RuntimeError):
        store.upsert(b, 1)                                                       # data written, manifest not
    monkeypatch.undo()
    assert store.committed() == [0] and rows_of(store.history(a.schema)) == before
    assert store.upsert(b, 1)
    assert rows_of(store.history(a.schema)) == rows_of(run_history(a.unionByName(b), tiebreak="run_id"))


def test_empty_batch_and_stream(spark, tmpdir_path):
    runs = make(spark, 200, 4)
    source, store = f"{tmpdir_path}/in", RunStore(spark, f"{tmpdir_path}/store", tiebreak="run_id", buckets=4)
    for k in range(3):
        runs.where(F.col("run_id") % 3 == k).coalesce(1).write.mode("append").parquet(source)

    def follow():
        stream = spark.readStream.schema(runs.schema).option("maxFilesPerTrigger", 1).parquet(source)
        q = store.follow(stream, f"{tmpdir_path}/checkpoint")
        q.awaitTermination(120)
        assert q.exception() is None

    follow()
    assert rows_of(store.history(runs.schema)) == rows_of(run_history(runs, tiebreak="run_id"))
    last = store.committed()[-1]
    assert store.upsert(runs.limit(0), last + 1)
    more = make(spark, 50, 5).withColumn("run_id", F.col("run_id") + 1000)
    store.upsert(more, last + 2)
    assert rows_of(store.history(runs.schema)) == rows_of(run_history(runs.unionByName(more), tiebreak="run_id"))
