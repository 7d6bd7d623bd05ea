"""Driver contract and the streaming derivations."""

import tempfile

import __spark_entry__ as E
from tabmine.streaming import derive_encounters, start_derived_stream

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    row = df.first()
    assert df.columns == ["n_rows", "n_pos", "n_neg", "positive_rate", "scale_pos_weight"]
    assert row["n_rows"] == row["n_pos"] + row["n_neg"] and row["n_rows"] > 0


def test_registry():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 50


def test_streaming_matches_batch(spark):
    ckpt = tempfile.mkdtemp(prefix="tabmine-stream-")
    q = start_derived_stream(spark, SF, ckpt, "derived_test")
    q.processAllAvailable()
    q.stop()
    streamed = {r["o_orderkey"]: r.asDict() for r in spark.sql("SELECT * FROM derived_test").collect()}
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    cust = spark.read.parquet(f"{SF}/customer.parquet").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    batch = {r["o_orderkey"]: r.asDict() for r in derive_encounters(
        orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"), cust).collect()}
    assert streamed == batch and len(batch) == orders.count()
