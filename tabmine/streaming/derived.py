"""Per-row derivations on a stream of orders (stream-static join to customers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tabmine.functions.derive import active_items, binary_target, change_count, itemize, stay_bucket
from tabmine.operators.clean import not_in
from tabmine.plans import bindings as B
from tabmine.sources.tables import read_table, with_missing_token


def derive_encounters(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Encounter rows with the stateless flags and derived columns: terminal
    code, invalid value, binary target, change count, active status list and
    the basket items.  Works on a batch or a streaming ``orders`` frame."""
    j = orders.join(customers, orders["o_custkey"] == customers["c_custkey"], "left").drop("c_custkey")
    j = with_missing_token(j, B.MISSING_TOKEN, [B.MISSING_COL])
    p, b = F.col("o_totalprice"), F.col("c_acctbal")
    j = j.select("*",
                 F.when(p >= 450000, "Up").when(p < 50000, "Down").when(p < 250000, "Steady").otherwise("No")
                 .alias("st_price"),
                 F.when(b < 0, "Down").when(b > 9900, "Up").otherwise("No").alias("st_balance"),
                 F.when(p >= 495000, "Up").otherwise("No").alias("st_rush"))
    items = itemize(B.BASKET_COLS, {"o_totalprice": lambda c: stay_bucket(c / 50000)})
    return j.select(
        "o_orderkey", "o_custkey",
        (~not_in(B.TERMINAL_COL, B.TERMINAL_CODES)).alias("terminal"),
        F.col(B.INVALID_COL).eqNullSafe(F.lit(B.INVALID_VALUE)).alias("invalid"),
        binary_target(j, B.TARGET_COL, B.TARGET_POSITIVE).alias("target"),
        change_count(B.STATUS_COLS).alias("n_changed"),
        active_items(B.STATUS_COLS).alias("active_status"),
        F.array_join(items, "|").alias("items"))


def start_derived_stream(spark: SparkSession, sf_dir: str, checkpoint: str, query_name: str = "derived_encounters",
                         max_files_per_trigger: int = 1) -> StreamingQuery:
    """Stream the orders table file by file through ``derive_encounters`` into a
    memory sink (tests) with a checkpoint folder for exactly-once progress."""
    schema = read_table(spark, sf_dir, "orders").schema
    orders = (spark.readStream.schema(schema).option("pathGlobFilter", "orders.parquet")
              .option("maxFilesPerTrigger", max_files_per_trigger).parquet(sf_dir))
    customers = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    out = derive_encounters(orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                          "o_orderpriority"), customers)
    return (out.writeStream.format("memory").queryName(query_name).outputMode("append")
            .option("checkpointLocation", checkpoint).start())
