"""Bindings of the operators to the driver tables.

The reference mines one flat table of hospital encounters; here the same roles
are played by columns of the TPC-H-like tables, every one derived by Spark from
the given tables so the work grows with them:

| role                         | binding                                                    |
| ---------------------------- | ---------------------------------------------------------- |
| encounter / patient key      | ``o_orderkey`` / ``o_custkey``                             |
| terminal code + dictionary   | ``c_nationkey`` in TERMINAL_CODES, labels from ``nation``   |
| invalid category             | ``c_mktsegment = 'AUTOMOBILE'``                             |
| missing token                | ``o_orderpriority = '4-NOT SPECIFIED'`` (read as null)      |
| target                       | ``o_orderstatus = 'F'``                                     |
| status ("medication") columns| ``st_price``, ``st_balance``, ``st_rush`` derived by rule   |

The SQL in ``ENCOUNTERS_SQL`` builds the same view in DuckDB for the oracles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmine.functions.derive import (age_midpoint, binary_target, change_count, icd9_group, stay_bucket,
                                      visit_bucket)
from tabmine.sources.tables import read_table, with_missing_token

# ---------------------------------------------------------------------------
# The reference's terminal discharge codes, reused as nation keys.
TERMINAL_CODES = [11, 13, 14, 19, 20, 21]
# ---------------------------------------------------------------------------
KEY, ORDER = "o_custkey", "o_orderkey"
TERMINAL_COL = "c_nationkey"
INVALID_COL, INVALID_VALUE = "c_mktsegment", "AUTOMOBILE"
MISSING_COL, MISSING_TOKEN = "o_orderpriority", "4-NOT SPECIFIED"
TARGET_COL, TARGET_POSITIVE = "o_orderstatus", "F"
STATUS_COLS = ["st_price", "st_balance", "st_rush"]
FILLS = {"o_orderpriority": "Unknown"}
ENCOUNTER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
                  "c_nationkey", "c_mktsegment", "c_acctbal", *STATUS_COLS]


def _status_columns() -> list:
    p, b = F.col("o_totalprice"), F.col("c_acctbal")
    return [
        F.when(p >= 450000, "Up").when(p < 50000, "Down").when(p < 250000, "Steady").otherwise("No").alias("st_price"),
        F.when(b < 0, "Down").when(b > 9900, "Up").otherwise("No").alias("st_balance"),
        F.when(p >= 495000, "Up").otherwise("No").alias("st_rush"),
    ]


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders x customer as the flat encounter table (a sort-merge join on the
    customer key at scale; both sides are pruned to the columns used)."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                                              "o_orderpriority"])
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"])
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "left").drop("c_custkey")
    j = with_missing_token(j, MISSING_TOKEN, [MISSING_COL])
    return j.select(*[F.col(c) for c in ENCOUNTER_COLS[:8]], *_status_columns())


def code_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(domain, id, label)``: nation names for the terminal code column."""
    n = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.select(F.lit(TERMINAL_COL).alias("domain"), F.col("n_nationkey").cast("string").alias("id"),
                    F.col("n_name").alias("label"))


def code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_dictionary(spark, sf_dir).select("id", "label")


ENCOUNTERS_SQL = """
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice,
       NULLIF(o.o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
       c.c_nationkey, c.c_mktsegment, c.c_acctbal,
       CASE WHEN o.o_totalprice >= 450000 THEN 'Up' WHEN o.o_totalprice < 50000 THEN 'Down'
            WHEN o.o_totalprice < 250000 THEN 'Steady' ELSE 'No' END AS st_price,
       CASE WHEN c.c_acctbal < 0 THEN 'Down' WHEN c.c_acctbal > 9900 THEN 'Up' ELSE 'No' END AS st_balance,
       CASE WHEN o.o_totalprice >= 495000 THEN 'Up' ELSE 'No' END AS st_rush
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
"""


# --- lineitem-derived text columns for the row functions (C1, C2, C5, C6) -----------------

def coded_lineitems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with rule-derived text codes: a diagnosis-like code per line
    (V/E prefixes, decimals, junk suffix), an age-like bracket from the part
    size, and stay/visit-like counts."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                                 "l_quantity", "l_tax", "l_returnflag"])
    pk = F.col("l_partkey")
    code = (F.when(pk % 17 == 0, F.concat(F.lit("V"), (pk % 100).cast("string")))
            .when(pk % 19 == 0, F.concat(F.lit("E"), (pk % 1000).cast("string")))
            .when(pk % 23 == 0, F.concat((pk % 1000).cast("string"), F.lit("d")))
            .when(F.col("l_linenumber") == 1, (pk % 1000).cast("string"))
            .otherwise(F.concat((pk % 1000).cast("string"), F.lit("."), F.col("l_linenumber").cast("string"))))
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_tax",
                     "l_returnflag", code.alias("diag_code"))


CODED_LINEITEMS_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_tax, l_returnflag,
       CASE WHEN l_partkey % 17 = 0 THEN 'V' || CAST(l_partkey % 100 AS VARCHAR)
            WHEN l_partkey % 19 = 0 THEN 'E' || CAST(l_partkey % 1000 AS VARCHAR)
            WHEN l_partkey % 23 = 0 THEN CAST(l_partkey % 1000 AS VARCHAR) || 'd'
            WHEN l_linenumber = 1 THEN CAST(l_partkey % 1000 AS VARCHAR)
            ELSE CAST(l_partkey % 1000 AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) END AS diag_code
FROM lineitem
"""


def age_brackets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part with an age-like bracket text ``[lo-hi)`` from ``p_size``."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_size"])
    lo = (F.col("p_size") / 10).cast("int") * 10
    return p.select("p_partkey", "p_size",
                    F.concat(F.lit("["), lo.cast("string"), F.lit("-"), (lo + 10).cast("string"), F.lit(")"))
                    .alias("age"))


AGE_BRACKETS_SQL = """
SELECT p_partkey, p_size,
       '[' || CAST((p_size // 10) * 10 AS VARCHAR) || '-' || CAST((p_size // 10) * 10 + 10 AS VARCHAR) || ')' AS age
FROM part
"""

__all__ = ["encounters", "code_dictionary", "code_labels", "coded_lineitems", "age_brackets",
           "binary_target", "change_count", "icd9_group", "age_midpoint", "stay_bucket", "visit_bucket"]


# --- model-ready source (P1-P5) ---------------------------------------------------------------
MR_NUMERIC = ["o_totalprice", "c_acctbal", "c_nationkey", "n_changed", "bal_mid"]
MR_CATEGORICAL = ["o_orderpriority", "c_mktsegment", "st_price"]


def model_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order per customer with the derived features: change count (C3),
    a bracket midpoint with missing values (C2 on the balance), binary target (C4)."""
    from tabmine.operators.clean import first_per_key

    e = first_per_key(encounters(spark, sf_dir), KEY, ORDER)
    lo = F.floor(F.col("c_acctbal") / 1000) * 10
    bracket = F.concat(F.lit("["), lo.cast("string"), F.lit("-"), (lo + 10).cast("string"), F.lit(")"))
    return e.select(F.col("o_orderkey").alias("row_id"),
                    binary_target(e, TARGET_COL, TARGET_POSITIVE).alias("target"),
                    "o_totalprice", "c_acctbal", "c_nationkey", change_count(STATUS_COLS).alias("n_changed"),
                    age_midpoint(bracket).alias("bal_mid"), *MR_CATEGORICAL)


MODEL_SOURCE_SQL = """
SELECT o_orderkey AS row_id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS target, o_totalprice, c_acctbal,
       c_nationkey,
       (CASE WHEN st_price IN ('Up', 'Down') THEN 1 ELSE 0 END) + (CASE WHEN st_balance IN ('Up', 'Down') THEN 1 ELSE 0 END)
         + (CASE WHEN st_rush IN ('Up', 'Down') THEN 1 ELSE 0 END) AS n_changed,
       CASE '[' || CAST(floor(c_acctbal / 1000) * 10 AS BIGINT) || '-' || CAST(floor(c_acctbal / 1000) * 10 + 10 AS BIGINT) || ')'
         WHEN '[0-10)' THEN 5.0 WHEN '[10-20)' THEN 15.0 WHEN '[20-30)' THEN 25.0 WHEN '[30-40)' THEN 35.0
         WHEN '[40-50)' THEN 45.0 WHEN '[50-60)' THEN 55.0 WHEN '[60-70)' THEN 65.0 WHEN '[70-80)' THEN 75.0
         WHEN '[80-90)' THEN 85.0 WHEN '[90-100)' THEN 95.0 END AS bal_mid,
       o_orderpriority, c_mktsegment, st_price
FROM first
"""


ENCODER = {"rowIdCol": "o_orderkey", "targetCol": TARGET_COL, "positiveValue": TARGET_POSITIVE, "statusCols": STATUS_COLS,
           "bracketCols": ["bal_bracket"], "codeCols": ["diag_code"], "dropCols": ["o_custkey"]}


def raw_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First order per customer as it comes, with a bracket text (from the balance) and a diagnosis-like code (from the key)."""
    from tabmine.operators.clean import first_per_key

    e = first_per_key(encounters(spark, sf_dir), KEY, ORDER)
    lo = F.floor(F.col("c_acctbal") / 1000) * 10
    return e.withColumn("bal_bracket", F.concat(F.lit("["), lo.cast("string"), F.lit("-"), (lo + 10).cast("string"), F.lit(")"))) \
        .withColumn("diag_code", (F.col("o_orderkey") % 1000).cast("string"))


# --- predictions of three fixed scoring rules (M11-M14, M18) ----------------------------------

def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, model, label, score, prediction)``: label = returned line;
    three rule 'models' scoring every line by discount, tax and price."""
    li = read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber", "l_returnflag", "l_discount", "l_tax",
                                                 "l_extendedprice"])
    base = li.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("row_id"),
                     (F.col("l_returnflag") == "R").cast("int").alias("label"), "l_discount", "l_tax",
                     "l_extendedprice")
    stacked = base.select("row_id", "label", F.expr(
        "stack(3, 'discount', l_discount, 0.05D, 'tax', l_tax, 0.04D, 'price', l_extendedprice, 50000.0D)"
        " as (model, score, cut)"))
    return stacked.select("row_id", "model", "label", "score",
                          (F.col("score") >= F.col("cut")).cast("int").alias("prediction"))


PREDICTIONS_SQL = """
SELECT l_orderkey * 8 + l_linenumber AS row_id, 'discount' AS model, CAST(l_returnflag = 'R' AS INTEGER) AS label,
       l_discount AS score, CAST(l_discount >= 0.05 AS INTEGER) AS prediction FROM lineitem
UNION ALL
SELECT l_orderkey * 8 + l_linenumber, 'tax', CAST(l_returnflag = 'R' AS INTEGER), l_tax,
       CAST(l_tax >= 0.04 AS INTEGER) FROM lineitem
UNION ALL
SELECT l_orderkey * 8 + l_linenumber, 'price', CAST(l_returnflag = 'R' AS INTEGER), l_extendedprice,
       CAST(l_extendedprice >= 50000.0 AS INTEGER) FROM lineitem
"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as experiment runs: algorithm = user, signature = C16 of the event
    type and its ``k`` parameter, metric = value."""
    from tabmine.functions.derive import run_signature

    ev = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type", "value", "props"])
    params = F.from_json("props", "map<string,string>")
    return ev.select(F.col("user_id").alias("algorithm"), run_signature("event_type", params).alias("signature"),
                     "ts", "event_id", "value")


RUNS_SQL = """
SELECT user_id AS algorithm, event_type || '::k=' || json_extract_string(props, '$.k') AS signature, ts, event_id, value
FROM events
"""


# --- transactions (R1-R4) -----------------------------------------------------------------------
BASKET_COLS = ["o_orderstatus", "o_orderpriority", "c_mktsegment", "st_price", "st_balance", "st_rush", "o_totalprice"]


def baskets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as a transaction of 'col=value' items (C11), the price
    bucketed like a stay length (C5 on price / 50000); missing values skipped."""
    from tabmine.functions.derive import itemize

    e = encounters(spark, sf_dir)
    items = itemize(BASKET_COLS, {"o_totalprice": lambda c: stay_bucket(c / 50000)})
    return e.select("o_orderkey", items.alias("items"))


BASKETS_SQL = """
SELECT o_orderkey AS tid, 'o_orderstatus=' || o_orderstatus AS item FROM enc WHERE o_orderstatus IS NOT NULL
UNION ALL SELECT o_orderkey, 'o_orderpriority=' || o_orderpriority FROM enc WHERE o_orderpriority IS NOT NULL
UNION ALL SELECT o_orderkey, 'c_mktsegment=' || c_mktsegment FROM enc WHERE c_mktsegment IS NOT NULL
UNION ALL SELECT o_orderkey, 'st_price=' || st_price FROM enc WHERE st_price IS NOT NULL
UNION ALL SELECT o_orderkey, 'st_balance=' || st_balance FROM enc WHERE st_balance IS NOT NULL
UNION ALL SELECT o_orderkey, 'st_rush=' || st_rush FROM enc WHERE st_rush IS NOT NULL
UNION ALL SELECT o_orderkey, 'o_totalprice=' || CASE WHEN o_totalprice / 50000 <= 3 THEN '1-3'
    WHEN o_totalprice / 50000 <= 6 THEN '4-6' ELSE '7+' END FROM enc WHERE o_totalprice IS NOT NULL
"""
