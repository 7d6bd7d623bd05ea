"""Dictionary lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.functions.derive import normalized_id
from tabmine.operators.common import broadcast_checked, lookup_join

CATEGORY_SUFFIX = " (category)"


def label_codes(df: DataFrame, code_col: str, labels: DataFrame, out_col: str = "label") -> DataFrame:
    """Add the dictionary label of ``code_col``; ids are normalised through
    float -> int on both sides (``'3.0'`` finds ``'3'``).  ``labels``: ``(id, label)``."""
    d = labels.select(normalized_id("id").alias("_id"), F.col("label").alias(out_col))
    d = d.groupBy("_id").agg(F.max(out_col).alias(out_col))
    return lookup_join(df.withColumn("_id", normalized_id(code_col)), broadcast_checked(d), "_id").drop("_id")


def prefix_label(codes: DataFrame, code_col: str, dictionary: DataFrame, out_col: str = "description",
                 strip: str = ".") -> DataFrame:
    """Label of ``code_col`` with ``strip`` characters removed: the exact
    dictionary key if present, else the label of the smallest key that starts
    with the code, suffixed ' (category)'.

    The prefix match is an equi-join: each dictionary key is exploded into its
    prefixes (``len(key)`` rows per key, a bounded dictionary) and joined to the
    codes that had no exact match, then ``min_by`` picks the smallest key.  No
    nested loop over codes x keys."""
    key = F.regexp_replace(F.col(code_col).cast("string"), "[" + strip + "]", "") if strip else F.col(code_col)
    c = codes.withColumn("_key", key)
    d = dictionary.select(F.col("key").cast("string").alias("_key"), F.col("label").alias("_exact"))
    exact = lookup_join(c, d.groupBy("_key").agg(F.min("_exact").alias("_exact")), "_key")
    prefixes = (dictionary.select(F.col("key").cast("string").alias("key"), "label")
                .select("key", "label", F.explode(F.sequence(F.lit(1), F.length("key"))).alias("_len"))
                .select(F.expr("substring(key, 1, _len)").alias("_key"), "key", "label")
                .groupBy("_key").agg(F.min_by("label", "key").alias("_prefix")))
    unmatched = exact.where(F.col("_exact").isNull()).select("_key").distinct()
    found = unmatched.join(broadcast_checked(prefixes), "_key", "inner")
    out = exact.join(found, "_key", "left")
    return out.select(*codes.columns, F.coalesce(F.col("_exact"), F.concat(F.col("_prefix"), F.lit(CATEGORY_SUFFIX)))
                      .alias(out_col))
