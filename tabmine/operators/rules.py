"""Frequent itemsets and association rules.

Level-wise counting: a transaction keeps only its frequent single items (the
frequent-item list is bounded by (items per transaction) / min_support, so it
travels as a literal); level k extends each frequent (k-1)-subset found in a
transaction by the later items of that transaction, counts the k-sets with a
partially aggregated ``groupBy``, and keeps those with support >= min.  Every
frequent k-set is some frequent (k-1)-set plus one later item, so this counts
exactly the frequent itemsets.  Rules enumerate every non-empty proper subset
of each frequent itemset (multi-item consequents included) and look the counts
up with a join on the sorted item array."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.operators.common import broadcast_checked
from tabmine.session import cut_lineage


def _bit(i):
    """Bit ``i`` of the subset mask ``_m``."""
    return F.col("_m").bitwiseAND(F.pow(F.lit(2), i).cast("int"))


def _key(col):
    return F.array_join(col, "\u0001")


def frequent_itemsets(tx: DataFrame, items: str = "items", min_support: float = 0.08,
                      max_length: int = 3) -> DataFrame:
    """``(items array<string>, n_items, count, support)`` for every itemset
    with count / transactions >= ``min_support`` and at most ``max_length`` items.
    Duplicate items in a transaction count once; an empty table gives no rows.

    Frequent items get integer ids in item order; each level groups on the
    ascending array of ids."""
    spark = tx.sparkSession
    schema = "items array<string>, n_items int, count bigint, support double"
    baskets = cut_lineage(tx.select(F.array_distinct(F.col(items)).alias("basket")))
    total = baskets.count()
    if total == 0:
        return spark.createDataFrame([], schema)
    ratio = F.lit(float(total))
    singles = (baskets.select(F.explode("basket").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("count"))
               .where(F.col("count") / ratio >= F.lit(min_support)))
    single_rows = sorted((r["item"], r["count"]) for r in singles.collect())   # bounded: items / min_support
    names = [i for i, _ in single_rows]
    levels = [spark.createDataFrame([([i], 1, c) for i, c in single_rows], "items array<string>, n_items int, count bigint")]
    if names and max_length > 1:
        ids = F.create_map(*[x for k, n in enumerate(names, start=1) for x in (F.lit(n), F.lit(k))])
        names_arr = F.array(*[F.lit(n) for n in names])
        coded = baskets.select(F.array_sort(F.filter(F.transform("basket", lambda x: F.element_at(ids, x)),
                                                     lambda x: x.isNotNull())).alias("b")).where(F.size("b") >= 2)
        first = F.array(F.col("last"))
        rows = coded.select("b", F.explode("b").alias("last")).select("b", first.alias("key"), "last")
        for k in range(2, max_length + 1):
            grow = F.concat(F.col("key"), F.array(F.col("last")))
            ext = rows.select("b", "key", F.explode(F.filter("b", lambda y: y > F.col("last"))).alias("last")) \
                .select("b", grow.alias("key"), "last")
            counts = cut_lineage(ext.groupBy("key").agg(F.count(F.lit(1)).alias("count"))
                                 .where(F.col("count") / ratio >= F.lit(min_support)))
            if counts.isEmpty():
                break
            digits = F.transform(F.col("key"), lambda i: F.element_at(names_arr, i))
            levels.append(counts.select(digits.alias("items"), F.lit(k).alias("n_items"), "count"))
            if k < max_length:
                # regenerated from the pinned baskets when the next level runs
                rows = ext.join(counts.select("key"), "key", "left_semi")
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out.select("items", F.col("n_items").cast("int").alias("n_items"), F.col("count").cast("bigint").alias("count"),
                      (F.col("count") / ratio).alias("support"))


def association_rules(itemsets: DataFrame, min_confidence: float = 0.6) -> DataFrame:
    """R2: every split of a frequent itemset (size >= 2) into a non-empty
    antecedent and consequent; confidence = count / antecedent count >=
    ``min_confidence``; lift = confidence / consequent support."""
    multi = itemsets.where(F.col("n_items") >= 2)
    masks = multi.select("items", "count", "support",
                         F.explode(F.sequence(F.lit(1), F.pow(F.lit(2), F.size("items")).cast("int") - 2)).alias("_m"))
    split = masks.select(
        "count", "support",
        F.filter("items", lambda x, i: _bit(i) != 0).alias("antecedent"),
        F.filter("items", lambda x, i: _bit(i) == 0).alias("consequent"))
    lookup = broadcast_checked(itemsets.select(_key(F.col("items")).alias("_k"), F.col("count").alias("_c"),
                                               F.col("support").alias("_s")))
    a = lookup.select(F.col("_k").alias("_ak"), F.col("_c").alias("antecedent_count"))
    c = lookup.select(F.col("_k").alias("_ck"), F.col("_s").alias("consequent_support"))
    j = (split.withColumn("_ak", _key(F.col("antecedent"))).withColumn("_ck", _key(F.col("consequent")))
         .join(a, "_ak").join(c, "_ck"))
    conf = F.col("count") / F.col("antecedent_count")
    return (j.withColumn("confidence", conf).where(F.col("confidence") >= F.lit(min_confidence))
            .select("antecedent", "consequent", "support", "confidence",
                    F.try_divide(F.col("confidence"), F.col("consequent_support")).alias("lift"),
                    F.col("count").cast("bigint").alias("count")))


def top_rules(rules: DataFrame, n: int = 25, digits: int = 6) -> DataFrame:
    """By lift, confidence, support (descending), then antecedent and
    consequent arrays; rounded."""
    return (rules.orderBy(F.desc("lift"), F.desc("confidence"), F.desc("support"), "antecedent", "consequent")
            .limit(n).select("antecedent", "consequent", *[F.round(c, digits).alias(c)
                                                           for c in ("support", "confidence", "lift")], "count"))


def top_itemsets(itemsets: DataFrame, n: int = 50, digits: int = 6) -> DataFrame:
    """Longest first, then support descending, then items."""
    return (itemsets.orderBy(F.desc("n_items"), F.desc("support"), "items").limit(n)
            .select("items", "n_items", "count", F.round("support", digits).alias("support")))


def transactions(df: DataFrame, items_col) -> DataFrame:
    """Transactions from a table: one ``items`` array per row (C11 output)."""
    return df.select(items_col.alias("items"))

