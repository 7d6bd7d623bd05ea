"""Feature scoring (FS1, FS2, FS5, FS7) on the sparse long feature table
``(row_id, label, feature, value)`` (absent entries are 0).

Both scores come from one partially aggregated ``groupBy(feature, class, bin)``
over the long table (count and sum of the present entries) plus the class
sizes; the absent (zero) entries are added back per (feature, class) from the
class sizes.  No dense matrix, no row pairs, no join on row id."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.operators.common import attach_scalars, broadcast_checked, fitted_side, with_each
from tabmine.session import cut_lineage


def feature_class_cells(long: DataFrame, label: str = "label", bins: int = 10, rows: DataFrame | None = None) -> DataFrame:
    """``(feature, label, b, n_bc, s_bc, n_c, N, lo, hi)`` for every (feature,
    class, bin) with rows, absent zeros included.  Features are cut into
    ``bins`` equal-width bins over [lo, hi] (lo/hi include 0 when a feature is
    absent somewhere).  ``rows``: ``(row_id, label)`` of all rows, one each; without
    it, rows whose entries are all zero are not known and not counted."""
    long = cut_lineage(long)
    rows = rows if rows is not None else long.select("row_id", label).distinct()
    classes = cut_lineage(rows.groupBy(label).agg(F.count(F.lit(1)).alias("n_c")))
    total = classes.agg(F.sum("n_c").alias("N"))
    ext = attach_scalars(long.groupBy("feature").agg(F.count(F.lit(1)).alias("cnt"), F.min("value").alias("min_p"),
                                                     F.max("value").alias("max_p")), total)
    lohi = ext.select("feature", "N",
                      F.when(F.col("cnt") < F.col("N"), F.least("min_p", F.lit(0.0))).otherwise(F.col("min_p")).alias("lo"),
                      F.when(F.col("cnt") < F.col("N"), F.greatest("max_p", F.lit(0.0))).otherwise(F.col("max_p"))
                      .alias("hi"))
    lohi = fitted_side(lohi)
    rng = F.col("hi") - F.col("lo")

    def bin_of(x):
        # the position is rounded to 9 decimals first so values that sit exactly on a
        # bin edge (e.g. standardised integer codes) do not flip with the last bit
        pos = F.round((x - F.col("lo")) / rng * bins, 9)
        return F.when(rng > 0, F.least(F.floor(pos), F.lit(bins - 1))).otherwise(F.lit(0))

    present = cut_lineage(long.join(lohi, "feature").groupBy("feature", label, bin_of(F.col("value")).alias("b"))
                          .agg(F.count(F.lit(1)).alias("n_bc"), F.sum("value").alias("s_bc")))
    per_fc = present.groupBy("feature", label).agg(F.sum("n_bc").alias("cnt_c"))
    grid = with_each(lohi, classes).join(per_fc, ["feature", label], "left").fillna({"cnt_c": 0})
    absent = grid.select("feature", label, bin_of(F.lit(0.0)).alias("b"),
                         (F.col("n_c") - F.col("cnt_c")).alias("n_bc"), F.lit(0.0).alias("s_bc")) \
        .where(F.col("n_bc") > 0)
    cells = present.unionByName(absent).groupBy("feature", label, "b").agg(F.sum("n_bc").alias("n_bc"),
                                                                            F.sum("s_bc").alias("s_bc"))
    return cells.join(broadcast_checked(classes), label).join(lohi, "feature")


def chi_square(cells: DataFrame, label: str = "label") -> DataFrame:
    """FS2: chi-square of min-max scaled features against the class:
    O_c = scaled sum in class c, E_c = class share * scaled total,
    score = sum (O - E)^2 / E; undefined (some E = 0) -> 0."""
    per = cells.groupBy("feature", label).agg(F.sum("s_bc").alias("s_c"), F.first("n_c").alias("n_c"),
                                              F.first("N").alias("N"), F.first("lo").alias("lo"),
                                              F.first("hi").alias("hi"))
    rng = F.col("hi") - F.col("lo")
    g = per.withColumn("O", F.when(rng > 0, (F.col("s_c") - F.col("n_c") * F.col("lo")) / rng).otherwise(F.lit(0.0)))
    g = g.withColumn("E", F.col("n_c") / F.col("N") * F.sum("O").over(Window.partitionBy("feature")))
    term = F.when(F.col("E") > 0, (F.col("O") - F.col("E")) ** 2 / F.col("E"))
    s = g.groupBy("feature").agg(F.sum(term).alias("_s"), F.count_if(F.col("E") > 0).alias("_ok"),
                                 F.count(F.lit(1)).alias("_k"))
    return s.select("feature", F.when(F.col("_ok") == F.col("_k"), F.col("_s")).otherwise(F.lit(0.0)).alias("score"))


def mutual_information(cells: DataFrame, label: str = "label") -> DataFrame:
    """FS1 (plug-in estimate, natural log, equal-width bins; bin position
    rounded to 9 decimals before the floor):
    MI = sum p(b,c) ln(p(b,c) / (p(b) p(c)))."""
    n_b = F.sum("n_bc").over(Window.partitionBy("feature", "b"))
    c = cells.withColumn("n_b", n_b)
    term = F.col("n_bc") / F.col("N") * F.log(F.col("n_bc") * F.col("N") / (F.col("n_b") * F.col("n_c")))
    return c.groupBy("feature").agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("score"))


def feature_scores(long: DataFrame, label: str = "label", bins: int = 10, rows: DataFrame | None = None) -> DataFrame:
    """``(method, feature, score)`` for both methods from one cell table."""
    cells = cut_lineage(feature_class_cells(long, label, bins, rows))
    return (mutual_information(cells, label).withColumn("method", F.lit("mutual_information"))
            .unionByName(chi_square(cells, label).withColumn("method", F.lit("chi_square"))))


def top_features(scores: DataFrame, n: int = 20, digits: int = 6) -> DataFrame:
    """FS5: ``(method, rank, feature, score)``, the ``n`` best per method (ties
    by feature name); planned as a group limit."""
    w = Window.partitionBy("method").orderBy(F.desc("score"), "feature")
    return (scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
            .select("method", "rank", "feature", F.round("score", digits).alias("score")))


def method_summary(top: DataFrame, k: int = 5) -> DataFrame:
    """FS7: best feature and score per method and the top ``k`` names joined."""
    return top.groupBy("method").agg(
        F.min_by("feature", "rank").alias("best_feature"), F.min_by("score", "rank").alias("best_score"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("rank") <= k, F.struct("rank", "feature")))),
                                 lambda x: x["feature"]), ", ").alias("top_features"))
