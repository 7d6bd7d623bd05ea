"""Column profiling.

All columns are profiled in a constant number of jobs: one unpivot ->
``groupBy(column, value).count()`` pass (partial counts on every map task, so a
dominant value never concentrates in one task) feeds near-zero variance,
distinct counts and distributions; one multi-column aggregate gives missing
counts and numeric statistics."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.operators.common import attach_scalars, lookup_join, prefix_sums
from tabmine.session import cut_lineage

# ---------------------------------------------------------------------------
# Treatment names of the per-column decision list.
T_DROP = "Drop"
T_MISSING_CATEGORY = "Missing Category"
T_MIDPOINT = "Midpoint Encode"
T_GROUP = "Group & Encode"
T_MEDIAN = "Median Impute"
T_MODE = "Mode Impute / 'Missing' Category"
T_TARGET_ENC = "Target / Frequency Encode"
T_ONEHOT = "One-Hot Encode"
T_SCALE = "Scale / Standardize"
T_BINARIZE = "Binarize (Target)"
DEFAULT_DESCRIPTION = "No detailed description available."
# ---------------------------------------------------------------------------


def is_numeric_type(dt: T.DataType) -> bool:
    """C14: numeric vs categorical from the declared schema."""
    return isinstance(dt, T.NumericType)


def numeric_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    cols = set(columns) if columns is not None else None
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and (cols is None or f.name in cols)]


def _names(spark, columns: Sequence[str], df: DataFrame | None = None) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields} if df is not None else {}
    rows = [(c, i, is_numeric_type(types[c]) if c in types else False) for i, c in enumerate(columns)]
    return spark.createDataFrame(rows, "column string, col_pos int, is_numeric boolean")


def value_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, value, cnt)`` for every non-null value of every column, compared
    as text.  One Expand + one partially aggregated shuffle for all columns."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], list(columns), "column", "value")
    return (long.where(F.col("value").isNotNull())
            .groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt")))


def nzv_metrics(df: DataFrame, columns: Sequence[str], fr_threshold: float = 20.0, up_threshold: float = 10.0,
                var_threshold_p0: float = 0.95, numeric_exempt: bool = False,
                counts: DataFrame | None = None) -> DataFrame:
    """A1/A2: near-zero variance metrics per column over non-null values.

    FR = top count / second count (missing when there is no second), UP = 100 *
    distinct / n, dominant_p = top / n, variance = p (1 - p); is_nzv = FR > 20 and
    UP < 10; below_var_thresh = variance < p0 (1 - p0); drop = either.  With
    ``numeric_exempt`` numeric columns skip the variance test (A2).  Flags use
    the unrounded values; outputs are rounded 2/4/6/6.  An all-null column gets
    FR missing, UP 0, variance 0, p 1 and is dropped."""
    spark = df.sparkSession
    vc = counts if counts is not None else value_counts_long(df, columns)
    # count-of-counts: tiny (<= distinct count values per column); pinned so the
    # size checks and the final query do not re-run the value counting
    cc = cut_lineage(vc.groupBy("column", "cnt").agg(F.count(F.lit(1)).alias("n_vals")))
    rk = F.row_number().over(Window.partitionBy("column").orderBy(F.desc("cnt")))
    top2 = cc.withColumn("_rk", rk).where(F.col("_rk") <= 2)
    per = top2.groupBy("column").agg(
        F.max(F.when(F.col("_rk") == 1, F.col("cnt"))).alias("top"),
        F.max(F.when(F.col("_rk") == 1, F.col("n_vals"))).alias("n_top"),
        F.max(F.when(F.col("_rk") == 2, F.col("cnt"))).alias("next_cnt"))
    tot = cc.groupBy("column").agg(F.sum("n_vals").alias("n_unique"),
                                   F.sum(F.col("cnt") * F.col("n_vals")).alias("n"))
    names = _names(spark, columns, df)
    j = lookup_join(lookup_join(names, per, "column"), tot, "column")
    second = F.when(F.col("n_top") > 1, F.col("top")).otherwise(F.coalesce(F.col("next_cnt"), F.lit(0)))
    empty = F.coalesce(F.col("n"), F.lit(0)) == 0
    fr = F.when(empty | (second == 0), F.lit(float("inf"))).otherwise(F.col("top") / second)
    up = F.when(empty, F.lit(0.0)).otherwise(F.col("n_unique") * 100.0 / F.col("n"))
    p = F.when(empty, F.lit(1.0)).otherwise(F.col("top") / F.col("n"))
    var = F.when(empty, F.lit(0.0)).otherwise(p * (1 - p))
    thresh = var_threshold_p0 * (1 - var_threshold_p0)
    is_nzv = F.when(empty, F.lit(True)).otherwise((fr > fr_threshold) & (up < up_threshold))
    below = F.when(empty, F.lit(True)).otherwise(var < F.lit(thresh))
    if numeric_exempt:
        below = F.when(F.col("is_numeric") & ~empty, F.lit(False)).otherwise(below)
    out = j.select(
        "column", "col_pos", "is_numeric",
        F.when(fr == float("inf"), F.lit(None)).otherwise(F.round(fr, 2)).alias("fr"),
        F.round(up, 4).alias("up"), F.round(var, 6).alias("variance"), F.round(p, 6).alias("dominant_p"),
        is_nzv.alias("is_nzv"), below.alias("below_var_thresh"))
    out = out.withColumn("drop", F.col("is_nzv") | F.col("below_var_thresh"))
    cols = ["column", "fr", "up", "variance", "dominant_p"] + (["is_numeric"] if numeric_exempt else []) + [
        "is_nzv", "below_var_thresh", "drop"]
    return out.orderBy("col_pos").select(*cols)


def nzv_summary(nzv: DataFrame) -> DataFrame:
    """A3: counts of dropped and kept columns."""
    return nzv.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if(F.col("drop")).alias("n_drop"),
                   F.count_if(~F.col("drop")).alias("n_keep"))


def overview(df: DataFrame) -> DataFrame:
    """A4: rows, columns, missing cells, fully duplicate rows (rows beyond the
    first of each distinct row)."""
    cols = df.columns
    miss = None
    for c in cols:
        term = F.count_if(F.col(c).isNull())
        miss = term if miss is None else miss + term
    base = df.agg(F.count(F.lit(1)).alias("total_rows"), F.lit(len(cols)).alias("total_cols"),
                  (miss if miss is not None else F.lit(0)).cast("bigint").alias("total_missing_cells"))
    dups = (df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
            .agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows")))
    return attach_scalars(base, dups)


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None, counts: DataFrame | None = None,
                    raw: DataFrame | None = None) -> DataFrame:
    """Per column missing count, missing percent (2 decimals) and distinct
    non-null values compared as text (from ``raw`` when given: the all-string
    view)."""
    cols = list(columns or df.columns)
    spark = df.sparkSession
    agg = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    stack = F.expr("stack({n}, {args}) as (col_pos, missing_count)".format(
        n=len(cols), args=", ".join(f"{i}, m{i}" for i in range(len(cols)))))
    miss = agg.select("_rows", stack)
    vc = counts if counts is not None else value_counts_long(raw if raw is not None else df, cols)
    uniq = cut_lineage(vc.groupBy("column").agg(F.count(F.lit(1)).alias("unique_count")))
    names = _names(spark, cols, df)
    out = lookup_join(lookup_join(names, miss, "col_pos"), uniq, "column")
    return out.select("column", "col_pos", "is_numeric", F.col("missing_count").cast("bigint").alias("missing_count"),
                      F.round(F.try_divide(F.col("missing_count") * 100.0, F.col("_rows")), 2).alias("missing_pct"),
                      F.coalesce(F.col("unique_count"), F.lit(0)).cast("bigint").alias("unique_count"))


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    counts: DataFrame | None = None) -> DataFrame:
    """``(column, p, value)``: quantiles with linear interpolation between order
    statistics (position p * (n - 1)), exact, over non-null values.

    No single task holds a column: values are counted per (column, value),
    ranked by a distributed running count, and only the rows covering the
    needed ranks (two per quantile, passed as a literal map per column) are
    kept and interpolated."""
    spark = df.sparkSession
    if counts is not None:
        # the shared text value counts: Spark's number -> text conversion round-trips exactly
        vc = (counts.where(F.col("column").isin(*columns))
              .select("column", F.col("value").cast("double").alias("v"), "cnt").where(~F.isnan("v")))
    else:
        long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "v")
        vc = long.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("column", "v").agg(
            F.count(F.lit(1)).alias("cnt"))
        vc = cut_lineage(vc)
    n = {r["column"]: r["n"] for r in vc.groupBy("column").agg(F.sum("cnt").alias("n")).collect()}  # one per column
    if not n:
        return spark.createDataFrame([], "column string, p double, value double")
    want = {}
    for c, total in n.items():
        ranks = set()
        for q in probs:
            pos = q * (total - 1)
            ranks.update({int(math.floor(pos)), int(math.ceil(pos))})
        want[c] = sorted(ranks)
    ranked = prefix_sums(vc, order_cols=["v"], sum_cols=["cnt"], group_cols=["column"])
    wmap = F.create_map(*[x for c, ks in want.items() for x in (F.lit(c), F.array(*[F.lit(k) for k in ks]))])
    before = F.col("cum_cnt") - F.col("cnt")
    hits = ranked.select("column", "v", before.alias("_b"), F.col("cum_cnt").alias("_c"),
                         F.element_at(wmap, F.col("column")).alias("_ks"))
    hits = hits.select("column", "v", F.explode(F.filter("_ks", lambda k: (k >= F.col("_b")) & (k < F.col("_c"))))
                       .alias("k"))
    at = {(r["column"], r["k"]): r["v"] for r in hits.collect()}                 # <= 2 x probs per column
    rows = []
    for c, total in n.items():
        for q in probs:
            pos = q * (total - 1)
            lo, hi = int(math.floor(pos)), int(math.ceil(pos))
            a, b = at[(c, lo)], at[(c, hi)]
            rows.append((c, float(q), a + (pos - lo) * (b - a)))
    return spark.createDataFrame(rows, "column string, p double, value double")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None, approx: bool = False,
                    accuracy: int = 10000, counts: DataFrame | None = None) -> DataFrame:
    """Mean and sample std (4 decimals), min, quartiles with linear
    interpolation, max, over non-null values.  Moments come from one aggregate
    for all columns; quartiles from ``exact_quantiles`` (distributed), or from
    ``percentile_approx`` when ``approx=True``."""
    cols = columns if columns is not None else numeric_columns(df)
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, mean double, std double, min double, "
                                                   "q25 double, median double, q75 double, max double")
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        aggs += [F.round(F.avg(x), 4).alias(f"mean{i}"), F.round(F.stddev_samp(x), 4).alias(f"std{i}"),
                 F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        if approx:
            aggs.append(F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy).alias(f"q{i}"))
    row = df.agg(*aggs)
    qexpr = ", q{i}" if approx else ""
    stack = "stack({n}, {a}) as (column, mean, std, min, max{q})".format(
        n=len(cols), q=", q" if approx else "",
        a=", ".join(f"'{c}', mean{i}, std{i}, min{i}, max{i}" + qexpr.format(i=i) for i, c in enumerate(cols)))
    base = row.select(F.expr(stack))
    if approx:
        return base.select("column", "mean", "std", "min", F.col("q")[0].alias("q25"), F.col("q")[1].alias("median"),
                           F.col("q")[2].alias("q75"), "max")
    q = exact_quantiles(df, cols, [0.25, 0.5, 0.75], counts).groupBy("column").agg(
        *[F.max(F.when(F.col("p") == p, F.col("value"))).alias(name)
          for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))])
    return base.join(q, "column", "left").select("column", "mean", "std", "min", "q25", "median", "q75", "max")


def distribution(df: DataFrame, columns: Sequence[str] | None = None, counts: DataFrame | None = None,
                 ordinal: bool = True) -> DataFrame:
    """``(column, label, n, ord)`` value counts without nulls; numeric
    columns ordered by numeric value, others by text.  ``ord`` comes from a
    distributed prefix count (no per-column single task)."""
    cols = list(columns or df.columns)
    numeric = set(numeric_columns(df, cols))
    vc = counts if counts is not None else value_counts_long(df, cols)
    num_key = F.when(F.col("column").isin(*numeric) if numeric else F.lit(False),
                     F.coalesce(F.col("value").try_cast("double"), F.lit(float("inf")))).otherwise(F.lit(0.0))
    d = vc.select("column", F.col("value").alias("label"), F.col("cnt").alias("n"), num_key.alias("_key"),
                  F.lit(1).alias("_one"))
    if not ordinal:
        return d.drop("_one")
    ranked = prefix_sums(d, order_cols=["_key", "label"], sum_cols=["_one"], group_cols=["column"])
    return ranked.select("column", "label", "n", F.col("cum__one").cast("int").alias("ord"))


def log_scale_hint(dist: DataFrame, ratio: float = 50.0) -> DataFrame:
    """Per column, whether max count / smallest non-zero count exceeds
    ``ratio`` (1 when there is no non-zero count)."""
    return dist.groupBy("column").agg(
        (F.max("n") / F.coalesce(F.min(F.when(F.col("n") > 0, F.col("n"))), F.lit(1)) > ratio).alias("use_log"))


def treatment(profile: DataFrame, id_cols: Sequence[str] = (), high_missing_cols: Sequence[str] = (),
              missing_category_cols: Sequence[str] = (), midpoint_cols: Sequence[str] = (),
              group_cols: Sequence[str] = (), target: str | None = None,
              missing_drop_pct: float = 40.0, onehot_max_levels: int = 10) -> DataFrame:
    """Recommended treatment per column, the first matching rule wins;
    the target column is always 'Binarize (Target)'.  ``profile`` needs
    ``column, is_numeric, missing_pct, unique_count``."""
    def isin(cols):
        return F.col("column").isin(*cols) if cols else F.lit(False)

    num, miss, uniq = F.col("is_numeric"), F.col("missing_pct"), F.col("unique_count")
    rule = (F.when(isin(id_cols), T_DROP).when(isin(high_missing_cols), T_DROP)
            .when(isin(missing_category_cols), T_MISSING_CATEGORY).when(isin(midpoint_cols), T_MIDPOINT)
            .when(miss > missing_drop_pct, T_DROP).when(uniq == 1, T_DROP).when(isin(group_cols), T_GROUP)
            .when(num & (miss > 0), T_MEDIAN).when(~num & (miss > 0), T_MODE)
            .when(~num & (uniq > onehot_max_levels), T_TARGET_ENC).when(~num, T_ONEHOT).otherwise(T_SCALE))
    if target:
        rule = F.when(F.col("column") == target, T_BINARIZE).otherwise(rule)
    return profile.withColumn("treatment", rule)


def describe_columns(profile: DataFrame, descriptions: Mapping[str, str]) -> DataFrame:
    """C17: column description from a dictionary, a default text otherwise."""
    spark = profile.sparkSession
    d = spark.createDataFrame(list(descriptions.items()) or [("", "")], "column string, _desc string")
    return (lookup_join(profile, d, "column")
            .withColumn("description", F.coalesce(F.col("_desc"), F.lit(DEFAULT_DESCRIPTION))).drop("_desc"))


def column_profile(df: DataFrame, columns: Sequence[str] | None = None, descriptions: Mapping[str, str] | None = None,
                   code_dictionary: DataFrame | None = None, raw: DataFrame | None = None, **treatment_kw) -> DataFrame:
    """One row per column joining A5-A7, C12, C17 and the size of the
    column's code dictionary (C7).  ``code_dictionary`` is ``(domain, id,
    label)`` with ``domain`` = column name."""
    cols = list(columns or df.columns)
    counts = cut_lineage(value_counts_long(raw if raw is not None else df, cols))   # shared by every section
    prof = missing_profile(df, cols, counts=counts)
    stats = numeric_summary(df, numeric_columns(df, cols), counts=None if raw is not None else counts)
    prof = lookup_join(prof, stats, "column")
    prof = treatment(prof, **treatment_kw)
    prof = describe_columns(prof, descriptions or {})
    if code_dictionary is not None:
        # entries per dictionary domain: one number per domain (a handful), as a map literal
        sizes = {r["domain"]: r["n"] for r in code_dictionary.groupBy("domain").agg(F.count(F.lit(1)).alias("n"))
                 .collect()}
        m = F.create_map(*[x for k, v in sizes.items() for x in (F.lit(k), F.lit(v))]) if sizes else None
        prof = prof.withColumn("value_mapping_size", F.element_at(m, F.col("column")) if m is not None
                               else F.lit(None).cast("bigint"))
    else:
        prof = prof.withColumn("value_mapping_size", F.lit(None).cast("bigint"))
    prof = prof.withColumn("value_mapping_size", F.coalesce(F.col("value_mapping_size"), F.lit(0)).cast("bigint"))
    return prof.withColumn("type", F.when(F.col("is_numeric"), "Numeric").otherwise("Categorical")).orderBy("col_pos")
