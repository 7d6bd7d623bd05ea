"""Model-ready encoding.

``fit`` runs two aggregations over the training rows (medians and modes in one,
mean and population std of the imputed numbers in the other) plus the level
table of the categorical columns; the result is a small parameter set.
``transform`` is a projection (and a broadcast join for the level table in the
long form).  Three outputs:

* ``long``:  ``(row_id, feature, value)``, one row per numeric feature and one per
  present one-hot level (sparse; unseen levels give no row = all zeros);
* ``wide``:  one column per feature (width = number of levels, so the level
  names are brought to the driver: bounded by the output schema itself);
* ``vector``: the wide columns assembled into one ``features`` vector.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.operators.common import attach_scalars, broadcast_checked
from tabmine.session import cut_lineage
from tabmine.operators.profile import exact_quantiles, numeric_columns, value_counts_long


@dataclass
class EncoderModel:
    target: str | None
    numeric: list[str]
    categorical: list[str]
    numeric_params: DataFrame      # one row: med_<c>, mean_<c>, std_<c>
    levels: DataFrame              # (column, level, mode_level boolean)
    modes: dict = field(default_factory=dict)

    # -- outputs ---------------------------------------------------------------------------
    def _imputed(self, df: DataFrame) -> DataFrame:
        j = attach_scalars(df, self.numeric_params)
        cols = [F.col(c) for c in df.columns if c not in set(self.numeric) | set(self.categorical)]
        num = [F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}")).alias(c) for c in self.numeric]
        cat = [F.coalesce(F.col(c).cast("string"), F.lit(self.modes.get(c))).alias(c) for c in self.categorical]
        scaled = [F.when(F.col(f"_std_{c}") > 0, (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_std_{c}"))
                  .otherwise(F.lit(0.0)).alias(c) for c in self.numeric]
        keep_params = [f"_{k}_{c}" for c in self.numeric for k in ("med", "mean", "std")]
        staged = j.select(*cols, *num, *cat, *[F.col(p) for p in keep_params])
        return staged.select(*cols, *scaled, *[F.col(c) for c in self.categorical])

    def transform_long(self, df: DataFrame, row_id: str, keep: Sequence[str] = ()) -> DataFrame:
        """Sparse long form ``(row_id, *keep, feature, value)``; numeric features
        always present, one-hot features only where the level is present and
        known.  ``keep`` carries per-row columns (e.g. the label) along."""
        imp = self._imputed(df)
        ids = [F.col(row_id).alias("row_id"), *[F.col(k) for k in keep]]
        parts = []
        if self.numeric:
            stack = "stack({n}, {a}) as (feature, value)".format(
                n=len(self.numeric), a=", ".join(f"'{c}', `{c}`" for c in self.numeric))
            parts.append(imp.select(*ids, F.expr(stack)))
        if self.categorical:
            stack = "stack({n}, {a}) as (column, level)".format(
                n=len(self.categorical), a=", ".join(f"'{c}', `{c}`" for c in self.categorical))
            cat = imp.select(*ids, F.expr(stack)).where(F.col("level").isNotNull())
            known = broadcast_checked(self.levels.select("column", "level"))
            parts.append(cat.join(known, ["column", "level"], "left_semi")
                         .select("row_id", *keep, F.concat(F.col("column"), F.lit("_"), F.col("level")).alias("feature"),
                                 F.lit(1.0).alias("value")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def feature_names(self) -> list[str]:
        """Numeric names, then ``column_level`` in column order and level order."""
        rows = self.levels.orderBy("col_pos", "level").collect()
        return list(self.numeric) + [f"{r['column']}_{r['level']}" for r in rows]

    def level_lists(self) -> dict[str, list[str]]:
        out: dict[str, list[str]] = {c: [] for c in self.categorical}
        for r in self.levels.orderBy("col_pos", "level").collect():
            out[r["column"]].append(r["level"])
        return out

    def transform_wide(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Dense form: kept columns, target (as int) first, then every feature."""
        imp = self._imputed(df)
        lv = self.level_lists()
        one_hot = [F.when(F.col(c) == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"{c}_{v}")
                   for c in self.categorical for v in lv[c]]
        head = [F.col(self.target)] if self.target else []
        return imp.select(*[F.col(k) for k in keep], *head, *[F.col(c) for c in self.numeric], *one_hot)

    def transform_vector(self, df: DataFrame, keep: Sequence[str] = (), output: str = "features") -> DataFrame:
        from pyspark.ml.feature import VectorAssembler

        wide = self.transform_wide(df, keep)
        names = self.feature_names()
        vec = VectorAssembler(inputCols=names, outputCol=output).transform(wide)
        return vec.select(*[F.col(k) for k in keep], *([F.col(self.target)] if self.target else []), output)

    def group_counts(self) -> DataFrame:
        """Number of one-hot columns per categorical column."""
        return self.levels.groupBy("column").agg(F.count(F.lit(1)).alias("n_encoded"))


def fit_encoder(df: DataFrame, target: str | None = None, numeric: Sequence[str] | None = None,
                categorical: Sequence[str] | None = None) -> EncoderModel:
    """P1-P4 fit: exact (interpolated) median and population mean/std of the
    median-imputed numbers; mode (smallest on ties) and sorted levels of the
    categorical columns.  Column roles default to the schema's numeric types."""
    feats = [c for c in df.columns if c != target]
    num = list(numeric) if numeric is not None else numeric_columns(df, feats)
    cat = list(categorical) if categorical is not None else [c for c in feats if c not in set(num)]
    spark = df.sparkSession
    # one value-count pass serves the medians (numeric) and the modes/levels (categorical)
    counts = cut_lineage(value_counts_long(df, num + cat)) if (num or cat) else None
    if num:
        qs = {r["column"]: r["value"] for r in exact_quantiles(df, num, [0.5], counts).collect()}   # one per column
        meds = spark.createDataFrame([tuple(qs.get(c) for c in num)], ", ".join(f"_med_{c} double" for c in num))
        imp = attach_scalars(df.select(*num), meds)
        moments = imp.agg(*[F.first(f"_med_{c}").alias(f"_med_{c}") for c in num],
                          *[F.avg(F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}"))).alias(f"_mean_{c}")
                            for c in num],
                          *[F.stddev_pop(F.coalesce(F.col(c).cast("double"), F.col(f"_med_{c}"))).alias(f"_std_{c}")
                            for c in num])
        params = moments.cache()
    else:
        params = spark.range(1).select(F.lit(1).alias("_none"))
    modes: dict[str, str] = {}
    if cat:
        vc = counts.where(F.col("column").isin(*cat))
        best = vc.groupBy("column").agg(F.min_by("value", F.struct((-F.col("cnt")).alias("n"), F.col("value")))
                                        .alias("mode"))
        modes = {r["column"]: r["mode"] for r in best.collect()}
        pos = spark.createDataFrame([(c, i) for i, c in enumerate(cat)], "column string, col_pos int")
        levels = (vc.select("column", F.col("value").alias("level")).join(F.broadcast(pos), "column")
                  .withColumn("mode_level", F.lit(False)))
        levels = levels.cache()
    else:
        levels = spark.createDataFrame([], "column string, level string, col_pos int, mode_level boolean")
    return EncoderModel(target, num, cat, params, levels, modes)


def minmax_scale(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """(x - min) / (max - min); a constant column maps to 0."""
    stats = df.agg(*[F.min(c).alias(f"_lo_{c}") for c in columns], *[F.max(c).alias(f"_hi_{c}") for c in columns])
    j = attach_scalars(df, stats)
    return j.select(*[F.col(k) for k in keep], *[
        F.coalesce(F.try_divide(F.col(c) - F.col(f"_lo_{c}"), F.when(F.col(f"_hi_{c}") != F.col(f"_lo_{c}"),
                                                                    F.col(f"_hi_{c}") - F.col(f"_lo_{c}"))),
                   F.lit(0.0)).alias(c) for c in columns])


def model_ready_summary(model: EncoderModel, source: DataFrame, target_col: Column | None = None) -> DataFrame:
    """P10: rows, width, positive rate and the column roles as one row."""
    width = 1 + len(model.numeric) + (model.levels.count() if model.categorical else 0)
    y = F.col(model.target).cast("double") if target_col is None else target_col
    return source.agg(F.count(F.lit(1)).alias("model_ready_rows"), F.round(F.avg(y), 6).alias("positive_class_rate")
                      ).select("model_ready_rows", F.lit(width).cast("bigint").alias("model_ready_columns"),
                               "positive_class_rate",
                               F.lit(",".join(model.numeric)).alias("numeric_columns"),
                               F.lit(",".join(model.categorical)).alias("categorical_columns"))

