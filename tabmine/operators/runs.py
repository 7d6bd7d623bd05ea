"""Experiment run history."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def run_history(runs: DataFrame, algorithm: str = "algorithm", signature: str = "signature", ts: str = "ts",
                tiebreak: str | None = None, keep: int = 12) -> DataFrame:
    """Newest run per (algorithm, signature) replaces older ones; the
    ``keep`` newest per algorithm remain, with ``rank`` 1 = newest.

    The dedup is a partial-aggregated ``max_by`` (a hot algorithm collapses on
    the map side); the per-algorithm cut is ``row_number() <= keep``, which
    Spark plans as a group limit applied before the shuffle."""
    order = F.struct(F.col(ts), *([F.col(tiebreak)] if tiebreak else []))
    rest = [c for c in runs.columns if c not in (algorithm, signature)]
    latest = runs.groupBy(algorithm, signature).agg(F.max_by(F.struct(*rest), order).alias("_r")) \
        .select(algorithm, signature, "_r.*")
    w = Window.partitionBy(algorithm).orderBy(F.col(ts).desc(), *([F.col(tiebreak).desc()] if tiebreak else []))
    return latest.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= keep)


def merge_runs(live: DataFrame, reference: DataFrame, keys=("algorithm", "signature")) -> DataFrame:
    """Live runs plus the reference runs whose key is not live."""
    return live.unionByName(reference.join(live.select(*keys), list(keys), "left_anti"), allowMissingColumns=True)


def pick_runs(runs: DataFrame, metric: str, selected: DataFrame | None = None, algorithm: str = "algorithm",
              signature: str = "signature") -> DataFrame:
    """Per algorithm, the run matching the selected signature, else the
    best by ``metric`` (missing = 0), ties by signature.  ``selected``:
    ``(algorithm, signature)`` choices."""
    m = F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
    base = runs.withColumn("_m", m)
    if selected is not None:
        sel = selected.select(algorithm, F.col(signature).alias("_want"))
        base = base.join(sel, algorithm, "left")
        match = F.coalesce(F.col(signature) == F.col("_want"), F.lit(False))
    else:
        match = F.lit(False)
    base = base.withColumn("_match", match.cast("int"))
    best = base.groupBy(algorithm).agg(
        F.max_by(F.struct(*[F.col(c) for c in runs.columns if c != algorithm]),
                 F.struct(F.col("_match"), F.col("_m"), F.col(signature))).alias("_r"))
    return best.select(algorithm, "_r.*")


def rank_runs(history: DataFrame, metric: str, algorithm: str = "algorithm", signature: str = "signature") -> DataFrame:
    """O1: the runs of a history with ``rank``, 1 = best of its algorithm by any ``metric`` (missing = 0, ties by signature).  A
    history holds a bounded number of runs an algorithm."""
    w = Window.partitionBy(algorithm).orderBy(F.coalesce(F.col(metric).cast("double"), F.lit(0.0)).desc(), signature)
    return history.drop("rank").withColumn("rank", F.row_number().over(w))


def pick_by_params(runs: DataFrame, selected: Mapping[str, object], metric: str, params: str = "params", algorithm: str = "algorithm",
                   signature: str = "signature") -> DataFrame:
    """Per algorithm the run whose parameters hold every ``selected`` value (compared as text), else the best by ``metric``
    (missing = 0; of several the best, ties by signature).  ``params``: a map of texts.  ``matched`` says which of the two it is."""
    match = F.lit(True)
    for k, v in selected.items():
        match = match & F.coalesce(F.col(params)[k] == F.lit(str(v)), F.lit(False))
    value = F.coalesce(F.col(metric).cast("double"), F.lit(0.0))
    rest = [c for c in runs.columns if c != algorithm]
    best = runs.withColumn("_match", match).groupBy(algorithm).agg(
        F.max_by(F.struct(*rest, F.col("_match").alias("matched")), F.struct(F.col("_match").cast("int"), value, signature)).alias("_r"))
    return best.select(algorithm, "_r.*")
