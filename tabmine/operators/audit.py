"""Deletion audit.

Every raw row is tagged with the first reason that removes it, in the cleaning
order: duplicate key, terminal code (with its dictionary label), invalid value.
The tagged frame is the single source for the stats, the reason counts, the
deleted/kept split and the audit sample."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tabmine.functions.derive import normalized_id
from tabmine.operators.clean import not_in
from tabmine.operators.common import broadcast_checked, lookup_join
from tabmine.session import cut_lineage

# fixed values: texts that readers of the audit match on
DUPLICATE_REASON = "Duplicate key (keeping first only)"
TERMINAL_PREFIX = "Terminal code: "
MODIFIED_REASON = "Missing values replaced"


def tag_deletions(df: DataFrame, key: str, order: str, terminal_col: str, terminal_codes: Sequence,
                  code_labels: DataFrame | None, invalid_col: str, invalid_value,
                  missing_cols: Sequence[str] = (), invalid_reason: str | None = None) -> DataFrame:
    """F8-F10.  Adds ``_dup``, ``_terminal``, ``_invalid``, ``_deletion_reason``,
    ``_modified``, ``_status`` and ``_reason``.

    ``_dup``: a later row of a key (null keys equal).  The first row per key is the
    same smallest row that ``clean.first_per_key`` keeps (order, nulls last, then
    the other columns); it comes from a partial-aggregated ``min`` and is joined
    back on the key with a null-safe equi-join; a hot key is split by AQE's
    skew-join handling.  Rows equal in every column cannot be told apart.
    ``code_labels``: ``(id string, label string)`` dictionary for the reason text."""
    rest = [c for c in df.columns if c not in (key, order)]
    rank = F.struct(F.col(order).isNull().alias("_null"), F.col(order).alias(order), *[F.col(c) for c in rest])
    firsts = df.groupBy(F.col(key).alias("_k")).agg(F.min(rank).alias("_first"))
    tagged = df.join(firsts, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
    dup = ~rank.eqNullSafe(F.col("_first"))
    term = ~not_in(terminal_col, terminal_codes)
    invalid = F.col(invalid_col).eqNullSafe(F.lit(invalid_value))
    tagged = tagged.withColumn("_code_id", normalized_id(terminal_col))
    if code_labels is not None:
        labels = code_labels.select(F.col("id").alias("_code_id"), F.col("label").alias("_code_label"))
        tagged = lookup_join(tagged, broadcast_checked(labels), on="_code_id", how="left")
    else:
        tagged = tagged.withColumn("_code_label", F.lit(None).cast("string"))
    reason = (F.when(dup, F.lit(DUPLICATE_REASON))
              .when(term, F.concat(F.lit(TERMINAL_PREFIX), F.coalesce(F.col("_code_label"), F.lit("Unknown"))))
              .when(invalid, F.lit(invalid_reason or f"Invalid value: {invalid_value}")))
    missing = F.lit(False)
    for c in missing_cols:
        missing = missing | F.col(c).isNull()
    tagged = (tagged.withColumn("_dup", dup).withColumn("_terminal", term).withColumn("_invalid", invalid)
              .withColumn("_deletion_reason", reason)
              .withColumn("_modified", F.col("_deletion_reason").isNull() & missing)
              .drop("_first", "_code_id", "_code_label"))
    return (tagged
            .withColumn("_status", F.when(F.col("_deletion_reason").isNotNull(), "deleted")
                        .when(F.col("_modified"), "modified").otherwise("kept"))
            .withColumn("_reason", F.when(F.col("_deletion_reason").isNotNull(), F.col("_deletion_reason"))
                        .when(F.col("_modified"), F.lit(MODIFIED_REASON)).otherwise(F.lit(""))))


def split_deleted(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(deleted, kept) as two filters of one tagged frame."""
    return (tagged.where(F.col("_deletion_reason").isNotNull()),
            tagged.where(F.col("_deletion_reason").isNull()))


def _stat_columns() -> list[Column]:
    d, t, i = F.col("_dup"), F.col("_terminal"), F.col("_invalid")
    return [
        F.count(F.lit(1)).alias("original_rows"),
        F.count_if(F.col("_deletion_reason").isNotNull()).alias("deleted_rows"),
        F.count_if(d).alias("deleted_duplicates"),
        F.count_if(t & ~d).alias("deleted_terminal"),
        F.count_if(i & ~d & ~t).alias("deleted_invalid"),
        F.count_if(F.col("_modified")).alias("modified_rows"),
        F.count_if(F.col("_deletion_reason").isNull()).alias("kept_rows"),
    ]


def deletion_stats(tagged: DataFrame) -> DataFrame:
    """A10: one row of counts, one aggregation."""
    return tagged.agg(*_stat_columns())


@dataclass
class Audit:
    """One audited table: the tagged rows, pinned, and the counts observed while they were written."""

    tagged: DataFrame
    counts: dict[str, int]

    def stats(self) -> DataFrame:
        """A10, from the observed counts."""
        return self.tagged.sparkSession.createDataFrame([tuple(self.counts.values())], ", ".join(f"{c} bigint" for c in self.counts))

    def reasons(self, n: int = 20) -> DataFrame:
        """A11."""
        return top_reasons(self.tagged, n)

    def sample(self, order: str, hidden: Sequence[str] = (), size: int = 2000) -> DataFrame:
        """F12, with the number of deleted rows known beforehand."""
        return audit_sample(self.tagged, order, hidden, size, deleted_rows=self.counts["deleted_rows"])


def audit_table(df: DataFrame, *tag_args, **tag_kwargs) -> Audit:
    """A15's base: the source is read and tagged once (``tag_deletions``); A10's counts are observed in that same pass."""
    seen = Observation()
    tagged = cut_lineage(tag_deletions(df, *tag_args, **tag_kwargs).observe(seen, *_stat_columns()))
    return Audit(tagged, {k: int(v or 0) for k, v in seen.get.items()})


def top_reasons(tagged: DataFrame, n: int = 20) -> DataFrame:
    """The ``n`` most frequent deletion reasons (ties by reason text)."""
    return (tagged.where(F.col("_deletion_reason").isNotNull())
            .groupBy(F.col("_deletion_reason").alias("reason")).agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), "reason").limit(n))


def audit_sample(tagged: DataFrame, order: str, hidden: Sequence[str] = (), size: int = 2000,
                 deleted_rows: int | None = None) -> DataFrame:
    """first ``size//2`` deleted rows, then kept rows up to ``size`` in all,
    both by ``order``; ``hidden`` and internal columns are left out except the
    status and reason.  ``deleted_rows``: how many there are, if known (else they are counted)."""
    deleted, kept = split_deleted(tagged)
    first = deleted.orderBy(order).limit(size // 2)
    n_first = first.count() if deleted_rows is None else min(size // 2, deleted_rows)
    second = kept.orderBy(order).limit(size - n_first)
    show = [c for c in tagged.columns if not c.startswith("_") and c not in set(hidden)]
    return (first.unionByName(second)
            .select(*show, F.col("_status").alias("status"), F.col("_reason").alias("reason")))


def column_actions(columns: DataFrame, nzv: DataFrame | None, dropped: Sequence[str],
                   status_columns: Sequence[str], modify_reasons: Mapping[str, str],
                   variance_threshold: float = 0.0475) -> DataFrame:
    """KEEP / MODIFY / DROP per column with a reason.  ``columns`` is a frame
    with one ``column`` per row (e.g. from a profile).  Status columns take the
    NZV verdict; the reason prints FR as the infinity symbol when FR is missing or
    above 999999, else with one decimal, and the variance with 5 (drop) or 4
    (keep) decimals."""
    spark = columns.sparkSession
    if nzv is None:
        nzv = spark.createDataFrame([], "column string, fr double, variance double, drop boolean")
    n = nzv.select("column", F.col("fr").alias("_fr"), F.col("variance").alias("_var"),
                   F.col("drop").alias("_nzv_drop"))
    mods = spark.createDataFrame([(k, v) for k, v in modify_reasons.items()] or [("", "")],
                                 "column string, _mod_reason string")
    j = lookup_join(lookup_join(columns.select("column"), n, "column"), mods, "column")
    fr_txt = F.when(F.col("_fr").isNull() | (F.col("_fr") > 999999), F.lit("∞")).otherwise(
        F.format_string("%.1f", F.col("_fr")))
    var = F.coalesce(F.col("_var"), F.lit(0.0))
    is_status = F.col("column").isin(*status_columns) if status_columns else F.lit(False)
    action = (F.when(F.col("column").isin(*dropped) if dropped else F.lit(False), "DROP")
              .when(is_status & F.coalesce(F.col("_nzv_drop"), F.lit(False)), "DROP")
              .when(is_status, "KEEP")
              .when(F.col("_mod_reason").isNotNull(), "MODIFY")
              .otherwise("KEEP"))
    reason = (F.when(F.col("column").isin(*dropped) if dropped else F.lit(False),
                     F.lit("an identifier or mostly missing: no feature"))
              .when(is_status & F.coalesce(F.col("_nzv_drop"), F.lit(False)),
                    F.concat(F.lit("near-constant: frequency ratio "), fr_txt, F.lit(", variance "), F.format_string("%.5f", var),
                             F.lit(f", {variance_threshold} is asked for")))
              .when(is_status, F.concat(F.lit("varies enough: variance "), F.format_string("%.4f", var)))
              .when(F.col("_mod_reason").isNotNull(), F.col("_mod_reason"))
              .otherwise(F.lit("nothing found")))
    return j.select("column", action.alias("action"), reason.alias("reason"))
