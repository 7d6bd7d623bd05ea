"""Full reports (A14, A15, P10, R4, FS5, M19, K11) written section by section.

Each section is a DataFrame computed on the executors and written as JSON lines
under ``<out>/<report>/<section>`` (IO6, with NaN/Inf -> null, IO8); nothing is
assembled on the driver.  ``read_section`` reads one back (IO7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tabmine.plans.queries import QUERIES
from tabmine.sources.sinks import read_report, write_report

REPORTS: dict[str, list[str]] = {
    # cleaning audit (A15): stats, reasons, sample, per-column actions, cleaned head and distributions
    "cleaning": ["deletion_stats", "deletion_reasons", "audit_sample", "column_actions", "cleaned_head",
                 "cleaned_distribution", "clean_nzv"],
    # column profile (A14) with the overview and distributions
    "profile": ["dataset_overview", "column_profile", "value_distribution", "log_scale_hints"],
    # model-ready report (P10)
    "model_ready": ["model_ready_summary", "encoded_groups", "model_ready"],
    # association rules
    "rules": ["itemset_report", "rules_report"],
    # feature selection (FS5, FS7)
    "feature_selection": ["feature_scores", "feature_summary"],
    # evaluation of the rule predictions
    "evaluation": ["prediction_metrics", "confusion_matrix", "roc_curve", "mcnemar_test"],
    # classifiers (M19) and clustering
    "baseline": ["baseline_models", "baseline_significance", "model_coefficients"],
    "clustering": ["pca_projection", "cluster_runs", "dbscan_runs", "cluster_summaries", "cluster_points"],
}


def write_reports(spark: SparkSession, sf_dir: str, out_dir: str, reports: list[str] | None = None) -> dict[str, list[str]]:
    """Compute and write the chosen reports; returns the written section paths."""
    written: dict[str, list[str]] = {}
    for report in reports or list(REPORTS):
        for section in REPORTS[report]:
            path = f"{out_dir.rstrip('/')}/{report}/{section}"
            write_report(QUERIES[section](spark, sf_dir), path)
            written.setdefault(report, []).append(path)
    return written


def read_section(spark: SparkSession, out_dir: str, report: str, section: str) -> DataFrame:
    return read_report(spark, f"{out_dir.rstrip('/')}/{report}/{section}")
