"""Report sinks (IO5-IO7): sections written as JSON and read back."""

import tempfile

from tabmine.plans.queries import QUERIES
from tabmine.plans.reports import read_section, write_reports
from tabmine.sources import read_model_ready, write_table

SF = "/root/testdata/sf0.001"


def test_reports_roundtrip(spark):
    out = tempfile.mkdtemp(prefix="tabmine-reports-")
    written = write_reports(spark, SF, out, ["cleaning", "rules"])
    assert len(written["cleaning"]) == 7
    stats = read_section(spark, out, "cleaning", "deletion_stats").first()
    direct = QUERIES["deletion_stats"](spark, SF).first()
    assert stats["original_rows"] == direct["original_rows"] and stats["kept_rows"] == direct["kept_rows"]
    assert read_section(spark, out, "rules", "rules_report").count() == QUERIES["rules_report"](spark, SF).count()


def test_model_ready_table(spark):
    path = tempfile.mkdtemp(prefix="tabmine-mr-") + "/model_ready"
    df = QUERIES["model_ready"](spark, SF)
    write_table(df, path)
    back = read_model_ready(spark, path)
    assert back.count() == df.count()
    import pytest

    with pytest.raises(FileNotFoundError):
        read_model_ready(spark, path + "_missing")
