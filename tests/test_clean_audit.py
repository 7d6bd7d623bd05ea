"""Cleaning (F1-F7) and the deletion audit (F8-F12, A10, A11) on a hand-made table."""

from tabmine.operators import audit, clean

ROWS = [
    # encounter_id, patient, discharge, gender, race
    (5, 1, 1, "Male", "A"),
    (2, 1, 1, "Female", None),      # first visit of patient 1
    (7, 2, 11, "Male", "B"),        # first visit terminal -> patient 2 disappears
    (9, 2, 1, "Male", "B"),
    (4, 3, None, "Unknown/Invalid", "C"),
    (8, None, 1, None, None),       # null key pair
    (6, None, 13, "Male", "D"),
    (1, 4, 18, "Female", "E"),
]
SCHEMA = "encounter_id long, patient_nbr long, discharge_disposition_id int, gender string, race string"


def _df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_first_per_key(spark):
    out = clean.first_per_key(_df(spark), "patient_nbr", "encounter_id")
    assert sorted(r["encounter_id"] for r in out.collect()) == [1, 2, 4, 6, 7]


def test_filters_keep_missing(spark):
    df = _df(spark)
    kept = clean.drop_codes(df, "discharge_disposition_id", [11, 13])
    assert 4 in [r["encounter_id"] for r in kept.collect()]              # null code kept
    kept2 = clean.drop_value(df, "gender", "Unknown/Invalid")
    assert 8 in [r["encounter_id"] for r in kept2.collect()]             # null gender kept


def test_clean_order(spark):
    cleaned, nzv = clean.clean_table(_df(spark), "patient_nbr", "encounter_id", "discharge_disposition_id",
                                     [11, 13, 14, 19, 20, 21], "gender", "Unknown/Invalid",
                                     fills={"race": "Unknown", "absent": "x"})
    got = {r["encounter_id"]: r["race"] for r in cleaned.collect()}
    assert got == {2: "Unknown", 1: "E"}     # patient 2 gone entirely, null-key group's first row (6) is terminal
    assert nzv.count() == 0


def test_audit(spark):
    labels = spark.createDataFrame([("11", "Expired"), ("13", "Hospice / home")], "id string, label string")
    t = audit.tag_deletions(_df(spark), "patient_nbr", "encounter_id", "discharge_disposition_id", [11, 13],
                            labels, "gender", "Unknown/Invalid", ["race"], "Invalid gender")
    by = {r["encounter_id"]: (r["_status"], r["_reason"]) for r in t.collect()}
    assert by[5][0] == "deleted" and by[5][1].startswith("Duplicate")
    assert by[9][1].startswith("Duplicate")
    assert by[7] == ("deleted", "Terminal code: Expired")
    assert by[6] == ("deleted", "Terminal code: Hospice / home")
    assert by[8][1].startswith("Duplicate")                             # null keys are equal
    assert by[4] == ("deleted", "Invalid gender")
    assert by[2] == ("modified", "Missing values replaced")
    assert by[1] == ("kept", "")
    s = audit.deletion_stats(t).first().asDict()
    assert s == {"original_rows": 8, "deleted_rows": 6, "deleted_duplicates": 3, "deleted_terminal": 2,
                 "deleted_invalid": 1, "modified_rows": 1, "kept_rows": 2}
    top = audit.top_reasons(t).collect()
    assert top[0]["reason"].startswith("Duplicate") and top[0]["n_rows"] == 3
    sample = audit.audit_sample(t, "encounter_id", hidden=["patient_nbr"], size=4)
    assert [r["encounter_id"] for r in sample.collect()] == [4, 5, 1, 2]


def test_drill_and_search(spark):
    df = _df(spark)
    d = clean.drill_down(df, "discharge_disposition_id", 1, "encounter_id", 2).collect()
    assert [r["encounter_id"] for r in d] == [2, 5] and d[0]["match_count"] == 4
    nulls = clean.drill_down(df, "gender", None, "encounter_id", 10).collect()
    assert [r["encounter_id"] for r in nulls] == [8]
    prof = spark.createDataFrame([("Race",), ("gender",), ("discharge",)], "column string")
    assert [r[0] for r in clean.search_columns(prof, "RAC").collect()] == ["Race"]
    hidden = clean.hide_columns(df, ["race", "gender"], "active")
    assert "race" not in hidden.columns and "active" in hidden.columns
