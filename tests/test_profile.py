"""Profiling kernel (A1-A8): NZV identities, ties, all-null columns, exact quantiles."""

import math

from tabmine.operators import profile


def test_nzv_rules(spark):
    rows = [("a", "x", None, 1)] * 90 + [("b", "y", None, 1)] * 5 + [("c", "y", None, 2)] * 5
    df = spark.createDataFrame(rows, "dom string, tie string, empty string, num int")
    out = {r["column"]: r for r in profile.nzv_metrics(df, ["dom", "tie", "empty", "num"]).collect()}
    d = out["dom"]
    assert d["fr"] == 18.0 and d["up"] == 3.0 and d["dominant_p"] == 0.9
    assert math.isclose(d["variance"], 0.09) and not d["is_nzv"] and not d["below_var_thresh"] and not d["drop"]
    t = out["tie"]                                    # 90 x vs 10 y
    assert t["fr"] == 9.0
    e = out["empty"]
    assert e["fr"] is None and e["up"] == 0.0 and e["variance"] == 0.0 and e["dominant_p"] == 1.0 and e["drop"]
    n = out["num"]
    assert n["fr"] == 19.0
    for r in out.values():
        assert r["drop"] == (r["is_nzv"] or r["below_var_thresh"])


def test_nzv_second_count_tie_and_single_value(spark):
    rows = [("a",)] * 50 + [("b",)] * 50
    out = profile.nzv_metrics(spark.createDataFrame(rows, "v string"), ["v"]).first()
    assert out["fr"] == 1.0
    one = profile.nzv_metrics(spark.createDataFrame([("a",)] * 10, "v string"), ["v"]).first()
    assert one["fr"] is None and one["is_nzv"] is False and one["below_var_thresh"] is True
    exempt = profile.nzv_metrics(spark.createDataFrame([(1,)] * 99 + [(2,)], "v int"), ["v"], numeric_exempt=True).first()
    assert exempt["is_numeric"] and exempt["below_var_thresh"] is False and exempt["is_nzv"]


def test_missing_and_numeric(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, None), (3.0, "a"), (10.0, "b"), (None, "c")], "x double, s string")
    mp = {r["column"]: r for r in profile.missing_profile(df).collect()}
    assert mp["x"]["missing_count"] == 1 and mp["x"]["missing_pct"] == 20.0 and mp["s"]["unique_count"] == 3
    ns = profile.numeric_summary(df).first()
    assert ns["median"] == 2.5 and ns["q25"] == 1.75 and ns["q75"] == 4.75 and ns["min"] == 1.0 and ns["max"] == 10.0
    assert ns["std"] == round(math.sqrt(sum((v - 4) ** 2 for v in [1, 2, 3, 10]) / 3), 4)
    ov = profile.overview(spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "a int, b string")).first()
    assert (ov["total_rows"], ov["total_cols"], ov["total_missing_cells"], ov["duplicate_rows"]) == (3, 2, 1, 1)


def test_distribution_order(spark):
    df = spark.createDataFrame([(10, "b"), (9, "a"), (10, "c"), (100, None)], "n int, s string")
    d = {(r["column"], r["label"]): (r["n"], r["ord"]) for r in profile.distribution(df).collect()}
    assert d[("n", "9")] == (1, 1) and d[("n", "10")] == (2, 2) and d[("n", "100")] == (1, 3)
    assert d[("s", "a")][1] == 1 and d[("s", "c")][1] == 3
    hint = {r["column"]: r["use_log"] for r in profile.log_scale_hint(profile.distribution(df)).collect()}
    assert hint == {"n": False, "s": False}


def test_treatment_rules(spark):
    p = spark.createDataFrame([("id", True, 0.0, 100), ("spec", False, 5.0, 20), ("w", False, 90.0, 3),
                               ("k", False, 0.0, 1), ("g", False, 0.0, 3), ("hc", False, 0.0, 40),
                               ("num", True, 1.0, 50), ("cat", False, 2.0, 4), ("n2", True, 0.0, 9),
                               ("y", False, 0.0, 3)],
                              "column string, is_numeric boolean, missing_pct double, unique_count long")
    t = {r["column"]: r["treatment"] for r in profile.treatment(
        p, id_cols=["id"], missing_category_cols=["spec"], target="y").collect()}
    assert t == {"id": "Drop", "spec": "Missing Category", "w": "Drop", "k": "Drop", "g": "One-Hot Encode",
                 "hc": "Target / Frequency Encode", "num": "Median Impute", "cat": "Mode Impute / 'Missing' Category",
                 "n2": "Scale / Standardize", "y": "Binarize (Target)"}


def test_empty_table_profiles(spark):
    df = spark.createDataFrame([], "a int, b string")
    mp = {r["column"]: r for r in profile.missing_profile(df).collect()}
    assert mp["a"]["missing_count"] == 0 and mp["a"]["missing_pct"] is None and mp["b"]["unique_count"] == 0
    nz = {r["column"]: r for r in profile.nzv_metrics(df, ["a", "b"]).collect()}
    assert nz["a"]["drop"] and nz["b"]["fr"] is None
