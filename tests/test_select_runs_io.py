"""Feature scores (FS1, FS2), run history (M22, J6, M23), lookup file (IO3), sinks (IO8)."""

import math
import os

import numpy as np

from tabmine.operators.runs import merge_runs, pick_runs, run_history
from tabmine.operators.select import chi_square, feature_class_cells, mutual_information
from tabmine.sources import json_safe, read_lookup_file


def test_chi_square_and_mi(spark):
    X = np.array([[1.0, 0.0, 2.0], [0.0, 0.0, 4.0], [1.0, 1.0, 2.0], [0.0, 1.0, 8.0], [1.0, 0.0, 2.0]])
    y = np.array([1, 0, 1, 0, 0])
    long = [(i, int(y[i]), f"f{j}", float(X[i, j])) for i in range(5) for j in range(3) if X[i, j] != 0]
    df = spark.createDataFrame(long, "row_id long, label int, feature string, value double")
    cells = feature_class_cells(df, "label", bins=10)
    chi = {r["feature"]: r["score"] for r in chi_square(cells).collect()}
    mi = {r["feature"]: r["score"] for r in mutual_information(cells).collect()}
    lo, hi = X.min(0), X.max(0)
    S = (X - lo) / np.where(hi > lo, hi - lo, 1)
    for j in range(3):
        obs = np.array([S[y == c, j].sum() for c in (0, 1)])
        exp = np.array([(y == c).mean() for c in (0, 1)]) * S[:, j].sum()
        assert math.isclose(chi[f"f{j}"], float(((obs - exp) ** 2 / exp).sum()), rel_tol=1e-9)
        bins = np.minimum(np.floor(np.round(S[:, j] * 10, 9)), 9)
        m = 0.0
        for b in set(bins):
            for c in (0, 1):
                n_bc = np.sum((bins == b) & (y == c))
                if n_bc:
                    m += n_bc / 5 * math.log(n_bc * 5 / (np.sum(bins == b) * np.sum(y == c)))
        assert math.isclose(mi[f"f{j}"], m, rel_tol=1e-9, abs_tol=1e-12)


def test_run_history(spark):
    rows = [("LR", "s1", i, float(i)) for i in range(3)] + [("LR", f"s{k}", 10 + k, 1.0) for k in range(2, 16)] + \
           [("RF", "s1", 5, 0.5)]
    df = spark.createDataFrame(rows, "algorithm string, signature string, ts long, value double")
    h = run_history(df, ts="ts", keep=12).collect()
    lr = sorted([r for r in h if r["algorithm"] == "LR"], key=lambda r: r["rank"])
    assert len(lr) == 12 and lr[0]["signature"] == "s15"
    assert all(r["signature"] != "s1" for r in lr)                  # s1 (ts 2) is older than 12 others
    live = df.where("algorithm = 'RF'").select("algorithm", "signature", "value")
    ref = spark.createDataFrame([("RF", "s1", 9.0), ("RF", "s2", 0.7)], "algorithm string, signature string, value double")
    merged = merge_runs(live, ref).collect()
    assert sorted((r["signature"], r["value"]) for r in merged) == [("s1", 0.5), ("s2", 0.7)]
    want = spark.createDataFrame([("RF", "s1")], "algorithm string, signature string")
    assert pick_runs(merge_runs(live, ref), "value", want).first()["signature"] == "s1"
    assert pick_runs(merge_runs(live, ref), "value").first()["signature"] == "s2"


def test_lookup_file(spark):
    path = os.path.join(os.path.dirname(__file__), "fixtures", "codes.txt")
    d = read_lookup_file(spark, path, ["kind_a", "kind_b", "kind_c"])
    got = {(r["domain"], r["id"]): r["label"] for r in d.collect()}
    assert got[("kind_a", "3")] == "NULL"
    assert got[("kind_b", "2")] == "Two again"                     # repeated id keeps the last line
    assert got[("kind_b", "5")] == "Five with spaces"
    assert got[("kind_c", "7")] == "Seven" and got[("kind_c", "8")] == "Eight"
    assert sum(1 for k in got if k[0] == "kind_b") == 5            # 'x' skipped
    assert len([k for k in got if k[0] == "kind_a"]) == 3


def test_json_safe(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("inf"), -float("inf"))], "a double, b double")
    rows = json_safe(df).collect()
    assert rows[0]["a"] is None and rows[0]["b"] == 1.0 and rows[1]["a"] is None and rows[1]["b"] is None
