"""Runs by any metric and by parameters; the best run of the lab."""

from tabmine.operators.lab import best_run
from tabmine.operators.runs import pick_by_params, rank_runs

RUNS = "algorithm string, signature string, params map<string,string>, f1 double, roc_auc double"


def runs(spark):
    return spark.createDataFrame([
        ("a", "s1", {"k": "3", "w": "u"}, 0.5, 0.9), ("a", "s2", {"k": "5", "w": "u"}, 0.8, 0.1), ("a", "s3", {"k": "5"}, None, 0.2),
        ("b", "s1", {"k": "7"}, 0.1, None), ("b", "s4", None, 0.1, 0.3), ("c", "s5", {"k": "5", "w": "u"}, 0.2, 0.2),
        ("c", "s6", {"k": "5", "w": "u"}, 0.2, 0.7)], RUNS)


def test_rank_by_any_metric(spark):
    got = {(r["algorithm"], r["signature"]): r["rank"] for r in rank_runs(runs(spark), "f1").collect()}
    assert got == {("a", "s2"): 1, ("a", "s1"): 2, ("a", "s3"): 3, ("b", "s1"): 1, ("b", "s4"): 2, ("c", "s5"): 1, ("c", "s6"): 2}


def test_pick_by_parameter_values(spark):
    def pick(selected, metric="f1"):
        return {r["algorithm"]: (r["signature"], r["matched"]) for r in pick_by_params(runs(spark), selected, metric).collect()}

    assert pick({"k": 5, "w": "u"}) == {"a": ("s2", True), "b": ("s4", False), "c": ("s6", True)}
    assert pick({"k": 5, "w": "u"}, "roc_auc") == {"a": ("s2", True), "b": ("s4", False), "c": ("s6", True)}
    assert pick({"k": 4}, "roc_auc") == {"a": ("s1", False), "b": ("s4", False), "c": ("s6", False)}
    assert pick({}) == {"a": ("s2", True), "b": ("s4", True), "c": ("s6", True)}
    assert pick_by_params(runs(spark).limit(0), {"k": 1}, "f1").collect() == []


def test_best_run_of_all(spark):
    df = runs(spark).withColumnRenamed("signature", "model")
    assert best_run(df).first()["model"] == "s1"
    assert best_run(df.where("roc_auc IS NULL")).first()["model"] == "s1"
