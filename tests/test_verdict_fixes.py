"""Cases that used to give wrong or unstable answers."""

from itertools import combinations

from pyspark.sql import functions as F

from tabmine.functions import derive
from tabmine.operators.audit import deletion_stats, tag_deletions
from tabmine.operators.clean import first_per_key
from tabmine.operators.cluster import best_runs
from tabmine.operators.lab import best_per_algorithm
from tabmine.operators.rules import frequent_itemsets
from tabmine.operators.split import stratified_sample


def test_long_itemsets_of_many_items(spark):
    names = [f"i{k:02d}" for k in range(60)]
    big = names[7:15] + ["i57", "i59"]
    rows = [(sorted(big),)] * 6 + [([n],) for n in names] * 5
    tx = spark.createDataFrame(rows, "items array<string>")
    got = {tuple(r["items"]): r["count"] for r in frequent_itemsets(tx, min_support=5 / len(rows), max_length=10).collect()}
    want = {c: 6 for k in range(2, 11) for c in combinations(sorted(big), k)} | {(n,): 5 + 6 * (n in big) for n in names}
    assert got == want


def test_audit_keeps_the_rows_that_cleaning_keeps(spark):
    df = spark.createDataFrame([(1, 5, "b", 0, "x"), (1, 5, "a", 0, "x"), (1, None, "c", 0, "x"), (2, None, "d", 0, "x"), (2, None, "e", 0, "x")],
                               "k int, o int, v string, t int, i string")
    tagged = tag_deletions(df, "k", "o", "t", [9], None, "i", "bad")
    kept = sorted(r.v for r in tagged.where("NOT _dup").collect())
    assert kept == sorted(r.v for r in first_per_key(df, "k", "o").collect()) == ["a", "d"]
    assert deletion_stats is not None


def test_text_that_only_begins_as_a_number(spark):
    df = spark.createDataFrame([("5d",), ("5",), (" 5.0 ",), ("nan",), ("-1",)], "c string")
    got = df.select(derive.stay_bucket("c"), derive.visit_bucket("c"), derive.normalized_id("c")).collect()
    assert [tuple(r) for r in got] == [("unknown", "unknown", None), ("4-6", "2+", "5"), ("4-6", "2+", "5"),
                                       ("unknown", "unknown", None), ("1-3", "0", "-1")]
    nums = spark.createDataFrame([(5.0, 3), (1.5e10, 0)], "d double, i int")
    got = nums.select(derive.stay_bucket("d"), derive.normalized_id("d"), derive.visit_bucket("i")).collect()
    assert [tuple(r) for r in got] == [("4-6", "5", "2+"), ("7+", "15000000000", "0")]


def test_sample_counts_rows_without_a_label(spark):
    df = spark.range(200).select("id", F.when(F.col("id") % 2 == 0, "a").alias("y"))
    got = stratified_sample(df, "id", "y", 100)
    assert got.count() == 100 and got.where("y IS NULL").count() == 50


def test_ties_do_not_depend_on_row_order(spark):
    rows = [("alg", "m2", 0.5), ("alg", "m1", 0.5), ("alg", "m0", 0.1)]
    runs = [("dbscan", "eps=0.65", None, 2, 1), ("dbscan", "eps=0.45", None, 2, 1), ("kmeans", "k=2", None, 2, 0), ("kmeans", "k=3", 0.1, 3, 0)]
    for turn in (1, -1):
        m = spark.createDataFrame(rows[::turn], "algorithm string, model string, roc_auc double")
        assert best_per_algorithm(m).first().best_model == "m1"
        o = spark.createDataFrame(runs[::turn], "method string, run string, silhouette_sq double, cluster_count int, noise_count int")
        assert {r.method: r.run for r in best_runs(o).collect()} == {"dbscan": "eps=0.45", "kmeans": "k=3"}
