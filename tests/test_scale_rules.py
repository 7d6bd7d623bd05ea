"""Answers do not depend on the partition layout or on a size switch; rows are not
shuffled on keys of a few values; exact tests in constant memory."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tabmine.operators.cluster import _ward_merge, kmeans_labels, micro_clusters, ward_labels
from tabmine.operators.common import broadcast_checked
from tabmine.operators.evaluate import binom_two_sided_p, mcnemar
from tabmine.operators.lookup import label_codes
from tabmine.operators.models import balanced_weights, gaussian_nb
from tabmine.operators.select import feature_class_cells
from tabmine.operators.split import stratified_split


def _points(spark, n, seed=3):
    rnd = random.Random(seed)
    rows = [(i, rnd.gauss(3 * (i % 4), 1.0), rnd.gauss(2 * (i % 3), 1.0)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "row_id long, x double, y double")


def _labels(df):
    return {r["row_id"]: r["label"] for r in df.collect()}


def test_kmeans_does_not_depend_on_the_layout(spark):
    _, df = _points(spark, 600)
    one, eight = (kmeans_labels(df.repartition(p), 7, n_init=2) for p in (1, 8))
    assert _labels(one) == _labels(eight)


@pytest.mark.parametrize("n", [100, 200, 201, 3000])
def test_ward_does_not_depend_on_the_layout(spark, n):
    _, df = _points(spark, n)
    one, eight = (_labels(ward_labels(df.repartition(p), 5)) for p in (1, 8))
    assert one == eight and len(one) == n and set(one.values()) == set(range(5))


def test_ward_is_exact_up_to_the_bound(spark):
    import numpy as np

    rows, df = _points(spark, 120)
    want = _ward_merge(np.array([[x, y] for _, x, y in rows]), np.ones(120), 4)
    got = _labels(ward_labels(df, 4))
    pairs = {(got[i], int(want[i])) for i in range(120)}
    assert len(pairs) == 4


def test_ward_with_a_hot_point_and_with_no_rows(spark):
    rows, _ = _points(spark, 300)
    hot = [(i, 9.0, 9.0) for i in range(1000, 1200)]
    df = spark.createDataFrame(rows + hot, "row_id long, x double, y double")
    assigned, cents = micro_clusters(df)
    assert len(cents) <= 200 and sum(r["w"] for r in cents) == 500
    got = _labels(ward_labels(df, 3))
    assert len({got[i] for i in range(1000, 1200)}) == 1
    assert ward_labels(df.limit(0), 3).collect() == []


def test_binomial_against_exact_integers():
    for n in (1, 2, 7, 63, 64, 129, 130, 500, 1999, 2000):
        for k in range(0, n + 1, max(1, n // 23)):
            m = min(k, n - k)
            want = 1.0 if 2 * m == n else min(1.0, float(Fraction(2 * sum(math.comb(n, i) for i in range(m + 1)), 2**n)))
            if want > 1e-300:
                assert math.isclose(binom_two_sided_p(k, n), want, rel_tol=1e-11)


def test_binomial_of_ten_billion_rows():
    n, k = 10**10, 10**10 // 2 - 100_000
    z = (n / 2 - k - 0.5) / math.sqrt(n / 4)
    assert math.isclose(binom_two_sided_p(k, n), math.erfc(z / math.sqrt(2)), rel_tol=1e-8)


def test_mcnemar_counts_rows_that_both_models_have(spark):
    rows = [(1, "a", 1, 1), (1, "b", 1, 0), (2, "a", 0, 1), (2, "b", 0, 0), (3, "a", 1, 1), (4, "b", 1, 1), (5, "a", 1, 1), (5, "b", 1, 1)]
    df = spark.createDataFrame(rows, "row_id long, model string, label int, prediction int")
    r = mcnemar(df, "a", "b").first()
    assert (r["best_only_correct"], r["competitor_only_correct"], r["discordant_pairs"]) == (1, 1, 2)
    r = mcnemar(df.unionByName(df.where("row_id = 1 AND model = 'b'")), "a", "b").first()
    assert (r["best_only_correct"], r["competitor_only_correct"]) == (2, 1)


def test_rows_without_entries_count(spark):
    long = spark.createDataFrame([(1, 0, "f", 2.0), (2, 1, "f", 1.0)], "row_id long, label int, feature string, value double")
    rows = spark.createDataFrame([(1, 0), (2, 1), (3, 1), (4, 1)], "row_id long, label int")
    cells = feature_class_cells(long, "label", 4, rows).collect()
    assert sum(r["n_bc"] for r in cells) == 4 and {r["N"] for r in cells} == {4}


def test_naive_bayes_variance_of_a_large_mean(spark):
    rnd = random.Random(1)
    rows = [(i, i % 2, "f", 1e8 + rnd.gauss(3.0 * (i % 2), 1.0)) for i in range(200)]
    long = spark.createDataFrame(rows, "row_id long, label int, feature string, value double")
    got = gaussian_nb(long, long, 0.0).where("label = prediction").count()
    assert got > 170


def test_broadcast_is_hinted_by_bytes(spark):
    wide = spark.createDataFrame([(i, "x" * 1000) for i in range(100)], "k long, v string")
    assert broadcast_checked(wide, max_bytes=50_000) is wide
    assert broadcast_checked(wide) is not wide


def test_no_row_exchange_on_keys_of_few_values(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(500).select(F.col("id"), (F.col("id") % 2).cast("string").alias("label"))
        codes = spark.createDataFrame([("0", "zero"), ("1", "one")], "id string, label string")
        for df in (balanced_weights(rows), label_codes(rows.withColumnRenamed("label", "code"), "code", codes)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        plan = stratified_split(rows, "id", "label")._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
