"""Stacked k-means against Spark ML's, Ward's rounds against the greedy method."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.operators import lloyd, ward
from tabmine.operators.silhouette import silhouettes


def frame(spark, points):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "row_id bigint, x double, y double")


def blobs(n, k, seed):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(k, 2)) * 4
    own = rng.integers(0, k, n)
    return c[own] + rng.normal(size=(n, 2)) * rng.uniform(0.2, 1.0, (k, 1))[own]


def cost(points, c):
    return ((points[:, None] - c[None]) ** 2).sum(-1).min(1).sum()


def greedy_ward(points, ks):
    """Nearest pair again and again on a full matrix."""
    c, w = points.copy(), np.ones(len(points))
    d = ((c[:, None] - c[None]) ** 2).sum(-1) / 2
    np.fill_diagonal(d, np.inf)
    near, own = d.argmin(1), np.arange(len(c))
    best, live, out = d.min(1), np.ones(len(c), dtype=bool), {}
    for left in range(len(c), 0, -1):
        if left in ks:
            names = {g: i for i, g in enumerate(dict.fromkeys(own.tolist()))}
            out[left] = [names[g] for g in own.tolist()]
        if left == 1:
            break
        a = int(best.argmin())
        a, b = sorted((a, int(near[a])))
        c[a] = (c[a] * w[a] + c[b] * w[b]) / (w[a] + w[b])
        w[a] += w[b]
        live[b] = False
        own[own == b] = a
        d[b], d[:, b] = np.inf, np.inf
        row = ((c - c[a]) ** 2).sum(1) * w * w[a] / (w + w[a])
        row[~live] = np.inf
        row[a] = np.inf
        d[a], d[:, a] = row, row
        best[b] = np.inf
        stale = live & ((near == a) | (near == b))
        stale[a] = True
        near[stale], best[stale] = d[stale].argmin(1), d[stale].min(1)
        better = live & (row < best)
        near[better], best[better] = a, row[better]
    return out


def test_kmeans_no_worse_than_single_fits_and_any_layout(spark):
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    points = blobs(6000, 7, 2)
    df = frame(spark, points)
    fits = lloyd.kmeans_fits(df.repartition(7), [3, 7], n_init=10)
    again = lloyd.kmeans_fits(df.coalesce(1), [3, 7], n_init=10)
    vec = df.select(array_to_vector(F.array("x", "y")).alias("features")).cache()
    for k, (c, got) in fits.items():
        assert np.array_equal(c, again[k][0]) and len(c) == k
        assert abs(got - cost(points, c)) < 1e-6 * got
        other = min(KMeans(k=k, seed=42 + s).fit(vec).summary.trainingCost for s in range(4))
        assert got <= other * (1 + 1e-6)
    lab = lloyd.nearest_labels(df, {str(k): c for k, (c, _) in fits.items()})
    seven = [r["label"] for r in lab.where("run = '7'").orderBy("row_id").collect()]
    own = ((points[:, None] - fits[7][0][None]) ** 2).sum(-1).argmin(1)
    names = {g: i for i, g in enumerate(dict.fromkeys(own.tolist()))}
    assert seven == [names[g] for g in own.tolist()]


def test_kmeans_jobs_do_not_depend_on_starts(spark, monkeypatch):
    df, steps = frame(spark, blobs(300, 4, 9)), []
    step = lloyd._step
    monkeypatch.setattr(lloyd, "_step", lambda whole, stack: steps.append(len(stack)) or step(whole, stack))
    lloyd.kmeans_fits(df, [2, 3, 4], n_init=12)
    assert len(steps) < 12 and max(steps) <= 36


def test_kmeans_edges(spark):
    same = frame(spark, [(1.0, 2.0)] * 5)
    c, got = lloyd.kmeans_fits(same, [3])[3]
    assert len(c) == 1 and got == 0
    empty = lloyd.kmeans_fits(same.limit(0), [2])
    assert len(empty[2][0]) == 0
    assert lloyd.nearest_labels(same.limit(0), {"2": empty[2][0]}).collect() == []


@pytest.mark.parametrize(("n", "block", "finish"), [(5000, 512, 400), (700, 64, 100)])
def test_ward_equals_the_greedy_method(spark, monkeypatch, n, block, finish):
    monkeypatch.setattr(ward, "BLOCK", block)
    monkeypatch.setattr(ward, "FINISH", finish)
    points = blobs(n, 6, 4)
    ks = [2, 5, 8]
    want = greedy_ward(points, ks)
    got = ward.ward_runs(frame(spark, points).repartition(5), ks)
    rows = {k: [r["label"] for r in got.where(F.col("run") == str(k)).orderBy("row_id").collect()] for k in ks}
    assert rows == want


def test_ward_cuts_inside_the_rounds(spark, monkeypatch):
    """Two far groups of one block each: the highest merges are found in the rounds."""
    monkeypatch.setattr(ward, "BLOCK", 64)
    monkeypatch.setattr(ward, "FINISH", 30)
    points = blobs(160, 3, 11)
    ks = [2, 40, 60]
    got = ward.ward_runs(frame(spark, points), ks)
    rows = {k: [r["label"] for r in got.where(F.col("run") == str(k)).orderBy("row_id").collect()] for k in ks}
    assert rows == greedy_ward(points, ks)


def test_ward_repeated_points_and_edges(spark):
    points = np.array([(0.0, 0.0)] * 4 + [(0.1, 0.0)] * 2 + [(5.0, 5.0), (5.1, 5.0), (9.0, 0.0)])
    df = frame(spark, points)
    got = {k: [r["label"] for r in ward.ward_runs(df, [3, 9]).where(F.col("run") == str(k)).orderBy("row_id").collect()] for k in (3, 9)}
    assert got == {3: [0] * 6 + [1, 1, 2], 9: [0] * 4 + [1] * 2 + [2, 3, 4]}
    assert ward.ward_runs(df.limit(0), [2]).collect() == []


def test_runs_feed_the_silhouette(spark):
    points = blobs(800, 4, 6)
    df = frame(spark, points)
    s = {r["run"]: r["silhouette"] for r in silhouettes(df, ward.ward_runs(df, [2, 4])).collect()}
    assert s.keys() == {"2", "4"} and all(-1 < v < 1 for v in s.values())
