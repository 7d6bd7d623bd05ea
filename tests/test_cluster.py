"""Clustering (K3-K5): DBSCAN against brute force, Ward exactness, silhouette."""

import math
import random

import numpy as np

from tabmine.operators.cluster import _ward_merge, dbscan_labels, silhouette_sq, ward_labels


def _dbscan_brute(pts, eps, ms):
    n = len(pts)
    nb = [[j for j in range(n) if (pts[i][0] - pts[j][0]) ** 2 + (pts[i][1] - pts[j][1]) ** 2 <= eps * eps]
          for i in range(n)]
    core = [len(nb[i]) >= ms for i in range(n)]
    comp = list(range(n))

    def find(a):
        while comp[a] != a:
            comp[a] = comp[comp[a]]
            a = comp[a]
        return a
    for i in range(n):
        if core[i]:
            for j in nb[i]:
                if core[j]:
                    ra, rb = find(i), find(j)
                    comp[max(ra, rb)] = min(ra, rb)
    lab = {}
    for i in range(n):
        if core[i]:
            lab[i] = min(j for j in range(n) if core[j] and find(j) == find(i))
    for i in range(n):
        if not core[i]:
            cands = [lab[j] for j in nb[i] if core[j]]
            lab[i] = min(cands) if cands else -1
    order = sorted({v for v in lab.values() if v >= 0})
    ren = {v: k for k, v in enumerate(order)}
    return [ren.get(lab[i], -1) for i in range(n)]


def test_dbscan_matches_brute_force(spark):
    rnd = random.Random(5)
    pts = [(rnd.gauss(0, 0.3), rnd.gauss(0, 0.3)) for _ in range(60)] + \
          [(rnd.gauss(3, 0.3), rnd.gauss(0, 0.3)) for _ in range(60)] + [(1.5, 5.0)]
    pts.append((pts[0][0] + 0.5, pts[0][1]))              # a point at exactly eps from another
    df = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "row_id long, x double, y double")
    for eps, ms in [(0.5, 5), (0.3, 8), (1.6, 3)]:
        got = {r["row_id"]: r["label"] for r in dbscan_labels(df, eps, ms).collect()}
        exp = _dbscan_brute(pts, eps, ms)
        assert [got[i] for i in range(len(pts))] == exp


def test_dbscan_dense_neighbours(spark):
    rnd = random.Random(11)
    pts = [(rnd.uniform(0, 2), rnd.uniform(0, 2)) for _ in range(400)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "row_id long, x double, y double")
    for eps, ms in [(0.3, 4), (0.12, 3), (0.09, 6)]:
        got = {r["row_id"]: r["label"] for r in dbscan_labels(df, eps, ms).collect()}
        assert [got[i] for i in range(len(pts))] == _dbscan_brute(pts, eps, ms)


def test_ward_exact_small(spark):
    pts = [(0.0, 0.0), (0.1, 0.0), (5.0, 5.0), (5.1, 5.0), (10.0, 0.0)]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "row_id long, x double, y double")
    lab = {r["row_id"]: r["label"] for r in ward_labels(df, 3).collect()}
    assert lab == {0: 0, 1: 0, 2: 1, 3: 1, 4: 2}
    g = _ward_merge(np.array(pts), np.ones(5), 2)
    assert g[0] == g[1] and g[2] == g[3]


def test_silhouette_sq(spark):
    pts = [(0.0, 0.0), (0.0, 1.0), (4.0, 0.0), (4.0, 1.0)]
    labels = [0, 0, 1, 1]
    df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "row_id long, x double, y double")
    lab = spark.createDataFrame(list(enumerate(labels)), "row_id long, label int")
    s = silhouette_sq(df, lab)
    vals = []
    for i, p in enumerate(pts):
        d = lambda q: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2
        a = np.mean([d(q) for j, q in enumerate(pts) if labels[j] == labels[i] and j != i])
        b = np.mean([d(q) for j, q in enumerate(pts) if labels[j] != labels[i]])
        vals.append((b - a) / max(a, b))
    assert math.isclose(s, float(np.mean(vals)), rel_tol=1e-9)
    one = spark.createDataFrame([(i, 0) for i in range(4)], "row_id long, label int")
    assert silhouette_sq(df, one) is None


def test_connected_components_long_chain(spark):
    from tabmine.operators.cluster import connected_components

    n = 300
    order = list(range(n))
    random.Random(2).shuffle(order)                       # a path visiting ids in random order
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (1002, 1001)]
    e = spark.createDataFrame(edges, "a long, b long")
    nodes = spark.createDataFrame([(i,) for i in list(range(n)) + [1000, 1001, 1002, 2000]], "node long")
    got = {r["node"]: r["comp"] for r in connected_components(e, nodes).collect()}
    assert all(got[i] == 0 for i in range(n))
    assert got[1000] == got[1001] == got[1002] == 1000 and got[2000] == 2000


def test_knn_exact(spark):
    from pyspark.ml.linalg import Vectors

    from tabmine.operators.models import knn

    rnd = random.Random(4)
    tr = [(i, int(rnd.random() < 0.4), [rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)]) for i in range(300)]
    te = [(1000 + i, int(rnd.random() < 0.4), [rnd.gauss(0, 1), rnd.gauss(0, 1), rnd.gauss(0, 1)]) for i in range(40)]
    te.append((2000, 1, tr[5][2]))                          # exact duplicate of a train row: distance 0
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("row_id", T.LongType()), T.StructField("label", T.IntegerType()),
                           T.StructField("features", VectorUDT())])
    mk = lambda rows: spark.createDataFrame([(a, b, Vectors.dense(c)) for a, b, c in rows], schema)
    for k, weights in [(7, "uniform"), (21, "distance")]:
        got = {r["row_id"]: r["score"] for r in knn(mk(tr), mk(te), k, weights, pivots=16).collect()}
        for qid, _, q in te:
            ds = sorted((math.dist(q, x), i, y) for i, y, x in tr)[:k]
            if weights == "distance" and ds[0][0] == 0:
                w = [1.0 if d == 0 else 0.0 for d, _, _ in ds]
            else:
                w = [1.0 if weights == "uniform" else 1.0 / d for d, _, _ in ds]
            exp = sum(wi for wi, (_, _, y) in zip(w, ds) if y == 1) / sum(w)
            assert math.isclose(got[qid], exp, rel_tol=1e-9, abs_tol=1e-12)


def test_growing_tables_do_not_go_through_the_driver(spark, monkeypatch):
    from tabmine.operators import cluster
    from tabmine.operators.cluster import connected_components, renumber

    monkeypatch.setattr(cluster, "SMALL_GRAPH", 0)
    nodes = spark.range(40).withColumnRenamed("id", "node")
    edges = nodes.where("node % 10 > 0").selectExpr("node a", "node - 1 b")
    comp = connected_components(edges, nodes)
    labels = renumber(comp.selectExpr("node row_id", "comp label"), by_label=True)
    for df in (comp, labels):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan
    assert "Broadcast" not in comp._jdf.queryExecution().executedPlan().toString()
    assert {r["row_id"]: r["label"] for r in labels.collect()} == {i: i // 10 for i in range(40)}


def test_dbscan_graph_grows_with_cells(spark, monkeypatch):
    """Points of a dense cell are one node: more points in the same cells give no more edges; rows that share an id stay together."""
    from tabmine.operators import cluster

    seen, components = [], cluster._components
    monkeypatch.setattr(cluster, "_components", lambda e, n: seen.append(e.distinct().count()) or components(e, n))
    rnd = random.Random(3)
    for n in (400, 1600):
        pts = [(rnd.uniform(0, 1) + 9 * (i % 2), rnd.uniform(0, 1)) for i in range(n)] + [(5.0, 5.0)]
        df = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(pts)], "row_id long, x double, y double")
        got = [r["label"] for r in dbscan_labels(df, 0.5, 5).orderBy("row_id").collect()]
        assert got == [i % 2 for i in range(n)] + [-1]
    assert max(seen) < 400
    joined = df.unionByName(spark.createDataFrame([(0, 9.5, 0.5)], "row_id long, x double, y double"))
    assert {r["label"] for r in dbscan_labels(joined, 0.5, 5).where("row_id < 1600").collect()} == {0}
