"""Clustering (K1-K10) on 2-D projections.

* K1 PCA: centre, project on two components, fix signs;
* K2 k-means: ``lloyd``, all seeds and all ``k`` as one stack of centres;
* K3 Ward: ``m`` weighted micro-clusters on Spark, Ward merging of
  those ``m`` centroids (a bounded table), labels attached as literals; with at
  most ``m`` distinct points each point is its own micro-cluster;
* K4 DBSCAN: exact grid algorithm, cells of side eps/sqrt(2) so a cell holding
  ``min_samples`` points is all core; neighbour counts and core links come from
  an equi-join on neighbouring cell keys filtered by distance; components by
  large-star / small-star rounds on pinned edge tables; a border point takes
  the lowest adjacent cluster; noise is -1; clusters numbered by smallest core id;
* K5 silhouette on squared Euclidean distance, exact in O(n), named differently on purpose (the
  Euclidean one: ``silhouette``);
* K6/K7 per-run summaries and best runs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.operators.common import prefix_sums, shuffled
from tabmine.session import cut_lineage

SEED = 42
#: edges up to which the planner may broadcast the tables of a round (half a MB each)
SMALL_GRAPH = 20_000


def pca_2d(df: DataFrame, features: str = "features", row_id: str = "row_id",
           standardize: bool = False) -> tuple[DataFrame, list[float]]:
    """K1: ``(row_id, x, y)`` and the explained variance ratios of the two
    components.  Centred first (Spark's PCA does not centre); with
    ``standardize`` each input dimension is also scaled to unit population
    standard deviation (Spark's scaler divides by the sample std, so the
    projection is multiplied back by sqrt(n / (n - 1))).  Each component's sign
    makes its largest-magnitude loading positive."""
    centred = StandardScaler(inputCol=features, outputCol="_c", withMean=True, withStd=standardize).fit(df).transform(df)
    model = PCA(k=2, inputCol="_c", outputCol="_p").fit(centred)
    pc = model.pc.toArray()
    n = df.count() if standardize else 2
    fix = math.sqrt(n / (n - 1)) if standardize and n > 1 else 1.0
    signs = [fix * (1.0 if pc[np.argmax(np.abs(pc[:, j])), j] >= 0 else -1.0) for j in range(2)]
    out = model.transform(centred).select(row_id, vector_to_array("_p").alias("_a"))
    coords = out.select(row_id, (F.col("_a")[0] * signs[0]).alias("x"), (F.col("_a")[1] * signs[1]).alias("y"))
    return coords, [float(v) for v in model.explainedVariance.toArray()]


def _vec(coords: DataFrame) -> DataFrame:
    return coords.withColumn("features", array_to_vector(F.array("x", "y")))


def renumber(labels: DataFrame, row_id: str = "row_id", label: str = "label", by_label: bool = False,
             bounded: bool = False) -> DataFrame:
    """Number clusters 0..k-1 by their smallest row id (or, with ``by_label``,
    by the label value itself); -1 (noise) stays.  With ``bounded`` (k-means,
    Ward: exactly k clusters, a parameter) the k-row cluster table
    is attached as literals; otherwise (DBSCAN: the cluster count grows with the data) the
    ordinal comes from a distributed running count."""
    members = labels.where(F.col(label) >= 0)
    firsts = (members.select(label).distinct().withColumn("_first", F.col(label)) if by_label
              else members.groupBy(label).agg(F.min(row_id).alias("_first")))
    if bounded:                                         # at most k rows: literals, no shuffle on the label
        ids = [r[label] for r in firsts.orderBy("_first").collect()]
        new = F.coalesce(*[F.when(F.col(label) == v, F.lit(i)) for i, v in enumerate(ids)], F.col(label))
        return labels.select(row_id, new.cast("int").alias(label))
    order = prefix_sums(firsts.withColumn("_one", F.lit(1)), ["_first"], ["_one"]).select(
        label, (F.col("cum__one") - 1).alias("_new"))
    return (labels.join(shuffled(order), label, "left")
            .select(row_id, F.coalesce(F.col("_new"), F.col(label)).cast("int").alias(label)))


def kmeans_labels(coords: DataFrame, k: int, n_init: int = 10, row_id: str = "row_id") -> DataFrame:
    """K2: best of ``n_init`` starts by cost (all starts are one stack of centres, see ``lloyd``)."""
    from tabmine.operators.lloyd import kmeans_fits, nearest_labels

    centres = kmeans_fits(coords, [k], n_init, row_id=row_id)[k][0]
    return nearest_labels(coords, {str(k): centres}, row_id).select(row_id, "label")


def _ward_merge(cent: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Ward agglomeration of weighted centroids down to ``k`` groups: merge the
    pair with the smallest increase w_a w_b / (w_a + w_b) |c_a - c_b|^2 (ties:
    lowest index pair).  Returns the group of each centroid.  Bounded input
    (``m`` centroids); a numpy cost matrix with one row updated per merge."""
    m = len(cent)
    c = np.asarray(cent, dtype=float).copy()
    ww = np.asarray(w, dtype=float).copy()
    active = np.ones(m, dtype=bool)
    owner = np.arange(m)

    def costs(i):
        d = np.sum((c - c[i]) ** 2, axis=1)
        return ww * ww[i] / (ww + ww[i]) * d

    cost = np.full((m, m), np.inf)
    for i in range(m):
        row = costs(i)
        cost[i, i + 1:] = row[i + 1:]
    n_groups = m
    while n_groups > k:
        a, b = divmod(int(np.argmin(cost)), m)
        c[a] = (ww[a] * c[a] + ww[b] * c[b]) / (ww[a] + ww[b])
        ww[a] += ww[b]
        active[b] = False
        owner[owner == b] = a
        cost[b, :] = np.inf
        cost[:, b] = np.inf
        row = costs(a)
        row[~active] = np.inf
        cost[a, a + 1:] = row[a + 1:]
        cost[:a, a] = row[:a]
        n_groups -= 1
    roots = sorted(set(owner.tolist()))
    index = {r: g for g, r in enumerate(roots)}
    return np.array([index[o] for o in owner], dtype=int)


def _nearest(coords: DataFrame, centres: np.ndarray, row_id: str) -> DataFrame:
    """``(row_id, x, y, _m)``: index of the nearest centre (ties: the first)."""
    @F.pandas_udf("int")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        out = [np.empty(0, dtype=np.int32)]
        for at in range(0, len(x), 4096):
            dx = x.to_numpy()[at:at + 4096, None] - centres[:, 0]
            dy = y.to_numpy()[at:at + 4096, None] - centres[:, 1]
            out.append((dx * dx + dy * dy).argmin(axis=1).astype(np.int32))
        return pd.Series(np.concatenate(out))

    return coords.select(row_id, "x", "y", near("x", "y").alias("_m"))


def micro_clusters(coords: DataFrame, micro: int = 200, iterations: int = 5,
                   row_id: str = "row_id") -> tuple[DataFrame, list]:
    """``(row_id, _m)`` (pinned) and the rows ``(_m, x, y, w)`` of at most ``micro``
    micro-clusters: Lloyd steps from the ``micro`` distinct points whose row ids
    hash lowest.  One method at every size: with at most ``micro`` distinct points
    every point is a centre and stays one.  Only the centres reach the driver."""
    starts = (coords.groupBy("x", "y").agg(F.min(F.struct(F.xxhash64(row_id).alias("h"), F.col(row_id).alias("i"))).alias("_h"))
              .orderBy("_h").limit(micro).collect())
    centres = np.array([[r["x"], r["y"]] for r in starts], dtype=float).reshape(-1, 2)
    if not len(centres):
        return coords.select(row_id, F.lit(0).alias("_m")), []

    def means(assigned):
        return assigned.groupBy("_m").agg(F.avg("x").alias("x"), F.avg("y").alias("y"),
                                          F.count(F.lit(1)).alias("w")).orderBy("_m").collect()

    for _ in range(iterations):
        for r in means(_nearest(coords, centres, row_id)):
            centres[r["_m"]] = r["x"], r["y"]
    assigned = cut_lineage(_nearest(coords, centres, row_id))
    return assigned.select(row_id, "_m"), means(assigned)


def ward_labels(coords: DataFrame, k: int, micro: int = 200, row_id: str = "row_id",
                fitted: tuple[DataFrame, list] | None = None) -> DataFrame:
    """K3: Ward over at most ``micro`` weighted micro-clusters (``fitted``: those of
    ``micro_clusters``, to cut one fit at several ``k``)."""
    assigned, rows = fitted or micro_clusters(coords, micro, row_id=row_id)
    if not rows:
        return assigned.select(row_id, F.lit(0).alias("label"))
    grp = _ward_merge(np.array([[r["x"], r["y"]] for r in rows]), np.array([r["w"] for r in rows]), k)
    group_of = F.create_map(*[F.lit(int(v)) for r, g in zip(rows, grp, strict=True) for v in (r["_m"], g)])
    return renumber(assigned.select(row_id, group_of[F.col("_m")].alias("label")), row_id, bounded=True)


def connected_components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, comp)``: every node labelled with the smallest node id of its
    connected component.  Large-star / small-star rounds (Kiveris et al.,
    2014) on an edge list stored as ``(hi, lo)`` with hi > lo; O(log^2 n)
    rounds instead of one round per unit of graph diameter.  Each round is an
    aggregate (partial ``min`` per node, so a hub does not land whole in one
    task) and a join, and its edges are pinned with ``cut_lineage``.  Stops when
    the edges form stars around component minima (no edge points at a node
    that itself has an outgoing edge)."""
    e = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi <> lo").distinct()
    e = cut_lineage(e)
    side = shuffled if e.count() > SMALL_GRAPH else lambda df: df
    while True:
        # large star: every neighbour above u is re-pointed at m(u) = min(u, neighbours of u)
        sym = e.unionByName(e.select(F.col("lo").alias("hi"), F.col("hi").alias("lo")))
        m = sym.groupBy("hi").agg(F.min("lo").alias("_mn")).select(
            F.col("hi").alias("u"), F.least(F.col("hi"), F.col("_mn")).alias("m"))
        big = (sym.where(F.col("lo") > F.col("hi")).join(side(m), F.col("hi") == F.col("u"))
               .select(F.col("lo").alias("hi"), F.col("m").alias("lo")))
        e = cut_lineage(big.where("hi <> lo").distinct())
        # small star: u and its lower neighbours are re-pointed at the smallest of them
        ms = e.groupBy("hi").agg(F.min("lo").alias("m"))
        j = e.join(side(ms), "hi")
        small = (j.select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(j.select("hi", F.col("m").alias("lo"))))
        e = cut_lineage(small.where("hi <> lo").distinct())
        pointing_at_child = e.join(side(e.select(F.col("hi").alias("lo")).distinct()), "lo", "left_semi")
        if pointing_at_child.limit(1).count() == 0:
            break
    leaf = e.select(F.col("hi").alias("node"), F.col("lo").alias("comp"))
    return (nodes.select("node").join(side(leaf), "node", "left")
            .select("node", F.coalesce("comp", "node").alias("comp")))


_components = connected_components


def _dense_links(p: DataFrame, s: float, eps: float, sub: int = 8) -> DataFrame:
    """Links between neighbouring dense cells (all their points are core), named by the cells' ``rep``.

    Each dense cell is cut into ``sub`` x ``sub`` sub-cells summarised by point
    count and bounding box.  Sub-cell pairs of neighbouring dense
    cells are classified by box distances: a pair whose farthest corners are
    within eps links the two cells outright; a pair whose nearest edges are
    farther than eps cannot link; only the remaining pairs, and only for cell
    pairs without an outright link, compare their points.  The summary join is
    bounded by the number of dense cells, not points."""
    h = s / sub
    d = p.where("dense AND id IS NOT NULL").select(
        "rep", "x", "y", "cx", "cy",
        F.least(F.greatest(F.floor((F.col("x") - F.col("cx") * s) / h), F.lit(0)), F.lit(sub - 1)).alias("sx"),
        F.least(F.greatest(F.floor((F.col("y") - F.col("cy") * s) / h), F.lit(0)), F.lit(sub - 1)).alias("sy"))
    d = cut_lineage(d)
    summ = cut_lineage(d.groupBy("cx", "cy", "sx", "sy").agg(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
        F.min("rep").alias("rep")))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in range(-2, 3) for dy in range(-2, 3) if (dx, dy) > (0, 0)])
    a = summ.select(*[F.col(c).alias(f"a_{c}") for c in summ.columns], F.explode(offsets).alias("o"))
    a = a.select("*", (F.col("a_cx") + F.col("o.dx")).alias("cx"), (F.col("a_cy") + F.col("o.dy")).alias("cy"))
    b = summ.select(*[F.col(c).alias(f"b_{c}") if c not in ("cx", "cy") else F.col(c) for c in summ.columns])
    pairs = a.join(shuffled(b), ["cx", "cy"])
    gap_x = F.greatest(F.col("b_x0") - F.col("a_x1"), F.col("a_x0") - F.col("b_x1"), F.lit(0.0))
    gap_y = F.greatest(F.col("b_y0") - F.col("a_y1"), F.col("a_y0") - F.col("b_y1"), F.lit(0.0))
    far_x = F.greatest(F.abs(F.col("b_x1") - F.col("a_x0")), F.abs(F.col("a_x1") - F.col("b_x0")))
    far_y = F.greatest(F.abs(F.col("b_y1") - F.col("a_y0")), F.abs(F.col("a_y1") - F.col("b_y0")))
    e2 = eps * eps
    pairs = pairs.select("a_cx", "a_cy", "a_sx", "a_sy", "cx", "cy", "b_sx", "b_sy", "a_rep", "b_rep",
                         (far_x ** 2 + far_y ** 2 <= e2).alias("sure"), (gap_x ** 2 + gap_y ** 2 <= e2).alias("maybe"))
    pairs = cut_lineage(pairs.where("maybe"))
    sure = pairs.where("sure").select("a_cx", "a_cy", "cx", "cy", "a_rep", "b_rep") \
        .dropDuplicates(["a_cx", "a_cy", "cx", "cy"])
    open_pairs = pairs.where("NOT sure").join(shuffled(sure.select("a_cx", "a_cy", "cx", "cy")),
                                              ["a_cx", "a_cy", "cx", "cy"], "left_anti")
    pa = d.select(F.col("rep").alias("ia"), F.col("x").alias("xa"), F.col("y").alias("ya"), F.col("cx").alias("a_cx"),
                  F.col("cy").alias("a_cy"), F.col("sx").alias("a_sx"), F.col("sy").alias("a_sy"))
    pb = d.select(F.col("rep").alias("ib"), F.col("x").alias("xb"), F.col("y").alias("yb"), "cx", "cy",
                  F.col("sx").alias("b_sx"), F.col("sy").alias("b_sy"))
    tested = (open_pairs.join(shuffled(pa), ["a_cx", "a_cy", "a_sx", "a_sy"]).join(shuffled(pb), ["cx", "cy", "b_sx", "b_sy"])
              .where((F.col("xa") - F.col("xb")) ** 2 + (F.col("ya") - F.col("yb")) ** 2 <= e2)
              .select(F.col("ia").alias("a"), F.col("ib").alias("b")))
    return sure.select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b")).unionByName(tested)


def dbscan_labels(coords: DataFrame, eps: float, min_samples: int, row_id: str = "row_id") -> DataFrame:
    """K4: exact DBSCAN (a point's count includes itself; distance <= eps).

    Only points of sparse cells (fewer than ``min_samples`` points) probe their
    25 neighbouring cells at point level (at most ``min_samples - 1`` probing
    points per cell, so the pairs grow linearly with the neighbours' sizes).
    Points of a dense cell are core and stand for one node of the graph, the
    cell's smallest id, so the graph grows with the cells, not with the points;
    dense cells are linked to each other by ``_dense_links``."""
    s = eps / math.sqrt(2.0)
    pts = cut_lineage(coords.select(F.col(row_id).alias("id"), "x", "y",
                                    F.floor(F.col("x") / s).alias("cx"), F.floor(F.col("y") / s).alias("cy")))
    cells = pts.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("rep")).withColumn("dense", F.col("n") >= min_samples)
    p = cut_lineage(pts.join(shuffled(cells.select("cx", "cy", "dense", "rep")), ["cx", "cy"]))
    offsets = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                        for dx in range(-2, 3) for dy in range(-2, 3)])
    # sparse-cell points probe the 25 surrounding cells (equi-join on the shifted cell key)
    probe = (p.where(~F.col("dense")).select("id", "x", "y", "cx", "cy", F.explode(offsets).alias("o"))
             .select("id", "x", "y", (F.col("cx") + F.col("o.dx")).alias("ncx"), (F.col("cy") + F.col("o.dy")).alias("ncy")))
    other = p.select(F.col("id").alias("id2"), F.col("x").alias("x2"), F.col("y").alias("y2"),
                     F.col("cx").alias("ncx"), F.col("cy").alias("ncy"))
    d2 = (F.col("x") - F.col("x2")) ** 2 + (F.col("y") - F.col("y2")) ** 2
    near = cut_lineage(probe.join(shuffled(other), ["ncx", "ncy"]).where(d2 <= eps * eps).select("id", "id2"))
    counts = near.groupBy("id").agg(F.count(F.lit(1)).alias("cnt"))
    core = cut_lineage(p.join(shuffled(counts), "id", "left").select(
        "id", (F.col("dense") | (F.coalesce("cnt", F.lit(0)) >= min_samples)).alias("core"),
        F.when(F.col("dense"), F.col("rep")).otherwise(F.col("id")).alias("node")))
    c1 = core.select("id", F.col("core").alias("core1"), F.col("node").alias("node1"))
    c2 = core.select(F.col("id").alias("id2"), F.col("core").alias("core2"), F.col("node").alias("node2"))
    links = near.join(shuffled(c1), "id").join(shuffled(c2), "id2")
    edges = links.where("core1 AND core2 AND node1 <> node2").select(F.col("node1").alias("a"), F.col("node2").alias("b"))
    # rows that share an id belong together
    of = core.where("core")
    twice = of.groupBy("id").agg(F.min("node").alias("a"), F.max("node").alias("_most")).where("a <> _most").select("id", "a")
    edges = edges.unionByName(of.join(twice, "id").select("a", F.col("node").alias("b"))).unionByName(_dense_links(p, s, eps))
    comps = _components(edges, of.select("node").distinct())
    comps = of.select("id", "node").join(shuffled(comps), "node").select("id", "comp")
    border = (links.where("NOT core1 AND core2").join(shuffled(comps.select(F.col("id").alias("id2"), "comp")), "id2")
              .groupBy("id").agg(F.min("comp").alias("comp")))
    labelled = (core.join(shuffled(comps.select("id", F.col("comp").alias("c_core"))), "id", "left")
                .join(shuffled(border.select("id", F.col("comp").alias("c_border"))), "id", "left")
                .select(F.col("id").alias(row_id), F.coalesce("c_core", "c_border", F.lit(-1)).alias("label")))
    return renumber(labelled, row_id, by_label=True)


def silhouette_sq(coords: DataFrame, labels: DataFrame, row_id: str = "row_id") -> float | None:
    """K5: mean silhouette with squared Euclidean distance (exact, O(n)).  With
    noise present and more non-noise rows than clusters, noise is left out;
    fewer than two labels -> None."""
    j = _vec(coords).join(labels, row_id)
    stats = labels.agg(F.countDistinct("label").alias("k"), F.count_if(F.col("label") == -1).alias("noise"),
                       F.count_if(F.col("label") != -1).alias("rest"),
                       F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("k_rest")).first()
    if stats["k"] < 2:
        return None
    if stats["noise"] > 0 and stats["rest"] > stats["k_rest"]:
        j = j.where(F.col("label") != -1)
        if stats["k_rest"] < 2:
            return None
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="label", distanceMeasure="squaredEuclidean")
    return float(ev.evaluate(j.withColumn("label", F.col("label").cast("double"))))


def summarize(labels: DataFrame, y: DataFrame, run: str, row_id: str = "row_id") -> DataFrame:
    """K6: per label size and positive rate for one run."""
    return (labels.join(y, row_id).groupBy("label").agg(F.count(F.lit(1)).alias("size"),
                                                        F.round(F.avg("y"), 6).alias("positive_rate"))
            .select(F.lit(run).alias("run"), "label", "size", "positive_rate"))


def run_overview(labels: DataFrame, silhouette: float | None, run: str, method: str) -> DataFrame:
    """K6: cluster count (noise excluded), noise count and silhouette of a run."""
    return labels.agg(F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("cluster_count"),
                      F.count_if(F.col("label") == -1).alias("noise_count")).select(
        F.lit(method).alias("method"), F.lit(run).alias("run"), "cluster_count", "noise_count",
        F.lit(silhouette).cast("double").alias("silhouette_sq"))


def runs_overview(coords: DataFrame, labels: DataFrame) -> DataFrame:
    """K6 for all runs of ``labels(row_id, method, run, label)``: cluster count (noise excluded), noise count and Euclidean silhouette."""
    from tabmine.operators.silhouette import silhouettes

    key = F.concat_ws("\u0001", "method", "run")
    counts = labels.groupBy("method", "run").agg(F.countDistinct(F.when(F.col("label") != -1, F.col("label"))).alias("cluster_count"),
                                                 F.count_if(F.col("label") == -1).alias("noise_count")).withColumn("_key", key)
    scores = silhouettes(coords, labels.select("row_id", key.alias("run"), "label")).withColumnRenamed("run", "_key")
    return counts.join(scores, "_key", "left").drop("_key")


METHOD_ORDER = ["kmeans", "hierarchical", "dbscan"]


def best_runs(overview: DataFrame, score: str = "silhouette_sq") -> DataFrame:
    """K7: best run per method: max silhouette, then fewer clusters, then less
    noise, then the smallest run name.  A missing silhouette counts as -1 for
    DBSCAN; runs of the other methods without one take no part."""
    overview = overview.where((F.col("method") == "dbscan") | F.col(score).isNotNull())
    key = F.struct(-F.coalesce(score, F.lit(-1.0)), "cluster_count", "noise_count", "run")
    best = overview.groupBy("method").agg(F.min_by(F.struct(*overview.columns), key).alias("_b"))
    return best.select("_b.*")


def best_overall(best: DataFrame, method_order=METHOD_ORDER, score: str = "silhouette_sq") -> DataFrame:
    """K8: the best of the per-method winners by silhouette; on a tie the
    method listed first wins."""
    order = F.create_map(*[x for i, m in enumerate(method_order) for x in (F.lit(m), F.lit(-i))])
    key = F.struct(F.coalesce(score, F.lit(-1.0)), F.coalesce(F.element_at(order, F.col("method")), F.lit(-99)))
    return best.agg(F.max_by(F.struct(*best.columns), key).alias("_b")).select("_b.*")

