"""Ward agglomeration (K3) of all points, by reciprocal nearest neighbours in distributed rounds.

Ward's criterion is reducible: two clusters that are each other's nearest may be merged at any time, whatever
else is merged, and the tree of merges is that of the greedy method.  A round cuts the clusters into
quadtree blocks of bounded size.  Inside a block a cluster's nearest neighbour is *certain* when nothing
outside of the block can be nearer: everything there weighs at least the least weight and lies at least the
distance to the block's edge away.  Certain reciprocal pairs are merged until none is left; the next round moves
the grid, so that clusters near an edge come to lie inside.  Rounds go on until a bounded
number of clusters is left, whose merges are found at once.  Every number of clusters is a cut of the one tree."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.operators.common import shuffled
from tabmine.operators.lloyd import numbered_by_first
from tabmine.operators.silhouette import LEVELS, _blocks, _spread_bits, centres
from tabmine.session import cut_lineage

#: clusters of a block (at first), and clusters left when the driver takes over
BLOCK, FINISH = 2048, 4096
_ROW = "id bigint, x double, y double, w double, parent bigint, rep bigint, height double"


def _costs(c: np.ndarray, w: np.ndarray, rows: slice | np.ndarray) -> np.ndarray:
    """Ward distances (rise of the sum of squares) from ``rows`` to all clusters."""
    d = (c[rows, None, 0] - c[None, :, 0]) ** 2 + (c[rows, None, 1] - c[None, :, 1]) ** 2
    return d * (w[rows, None] * w[None, :] / (w[rows, None] + w[None, :]))


def _nearest(c: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    m = len(w)
    near, cost = np.zeros(m, np.int64), np.full(m, np.inf)
    for at in range(0, m, 256):
        d = _costs(c, w, slice(at, at + 256))
        i = np.arange(len(d))
        d[i, at + i] = np.inf
        near[at:at + 256] = d.argmin(axis=1)
        cost[at:at + 256] = d[i, near[at:at + 256]]
    return near, cost


def merge_certain(ids: np.ndarray, c: np.ndarray, w: np.ndarray, box: tuple | None, least: float, stop: int = 1) -> pd.DataFrame:
    """Merges of certain reciprocal nearest neighbours among the clusters of one block.

    ``box``: ``(x0, x1, y0, y1)`` beyond which others lie that weigh at least ``least`` (``None``: there are none).  One row per
    cluster that came in: its ``parent`` (the cluster that took it in, at ``height``; null if it is left), and ``rep``, the cluster
    it is now in; a cluster that is left carries its new centre and weight.  A merged cluster has the smaller id."""
    order = np.argsort(ids)
    ids, c, w = ids[order], c[order].astype(float), w[order].astype(float)
    parent, height = np.full(len(ids), -1), np.full(len(ids), np.nan)
    live = np.arange(len(ids))
    while len(live) > stop:
        near, cost = _nearest(c[live], w[live])
        if box is None:
            sure = np.ones(len(live), dtype=bool)
        else:
            x, y, wl = c[live, 0], c[live, 1], w[live]
            edge = np.minimum.reduce([x - box[0], box[1] - x, y - box[2], box[3] - y]).clip(0)
            sure = cost < edge * edge * (wl * least / (wl + least))
        i = np.arange(len(live))
        a = i[(near[near] == i) & (i < near) & sure & sure[near]]
        if not len(a):
            break
        a = a[np.argsort(cost[a], kind="stable")][:max(len(live) - stop, 0)]
        p, q = live[a], live[near[a]]
        total = w[p] + w[q]
        c[p] = (c[p] * w[p, None] + c[q] * w[q, None]) / total[:, None]
        w[p], parent[q], height[q] = total, p, cost[a]
        live = live[np.isin(live, q, invert=True)]
    rep = np.arange(len(ids))
    for k in range(len(ids)):                           # a parent has the smaller number
        if parent[k] >= 0:
            rep[k] = rep[parent[k]]
    gone = parent >= 0
    return pd.DataFrame({"id": ids, "x": c[:, 0], "y": c[:, 1], "w": w, "parent": pd.array(np.where(gone, ids[parent], 0), dtype="Int64").copy(),
                         "rep": ids[rep], "height": height}).assign(parent=lambda f: f["parent"].mask(gone == False))  # noqa: E712


def _round(live: DataFrame, n: int, limit: int, turn: int) -> DataFrame:
    """One round: every cluster with its parent, its representative and (if left) its new centre and weight."""
    box = live.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.min("w").alias("w")).first()
    extent = max(box["x1"] - box["x0"], box["y1"] - box["y0"]) * (1 + 1e-9) or 1.0
    least, shift = float(box["w"]), (0.0 if turn == 0 else (turn * 0.6180339887498949) % 1.0)
    x0, y0, side = box["x0"] - shift * extent, box["y0"] - shift * extent, extent * (1 if turn == 0 else 2)
    cell = [F.least(F.floor((F.col(c) - o) / side * (1 << LEVELS)), F.lit((1 << LEVELS) - 1)).cast("bigint") for c, o in (("x", x0), ("y", y0))]
    keyed = live.select("id", "x", "y", "w", _spread_bits(cell[0]).bitwiseOR(F.shiftleft(_spread_bits(cell[1]), 1)).alias("key"))
    level, cells = _blocks(keyed, n, limit)
    order = np.argsort(cells << 2 * (LEVELS - level))
    level, cells = level[order], cells[order]
    begin = cells << 2 * (LEVELS - level)
    mid, radius = centres(level, cells)
    half = radius / np.sqrt(0.5) / 2
    alone = len(cells) == 1

    @F.pandas_udf("int")
    def block_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(begin, key.to_numpy(), side="right") - 1).astype("int32")

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["block"].iloc[0])
        cx, cy, h = mid[b].real * side + x0, mid[b].imag * side + y0, half[b] * side
        return merge_certain(pdf["id"].to_numpy(np.int64), pdf[["x", "y"]].to_numpy(), pdf["w"].to_numpy(),
                             None if alone else (cx - h, cx + h, cy - h, cy + h), least)

    return cut_lineage(keyed.withColumn("block", block_of("key")).groupBy("block").applyInPandas(one, _ROW))


def ward_tree(coords: DataFrame, row_id: str = "row_id") -> tuple[list[DataFrame], pd.DataFrame]:
    """The rounds' tables and the merges of the clusters that were left: ``(id, parent, height)``."""
    pts = coords.where("x IS NOT NULL AND y IS NOT NULL")
    # equal points are merged at height 0 before all others
    live = cut_lineage(pts.groupBy(F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
                       .agg(F.min(row_id).cast("bigint").alias("id"), F.count(F.lit(1)).cast("double").alias("w")))
    rounds, limit, turn, n = [], BLOCK, 0, live.count()
    while n > FINISH:
        step = _round(live, n, limit, turn)
        rounds.append(step)
        live = step.where("parent IS NULL").select("id", "x", "y", "w")
        left = live.count()
        if left > 0.9 * n:
            limit *= 2                                  # wide clusters: nearest neighbours are certain in larger blocks only
        n, turn = left, turn + 1
    rest = live.select("id", "x", "y", "w").toPandas()  # at most FINISH rows
    return rounds, merge_certain(rest["id"].to_numpy(np.int64), rest[["x", "y"]].to_numpy(), rest["w"].to_numpy(), None, 1.0)


def ward_runs(coords: DataFrame, ks: Sequence[int], row_id: str = "row_id") -> DataFrame:
    """K3: ``(row_id, run, label)`` of Ward's clusters of all points for every ``k`` (``run`` is ``k`` as text), clusters numbered by
    smallest row id.  Equal to the greedy method wherever no two merges tie.  With fewer distinct points than ``k`` every
    point is a cluster; rows of null coordinates take no part."""
    from tabmine.operators.cluster import connected_components

    rounds, last = ward_tree(coords, row_id)
    pts = coords.where("x IS NOT NULL AND y IS NOT NULL").select(row_id, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    first = pts.groupBy("x", "y").agg(F.min(row_id).cast("bigint").alias("id"))
    member = pts.join(shuffled(first), ["x", "y"]).select(row_id, "id")
    most = max(ks, default=1) - 1
    # the highest merges of all, those of the rounds among them
    tops = [(r["height"], r["id"]) for s in rounds for r in s.where("parent IS NOT NULL").orderBy(F.desc("height"), F.desc("id")).limit(most).collect()]
    in_rounds = {i for _, i in tops}
    tops = sorted(tops + [(r.height, r.id) for r in last.itertuples() if not pd.isna(r.parent)], reverse=True)[:most]
    spark = coords.sparkSession
    out = None
    if not any(i in in_rounds for _, i in tops):        # all cuts lie among the last clusters
        rep = None
        for step in reversed(rounds):                   # the tables shrink from round to round
            own = step.select("id", "rep")
            rep = own if rep is None else own.join(shuffled(rep.select(F.col("id").alias("rep"), F.col("rep").alias("top"))), "rep").select("id", F.col("top").alias("rep"))
        member = cut_lineage(member if rep is None else member.join(shuffled(rep), "id").select(row_id, F.col("rep").alias("id")))
        for k in ks:
            cut = {i for _, i in tops[:k - 1]}
            label = {}
            for r in last.sort_values("id").itertuples():                  # parents first
                label[r.id] = r.id if pd.isna(r.parent) or r.id in cut else label[int(r.parent)]
            table = spark.createDataFrame(list(label.items()) or [(0, 0)], "id bigint, label bigint")
            part = member.join(table, "id").select(row_id, F.lit(str(k)).alias("run"), "label")
            out = part if out is None else out.unionByName(part)
    else:                                               # a cut goes through the rounds' merges: components of all others
        edges = spark.createDataFrame([(r.id, int(r.parent)) for r in last.itertuples() if not pd.isna(r.parent)], "a bigint, b bigint")
        for step in rounds:
            edges = edges.unionByName(step.where("parent IS NOT NULL").select(F.col("id").alias("a"), F.col("parent").alias("b")))
        edges, member = cut_lineage(edges), cut_lineage(member)
        for k in ks:
            kept = edges.where(~F.col("a").isin([i for _, i in tops[:k - 1]])) if k > 1 else edges
            comp = connected_components(kept, member.select(F.col("id").alias("node")).distinct())
            part = member.join(shuffled(comp), F.col("id") == F.col("node")).select(row_id, F.lit(str(k)).alias("run"), F.col("comp").alias("label"))
            out = part if out is None else out.unionByName(part)
    return numbered_by_first(cut_lineage(out), row_id)
