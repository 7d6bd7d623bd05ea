"""Multi-start k-means (K2): all ``k`` and all seeds as one stack of centres.

Starting centres come from a bounded hash sample of the points (k-means++ with several trials, refined on the
sample).  Every Lloyd step over the whole table is then one scan and one aggregate for the whole stack: a
task sums its points per centre and sends one row a centre.  Starts that met are merged, settled ones leave the stack.
Coordinates are summed as whole numbers (2^-30 of the extent), so the result does not depend on how rows are dealt."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: points on which starting centres are sought (a bound of the fit; Lloyd steps and costs take all points)
SAMPLE = 4096
GRID = 1 << 30


def _squares(x: np.ndarray, y: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x[:, None] - c[:, 0]) ** 2 + (y[:, None] - c[:, 1]) ** 2


def starting_centres(points: np.ndarray, k: int, rng: np.random.Generator, steps: int = 100) -> np.ndarray:
    """k-means++ over ``points``, of some trials a centre the best, then Lloyd steps on them."""
    n, trials = len(points), 2 + int(np.log(max(k, 1)))
    c = points[rng.integers(n)][None]
    near = _squares(points[:, 0], points[:, 1], c)[:, 0]
    for _ in range(1, min(k, n)):
        total = near.sum()
        pick = rng.integers(n, size=trials) if total <= 0 else np.searchsorted(np.cumsum(near), rng.random(trials) * total).clip(0, n - 1)
        tried = np.minimum(near[:, None], _squares(points[:, 0], points[:, 1], points[pick]))
        best = int(tried.sum(axis=0).argmin())
        near, c = tried[:, best], np.vstack([c, points[pick[best]]])
    for _ in range(steps):
        own = _squares(points[:, 0], points[:, 1], c).argmin(axis=1)
        m = np.bincount(own, minlength=len(c))
        new = np.stack([np.bincount(own, weights=points[:, j], minlength=len(c)) for j in (0, 1)], 1) / np.maximum(m, 1)[:, None]
        new = np.where(m[:, None] > 0, new, c)
        if np.array_equal(new, c):
            break
        c = new
    return c


def _step(whole: DataFrame, stack: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Points, sums of both coordinates and squares of every centre of the stack."""
    offsets = np.concatenate([[0], np.cumsum([len(c) for c in stack])])
    m = int(offsets[-1])

    def run(batches):
        n, sx, sy, cost = np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m, np.int64), np.zeros(m)
        for pdf in batches:
            for at in range(0, len(pdf), 8192):
                x, y = (pdf[c].to_numpy(np.int64)[at:at + 8192] for c in ("x", "y"))
                fx, fy = x.astype(float), y.astype(float)
                for c, lo in zip(stack, offsets[:-1], strict=True):
                    d = _squares(fx, fy, c)
                    own = d.argmin(axis=1)
                    np.add.at(sx, lo + own, x)
                    np.add.at(sy, lo + own, y)
                    n[lo:lo + len(c)] += np.bincount(own, minlength=len(c))
                    cost[lo:lo + len(c)] += np.bincount(own, weights=d[np.arange(len(own)), own], minlength=len(c))
        yield pd.DataFrame({"c": np.arange(m), "n": n, "sx": sx, "sy": sy, "cost": cost})

    got = whole.mapInPandas(run, "c int, n bigint, sx bigint, sy bigint, cost double").groupBy("c").agg(
        F.sum("n"), F.sum("sx"), F.sum("sy"), F.sum("cost")).collect()              # one row a centre
    out = np.zeros((m, 3), dtype=np.int64), np.zeros(m)
    for r in got:
        out[0][r[0]], out[1][r[0]] = r[1:4], r[4]
    return out[0][:, 0], out[0][:, 1], out[0][:, 2], out[1]


def kmeans_fits(coords: DataFrame, ks: Sequence[int], n_init: int = 10, max_steps: int = 50, seed: int = 42,
                row_id: str = "row_id") -> dict[int, tuple[np.ndarray, float]]:
    """K2: ``k -> (centres, cost)``, for every ``k`` the cheapest of ``n_init`` starts.  The number of jobs is two plus the Lloyd steps of
    the slowest start, whatever the number of starts and of ``k``.  With fewer distinct sampled points than ``k`` there are as many
    centres as points; an empty table gives no centres."""
    pts = coords.where("x IS NOT NULL AND y IS NOT NULL")
    box = pts.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).first()
    if box["x0"] is None:
        return {k: (np.zeros((0, 2)), 0.0) for k in ks}
    extent = max(box["x1"] - box["x0"], box["y1"] - box["y0"]) or 1.0
    whole = pts.select(row_id, *[F.round((F.col(c) - box[f"{c}0"]) / extent * GRID).cast("bigint").alias(c) for c in ("x", "y")])
    sample = whole.orderBy(F.xxhash64(row_id), row_id).limit(SAMPLE).select("x", "y").collect()
    points = np.array([[r["x"], r["y"]] for r in sample], dtype=float)
    points = points[np.lexsort(points.T)]
    distinct = len(np.unique(points, axis=0))
    whole = whole.select("x", "y")
    live = [(k, starting_centres(points, min(k, distinct), np.random.default_rng(seed + 1000 * s + k))) for k in ks for s in range(n_init)]
    done: list[tuple[int, np.ndarray, float]] = []
    for turn in range(max_steps + 1):
        unique = {(k, tuple(map(tuple, c[np.lexsort(c.T)]))): (k, c[np.lexsort(c.T)]) for k, c in live}
        live = [unique[u] for u in sorted(unique)]
        n, sx, sy, cost = _step(whole, [c for _, c in live])
        at, rest = 0, []
        for k, c in live:
            part = slice(at, at + len(c))
            at += len(c)
            m = np.maximum(n[part], 1)
            new = np.where(n[part][:, None] > 0, np.stack([sx[part] / m, sy[part] / m], 1), c)
            if turn == max_steps or np.array_equal(new, c):
                done.append((k, c, float(f"{cost[part].sum():.9g}")))
            else:
                rest.append((k, new))
        live = rest
        if not live:
            break
    out = {}
    for k in ks:
        _, c, cost = min((d for d in done if d[0] == k), key=lambda d: (d[2], d[1].tolist()))
        out[k] = (c / GRID * extent + [box["x0"], box["y0"]], cost / GRID / GRID * extent * extent)
    return out


def nearest_labels(coords: DataFrame, fits: dict[str, np.ndarray], row_id: str = "row_id") -> DataFrame:
    """``(row_id, run, label)``: for every run the number of the nearest of its centres (ties: the first), clusters
    numbered by their smallest row id."""
    names = list(fits)
    pts = coords.where("x IS NOT NULL AND y IS NOT NULL").select(row_id, "x", "y")

    @F.pandas_udf("array<int>")
    def near(x: pd.Series, y: pd.Series) -> pd.Series:
        got = [[] for _ in names]
        for at in range(0, len(x), 8192):
            fx, fy = x.to_numpy()[at:at + 8192], y.to_numpy()[at:at + 8192]
            for r, name in enumerate(names):
                got[r].append(_squares(fx, fy, fits[name]).argmin(axis=1).astype(np.int32))
        return pd.Series(list(np.stack([np.concatenate(g) if g else np.zeros(0, np.int32) for g in got], 1)))

    if not len(names) or not all(len(c) for c in fits.values()):
        return pts.select(row_id, F.lit("").alias("run"), F.lit(0).alias("label")).limit(0)
    long = pts.select(row_id, F.posexplode(near("x", "y")).alias("_r", "_l"))
    return numbered_by_first(long.select(row_id, F.array(*map(F.lit, names))[F.col("_r")].alias("run"), F.col("_l").alias("label")), row_id)


def numbered_by_first(labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Labels of every run renumbered 0, 1, ... by the cluster's smallest row id (a bounded number of clusters: the table is a literal)."""
    firsts: dict[str, list] = {}
    for r in labels.groupBy("run", "label").agg(F.min(row_id).alias("f")).orderBy("run", "f").collect():
        firsts.setdefault(r["run"], []).append(r["label"])
    pairs = [x for run, ls in firsts.items() for i, v in enumerate(ls) for x in (F.lit(f"{run}\x00{v}"), F.lit(i))]
    if not pairs:
        return labels.select(row_id, "run", F.col("label").cast("int").alias("label"))
    new = F.create_map(*pairs)[F.concat_ws("\x00", "run", F.col("label").cast("string"))]
    return labels.select(row_id, "run", new.alias("label"))
