"""Euclidean silhouette (K5) without all pairs: a quadtree of the points with power moments.

A silhouette needs, for every point, the sum of its distances to the points of every cluster.

1. Points become cells of a 2^16 x 2^16 grid (Morton order).  Quadtree cells with at most ``T`` distinct
   points are the *blocks*; ``T`` follows from the row count, so the number of blocks is bounded.
2. A block that lies far away (sum of both radii at most ``THETA`` times the distance) enters through its power
   moments, turned once per block into a local expansion.
3. Near blocks send their points.  Inside the task they are cut into quadtree cells down to small *leaves*; the largest cells
   far enough from the leaf that is being summed enter through their moments, the points of the leaves
   that are left are measured one by one.

In the complex plane |x - u| = |D| |1 - u/D| = |D| sum c_j c_k (-u/D)^j conj(-u/D)^k with the binomials c_j of the
square root.  Cut at degree ``ORDER`` the error of a distance is below THETA^(ORDER + 1) / 50 of it (1.3e-7), which
is the bound up to which cells stay closed.  One pass serves all labellings of the same points."""

from __future__ import annotations

from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.operators.common import shuffled
from tabmine.session import cut_lineage

ORDER, THETA = 14, 0.45
#: points of a leaf, of a block at least, and (about) the largest number of blocks
LEAF, BLOCK, BLOCKS = 128, 4096, 2048
#: points of a cell that are measured one by one at any distance: their moments would cost more
FEW = 64
#: grid levels: cells are 2^-16 of the extent
LEVELS = 16
#: clusters of all labellings worked on together (the blocks' moments are sent to every task), and where blocks are few
COLUMNS, MOST_COLUMNS = 32, 96


def _half_binomials(n: int) -> np.ndarray:
    c = np.ones(n + 1)
    for j in range(1, n + 1):
        c[j] = c[j - 1] * (0.5 - (j - 1)) / j
    return c


_C = _half_binomials(ORDER)
#: (j, k) with j <= k; the others are their conjugates
_JK = [(j, k) for j in range(ORDER + 1) for k in range(j, ORDER + 1 - j)]
_J, _K = np.array([p[0] for p in _JK]), np.array([p[1] for p in _JK])
_TWICE = np.where(_J < _K, 2.0, 1.0)
_ALL = [(j, k) for j in range(ORDER + 1) for k in range(ORDER + 1 - j)]
_HALF_OF = {p: i for i, p in enumerate(_JK)}


def _products(first: np.ndarray, z: np.ndarray):
    """``first z^j conj(z)^k`` for the pairs ``_JK``, one after the other."""
    p, q = [first.astype(complex)], [np.ones_like(z)]
    for _ in range(ORDER):
        p.append(p[-1] * z)
        q.append(q[-1] * z.conj())
    for j, k in _JK:
        yield p[j] * q[k]


def _powers(z: np.ndarray) -> np.ndarray:
    """``z^j conj(z)^k`` for the pairs ``_JK``, along a new first axis."""
    return np.stack(list(_products(np.ones(z.shape), z)))


def moments(u: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Power moments (pair, cluster) of points ``u`` (complex, from the cell's centre) with ``mass`` (point, cluster)."""
    p = _powers(u)
    return p.real @ mass + 1j * (p.imag @ mass)


def from_far(d: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Distance sums at points that lie ``d`` (point, cell) from the centres of cells with moments ``m`` (cell, pair, cluster)."""
    m = m * (_C[_J] * _C[_K] * _TWICE * (-1.0) ** (_J + _K))[:, None]
    out = np.zeros((len(d), m.shape[-1]))
    for i, a in enumerate(_products(np.abs(d), 1 / d)):
        out += a.real @ m[:, i].real
        if _J[i] < _K[i]:
            out -= a.imag @ m[:, i].imag
    return out


def local_expansion(d: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Coefficients (pair, cluster) about a centre that lies ``d`` (cell) from the centres of far cells with moments ``m``."""
    full = np.stack([m[:, _HALF_OF[(j, k)]] if j <= k else m[:, _HALF_OF[(k, j)]].conj() for j, k in _ALL], 1)
    w = np.empty((len(d), ORDER + 1), dtype=complex)
    w[:, 0] = 1
    for j in range(1, ORDER + 1):
        w[:, j] = w[:, j - 1] / d
    w *= _C
    out = np.zeros((len(_JK), m.shape[-1]), dtype=complex)
    for i, (a, b) in enumerate(_JK):
        use = [(n, p, q) for n, (p, q) in enumerate(_ALL) if a + b + p + q <= ORDER]
        n = [x[0] for x in use]
        p, q = np.array([x[1] for x in use]), np.array([x[2] for x in use])
        f = np.array([comb(a + x, a) * comb(b + y, b) * (-1.0) ** (x + y) for x, y in zip(p.tolist(), q.tolist(), strict=True)])
        e = w[:, a + p] * w[:, b + q].conj() * f * np.abs(d)[:, None]
        out[i] = np.tensordot(e, full[:, n], axes=([0, 1], [0, 1]))
    return out


def from_local(v: np.ndarray, expansion: np.ndarray) -> np.ndarray:
    """Distance sums at points ``v`` from the centre of a local expansion."""
    p = _powers(v) * _TWICE[:, None]
    return p.real.T @ expansion.real - p.imag.T @ expansion.imag


def leaves(key: np.ndarray, level: int, start: int, stop: int) -> list[tuple[int, int, int, int]]:
    """Quadtree cells ``(level, cell, from, to)`` with at most ``LEAF`` of the sorted Morton keys (or of one grid cell)."""
    out, open_ = [], [(level, start, stop)]
    while open_:
        lv, lo, hi = open_.pop()
        if hi <= lo:
            continue
        cell = int(key[lo]) >> 2 * (LEVELS - lv)
        if hi - lo <= LEAF or lv == LEVELS:
            out.append((lv, cell, lo, hi))
            continue
        step = 2 * (LEVELS - lv - 1)
        cuts = lo + np.searchsorted(key[lo:hi], ((cell << 2) + np.arange(5)) << step)
        open_ += [(lv + 1, int(a), int(b)) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    return out


def _uncross(key: np.ndarray) -> np.ndarray:
    """Every second bit of Morton keys, put together."""
    x = key & 0x5555555555555555
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        x = (x | (x >> shift)) & mask
    return x


def centres(level: np.ndarray, cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centre and radius of quadtree cells of the unit square."""
    side = 0.5 ** level.astype(float)
    return (_uncross(cell) + 0.5) * side + 1j * (_uncross(cell >> 1) + 0.5) * side, side * np.sqrt(0.5)


def _spread_bits(v: Column) -> Column:
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def _mass(cols: np.ndarray, w: np.ndarray, k: int) -> np.ndarray:
    """Weight of every point in every cluster column (points, columns); -1 stands for none."""
    out = np.zeros((len(w), k))
    for r in range(cols.shape[1]):
        ok = np.flatnonzero(cols[:, r] >= 0)
        out[ok, cols[ok, r]] = w[ok]
    return out


def _tree(key: np.ndarray, roots: list[tuple[int, int, int]]) -> dict[str, np.ndarray]:
    """Quadtree cells under the ``roots`` ``(level, from, to)`` of the sorted Morton keys, down to ``LEAF`` keys (or one grid cell):
    their points ``lo:hi``, ``centre``, ``radius``, and their parts ``child:child + parts``."""
    level, lo, hi = (np.array(x, dtype=np.int64) for x in zip(*roots, strict=True))
    done, at = [], 0
    while len(lo):
        split = np.flatnonzero((hi - lo > LEAF) & (level < LEVELS))
        c, r = centres(level, key[lo] >> 2 * (LEVELS - level))
        child, parts = np.zeros(len(lo), np.int64), np.zeros(len(lo), np.int64)
        step = 2 * (LEVELS - level[split] - 1)
        first = (key[lo[split]] >> step >> 2 << 2)[:, None] + np.arange(5)
        cuts = np.stack([np.searchsorted(key, first[:, i] << step) for i in range(5)], 1).clip(lo[split, None], hi[split, None])
        keep = cuts[:, 1:] > cuts[:, :-1]
        parts[split] = keep.sum(axis=1)
        child[split] = at + len(lo) + np.cumsum(parts[split]) - parts[split]
        done.append((lo, hi, c, r, child, parts))
        at += len(lo)
        level, lo, hi = np.repeat(level[split] + 1, parts[split]), cuts[:, :-1][keep], cuts[:, 1:][keep]
    return dict(zip(("lo", "hi", "centre", "radius", "child", "parts"), (np.concatenate(x) for x in zip(*done, strict=True)), strict=True))


def _ranges(lo: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers ``lo, lo + 1, ...``, ``n`` of each, one after the other."""
    return np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())


def distance_sums(target: np.ndarray, blocks: list[dict], far: np.ndarray, mine: tuple, k: int) -> np.ndarray:
    """Sums of distances from the points ``target`` (sorted by key) to all points of every cluster column.

    ``blocks``: near blocks with their points; ``far``: local expansion of all others about ``mine``'s centre;
    ``mine``: ``(key, level, cell, centre)`` of the targets."""
    key, level, _, centre = mine
    total = from_local(target - centre, far)
    blocks = sorted(blocks, key=lambda b: int(b["key"][0]))      # blocks are ranges of keys
    keys, z, mass = (np.concatenate([b[c] for b in blocks]) for c in ("key", "z", "mass"))
    x, y = z.real.copy(), z.imag.copy()
    ends = np.cumsum([len(b["key"]) for b in blocks])
    tree = _tree(keys, [(b["level"], e - len(b["key"]), e) for b, e in zip(blocks, ends.tolist(), strict=True)])
    size, known = tree["hi"] - tree["lo"], {}

    def of(cell: int) -> np.ndarray:
        if cell not in known:
            part = slice(tree["lo"][cell], tree["hi"][cell])
            known[cell] = moments(z[part] - tree["centre"][cell], mass[part])
        return known[cell]

    for lv, cell, lo, hi in leaves(key, level, 0, len(key)):
        c, r = (v[0] for v in centres(np.array([lv]), np.array([cell])))
        t = target[lo:hi]
        shut, near, look = [], [], np.arange(len(blocks))
        while len(look):
            # a cell is far when its radius is at most THETA of the least distance to any point of this leaf; the largest such cells stay shut
            away = tree["radius"][look] <= THETA * (np.abs(tree["centre"][look] - c) - r)
            away &= size[look] > FEW
            whole = ~away & ((tree["parts"][look] == 0) | (size[look] <= FEW))
            shut.append(look[away])
            near.append(look[whole])
            look = look[~away & ~whole]
            look = _ranges(tree["child"][look], tree["parts"][look])
        shut, near = np.concatenate(shut), np.concatenate(near)
        for s in range(0, len(shut), 64):
            at = shut[s:s + 64]
            total[lo:hi] += from_far(t[:, None] - tree["centre"][at], np.stack([of(i) for i in at.tolist()]))
        points = _ranges(tree["lo"][near], size[near])
        for s in range(0, len(points), 4096):
            at = points[s:s + 4096]
            d = (t.real[:, None] - x[at]) ** 2
            d += (t.imag[:, None] - y[at]) ** 2
            total[lo:hi] += np.sqrt(d, out=d) @ mass[at]
    return total


def _values(sums: np.ndarray, cols: np.ndarray, sizes: np.ndarray, groups: list[list[int]]) -> np.ndarray:
    """Silhouette of every point in every labelling (nan: not in it)."""
    out = np.full(cols.shape, np.nan)
    for r, members in enumerate(groups):
        ok = np.flatnonzero(cols[:, r] >= 0)
        if not len(ok) or len(members) < 2:
            continue
        own = cols[ok, r]
        n = sizes[own]
        a = np.maximum(sums[ok, own], 0) / np.maximum(n - 1, 1)
        means = np.maximum(sums[ok][:, members], 0) / sizes[members]
        means[np.arange(len(ok)), np.searchsorted(members, own)] = np.inf
        b = means.min(axis=1)
        top = np.maximum(a, b)
        out[ok, r] = np.where((n > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0.0)
    return out


def silhouettes(coords: DataFrame, labels: DataFrame, row_id: str = "row_id", label: str = "label", run: str = "run") -> DataFrame:
    """K5: ``(run, silhouette)``, the mean Euclidean silhouette of every labelling in ``labels(row_id, run, label)`` of the points
    ``coords(row_id, x, y)``; about 1e-7 from the sum over all pairs.

    Label -1 is noise: where the rows that are no noise outnumber their clusters noise is left out, else it
    is a cluster.  A point alone in its cluster counts 0.  Fewer than two clusters give null.  Rows of
    null coordinates or labels take no part; equal points with equal labels are worked on once, by weight.

    Work is n times the number of clusters; each near block (some 25) gets a copy of a block's points."""
    spark = coords.sparkSession
    lab = labels.where(F.col(label).isNotNull()).select(F.col(row_id).alias("_id"), F.col(run).cast("string").alias("_run"), F.col(label).cast("bigint").alias("_label"))
    pts = coords.where("x IS NOT NULL AND y IS NOT NULL").select(F.col(row_id).alias("_id"), F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))
    rows = cut_lineage(pts.join(shuffled(lab), "_id"))
    runs = {}
    for r in rows.groupBy("_run", "_label").count().orderBy("_run", "_label").collect():   # one row a cluster
        runs.setdefault(r["_run"], {})[r["_label"]] = r["count"]
    names = [r["_run"] for r in lab.select("_run").distinct().orderBy("_run").collect()]
    kept, out = {}, {n: None for n in names}
    for name, sizes in runs.items():
        clusters = {k: n for k, n in sizes.items() if k != -1}
        if sizes.get(-1) and not sum(clusters.values()) > len(clusters):
            clusters = sizes
        if len(clusters) >= 2 and len(sizes) >= 2:
            kept[name] = clusters
    todo = sorted(kept)
    points = max((sum(sizes.values()) for sizes in runs.values()), default=0)
    most = min(max(COLUMNS, COLUMNS * BLOCKS * BLOCK // max(4 * points, 1)), max(COLUMNS, MOST_COLUMNS))
    while todo:                                         # labellings in groups of a bounded number of clusters
        batch, columns = [], 0
        while todo and (not batch or columns + len(kept[todo[0]]) <= most):
            columns += len(kept[todo[0]])
            batch.append(todo.pop(0))
        out.update(_batch(rows, {n: kept[n] for n in batch}))
    return spark.createDataFrame(sorted(out.items()), "run string, silhouette double")


def _batch(rows: DataFrame, runs: dict[str, dict[int, int]]) -> dict[str, float]:
    names, groups, sizes, number = list(runs), [], [], {}
    for name, clusters in runs.items():
        groups.append(list(range(len(sizes), len(sizes) + len(clusters))))
        for k, n in sorted(clusters.items()):
            number[(name, k)] = len(sizes)
            sizes.append(n)
    sizes, k = np.array(sizes, dtype=float), len(sizes)
    column = F.create_map(*[x for (name, lab), c in number.items() for x in (F.lit(f"{name}\x00{lab}"), F.lit(c))])
    mine = rows.where(F.col("_run").isin(names)).withColumn("_c", column[F.concat_ws("\x00", "_run", F.col("_label").cast("string"))])
    wide = mine.groupBy("_id", "x", "y").agg(*[F.coalesce(F.max(F.when(F.col("_run") == n, F.col("_c"))), F.lit(-1)).alias(f"c{i}")
                                              for i, n in enumerate(names)])
    cols = [f"c{i}" for i in range(len(names))]
    pts = cut_lineage(wide.groupBy("x", "y", *cols).agg(F.count(F.lit(1)).alias("w")))
    box = pts.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"), F.count(F.lit(1)).alias("n")).first()
    extent = max(box["x1"] - box["x0"], box["y1"] - box["y0"], 1e-300) * (1 + 1e-9)
    cell = [F.least(F.floor((F.col(c) - box[f"{c}0"]) / extent * (1 << LEVELS)), F.lit((1 << LEVELS) - 1)).cast("bigint") for c in ("x", "y")]
    keyed = pts.select(((F.col("x") - box["x0"]) / extent).alias("x"), ((F.col("y") - box["y0"]) / extent).alias("y"), "w", *cols,
                       _spread_bits(cell[0]).bitwiseOR(F.shiftleft(_spread_bits(cell[1]), 1)).alias("key"))
    limit = max(BLOCK, -(-box["n"] // BLOCKS))
    level, cells = _blocks(keyed, box["n"], limit)
    begin = cells << 2 * (LEVELS - level)
    order = np.argsort(begin)
    level, cells, begin = level[order], cells[order], begin[order]
    centre, radius = centres(level, cells)
    m = len(cells)
    near = [np.flatnonzero(radius + radius[b] > THETA * np.abs(centre - centre[b])) for b in range(m)]

    @F.pandas_udf("int")
    def block_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(begin, key.to_numpy(), side="right") - 1).astype("int32")

    placed = cut_lineage(keyed.withColumn("block", block_of("key")))

    def arrays(pdf: pd.DataFrame) -> tuple:
        pdf = pdf.sort_values("key", kind="stable")
        z = pdf["x"].to_numpy() + 1j * pdf["y"].to_numpy()
        c = pdf[cols].to_numpy(np.int64)
        return pdf["key"].to_numpy(np.int64), z, c, pdf["w"].to_numpy(float)

    def root(pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(pdf["block"].iloc[0])
        _, z, c, w = arrays(pdf)
        return pd.DataFrame({"block": [b], "m": [moments(z - centre[b], _mass(c, w, k)).tobytes()]})

    far_any = any(len(n) < m for n in near)
    roots = np.zeros((m, len(_JK), k), dtype=complex)
    if far_any:                                         # at most some BLOCKS rows of 64 numbers a cluster
        for r in placed.groupBy("block").applyInPandas(root, "block int, m binary").collect():
            roots[r["block"]] = np.frombuffer(r["m"], dtype=complex).reshape(len(_JK), k)

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        b = int(key[0])
        blocks, own = [], None
        for s, part in pdf.groupby("block"):
            keys, z, c, w = arrays(part)
            if s == b:
                own = keys, z, c, w
            blocks.append({"key": keys, "z": z, "mass": _mass(c, w, k), "level": int(level[s]), "centre": centre[s], "radius": radius[s], "number": int(s)})
        keys, z, c, w = own
        away = np.setdiff1d(np.arange(m), near[b])
        far = local_expansion(centre[b] - centre[away], roots[away]) if len(away) else np.zeros((len(_JK), k), dtype=complex)
        sums = distance_sums(z, blocks, far, (keys, int(level[b]), int(cells[b]), centre[b]), k)
        s = _values(sums, c, sizes, groups)
        ok = ~np.isnan(s)
        return pd.DataFrame({"r": np.arange(len(names)), "s": np.nansum(s * w[:, None], axis=0), "n": (ok * w[:, None]).sum(axis=0)})

    targets = F.array(*[F.lit(0)])
    if m > 1:
        lists = pd.Series([n.astype(np.int32) for n in near])

        @F.pandas_udf("array<int>")
        def near_of(block: pd.Series) -> pd.Series:
            return lists.iloc[block.to_numpy()].reset_index(drop=True)

        targets = near_of("block")
    sent = placed.withColumn("target", F.explode(targets))
    got = sent.groupBy("target").applyInPandas(one, "r int, s double, n double").groupBy("r").agg(F.sum("s").alias("s"), F.sum("n").alias("n")).collect()
    return {names[r["r"]]: r["s"] / r["n"] for r in got if r["n"]}


def _blocks(keyed: DataFrame, n: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """``(level, cell)`` of the quadtree cells with at most ``limit`` points whose parent has more (or grid cells)."""
    if n <= limit:
        return np.array([0]), np.array([0])
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("level")
    at = keyed.select("key", levels).select("level", F.expr(f"shiftright(key, 2 * ({LEVELS} - level))").alias("cell"))
    count = cut_lineage(at.groupBy("level", "cell").agg(F.count(F.lit(1)).alias("n")))
    full = count.where((F.col("n") > limit) & (F.col("level") < LEVELS)).select((F.col("level") + 1).alias("level"), F.col("cell").alias("up"))
    found = count.withColumn("up", F.shiftright("cell", 2)).join(full, ["level", "up"], "left_semi")
    got = found.where((F.col("n") <= limit) | (F.col("level") == LEVELS)).select("level", "cell").collect()
    return np.array([r["level"] for r in got], dtype=np.int64), np.array([r["cell"] for r in got], dtype=np.int64)


def silhouette(coords: DataFrame, labels: DataFrame, row_id: str = "row_id", label: str = "label") -> float | None:
    """K5 for one labelling."""
    got = silhouettes(coords, labels.select(row_id, F.col(label).alias("label"), F.lit("one").alias("run")), row_id).collect()
    return got[0]["silhouette"] if got else None
