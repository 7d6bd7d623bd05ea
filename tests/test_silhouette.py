"""The quadtree silhouette against the sum over all pairs."""

import numpy as np
import pytest

from tabmine.operators import silhouette as S


def brute(points, labels):
    """Mean silhouette by the definition, all pairs."""
    points, labels = np.asarray(points, dtype=float), np.asarray(labels)
    d = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    names = sorted(set(labels.tolist()))
    if len(names) < 2:
        return None
    means = np.stack([d[:, labels == k].sum(1) for k in names], 1)
    size = np.array([(labels == k).sum() for k in names])
    own = np.searchsorted(names, labels)
    rows = np.arange(len(points))
    a = means[rows, own] / np.maximum(size[own] - 1, 1)
    other = means / size
    other[rows, own] = np.inf
    b = other.min(1)
    top = np.maximum(a, b)
    return float(np.where((size[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1), 0).mean())


def frames(spark, points, runs):
    pts = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(points)], "row_id bigint, x double, y double")
    lab = spark.createDataFrame([(i, r, int(k)) for r, ls in runs.items() for i, k in enumerate(ls)], "row_id bigint, run string, label int")
    return pts, lab


def blobs(n, k, seed, scale=1.0):
    rng = np.random.default_rng(seed)
    c = rng.normal(size=(k, 2)) * 5
    own = rng.integers(0, k, n)
    return (c[own] + rng.normal(size=(n, 2)) * rng.uniform(0.05, 1.5, (k, 1))[own]) * scale, own


def test_expansions_against_direct_sums():
    rng = np.random.default_rng(1)
    u = (rng.uniform(-1, 1, 50) + 1j * rng.uniform(-1, 1, 50)) * 0.1
    mass = np.stack([np.ones(50), rng.integers(0, 2, 50).astype(float)], 1)
    x = 0.1 * np.sqrt(2) / S.THETA * np.exp(1j * np.linspace(0, 6.28, 20))
    want = np.abs(x[:, None] - u) @ mass
    assert np.abs(S.from_far(x[:, None], S.moments(u, mass)[None]) / want - 1).max() < 2e-7
    d = np.array([(0.1 + 0.05) * np.sqrt(2) / S.THETA * np.exp(1j * t) for t in (0.3, 2.0)])
    v = (rng.uniform(-1, 1, 30) + 1j * rng.uniform(-1, 1, 30)) * 0.05
    got = S.from_local(v, S.local_expansion(d, np.stack([S.moments(u, mass)] * 2)))
    want = sum(np.abs(v[:, None] + c - u) @ mass for c in d)
    assert np.abs(got / want - 1).max() < 2e-7


@pytest.mark.parametrize(("block", "leaf"), [(4096, 128), (300, 32)])
def test_five_thousand_points(spark, monkeypatch, block, leaf):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "LEAF", leaf)
    points, own = blobs(5000, 6, 3)
    runs = {"own": own, "half": own % 2, "stripes": (points[:, 0] > 0) + 2 * (points[:, 1] > 1)}
    got = {r["run"]: r["silhouette"] for r in S.silhouettes(*frames(spark, points, runs)).collect()}
    assert got.keys() == runs.keys()
    for r, labels in runs.items():
        assert abs(got[r] - brute(points, labels)) < 1e-6


def test_skewed_and_tiny_scales(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 100)
    monkeypatch.setattr(S, "LEAF", 16)
    rng = np.random.default_rng(8)
    tight = rng.normal(size=(400, 2)) * 1e-7 + 3
    wide = rng.uniform(-1, 1, (300, 2)) * 10
    line = np.stack([np.linspace(-10, 10, 200), np.full(200, 0.5)], 1)
    same = np.tile([[1.0, 1.0]], (300, 1))
    points = np.concatenate([tight, wide, line, same])
    labels = np.repeat([0, 1, 2, 3], [400, 300, 200, 300])
    pts, lab = frames(spark, points, {"a": labels, "b": rng.integers(0, 3, 1200)})
    got = {r["run"]: r["silhouette"] for r in S.silhouettes(pts, lab).collect()}
    assert abs(got["a"] - brute(points, labels)) < 1e-6
    b = np.array([r["label"] for r in lab.where("run = 'b'").orderBy("row_id").collect()])
    assert abs(got["b"] - brute(points, b)) < 1e-6


def test_noise_lone_points_and_single_clusters(spark):
    points, own = blobs(60, 3, 5)
    noisy = np.where(np.arange(60) % 7 == 0, -1, own)
    runs = {"noise": noisy, "one": np.zeros(60), "lone": np.where(np.arange(60) == 4, 9, own), "all noise": np.full(60, -1),
            "noise and one": np.where(np.arange(60) < 5, -1, 0)}
    got = {r["run"]: r["silhouette"] for r in S.silhouettes(*frames(spark, points, runs)).collect()}
    keep = noisy >= 0
    assert abs(got["noise"] - brute(points[keep], noisy[keep])) < 1e-9
    assert abs(got["lone"] - brute(points, runs["lone"])) < 1e-9
    assert got["one"] is None and got["all noise"] is None and got["noise and one"] is None
    few = {"f": np.array([-1, -1, 0, 1])}                                        # noise is a cluster: clusters of one point each
    assert abs(S.silhouettes(*frames(spark, points[:4], few)).first()["silhouette"] - brute(points[:4], few["f"])) < 1e-9
    empty = frames(spark, points[:4], few)
    assert S.silhouettes(empty[0], empty[1].limit(0)).collect() == []
    assert S.silhouette(empty[0].limit(0), empty[1]) is None


def _near_blocks(points):
    """Sixteen blocks of the unit square; the targets are those of one of them."""
    rng = np.random.default_rng(6)
    z = rng.uniform(size=points) + 1j * rng.uniform(size=points)
    x, y = ((v * (1 << S.LEVELS)).astype(np.int64) for v in (z.real, z.imag))
    key = np.zeros(points, np.int64)
    for bit in range(S.LEVELS):
        key |= (x >> bit & 1) << 2 * bit | (y >> bit & 1) << 2 * bit + 1
    order = np.argsort(key)
    key, z, mass = key[order], z[order], np.eye(3)[rng.integers(0, 3, points)]
    blocks = []
    for b in range(16):
        at = np.flatnonzero(key >> 2 * (S.LEVELS - 2) == b)
        c, r = S.centres(np.array([2]), np.array([b]))
        blocks.append({"key": key[at], "z": z[at], "mass": mass[at], "level": 2, "centre": c[0], "radius": r[0], "number": b})
    return blocks, z, mass


def test_near_blocks_are_closed_at_their_largest_cells(monkeypatch):
    """Four times the points: the cells a point meets grow with the depth of the tree, not with its leaves."""
    far, met = S.from_far, {}
    none = np.zeros((len(S._JK), 3), dtype=complex)
    for n in (20_000, 80_000):
        seen = []
        monkeypatch.setattr(S, "from_far", lambda d, m, seen=seen: seen.append(d.size) or far(d, m))
        blocks, z, mass = _near_blocks(n)
        b = blocks[6]
        got = S.distance_sums(b["z"], blocks[::-1], none, (b["key"], 2, 6, b["centre"]), 3)
        met[n] = sum(seen) / len(b["z"])
        want = np.abs(b["z"][:50, None] - z) @ mass
        assert np.abs(got[:50] / want - 1).max() < 1e-6
    assert met[80_000] < 2 * met[20_000] and met[80_000] < 200
