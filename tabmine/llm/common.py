"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.session import cut_lineage

#: rows of a two-column table of longs that may be broadcast (about 32 MB in memory)
BROADCAST_ROWS = 500_000


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only when the (pinned, narrow) table is within ``rows``;
    beyond that the same join runs as a shuffle join."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``: the smallest node
    reachable.  Contraction rounds: every node hooks onto its smallest
    neighbour, hooks are flattened by pointer jumping, edges are relabelled to
    the hooks and made distinct.  Each round at least halves the live nodes.
    Parents are pinned before a join, so both join sides are plain exchanges
    that adaptive execution can split when a hub is hot."""
    sym = edges.select("a", "b").where("a <> b")
    live = cut_lineage(sym.unionByName(sym.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = None
    while not live.isEmpty():
        parent = cut_lineage(live.groupBy("a").agg(F.min("b").alias("b"))
                             .select(F.col("a").alias("node"), F.least("a", "b").alias("up")))
        while True:                                     # flatten the hooks
            over = parent.select(F.col("node").alias("up"), F.col("up").alias("top"))
            nxt = cut_lineage(parent.join(over, "up").select("node", F.col("top").alias("up"),
                                                             (F.col("top") != F.col("up")).alias("moved")))
            parent = nxt.select("node", "up")
            if nxt.where("moved").isEmpty():
                break
        if labels is None:
            labels = parent.select("node", F.col("up").alias("comp"))
        else:
            hop = parent.select(F.col("node").alias("comp"), F.col("up").alias("top"))
            labels = cut_lineage(labels.join(hop, "comp", "left")
                                 .select("node", F.coalesce("top", "comp").alias("comp")))
        pa = parent.select(F.col("node").alias("a"), F.col("up").alias("ua"))
        pb = parent.select(F.col("node").alias("b"), F.col("up").alias("ub"))
        half = cut_lineage(live.join(pa, "a").select(F.col("ua").alias("a"), "b").distinct())
        live = cut_lineage(half.join(pb, "b").select("a", F.col("ub").alias("b")).where("a <> b").distinct())
    if labels is None:
        return sym.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    return labels


def tidy(run):
    """A batch function that gives freed memory back to the system when its task ends.  Python workers live on between
    tasks, and several wait side by side; without this each keeps the most it ever needed."""
    def tidied(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):                        # glibc only
            ctypes.CDLL(None).malloc_trim(0)

    return tidied


# ---- vectorised text hashing (numpy, inside tasks) ---------------------------------------------

_M64 = 2**64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, _M64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(1 << 19, 1 << math.ceil(math.log2(max(n, 2))))
        for name, base in (("up", _BASE), ("down", _INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32                                      # A-Z only, as the word rule says
_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of every word ``[^\\x20\\x09-\\x0D]+`` (A-Z lower-cased) of the
    texts laid end to end in ``data`` (UTF-8 bytes), and the text each belongs
    to.  ``starts`` holds each text's first byte; a text's end ends a word."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    data = _FOLD[data]
    word = ~_SEP[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts[starts < n]] = True
    edge[n] = True
    first = word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    b, e = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _powers(n)
    acc = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up, out=acc[1:])
    h = (acc[e + 1] - acc[b]) * down[b]
    h = mix64(h + (e - b).astype(np.uint64))
    return h, np.searchsorted(starts, b, side="right") - 1


def text_chunks(arr, limit: int = 400_000, rows: int = 1 << 30):
    """Split an Arrow string array into runs of at most ``limit`` bytes and ``rows``
    texts (a longer single text is a run of its own): ``(first row, bytes,
    starts)``.  Nulls count as empty texts."""
    arr = arr.cast(pa.large_string()).fill_null("")
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else np.zeros(1, np.int64)
    raw = arr.buffers()[2] if len(arr) else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        j = min(j, i + rows)
        yield i, data[offs[i]:offs[j]], offs[i:j] - offs[i]
        i = j


def text_slices(arr, limit: int = 1_000_000):
    """The texts of an Arrow string array as lists of about ``limit`` bytes; nulls stay ``None``."""
    arr = arr.cast(pa.large_string())
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1] if len(arr) else []
    i = 0
    while i < len(arr):
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, side="right")) - 1)
        yield arr.slice(i, j - i).to_pylist()
        i = j
