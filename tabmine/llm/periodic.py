"""Operator 13: periodic runs of words, by recursive frequency splitting.

A run of period q and at least 4 q words holds each of its words four times or more,
so a word that occurs less often within a segment is in no run of that segment:
it splits the segment, the pieces are counted anew, and so on until no piece
has a rare word.  Ordinary prose falls apart in two or three steps; what survives is scanned
lag by lag.  A run of period q covers four multiples of q, so for lag q only words at
multiples of q are compared (n log n comparisons over all lags); agreeing places are
checked by prefix hashes and then grown word by word in both directions.

Every text is worked through whole inside the task that holds it."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import mix64, text_slices

#: fewest words of a run, and of its length in periods
LEAST_WORDS, LEAST_PERIODS = 6, 4
_BASE = np.uint64(0xD6E8FEB86659FD93 | 1)
#: after so many splits in a row that leave nearly all of a segment, the exact scan takes it as it is
_SLOW = 32


def surviving_segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """``(start, end)`` of the segments in which every word occurs ``LEAST_PERIODS`` times or more."""
    found, open_ = [], [(0, len(codes), 0)]
    while open_:
        lo, hi, slow = open_.pop()
        if hi - lo < LEAST_WORDS:
            continue
        seg = codes[lo:hi]
        if lo == 0 and hi == len(codes):
            often = (np.bincount(seg) >= LEAST_PERIODS)[seg]
        else:
            _, inv, n = np.unique(seg, return_inverse=True, return_counts=True)
            often = (n >= LEAST_PERIODS)[inv]
        if slow >= _SLOW or often.all():
            found.append((lo, hi))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate([[0], often.view(np.int8), [0]])))
        for b, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if e - b >= LEAST_WORDS:
                open_.append((lo + b, lo + e, slow + 1 if 16 * (e - b) > 15 * (hi - lo) else 0))
    return sorted(found)


def _agree(w: np.ndarray, i: int, q: int, step: int) -> int:
    """How many places from ``i`` on (``step`` 1) or before it (-1) hold the same word as the place ``q`` later."""
    total, size = 0, 32
    while True:
        lo, hi = (i + total, min(i + total + size, len(w) - q)) if step > 0 else (max(i - total - size, 0), i - total)
        if hi <= lo:
            return total
        bad = np.flatnonzero(w[lo:hi] != w[lo + q:hi + q])
        if len(bad):
            return total + (int(bad[0]) if step > 0 else hi - lo - 1 - int(bad[-1]))
        total += hi - lo
        size *= 2


def scan(w: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of the word codes ``w``, by rising lag.

    A place inside a known run of a smaller period is passed over: what it starts has that smaller period too."""
    m = len(w)
    power = np.full(m + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    prefix = np.zeros(m + 1, dtype=np.uint64)
    np.cumsum(mix64(w.astype(np.uint64) + np.uint64(1)) * power[:m], out=prefix[1:])
    known = np.zeros(m, dtype=np.int64)                 # end of the longest run known to hold a place
    out = []
    for q in range(1, m // LEAST_PERIODS + 1):
        a = w[::q]
        same = a[1:] == a[:-1]
        at = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * q
        if not len(at):
            continue
        # [at, at + 2q) against [at + q, at + 3q)
        equal = (prefix[at + 2 * q] - prefix[at]) * power[q] == prefix[at + 3 * q] - prefix[at + q]
        for i in at[equal & (known[at] <= at + 3 * q)].tolist():
            if known[i] > i + 3 * q:
                continue
            right = _agree(w, i, q, 1)
            if right < 2 * q:
                continue                                # hashes met, words do not
            start = i - _agree(w, i, q, -1)
            length = i + right + q - start
            if length >= max(LEAST_WORDS, LEAST_PERIODS * q):
                out.append((start, length, q))
                np.maximum(known[start:start + length], start + length, out=known[start:start + length])
        if out and known[0] >= m:
            break                                       # one run holds the whole segment
    return out


def runs_of(words: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of a list of words, by start and period."""
    if len(words) < LEAST_WORDS:
        return []
    number: dict = {}
    codes = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    if len(number) > len(words) - 3:
        return []                                       # no word four times
    return sorted(((lo + s, n, q) for lo, hi in surviving_segments(codes) for s, n, q in scan(codes[lo:hi])),
                  key=lambda r: (r[0], r[2]))


def periodic_runs(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                  order: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """``(id, n_words, runs, collapsed)`` per row of ``docs``: the runs of its whole text as an array of ``(start, length,
    period)`` by start and period, and the words outside of repeats, joined by one space (of each run the first period stays).

    ``order(id, n_words)`` may name the word numbers to read in place of 0, 1, 2, ... (``None``: as they are).  Words are
    ``[^\\x20\\x09-\\x0D]+``.  Null and empty texts have no words, no runs and the empty collapsed text; rows with a null id are
    read as they are.  Repeated rows are returned as often as they occur; other columns are ignored, so their names cannot clash;
    an empty table gives no rows."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def one(doc_id: int | None, text: str | None) -> tuple[int, list[tuple[int, int, int]], str]:
        words = (text or "").encode().split()           # bytes: ASCII white space only
        picked = order(doc_id, len(words)) if order is not None and doc_id is not None and words else None
        if picked is not None:
            words = [words[i] for i in picked.tolist()]
        runs = runs_of(words)
        kept = words
        if runs:
            stay = np.ones(len(words), dtype=bool)
            for start, length, period in runs:
                stay[start + period:start + length] = False
            kept = compress(words, stay.tolist())
        return len(words), runs, b" ".join(kept).decode()

    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            ids, at = batch.column("_id"), 0
            for part in text_slices(batch.column("_text")):
                mine = ids.slice(at, len(part))
                at += len(part)
                got = [one(d, t) for d, t in zip(mine.to_pylist(), part, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [mine, pa.array([g[0] for g in got], pa.int64()),
                     pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in g[1]] for g in got], run_type),
                     pa.array([g[2] for g in got], pa.string())], names=["_id", "n_words", "runs", "collapsed"])

    out = texts.mapInArrow(run, "_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("_id", id_col)


def longest_run(runs: Column) -> Column:
    """The run of greatest length (ties: smallest start, then smallest period); null without runs."""
    keyed = F.transform(runs, lambda r: F.struct((-r["length"]).alias("n"), r["start"].alias("start"), r["period"].alias("period")))
    return F.array_min(keyed)


def looped_order(doc_id: int, n: int) -> np.ndarray | None:
    """Word numbers of the contract's test texts: of every tenth id (by crc32) a stretch is read over and over from word ``a`` on."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % p)


def run_digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``periodic_runs`` of the contract's texts as counts, the longest run and digests, one row per row of ``docs``."""
    found = periodic_runs(docs, text_col, id_col, looped_order)
    best = F.col("_best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, F.lit("\n")).otherwise(F.lit("")))
    return found.withColumn("_best", longest_run(F.col("runs"))).select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), (-best["n"]).alias("length"),
        best["period"].alias("period"), F.floor(-1000 * best["n"] / best["period"]).cast("bigint").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
