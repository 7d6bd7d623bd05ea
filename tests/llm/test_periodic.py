"""Runs against a plain search over all starts and periods."""

import hashlib
import random
import re
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabmine.llm import queries
from tabmine.llm.periodic import periodic_runs, run_digests, runs_of, scan, surviving_segments

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_runs(w):
    """Maximal stretches of every period, those with a smaller period left out."""
    n, found = len(w), set()
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            length = e + q - i
            if length >= max(6, 4 * q) and not any(all(w[k] == w[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.add((i, length, q))
            i = e
    return sorted(found, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}

    def sha(t):
        return hashlib.sha256(t.encode()).hexdigest()

    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for k, x in enumerate(words) if k not in gone)))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=60), st.integers(1, 7), st.integers(0, 40))
def test_runs_against_plain_search(w, q, n):
    w = w + [w[k % q] if k % q < len(w) else "z" for k in range(n)] + w[:5]
    assert runs_of(w) == plain_runs(w)


@pytest.mark.parametrize("seed", range(6))
def test_longer_mixtures(seed):
    rng = random.Random(seed)
    w = []
    for _ in range(25):
        block = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(rng.randrange(1, 9))]
        w += block * rng.randrange(1, 9) + block[:rng.randrange(len(block))] + [f"u{rng.randrange(99)}"] * rng.randrange(2)
    assert runs_of(w) == plain_runs(w)


def test_segments_hold_every_run_and_no_rare_word():
    rng = random.Random(1)
    for _ in range(200):
        w = np.array([rng.randrange(rng.choice([2, 5, 9])) for _ in range(rng.randrange(6, 80))])
        segs = surviving_segments(w)
        for lo, hi in segs:
            assert np.unique(w[lo:hi], return_counts=True)[1].min() >= 4
        for s, m, _ in plain_runs(w.tolist()):
            assert any(lo <= s and s + m <= hi for lo, hi in segs)


def test_thue_morse_words_do_not_fool_the_hashes():
    w = np.array([bin(k).count("1") & 1 for k in range(4096)])
    assert scan(w) == [] and plain_runs(w[:300].tolist()) == []


def test_long_texts_end_soon():
    t = time.time()
    n = 400_000
    assert runs_of(["a"] * n) == [(0, n, 1)]
    assert runs_of([str(k % 90_000) for k in range(n)]) == [(0, n, 90_000)]
    rng = random.Random(7)
    assert runs_of([rng.choice("abcdef") for _ in range(100_000)])[:1]
    chain = [f"c{k // 4}" for k in range(3, 60_000)] + ["x"]                      # each split frees one more word at the end
    assert runs_of(chain) == []
    assert time.time() - t < 60


ODD = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a a a a a"), (6, "a a a a a a"), (7, "A a " * 9), (None, "b b b b b b"), (None, None),
       (8, "é é é é é é é é é é é é"), (9, "x y x y x y x y z z z z z z z"), (9, "x y x y x y x y z z z z z z z"),
       (10, "one two three\n" * 40), (11, "a\x1fb " * 8 + "q"), (12, "r s t " * 4 + "r s " + "r s t " * 4)]


def test_edges(spark):
    rows = ODD + [(k, " ".join(f"w{i}" for i in range(50))) for k in range(100, 200)]
    df = spark.createDataFrame([(*r, 5, "mine") for r in rows], SCHEMA + ", _id int, runs string").repartition(3)
    got = sorted((tuple(r) for r in run_digests(df).collect()), key=str)
    assert got == sorted((plain_row(*r) for r in rows), key=str)
    assert run_digests(df.limit(0)).collect() == []
    raw = {r.doc_id: r for r in periodic_runs(df).where("doc_id IN (9, 10, 1)").collect()}
    assert [tuple(x) for x in raw[9].runs] == [(0, 8, 2), (8, 7, 1)] and raw[9].collapsed == "x y z"
    assert raw[10].collapsed == "one two three" and raw[1].runs == [] and raw[1].collapsed == ""


def test_query_against_plain_search(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in queries.op13_periodic_runs(spark, SF).collect())
    want = {r[0]: r for r in got}
    short = [r for r in rows if len((r[1] or "").split()) <= 400]                 # the plain search is cubic
    assert len(got) == len(rows) and len(short) > 100
    assert all(want[r[0]] == plain_row(*r) for r in short)
    assert any(r[1] > 0 for r in got)
