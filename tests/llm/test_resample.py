"""Buckets and draws against a plain version, quickselect against sorting, edges."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabmine.llm import queries
from tabmine.llm.common import text_chunks
from tabmine.llm.resample import features, importance_resample, kth_key

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return [zlib.crc32(" ".join(w[i:i + m]).encode()) % 10_000 for m in (1, 2, 3) for i in range(len(w) - m + 1)], len(w)


def plain(rows, target):
    """Rows ``(id, n_features, weight, score, rank)``; ids must differ where ranks matter."""
    s, t = np.zeros(10_000), np.zeros(10_000)
    feats = [buckets(x) for _, x in rows]
    for f, _ in feats:
        np.add.at(s, f, 1)
    for x in target:
        np.add.at(t, buckets(x)[0], 1)
    gain = [math.floor(1000 * math.log((t[k] + 1) * (s.sum() + 10_000) / ((s[k] + 1) * (t.sum() + 10_000)))) for k in range(10_000)]
    out = []
    for (d, _), (f, n) in zip(rows, feats, strict=True):
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in f)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in out]


def test_buckets_against_the_checksum():
    rng = random.Random(2)
    texts = ["", "a", "A b", "x" * 47 + " y", "x" * 48 + " y z", "x" * 49 + " y z", "q " + "y" * 500 + " z é", "ÄÖ-äö 中文😀 1_2", "a\x00b", "-", "end."]
    texts += [" ".join("".join(rng.choice("abAÉ9é😀") for _ in range(rng.choice([1, 2, 5, 60]))) for _ in range(rng.randrange(12))) for _ in range(150)]
    for limit in (1, 300, 1 << 20):
        got = {}
        for i, data, starts in text_chunks(pa.array(texts), limit=limit):
            for r, b in zip(*features(data, starts), strict=True):
                got.setdefault(i + int(r), []).append(int(b))
        assert all(sorted(got.get(i, [])) == sorted(buckets(t)[0]) for i, t in enumerate(texts))


def test_query_against_plain_version(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted((tuple(r) for r in queries.op12_resampling(spark, SF).collect()), key=str)
    assert got == sorted(plain(rows, target), key=str)
    assert sum(r[4] is not None for r in got) >= 5


@pytest.mark.parametrize(("pivots", "ks"), [(3, [350]), (24, [1, 2, 350, 699, 700])])
def test_quickselect_against_sorting(spark, pivots, ks):
    rng = random.Random(pivots)
    keys = [(rng.randrange(-6, 6), rng.choice([None, *range(9)]), i) for i in range(700)]
    df = spark.createDataFrame(keys, "score bigint, _id bigint, _row bigint").coalesce(2)
    want = sorted(keys, key=lambda r: (-r[0], r[1] is not None, r[1] or 0, r[2]))
    for k in ks:
        assert kth_key(df, k, pivots) == (-want[k - 1][0], *want[k - 1][1:])


def test_ties_and_repeated_rows(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(40)]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(300)]
    hot = [(7, " ".join(words[:30]))] * 200                                         # one id and text again and again
    df = spark.createDataFrame(rows + hot, SCHEMA).repartition(6)
    target = spark.createDataFrame([("w1 w2 w3",), (None,), ("",)], "text string")
    got = importance_resample(df, target).collect()
    able = sum(len((t or "").split()) >= 20 for _, t in rows + hot)
    ranks = sorted(r.rank for r in got if r["rank"] is not None)
    assert len(got) == 500 and ranks == list(range(1, 5 * able // 100 + 1))
    drawn = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in drawn] == sorted((-r.score, r.doc_id) for r in drawn)
    left = [(-r.score, r.doc_id) for r in got if r["rank"] is None and r.n_features >= 57]
    assert (-drawn[-1].score, drawn[-1].doc_id) <= min(left)


def test_edges(spark):
    text = " ".join(f"t{k}" for k in range(25))
    rows = [(None, text), (None, None), (1, None), (2, ""), (3, "---"), (4, "one"), (5, "z" * 300_000)] + [(i, text + f" x{i}") for i in range(10, 60)]
    df = spark.createDataFrame([(*r, 1, "mine", 2) for r in rows], SCHEMA + ", _id int, score string, bucket int").repartition(3)
    none = spark.createDataFrame([], "text string")
    for target, texts in ((none, []), (none.unionByName(df.select("text").limit(20)), None)):
        texts = [r.text for r in target.collect()] if texts is None else texts
        got = sorted((tuple(r) for r in importance_resample(df, target).collect()), key=str)
        assert got == sorted(plain(rows, texts), key=str)
    assert importance_resample(df.limit(0), none).collect() == []
    few = importance_resample(df.where(F.col("doc_id") < 15), none)
    assert few.count() == 10 and few.where("rank IS NOT NULL").count() == 0
