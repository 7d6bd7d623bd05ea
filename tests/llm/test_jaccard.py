"""The blocked product against brute force over all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.llm.common import text_chunks
from tabmine.llm.jaccard import _keys, bands, jaccard_components, part_keys, shingle_sets

SCHEMA = "doc_id bigint, text string"


def shingles(text, width=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + width]) for i in range(max(1, len(w) - width + 1)))


def brute(rows, width=3, num=90, den=100):
    sets = [shingles(t, width) for _, t in rows]
    up = list(range(len(rows)))

    def find(v):
        while up[v] != v:
            v = up[v]
        return v

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[find(i)] = find(j)
    first = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            first[find(i)] = min(first.get(find(i), d), d)
    return sorted(((d, len(s), first.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))),
                  key=str)


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted([tuple(r) for r in jaccard_components(df, **kw).collect()], key=str)


def corpus(seed, n=160):
    """Short and long texts, chains of near copies, a shared passage, a hot group of copies."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rng.choice(vocab) for _ in range(15)]
    rows, base = [], None
    for i in range(n):
        kind = rng.random()
        if base is None or kind < 0.35:
            base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 12, 20, 60, 300]))]
            if rng.random() < 0.4:
                base = base + passage
            words = base
        elif kind < 0.85:
            words = list(base)
            for _ in range(rng.choice([1, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            if rng.random() < 0.5:
                base = words                                # chains drift away from the first text
        else:
            words = rows[0][1].split()
        rows.append((i * 7 % 1009, " ".join(w.upper() if rng.random() < 0.1 else w for w in words)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    assert run(spark, rows) == brute(rows)


def test_other_width_and_bound(spark):
    rows = corpus(5, 80)
    assert run(spark, rows, width=5, num=80) == brute(rows, 5, 80)


def test_near_copies_over_many_tiles(spark, monkeypatch):
    from tabmine.llm import jaccard
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)
    rng = random.Random(9)
    base = [f"v{rng.randrange(900)}" for _ in range(150)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(150)] = f"x{rng.randrange(900)}"
        rows.append((i, " ".join(words)))
    assert run(spark, rows) == brute(rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "one two"), (7, "one two"),
            (None, "one two three"), (8, "one two three"), (9, "One\ntwo  three"), (None, None), (10, "ÄÖ äö"), (11, "äö äö")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_extra_columns_and_long_text(spark):
    long = " ".join(str(i * i) for i in range(60_000))
    df = spark.createDataFrame([(1, long, 5, "x"), (2, long + " end", 5, "x")],
                               "doc_id bigint, text string, _n int, component_id string")
    got = sorted(tuple(r) for r in jaccard_components(df).collect())
    assert got == [(1, 59_998, 1), (2, 59_999, 1)]


def test_bands_keep_linked_sizes_near():
    lo = bands(90, 100, 5000)
    band = np.searchsorted(lo, np.arange(1, 5001), side="right") - 1
    for p in range(1, 4500):
        assert band[min(4999, 10 * p // 9 - 1)] - band[p - 1] <= 1


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = sorted([tuple(r) for r in jaccard_components(docs).select("doc_id", "n_shingles", F.col("component_id")).collect()], key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("held", [0, 10_000])
def test_keys_sent_on_in_many_runs(spark, monkeypatch, held):
    """The links do not depend on how many keys a task holds at a time."""
    monkeypatch.setattr("tabmine.llm.jaccard.KEYS_HELD", held)
    monkeypatch.setattr("tabmine.llm.jaccard.text_chunks", lambda arr, **kw: text_chunks(arr, limit=2_000))
    rows = corpus(11)
    assert run(spark, rows) == brute(rows)
    keys = _keys(spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id _id", "text _text").coalesce(1), 3, 90, 100)
    assert keys.where("other >= node").isEmpty()
    again = keys.where("other IS NULL").groupBy("key").count().where("count > 1")
    assert again.isEmpty() == (held > 0)


def test_small_sets_and_one_word_texts_at_four_fifths(spark):
    """Sets of few shingles, where most of the old part keys would have been empty."""
    rng = random.Random(3)
    rows = []
    for i in range(300):
        words = [f"w{rng.randrange(6)}" for _ in range(rng.choice([1, 2, 4, 5, 6, 7, 9, 14]))]
        rows.append((i, " ".join(words)))
    assert run(spark, rows, width=5, num=80) == brute(rows, 5, 80)


def test_a_passage_that_many_share_makes_no_large_block(spark):
    rng = random.Random(12)
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(200)) + " " + passage) for i in range(400)]
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id _id", "text _text")
    from tabmine.llm import jaccard
    nodes = jaccard._sets(texts, 5).selectExpr("_node node", "_id")
    common = jaccard.common_shingles(texts, nodes, 5)
    assert len(common) == 56
    stars = [_keys(texts.coalesce(1), 5, 80, 100, c).where("other IS NOT NULL").count() for c in (None, common)]
    assert stars[0] > 300 and stars[1] < stars[0] / 5


@pytest.mark.parametrize("kind", ["long", "short", "common"])
def test_linked_sets_share_a_key(kind):
    rng = random.Random(4)
    import pyarrow as pa
    base = [f"v{rng.randrange(300)}" for _ in range(14 if kind == "short" else 120)]
    texts = []
    for _ in range(60):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
        texts.append(" ".join(words[rng.randrange(3):]))
    (_, data, starts), = text_chunks(pa.array(texts))
    sets = [shingles(t, 5) for t in texts]
    linked = [(i, j) for i in range(60) for j in range(i)
              if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and sets[i] != sets[j]]
    rows, sh, sizes = shingle_sets(data, starts, 5)
    every = np.unique(sh)
    for common in {"common": (every, every[::2])}.get(kind, (None, every[::3])):
        who, key = part_keys(rows, sh, sizes, 80, 100, common)
        mine = [set(key[who == i].tolist()) for i in range(60)]
        assert linked and all(mine[i] & mine[j] for i, j in linked)


def test_rows_without_an_id_link_two_others(spark):
    words = [f"n{k}" for k in range(100)]
    a, b, c = words[:96], words[2:98], words[4:]
    rows = [(1, " ".join(a)), (None, " ".join(b)), (None, " ".join(b)), (2, " ".join(c)), (None, "lone words stand here")]
    assert run(spark, rows, num=90) == brute(rows)
    assert {r[2] for r in run(spark, rows) if r[0] in (1, 2)} == {1}


def test_large_blocks_by_size_bands(spark, monkeypatch):
    from tabmine.llm import jaccard
    monkeypatch.setattr(jaccard, "TILE_ROWS", 8)
    rng = random.Random(10)
    base = [f"v{k}" for k in range(400)]
    rows = []
    for i in range(120):
        n = rng.randrange(60, 400)                       # nested texts: one block of all sizes
        rows.append((i, " ".join(base[:n])))
    assert run(spark, rows, width=5, num=80) == brute(rows, 5, 80)


def test_chunks_of_copies_alone(spark, monkeypatch):
    """A task that meets only sets it has seen before."""
    from tabmine.llm import jaccard
    monkeypatch.setattr("tabmine.llm.jaccard.text_chunks", lambda arr, **kw: text_chunks(arr, limit=10))
    rows = [(i, "one two three four five six seven eight nine ten eleven") for i in range(30)]
    texts = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id _id", "text _text").coalesce(1)
    assert jaccard._keys(texts, 5, 80, 100).count() > 0
    assert [a.tolist() for a in part_keys(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(3, np.int64), 80, 100)] == [[], []]


def runs_of_words(rng, vocab):
    return " ".join(w for _ in range(9) for w in [rng.choice(vocab)] * 13)


def test_linked_sets_share_a_rarest_key():
    import pyarrow as pa

    from tabmine.llm.jaccard import rarest_keys

    rng = random.Random(12)
    texts = [runs_of_words(rng, "abcdefgh") for _ in range(20)] + ["", "x", "x y"]
    for _ in range(120):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 120))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(300)}"
            texts.append(" ".join(words + ["z"] * rng.randrange(5)))
    (_, data, starts), = text_chunks(pa.array(texts, pa.large_string()))
    rows, sh, sizes = shingle_sets(data, starts, 5)
    seen = np.random.default_rng(3).integers(1, 9, size=64).astype(np.uint16)
    who, key = rarest_keys(rows, sh, sizes, 80, 100, seen, 1)
    sets = [set(sh[rows == i].tolist()) for i in range(len(texts))]
    keys = [set(key[who == i].tolist()) for i in range(len(texts))]
    assert [len(k) for k in keys] == [len(s) - -(-80 * len(s) // 100) + 1 if s else 0 for s in sets]
    linked = [(i, j) for i in range(len(texts)) for j in range(i) if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert len(linked) > 50
    assert all(keys[i] & keys[j] for i, j in linked)


def test_strangers_joined_by_chance_are_split(spark, monkeypatch):
    """The sample of common shingles does not see what these texts share, as on large tables."""
    from tabmine.llm import jaccard

    monkeypatch.setattr(jaccard, "SAMPLE_SETS", 0)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 16)
    placed, copies = jaccard._placed, []

    def counted(*args):
        out = placed(*args)
        copies.append(out.agg(F.sum(F.size("others"))).first()[0])
        return out

    monkeypatch.setattr(jaccard, "_placed", counted)
    rng = random.Random(13)
    vocab = [f"w{i}" for i in range(40)]
    rows = [(i, runs_of_words(rng, vocab)) for i in range(300)]
    rows += [(1000 + i, rows[i][1].rsplit(" ", 2)[0] + " end") for i in range(0, 300, 3)]
    rows += [(None, rows[5][1] + " end"), (None, runs_of_words(rng, vocab)), (7, rows[8][1] + " end")]
    want = brute(rows, 5, 80, 100)
    assert any(c != d for d, _, c in want)
    assert run(spark, rows, width=5, num=80, den=100) == want
    assert copies[0] < 2 * len(rows)                    # 9 tiles or more met each set before
