import random

from tabmine.llm.packing import best_fit, pack

SCHEMA = "doc_id bigint, text string, source string, lang string"


def slow_pack(lengths, sources, clusters, capacity):
    """Every bin is looked at; the tightest compatible one (oldest on ties) wins."""
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        fit = [(b[0], k) for k, b in enumerate(bins) if b[0] >= n and b[0] > 0
               and (s is None or s not in b[1]) and (c is None or c not in b[2])]
        if fit:
            k = min(fit)[1]
        else:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] -= n
        bins[k][1].add(s)
        bins[k][2].add(c)
        out.append(k)
    return out


def test_pack_against_brute_force():
    rng = random.Random(3)
    for _ in range(30):
        n = rng.randrange(1, 120)
        sizes = [rng.randrange(1, 50) for _ in range(n)]
        src = [rng.choice(["a", "a", "a", "b", "c", None]) for _ in range(n)]
        dup = [rng.choice([1, 2, 3, None, *range(10, 60)]) for _ in range(n)]
        assert pack(sizes, src, dup, 50) == slow_pack(sizes, src, dup, 50)


def check(rows, got, capacity):
    by, seen = {}, {}
    meta = {}
    for r in rows:
        meta.setdefault(r[0], r)
    for r in got:
        if r.bin is not None:
            by.setdefault(r.bin, []).append(r)
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    for pieces in by.values():
        pieces.sort(key=lambda r: r.bin_offset)
        assert sum(r.length for r in pieces) <= capacity
        at = 0
        for r in pieces:
            assert r.bin_offset == at
            at += r.length
        src = [meta[r.doc_id][2] for r in pieces if meta[r.doc_id][2] is not None]
        assert len(src) == len(set(src))
        txt = [meta[r.doc_id][1].strip().lower() for r in pieces]
        assert len(txt) == len(set(txt))
    return seen


def test_all_rows_packed_without_conflicts(spark):
    rng = random.Random(1)
    rows = [(i, "x" * rng.choice([0, 3, 17, 100, 396, 1000, 5000]) + str(i % 90), rng.choice(["hot", "hot", "b", "c", None]), "en")
            for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = best_fit(df, capacity=100, shard_rows=64).collect()
    seen = check(rows, got, 100)
    assert seen == {r[0]: -(-len(r[1]) // 4) for r in rows}
    again = best_fit(df.repartition(7), capacity=100, shard_rows=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_edges(spark):
    rows = [(1, None, None, None), (2, "", "a", None), (None, "abcd", "a", None), (3, "é" * 4, "a", "x"), (3, "é" * 4, "a", "x")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS bin", "2 AS _n")
    got = sorted((tuple(r) for r in best_fit(df).collect()), key=str)
    assert [r[:4] for r in got] == [(1, 0, 0, 0), (2, 0, 0, 0), (3, 0, 0, 2), (3, 0, 0, 2), (None, 0, 0, 1)]
    assert len({r[4] for r in got if r[0] == 3}) == 2 and got[0][4] is None
    assert best_fit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_long_text(spark):
    df = spark.createDataFrame([(1, "ab " * 700_000, "s", "en")], SCHEMA)
    got = best_fit(df).collect()
    assert sum(r.length for r in got) == 525_000 and len({r.bin for r in got}) == len(got)
