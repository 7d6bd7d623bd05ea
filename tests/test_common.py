"""Distributed prefix sums across several range partitions, against brute force."""

import random

from tabmine.operators.common import prefix_sums


def test_prefix_sums_many_partitions(spark):
    rnd = random.Random(8)
    rows = [(g, i, rnd.randint(0, 9)) for g in ("a", "b", "c") for i in rnd.sample(range(10_000), 700)]
    df = spark.createDataFrame(rows, "g string, o long, v long").repartition(5)
    for n, asc in [(7, True), (13, False), (None, True)]:
        got = {(r["g"], r["o"]): r["cum_v"] for r in prefix_sums(df, ["o"], ["v"], ["g"], ascending=asc,
                                                                 num_partitions=n).collect()}
        for g in ("a", "b", "c"):
            seq = sorted(((o, v) for gg, o, v in rows if gg == g), reverse=not asc)
            total = 0
            for o, v in seq:
                total += v
                assert got[(g, o)] == total


def test_release_pinned(spark):
    import os

    from tabmine.session import _PINNED, cut_lineage, release_pinned

    before = len(_PINNED)
    t = cut_lineage(spark.range(10))
    assert t.count() == 10 and len(_PINNED) == before + 1
    path = _PINNED[-1].replace("file:", "")
    assert os.path.exists(path)
    assert release_pinned(spark) >= 1 and not os.path.exists(path) and not _PINNED
    from tabmine.plans.queries import clear_memo

    clear_memo()                       # memoised intermediates pointed at released tables
