"""Frequent itemsets and rules (R1-R3) against a brute-force level-wise miner."""

from itertools import combinations

from tabmine.operators.rules import association_rules, frequent_itemsets, top_rules


def _brute(tx, min_support, max_len):
    total = len(tx)
    sets = [set(t) for t in tx]
    items = sorted({i for t in sets for i in t})
    out = {}
    for k in range(1, max_len + 1):
        for c in combinations(items, k):
            n = sum(1 for t in sets if set(c) <= t)
            if n and n / total >= min_support:
                out[c] = n
    return out


def _df(spark, tx):
    return spark.createDataFrame([(i, t) for i, t in enumerate(tx)], "tid int, items array<string>")


def test_boundary_support(spark):
    tx = [["a", "b"]] * 7 + [["c"]] * 93        # 7 of 100 at min_support 0.07 is frequent
    got = {tuple(r["items"]): r["count"] for r in frequent_itemsets(_df(spark, tx), min_support=0.07).collect()}
    assert got == {("a",): 7, ("b",): 7, ("a", "b"): 7, ("c",): 93}


def test_against_brute_force(spark):
    import random

    rnd = random.Random(3)
    pool = list("abcdefg")
    tx = [rnd.sample(pool, rnd.randint(0, 5)) + (["a"] if rnd.random() < 0.3 else []) for _ in range(300)]
    tx.append([])                                                    # empty basket still counts
    tx += [["x", "y", "z", "x"]] * 40                                 # duplicate item counts once
    got = {tuple(r["items"]): r["count"] for r in frequent_itemsets(_df(spark, tx), min_support=0.1).collect()}
    assert got == _brute(tx, 0.1, 3)
    fi = frequent_itemsets(_df(spark, tx), min_support=0.1)
    rules = association_rules(fi, 0.3).collect()
    total = len(tx)
    exp = _brute(tx, 0.1, 3)
    for r in rules:
        a, c = tuple(r["antecedent"]), tuple(r["consequent"])
        full = tuple(sorted(a + c))
        assert r["count"] == exp[full]
        assert abs(r["confidence"] - exp[full] / exp[a]) < 1e-12
        assert abs(r["lift"] - r["confidence"] / (exp[c] / total)) < 1e-12
    n_expected = sum(1 for s in exp if len(s) >= 2 for k in range(1, len(s)) for a in combinations(s, k)
                     if exp[s] / exp[a] >= 0.3)
    assert len(rules) == n_expected
    assert any(len(r["consequent"]) == 2 for r in rules)
    top = top_rules(association_rules(fi, 0.3), 5).collect()
    lifts = [r["lift"] for r in top]
    assert lifts == sorted(lifts, reverse=True)


def test_empty(spark):
    assert frequent_itemsets(spark.createDataFrame([], "tid int, items array<string>")).count() == 0


def test_unpacked_keys_match(spark):
    """Long max_length forces the array-key path; results equal brute force."""
    import random

    rnd = random.Random(9)
    tx = [rnd.sample(list("abcdefghij"), rnd.randint(3, 8)) for _ in range(200)]
    got = {tuple(r["items"]): r["count"] for r in frequent_itemsets(_df(spark, tx), min_support=0.2,
                                                                   max_length=25).collect()}
    exp = {}
    sets = [set(t) for t in tx]
    items = sorted({i for t in sets for i in t})
    for k in range(1, 11):
        for c in combinations(items, k):
            n = sum(1 for t in sets if set(c) <= t)
            if n / 200 >= 0.2:
                exp[c] = n
    assert got == exp
