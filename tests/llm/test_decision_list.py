"""Counts against a plain version, the learner against enumeration, held-out accuracy, edges."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tabmine.llm import queries
from tabmine.llm.decision_list import Condition, DecisionList, _best_condition, learn, quality_rules

SF = "/root/testdata/sf0.01"
DOCS = "doc_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    again = {k for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(i, i + 3)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    failed = n < 50 or 100 * len(again) > 50 * n
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), failed)


def got_rows(df):
    return [(r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed), r.kept) for r in df.collect()]


ODD = ["", None, " \t\n\r\x0b\x0c", "a", "a b", "a a a a", "x y z x y z", "é ü ö 中文 😀", "a\n\na\n", "l\nl\nl", " l\nl", "l\r\nl\r\n", "#*$%&|<>",
       "\n\nq\n\nq", "one two three\none two three\none", "a b c a b", "w " * 49, "w " * 50, " ".join(map(str, range(50)))]


def test_counts_of_odd_texts(spark):
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice("ab# \n\té") for _ in range(rng.randrange(400))) for _ in range(200)] + ["z" * 600_000, "ab c\n" * 100_000]
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS).repartition(3)
    got = got_rows(quality_rules(docs, spark.createDataFrame([], LABELS)))
    assert sorted((d, c) for d, c, _ in got) == [(i, plain(t)) for i, t in enumerate(texts)]
    assert all(kept == (not c[-1]) for _, c, kept in got)                       # no labels: the base alone


def test_query_counts_and_held_out_verdicts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = got_rows(queries.op11_quality_rules(spark, SF))
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted((d, c) for d, c, _ in got) == sorted((d, plain(t)) for d, t in texts.items())
    assert not any(kept and c[-1] for _, c, kept in got)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    held = [(d, kept) for d, c, kept in got if d in labels and not c[-1] and zlib.crc32(str(d).encode()) % 5 == 0]
    assert len(held) > 30 and sum(kept == (labels[d] == 1) for d, kept in held) >= 0.93 * len(held)


def test_best_condition_against_enumeration():
    rng = np.random.default_rng(5)
    names = ["a", "b"]
    for _ in range(20):
        x = rng.integers(0, 12, size=(40, 2))
        y = ((x[:, 0] + rng.integers(0, 6, 40)) > 8).astype(float)
        w = rng.integers(1, 4, 40).astype(float)
        if y.min() == y.max():
            continue
        before = np.log2((w @ y) / w.sum())

        def gain(c, x=x, y=y, w=w, before=before):
            ok = c.holds(x[:, names.index(c.statistic)])
            p, n = w[ok] @ y[ok], w[ok] @ (1 - y[ok])
            return p * (np.log2(p / (p + n)) - before) if p else -np.inf

        every = [Condition(k, s, v) for k in names for s in ("<=", ">=") for v in range(12)]
        assert abs(gain(_best_condition(x, y, w, names)) - max(map(gain, every))) < 1e-9


def test_learns_conjunctions_and_orders_do_not_matter():
    rng = np.random.default_rng(8)
    x = rng.integers(0, 100, size=(3000, 3))
    bad = ((x[:, 0] > 70) & (x[:, 1] < 30)) | (x[:, 2] > 95)
    y = 1 - bad.astype(int)
    one = learn(x, y, np.ones(3000), ["a", "b", "c"])
    mixed = rng.permutation(3000)
    assert str(learn(x[mixed], y[mixed], np.ones(3000), ["a", "b", "c"])) == str(one)
    new = rng.integers(0, 100, size=(3000, 3))
    truth = ((new[:, 0] > 70) & (new[:, 1] < 30)) | (new[:, 2] > 95)
    assert (one.covers(new, ["a", "b", "c"]) == truth).mean() > 0.98
    assert one.target == 0 and any(len(r) > 1 for r in one.rules)


def test_noise_alone_gives_no_rule():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 50, size=(600, 4)), (rng.random(600) < 0.85).astype(int)
    rules = learn(x, y, np.ones(600), list("abcd"))
    assert rules.covers(x, list("abcd")).mean() < 0.1


def test_conditional_expression_matches_the_list(spark):
    rules = DecisionList(0, [[Condition("n_words", ">=", 5), Condition("n_words", "<=", 7)], [Condition("n_words", ">=", 7)]])
    from pyspark.sql import functions as F
    df = spark.range(10).select(F.col("id").alias("n_words"))
    stats = {"n_words": F.col("n_words")}
    got = [(r.v, r.n) for r in df.select("n_words", rules.verdict(stats).alias("v"), rules.rule_number(stats).alias("n")).orderBy("n_words").collect()]
    assert got == [(1, None)] * 5 + [(0, 1)] * 3 + [(0, 2)] * 2


@pytest.mark.parametrize("one_class", [None, 0, 1])
def test_edges(spark, one_class):
    rng = random.Random(4)
    rows = [(i, " ".join(("XX!! " if i % 4 == 0 else "") + str(rng.randrange(10**6)) for _ in range(80))) for i in range(160)]
    rows += [(None, rows[1][1]), (7, rows[1][1]), (7, rows[1][1]), (900, None), (901, "")]
    docs = spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], DOCS + ", n_words int, kept string, _id int")
    labels = [(i, int(i % 4 != 0) if one_class is None else one_class, 0) for i in range(160)]
    labels += [(None, 1, 1), (3, None, None), (5, 7, 7), (6, 0, 0), (6, 1, 0)]
    got = got_rows(quality_rules(docs, spark.createDataFrame(labels, LABELS)))
    assert len(got) == len(rows)
    kept = {d: k for d, _, k in got if d is not None and d < 160}
    want = {d: one_class is not None or d % 4 != 0 for d in kept}
    want[7] = True
    assert kept == want
    assert not any(k for d, _, k in got if d in (900, 901))
    assert quality_rules(docs.limit(0), spark.createDataFrame(labels, LABELS)).collect() == []


def test_one_clashing_id_keeps_the_sample_bounded(spark):
    from tabmine.llm.decision_list import labelled_statistics, text_statistics
    docs = spark.range(4000).selectExpr("5 AS doc_id", "concat('w', id, ' ', id % 7, repeat(' z', cast(id % 900 as int))) AS text")
    found = labelled_statistics(text_statistics(docs), spark.createDataFrame([(5, 1, 0)], LABELS), "quality", 5, 0, 100)
    n = found.count()
    assert 40 < n < 200
    assert abs(found.groupBy().sum("w").first()[0] - 4000) < 1500
