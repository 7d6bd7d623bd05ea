import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabmine.llm import quality, toxicity
from tabmine.llm.toxicity import CharModel, Scorer, trigram_counts

DOCS = "doc_id bigint, text string"
LABELS = "doc_id bigint, quality int, toxic int"
BAD = ["idiot", "stupid", "moron", "pathetic"]


def table(spark, n=400, seed=2):
    rng = random.Random(seed)
    syl = ["an", "er", "th", "ing", "on", "re", "st", "ou", "ble", "ti", "and", "with"]
    docs, labels = [], []
    for i in range(n):
        words = ["".join(rng.choices(syl, k=rng.randrange(1, 4))) for _ in range(rng.randrange(20, 60))]
        q, t = 1, 0
        if i % 5 == 0:
            t = 1
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        elif i % 5 == 1:
            q, words = 0, [w.upper() + "!!" for w in words]
        docs.append((i, " ".join(words)))
        labels.append((i, q, t))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), labels


def test_folds_are_the_contract_s(spark):
    docs, labels, _ = table(spark, 60)
    q = {r.doc_id: r.held_out for r in quality.score_quality(docs, labels).collect()}
    t = {r.doc_id: r.held_out for r in toxicity.score_toxicity(docs, labels).collect()}
    for i in range(60):
        crc = zlib.crc32(str(i).encode())
        assert q[i] == (crc % 5 == 0) and t[i] == (crc % 4 == 2)


@pytest.mark.parametrize(("fn", "at"), [(quality.score_quality, 1), (toxicity.score_toxicity, 2)])
def test_held_out_accuracy(spark, fn, at):
    docs, labels, truth = table(spark)
    got = {r.doc_id: r for r in fn(docs, labels).collect()}
    held = [x for x in truth if got[x[0]].held_out]
    assert sum(got[x[0]].predicted == x[at] for x in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())


@pytest.mark.parametrize("fn", [quality.score_quality, toxicity.score_toxicity])
def test_edges(spark, fn):
    docs, labels, _ = table(spark, 120)
    odd = spark.createDataFrame([(None, "words"), (900, None), (901, ""), (902, "a" * 400_000), (902, "a" * 400_000), (903, "😀 ❤ 中文")], DOCS)
    both = docs.unionByName(odd).withColumn("score", F.lit("mine")).withColumn("_text", F.lit(1)).withColumn("y", F.lit(2))
    got = fn(both, labels).collect()
    assert len(got) == 126
    scores = {(r.doc_id, r.text): r.score for r in got}
    assert scores[(900, None)] == scores[(901, "")]
    assert all(0 <= r.score <= 1 for r in got)
    empty = spark.createDataFrame([], DOCS)
    assert fn(empty, labels).count() == 0
    none = fn(docs, spark.createDataFrame([], LABELS))
    assert none.count() == 120 and none.select("score").distinct().count() == 1
    weird = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 7, 7)], LABELS))
    assert fn(docs, weird).count() == 120


def test_held_out_labels_do_not_matter(spark):
    docs, labels, _ = table(spark, 200)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = sorted(map(tuple, toxicity.score_toxicity(docs, labels).select("doc_id", "score").collect()))
    b = sorted(map(tuple, toxicity.score_toxicity(docs, flipped).select("doc_id", "score").collect()))
    assert a == b


def scorer():
    text = "the other thing was stupid and the idiot said so then the loser went with the moron into the house of glass"
    model = CharModel(trigram_counts([text] * 50), BAD)
    return Scorer({w: 5.0 for w in BAD}, model, -2.0)


@pytest.mark.parametrize("noisy", ["1d10t", "st00pid"[:2] + "upid", "$tup1d", "m0r0n", "i d i o t", "i.d.i.o.t", "stuuupid",
                                   "IIIDIOT", "p@thet1c", "s-t-u-p-i-d", "!d!ot", "m o r o n"])
def test_disguises_are_read(noisy):
    assert scorer().text(f"the {noisy} went") > 0.9


@pytest.mark.parametrize("noisy", ["m o r o n,", "i d i o t.", "(i d i o t)", "a i d i o t", "y o u m o r o n", "m*ron", "mоrоn", "idiοt", "stuріd",
                                   "m o r o n " * 9, "the " + "x y z " * 20 + "m o r o n", "you.are.an.idiot.and.a.stupid.moron.and.more.than.sixty.signs.long",
                                   "i" * 50_000 + "diot", "qwrtz." * 40 + "idiot", "i-d-i-o-t, he said"])
def test_more_disguises_of_any_length_are_read(noisy):
    assert scorer().text(f"the {noisy} went") > 0.9


def test_time_is_linear_in_long_tokens():
    import time
    t, s = time.time(), scorer()
    for token in ("ab1" * 30_000, "a b " * 20_000, "x*" * 20_000, "0" * 100_000 + "a", "мaм" * 20_000):
        assert s.text(token) < 0.3
    assert time.time() - t < 60


@pytest.mark.parametrize("clean", ["Москва и мир", "καλημέρα κόσμε", "a b c d e f g h i j", "x - y - z", "www.example.com/the/house-of-glass?x=1&y=2","", "the house of glass", "a b c d", "555-2186 +1 (456)", "ha ha ha", "$$$ %%% the!!", "-" * 5000, ". " * 5000])
def test_clean_text_is_left_alone(clean):
    assert scorer().text(clean) < 0.3


def test_viterbi_finds_the_best_path():
    """Against enumeration of every reading of a short lattice."""
    model = scorer().model

    def readings(token, last=""):
        if not token:
            yield "", 0.0
            return
        c, rest = token[0], token[1:]
        options = ([(c, 0.0)] if c.isalpha() else []) + [(x, toxicity.SWAP) for x in toxicity.LOOKALIKES.get(c, "")]
        for letter, cost in options:
            for tail, more in readings(rest, letter):
                yield letter + tail, cost + more
            if letter == last:
                for tail, more in readings(rest, last):
                    yield tail, cost + toxicity.COLLAPSE + more
        if not c.isalpha():
            drop = 3 * toxicity.DROP if c in toxicity.LOOKALIKES else toxicity.DROP
            for tail, more in readings(rest, last):
                yield tail, drop + more

    def likelihood(word):
        a = b = 0
        total = 0.0
        for ch in word:
            c = toxicity._CODE.get(ch, 1)
            total += model.log[a if b else 0][b][c]
            a, b = b, c
        return total + model.log[a][b][0]

    for token in ["1d10t", "m00r0n", "l0ss", "a1.b", "s$tup"]:
        best = max((likelihood(w) + cost, w) for w, cost in readings(token) if w)
        got = model.restore(token)
        scores = [likelihood(w) + cost for w, cost in readings(token) if w == got]
        assert abs(max(scores) - best[0]) < 1e-9


def test_dual_coordinate_descent_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ np.array([1.0, -2, 0.5, 0, 1]) + 0.3 * rng.normal(size=60) > 0, 1.0, -1.0)
    indptr, idx, val = np.arange(0, 301, 5), np.tile(np.arange(5), 60), x.ravel()
    w = quality.dual_coordinate_descent(indptr, idx, val, y, 5, 1.0, passes=2000, tol=1e-9)

    def loss(v):
        return 0.5 * v @ v + np.maximum(0, 1 - y * (x @ v)).sum()

    assert all(loss(w) <= loss(w + d) + 1e-6 for d in rng.normal(scale=0.02, size=(200, 5)))
