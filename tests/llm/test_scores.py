"""Indicators and evidence of the two classifiers against plain versions."""

import math
import random
import re

import numpy as np
import pyarrow as pa

from tabmine.llm import quality, toxicity
from tabmine.llm.common import text_chunks

MASK = 2**64 - 1


def plain_hash(parts, bits):
    h = 0
    for p in parts:
        h = ((h ^ p) * 0x9E3779B97F4A7C15) & MASK
        h ^= h >> 29
    return h >> (64 - bits)


def plain_kind(c):
    c = min(c, 0x2FFF)
    ch = chr(c)
    return 1 if ch.islower() else 2 if ch.isupper() else 4 if ch.isdigit() else 5 if ch.isspace() else 3 if ch.isalpha() else 16 + c % 4096


def level(n):
    return 0 if n == 0 else min(int(math.log2(n)) + 1, 12)


def plain_indicators(text):
    cp = [ord(c) for c in text]
    kinds = [plain_kind(c) for c in cp]
    out = {plain_hash(cp[i:i + 3], quality.CHAR_BITS) for i in range(len(cp) - 2)}
    out |= {quality.CHARS + plain_hash(kinds[i:i + 5], quality.CLASS_BITS) for i in range(len(cp) - 4)}
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    n, base = len(words), quality.CHARS + quality.CLASSES
    twice = [words[i] == words[i + 1] for i in range(n - 1)]
    thrice = sum(a and b for a, b in zip(twice, twice[1:]))
    out |= {base + s for s in range(13) if level(sum(twice) * 100 // max(n, 1)) >= s}
    out |= {base + 13 + s for s in range(13) if level(thrice) >= s}
    out |= {base + 26 + s for s in range(13) if len(set(words)) * 10 // max(n, 1) <= s}
    return out | {base + 40 + level(n)}


def texts(n=120):
    rng = random.Random(8)
    signs = ["a", "b", "B", "é", "Ä", "中", "😀", "7", " ", "\n", "#", "|", "!"]
    some = ["", " ", "a", "the the the the", "One one ONE two", "ab cd", "x" * 3000]
    return some + ["".join(rng.choice(signs) for _ in range(rng.randrange(80))) for _ in range(n)]


def test_quality_indicators_and_score():
    all_texts = texts()
    rng = np.random.default_rng(1)
    model = quality.QualityModel(rng.normal(size=quality.SIZE), 0.03, -0.4, True)
    for limit in (50, 1 << 20):
        for at, data, starts in text_chunks(pa.array(all_texts), limit=limit):
            rows, cols = quality.indicators(data, starts)
            score = model.score(data, starts)
            for i in range(len(starts)):
                want = plain_indicators(all_texts[at + i])
                assert set(cols[rows == i].tolist()) == want, repr(all_texts[at + i])
                margin = sum(model.weights[k] for k in want)
                assert abs(score[i] - 1 / (1 + math.exp(-(0.03 * margin - 0.4)))) < 1e-9


def test_toxic_evidence(spark):
    rng = random.Random(5)
    # many words, so that no two texts share a shingle and count as copies
    words = ["".join(rng.choice("bcdfgklmnprst") + rng.choice("aeiou") for _ in range(3)) for _ in range(3000)]
    rows = []
    for i in range(240):
        y = int(i % 3 == 0)
        picked = rng.choices(words, k=12) + (["grumolix", "Moron!"] if y and rng.random() < 0.7 else []) + (["house"] if not y else [])
        rng.shuffle(picked)
        rows.append((i, " ".join(picked), y))
    got = toxicity._evidence(spark.createDataFrame(rows, "_id bigint, text string, y int"), 2.0, 0.5, 0.05)
    seen = {}
    for _, t, y in rows:
        tokens = {w.strip(toxicity._EDGE) for w in t.lower().split()}
        for f in {g for w in tokens if w.isalpha() for g in [w, *[f"{w[:k]}^" for k in (4, 5, 6, 7) if len(w) > k]]}:
            seen.setdefault(f, [0, 0])[y] += 1
    n1, n0 = sum(y for _, _, y in rows), sum(1 - y for _, _, y in rows)
    tested = {f: c for f, c in seen.items() if c[1] > 1}
    want = {}
    for f, (b, a) in tested.items():
        share = n1 / (n1 + n0)
        gain = a * math.log(a / (a + b) / share) + (b * math.log(b / (a + b) / (1 - share)) if b else 0.0)
        ratio = math.log((a + 0.5) / (n1 + 1)) - math.log((b + 0.5) / (n0 + 1))
        if gain >= math.log(len(tested)) + 0.5 and ratio >= 2.0 and b <= 0.05 * (a + b):
            want[f] = ratio
    assert {"moron", "grumolix", "grum^"} <= want.keys() and "house" not in want
    found = dict(zip(got["f"], got["w"], strict=True))
    assert found.keys() == want.keys(), found.keys() ^ want.keys()
    assert all(abs(found[f] - w) < 1e-9 for f, w in want.items())
    # a text's score is the sum over its distinct words, each by its strongest feature
    scorer = toxicity.Scorer(found, toxicity.CharModel(toxicity.trigram_counts([t for _, t, _ in rows]), ["moron"]), -2.0)
    for _, t, _ in rows[:30]:
        tokens = {x.strip(toxicity._EDGE) for x in set(t.lower().split())}
        total = sum(max([want.get(g, 0.0) for g in [w, *[f"{w[:k]}^" for k in (4, 5, 6, 7) if len(w) > k]]]) for w in tokens)
        assert abs(scorer.text(t) - 1 / (1 + math.exp(-(total - 2.0)))) < 1e-9
