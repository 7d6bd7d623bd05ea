"""Operator 8: quality by Naive Bayes support vectors.

Indicators of n-grams (characters, character classes, repeated words) are scaled
by their class log-count ratios; a linear hinge-loss model over the scaled
indicators is fitted by dual coordinate descent; its margins are turned into
probabilities by a fitted sigmoid.  The fit takes a bounded sample of labelled
rows; every text is scored whole, inside the tasks."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import text_chunks, tidy, word_hashes
from tabmine.llm.labels import fold, labelled_sample

#: hashed spaces: character trigrams, character-class 5-grams, word patterns
CHAR_BITS, CLASS_BITS = 16, 13
CHARS, CLASSES, WORDS = 1 << CHAR_BITS, 1 << CLASS_BITS, 64
SIZE = CHARS + CLASSES + WORDS
_M = np.uint64(0x9E3779B97F4A7C15)


def _kinds() -> np.ndarray:
    """Class of a code point: marks stand for themselves, letters and digits for their kind."""
    kind = np.full(0x3000, 3, dtype=np.uint64)
    for c in range(0x3000):
        ch = chr(c)
        kind[c] = 1 if ch.islower() else 2 if ch.isupper() else 4 if ch.isdigit() else 5 if ch.isspace() \
            else 3 if ch.isalpha() else 16 + c % 4096
    return kind


_KINDS: list[np.ndarray] = []


def _hashed(parts: list[np.ndarray], bits: int) -> np.ndarray:
    h = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        h = (h ^ p.astype(np.uint64)) * _M
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _level(n: np.ndarray) -> np.ndarray:
    """0, 1, 2-3, 4-7, ... as 0, 1, 2, 3, ..., at most 12."""
    return np.minimum(np.floor(np.log2(n + 1e-9)) + 1, 12).clip(0).astype(np.int64)


def indicators(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram indicators ``(row, feature)`` of texts laid end to end."""
    if not _KINDS:
        _KINDS.append(_kinds())
    n_docs = len(starts)
    cp = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32)
    lead = np.flatnonzero((data & 0xC0) != 0x80)            # byte of every code point
    row = np.searchsorted(starts, lead, side="right") - 1
    found = np.zeros((n_docs, SIZE), dtype=bool)
    kind = _KINDS[0][np.minimum(cp, 0x2FFF)]
    for codes, width, bits, base in ((cp, 3, CHAR_BITS, 0), (kind, 5, CLASS_BITS, CHARS)):
        m = len(codes) - width + 1
        if m > 0:
            h = _hashed([codes[k:k + m] for k in range(width)], bits)
            same = row[:m] == row[width - 1:]
            found[row[:m][same], base + h[same]] = True
    words, at = word_hashes(data, starts)
    n_words = np.bincount(at, minlength=n_docs)
    twice = (words[1:] == words[:-1]) & (at[1:] == at[:-1])
    thrice = twice[1:] & twice[:-1]
    order = np.lexsort((words, at))
    new = np.ones(len(words), dtype=bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (at[order][1:] != at[order][:-1])
    distinct = np.bincount(at[order][new], minlength=n_docs)
    every = np.arange(n_docs)
    base = CHARS + CLASSES
    pairs = np.bincount(at[1:][twice], minlength=n_docs) * 100 // np.maximum(n_words, 1)
    thrices = np.bincount(at[2:][thrice], minlength=n_docs)
    steps = np.arange(13)
    found[:, base:base + 13] = _level(pairs)[:, None] >= steps      # every step reached, so that near levels share
    found[:, base + 13:base + 26] = _level(thrices)[:, None] >= steps
    found[:, base + 26:base + 39] = (distinct * 10 // np.maximum(n_words, 1))[:, None] <= steps
    found[every, base + 40 + _level(n_words)] = True
    return np.nonzero(found)


def dual_coordinate_descent(indptr: np.ndarray, idx: np.ndarray, val: np.ndarray, y: np.ndarray, size: int,
                            c: float = 1.0, passes: int = 30, tol: float = 1e-3, seed: int = 7) -> np.ndarray:
    """Weights of min 1/2 |w|^2 + c * sum max(0, 1 - y w.x): one dual variable at a time, each
    solved exactly and clipped to [0, c], in a new order every pass."""
    w, alpha = np.zeros(size), np.zeros(len(y))
    norm = np.add.reduceat(val * val, indptr[:-1]) if len(val) else np.zeros(len(y))
    order = np.random.default_rng(seed)
    for _ in range(passes):
        worst = 0.0
        for i in order.permutation(len(y)):
            a, b = indptr[i], indptr[i + 1]
            if a == b or norm[i] <= 0:
                continue
            cols, x = idx[a:b], val[a:b]
            g = y[i] * (w[cols] @ x) - 1.0
            new = min(max(alpha[i] - g / norm[i], 0.0), c)
            if new != alpha[i]:
                w[cols] += (new - alpha[i]) * y[i] * x
                worst = max(worst, abs(new - alpha[i]) * norm[i])
                alpha[i] = new
        if worst < tol:
            break
    return w


def fit_sigmoid(margin: np.ndarray, y01: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of P(1) = 1 / (1 + exp(-(a m + b))), with smoothed targets (Newton steps)."""
    n1, n0 = y01.sum(), (1 - y01).sum()
    t = np.where(y01 == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margin, np.ones_like(margin)], 1)
    ab = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ ab, -30, 30)))
        g = x.T @ (p - t) + np.array([1e-6, 0]) * ab
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2)
        step = np.linalg.solve(h, g)
        ab = ab - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(ab[0]), float(ab[1])


@dataclass
class QualityModel:
    """Folded weights over the hashed indicators; ``fitted`` is false without labels of both classes."""

    weights: np.ndarray
    slope: float
    offset: float
    fitted: bool

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        rows, cols = indicators(data, starts)
        m = np.bincount(rows, weights=self.weights[cols], minlength=len(starts))
        return 1 / (1 + np.exp(-np.clip(self.slope * m + self.offset, -60, 60)))


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 2_000, c: float = 1.0, blend: float = 0.5,
                text_col: str = "text", id_col: str = "doc_id") -> QualityModel:
    """Fit on at most ``per_class`` labelled rows of each class in expectation,
    outside the held-out fold.  Indicators are found in the tasks; the driver gets
    their hashed numbers (at most ``SIZE`` a row).  ``blend`` mixes the weights with their mean size."""
    sample, counts = labelled_sample(docs, labels, "quality", 5, 0, per_class, text_col, id_col)

    def run(batches):
        for pdf in batches:
            for i, data, starts in text_chunks(pa.array(pdf["text"], pa.large_string()), rows=128):
                rows, cols = indicators(data, starts)
                cuts = np.searchsorted(rows, np.arange(len(starts) + 1))
                yield pd.DataFrame({"y": pdf["y"].iloc[i:i + len(starts)].to_numpy(),
                                    "x": [cols[a:b].astype(np.int32).tobytes()
                                          for a, b in zip(cuts[:-1], cuts[1:], strict=True)]})

    got = sample.mapInPandas(tidy(run), "y int, x binary").toPandas().sort_values(["x", "y"]).reset_index(drop=True)
    y01 = got["y"].to_numpy(dtype=float)
    if not len(got) or y01.min() == y01.max():
        return QualityModel(np.zeros(SIZE), 0.0, 0.0 if not len(got) else (2.0 if y01[0] else -2.0), False)
    x = [np.frombuffer(b, dtype=np.int32) for b in got["x"]]
    indptr = np.concatenate([[0], np.cumsum([len(v) for v in x])])
    idx = np.concatenate(x).astype(np.int64)
    owner = np.repeat(y01, np.diff(indptr))
    p = 1 + np.bincount(idx, weights=owner, minlength=SIZE)
    q = 1 + np.bincount(idx, weights=1 - owner, minlength=SIZE)
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    val = ratio[idx]
    scale = np.sqrt(np.maximum(np.add.reduceat(val * val, indptr[:-1]), 1e-12)).mean()
    val = val / scale
    w = dual_coordinate_descent(indptr, idx, val, np.where(y01 == 1, 1.0, -1.0), SIZE, c)
    w = (1 - blend) * np.abs(w).mean() + blend * w
    folded = w * ratio / scale
    margin = np.add.reduceat(folded[idx], indptr[:-1])
    slope, offset = fit_sigmoid(margin, y01)
    n1, n0 = y01.sum(), (1 - y01).sum()                  # the sample thins the classes unequally
    offset += math.log(counts[1] / counts[0]) - math.log(n1 / n0)
    return QualityModel(folded, slope, offset, True)


def score_quality(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, text_col: str = "text",
                  id_col: str = "doc_id", threshold: float = 0.3, **fit) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` added (columns of these names are replaced).

    The model is learned from labelled rows of ``corpus`` (default: ``docs``).  Null
    texts are scored as empty ones.  Without any label the score is 0.5; with
    labels of one class only it is that class's side of 0.5.  Repeated rows are kept."""
    model = fit_quality(corpus if corpus is not None else docs, labels, text_col=text_col, id_col=id_col, **fit)
    keep = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    schema = docs.select(*keep).schema.add("score", "double")
    at = [c.lower() for c in keep].index(text_col.lower())

    def run(batches):
        for batch in batches:
            text = batch.column(at).cast(pa.string())
            scores = [model.score(data, starts) for _, data, starts in text_chunks(text, rows=128)]
            score = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*keep, "score"])

    out = docs.select(*keep).mapInArrow(tidy(run), schema)
    return out.select(*keep, (fold(id_col, 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
