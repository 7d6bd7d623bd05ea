"""Operator 10: toxicity by noisy-channel deobfuscation.

A token that is not a plain word is a noisy observation of one: letters may be
written as look-alike signs, set apart by spaces or marks, or repeated.  Its
lattice holds every reading; a Viterbi search under a character trigram model
picks the likeliest.  The character model is counted over all documents and mixed
with the learned vocabulary.  The restored words are scored by evidence learned
from labelled rows: words and word beginnings whose log-ratio between toxic and
other documents is large and significant among all features tested."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import text_slices, tidy
from tabmine.llm.labels import fold, labelled_sample, without_copies
from tabmine.session import cut_lineage

# fixed values: look-alike signs and the letters they stand for
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou",
              "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
              "ѕ": "s", "і": "i", "ј": "j", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u"}
#: the character model's symbols; 0 is the word edge, 1 any other letter
ALPHABET = "abcdefghijklmnopqrstuvwxyzàáâäãåæçèéêëìíîïñòóôöõùúûüýÿœß"
SYMBOLS = 64
_CODE = {c: i + 2 for i, c in enumerate(ALPHABET)}
_EDGE = "\"'`.,;:?!()[]{}<>«»“”‘’…*-_~#%&/\\"
#: single signs set apart by spaces or marks: spaced-out words, marks at their edges aside
SPACED = re.compile(r"(?<![^\s(\[{\"'«“‘¡¿])[^\s._*~-](?:[ \t._*~-]{1,3}[^\s._*~-]){2,}(?=[\s.,;:?!)\]}\"'»”’…]|\Z)")
_REPEAT = re.compile(r"(.)\1\1")
_LONG_RUN = re.compile(r"(.)\1{4,}", re.S)
_MARKS = re.compile(r"[\W_]+")
#: letters of two scripts in one word
_LATIN, _OTHER = re.compile("[a-z]"), re.compile("[\u0370-\u03ff\u0400-\u04ff]")
#: log costs of the channel; PART ends a word inside of a spaced run, beside what the character model asks for
SWAP, DROP, COLLAPSE, PART = -1.0, -0.3, -0.7, 0.0


@lru_cache
def _code_table() -> np.ndarray:
    table = np.zeros(0x250, dtype=np.int64)
    for c in range(0x250):
        if chr(c).isalpha():
            table[c] = _CODE.get(chr(c), 1)
    return table


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of symbol trigrams ``(a, b, c)``; after a word edge the older symbol counts as an edge too."""
    table = _code_table()
    joined = ("\n" + "\n".join(t or "" for t in texts).lower() + "\n").encode("utf-32-le", "surrogatepass")
    cp = np.frombuffer(joined, dtype=np.uint32)
    s = np.where(cp < len(table), table[np.minimum(cp, len(table) - 1)], 1)
    a, b, c = s[:-2], s[1:-1], s[2:]
    a = np.where(b == 0, 0, a)
    live = (b > 0) | (c > 0)
    return np.bincount(((a * SYMBOLS + b) * SYMBOLS + c)[live], minlength=SYMBOLS**3)


class CharModel:
    """Trigram model with backing-off by interpolation; ``words`` are mixed in with the given share."""

    def __init__(self, counts: np.ndarray, words: list[str], share: float = 0.3):
        own = trigram_counts(words).astype(float) if words else np.zeros(SYMBOLS**3)
        base = counts.astype(float)
        if own.sum():
            base = base * (1 - share) / max(base.sum(), 1.0) + own * share / own.sum()
        else:
            base = base / max(base.sum(), 1.0)
        tri = base.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
        bi, uni = tri.sum(0), tri.sum((0, 1))
        p1 = (uni + 1e-4) / (uni + 1e-4).sum()
        p2 = (bi + 1e-5 * p1) / (bi + 1e-5 * p1).sum(-1, keepdims=True)
        p3 = (tri + 1e-6 * p2[None]) / (tri + 1e-6 * p2[None]).sum(-1, keepdims=True)
        self.log = np.log(0.9 * p3 + 0.09 * p2[None] + 0.01 * p1).tolist()

    def restore(self, token: str, part: float | None = None) -> str:
        """The likeliest word behind ``token``: Viterbi over its lattice; states are the last two letters.  With ``part``, the log cost
        of a word break, the likeliest words, a space between them.  Time is linear: readings are chains of letters that share their
        beginnings.  A sign that stands more than four times in a row is read as four (more collapse alike)."""
        token = _LONG_RUN.sub(r"\1\1\1\1", token)
        best: dict[tuple[int, int, str], tuple[float, tuple | None]] = {(0, 0, ""): (0.0, None)}
        for sign in token:
            step: dict[tuple[int, int, str], tuple[float, tuple | None]] = {}

            def offer(key, score, chain, step=step):
                if key not in step or step[key][0] < score:
                    step[key] = (score, chain)

            swaps = LOOKALIKES.get(sign, "")
            for (a, b, last), (score, chain) in best.items():
                if sign.isalpha():
                    c = _CODE.get(sign, 1)
                    offer((b, c, sign), score + self.log[a if b else 0][b][c], (chain, sign))
                    if sign == last:
                        offer((a, b, last), score + COLLAPSE, chain)
                for letter in swaps:
                    c = _CODE[letter]
                    offer((b, c, letter), score + SWAP + self.log[a if b else 0][b][c], (chain, letter))
                    if letter == last:
                        offer((a, b, last), score + SWAP + COLLAPSE, chain)
                if not sign.isalpha():
                    offer((a, b, last), score + (3 * DROP if swaps else DROP), chain)
            if part is not None:
                for (a, b, _), (score, chain) in list(step.items()):
                    if b:
                        offer((0, 0, ""), score + self.log[a][b][0] + part, (chain, " "))
            best = step
        ends = [(score + self.log[a][b][0], chain) for (a, b, _), (score, chain) in best.items() if b]
        if not ends:
            return ""
        top = max(e[0] for e in ends)
        return max(_spelled(chain) for score, chain in ends if score == top)


def _spelled(chain: tuple | None) -> str:
    letters = []
    while chain is not None:
        chain, letter = chain
        letters.append(letter)
    return "".join(letters[::-1])


def plain_words(text: str) -> set[str]:
    """Distinct lower-cased tokens without the marks at their edges, when only letters remain."""
    return {w for w in (t.strip(_EDGE) for t in set(text.lower().split())) if w.isalpha()}


def features(word: str) -> list[str]:
    """A word, and the beginnings that carry a word family."""
    return [word] + [f"{word[:k]}^" for k in (4, 5, 6, 7) if len(word) > k]


def _evidence(sample: DataFrame, least: float, slack: float, impure: float) -> pd.DataFrame:
    """Features with a log-ratio of at least ``least`` whose log-likelihood gain over
    the base rate exceeds the log of the number of features tested by ``slack``
    and at most a share ``impure`` of whose texts is not toxic, with the log-ratio as weight.  Its size is bounded by the labelled sample."""
    def run(batches):
        seen = {0: Counter(), 1: Counter()}

        def flush():
            names = list(seen[0].keys() | seen[1].keys())
            out = pd.DataFrame({"f": names, "n1": [seen[1][f] for f in names], "n0": [seen[0][f] for f in names]})
            seen[0].clear()
            seen[1].clear()
            return out

        for pdf in batches:
            for text, y in zip(pdf["text"], pdf["y"], strict=True):
                seen[y].update({f for w in plain_words(text or "") for f in features(w)})
                if len(seen[0]) + len(seen[1]) > 200_000:   # summed again after the shuffle
                    yield flush()
        yield flush()

    sample = cut_lineage(without_copies(cut_lineage(sample)))
    size = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n1, n0 = float(size.get(1, 0)), float(size.get(0, 0))
    if not n1 or not n0:
        return pd.DataFrame(columns=["f", "w"])
    grouped = (sample.mapInPandas(tidy(run), "f string, n1 bigint, n0 bigint").groupBy("f")
               .agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")).where("n1 > 1"))
    grouped = cut_lineage(grouped)
    tested = max(grouped.count(), 1)
    p1, n = n1 / (n1 + n0), F.col("n1") + F.col("n0")
    gain = F.col("n1") * F.log(F.col("n1") / n / p1) + F.when(
        F.col("n0") > 0, F.col("n0") * F.log(F.col("n0") / n / (1 - p1))).otherwise(0.0)
    a1, a0 = F.col("n1") + 0.5, F.col("n0") + 0.5
    ratio = F.log(a1 / (n1 + 1)) - F.log(a0 / (n0 + 1))
    return (grouped.where(gain >= math.log(tested) + slack).where((ratio >= least) & (F.col("n0") <= impure * n))
            .select("f", ratio.alias("w")).toPandas())


def _corpus_trigrams(texts: DataFrame) -> np.ndarray:
    """Symbol trigram counts of all texts (a table of fixed size)."""
    def run(batches):
        total = np.zeros(SYMBOLS**3, dtype=np.int64)
        for batch in batches:
            for part in text_slices(batch.column("_text"), 300_000):
                total += trigram_counts(part)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["k", "n"])

    rows = texts.mapInArrow(tidy(run), "k bigint, n bigint").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SYMBOLS**3, dtype=np.int64)
    out[rows["k"].to_numpy(dtype=np.int64)] = rows["n"].to_numpy(dtype=np.int64)
    return out


class Scorer:
    """Evidence of a text: the sum over its distinct restored words."""

    def __init__(self, weights: dict[str, float], model: CharModel, prior: float, keep: int = 50_000):
        self.weights, self.model, self.prior, self.keep = weights, model, prior, keep
        self.memo: dict[str, float] = {}
        self.words = [w for w in weights if len(w) > 3 and not w.endswith("^")]

    def _weight(self, word: str) -> float:
        return max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)

    def token(self, token: str) -> float:
        """Evidence of a token of any length: its own, or that of the words that marks join in it."""
        word = token.strip(_EDGE)
        if word.isalpha():
            w = self._weight(word)
            mixed = not word.isascii() and _OTHER.search(word) and _LATIN.search(word)
            if w or not (_REPEAT.search(word) or token[0] in "!|" or mixed):
                return w
        elif not any(c.isalpha() for c in token):
            return 0.0
        tries = {word, token.strip("*")} - {""}            # other marks at the edges may be letters
        whole = max((self._weight(self.model.restore(t)) for t in tries), default=0.0)
        parts = {p for p in _MARKS.split(token) if len(p) > 2} - tries
        return max(whole, sum(self.token(p) for p in parts))

    def text(self, text: str | None) -> float:
        """Probability in 0 to 1; an empty text has no evidence."""
        low = (text or "").lower()
        memo, total = self.memo, 0.0
        if len(memo) > self.keep:
            memo.clear()
        for t in set(low.split()):
            w = memo.get(t)
            if w is None:
                w = memo[t] = self.token(t)
            total += w
        for m in SPACED.finditer(low):
            total += self.spaced(m.group())
        return 1.0 / (1.0 + math.exp(-min(60.0, total + self.prior)))

    def spaced(self, run: str) -> float:
        """Evidence of a run of single signs.  Wider gaps part words where there are any; between them the signs are read as
        one word, as several, and as a string in which learned words stand; the reading with more evidence counts."""
        total = 0.0
        for w in re.split(r"[ \t]{2,}", run):
            signs = "".join(c for c in w if not c.isspace())
            several = sum(self._weight(p) for p in set(self.model.restore(signs, PART).split()))
            one = self.model.restore(signs)
            total += max(self._weight(one), several, sum(self.weights[v] for v in self.words if v in one))
        return total


def score_toxicity(docs: DataFrame, labels: DataFrame, corpus: DataFrame | None = None, text_col: str = "text",
                   id_col: str = "doc_id", per_class: int = 10_000, least: float = 2.0,
                   slack: float = 0.5, impure: float = 0.05, threshold: float = 0.3) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` and ``predicted`` added (columns of these
    names are replaced).

    Learned from labelled rows of ``corpus`` (default: ``docs``) whose id is
    outside the held-out fold, at most ``per_class`` of each class in expectation;
    the character model counts every text of ``docs``.  Null and empty texts
    have no evidence and score the smoothed share of toxic labels.  Rows with a
    null id are scored too and count as not held out unless the fold of the
    empty text says so.  Without labels of both classes nothing is evidence."""
    texts = docs.select(F.col(text_col).cast("string").alias("_text"))
    sample, counts = labelled_sample(corpus if corpus is not None else docs, labels, "toxic", 4, 2, per_class,
                                     text_col, id_col)
    found = _evidence(sample, least, slack, impure)
    trigrams = _corpus_trigrams(texts)
    weights = dict(zip(found["f"], found["w"].astype(float), strict=True))
    words = [f for f in weights if not f.endswith("^")]
    share = (counts.get(1, 0.0) + 0.5) / (sum(counts.values()) + 5)
    prior = min(-1.5, math.log(share / (1 - share)))
    keep = [c for c in docs.columns if c.lower() not in ("held_out", "score", "predicted")]
    schema = docs.select(*keep).schema.add("score", "double")
    at = [c.lower() for c in keep].index(text_col.lower())

    def run(batches):
        scorer = Scorer(weights, CharModel(trigrams, words), prior)
        for batch in batches:
            score = [scorer.text(t) for part in text_slices(batch.column(at).cast(pa.string())) for t in part]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score, pa.float64())], names=[*keep, "score"])

    out = docs.select(*keep).mapInArrow(tidy(run), schema)
    return out.select(*keep, (fold(id_col, 4) == 2).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
