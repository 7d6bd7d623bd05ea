"""Operator 11: quality rules as a learned decision list.

Sequential covering over labelled text statistics: a rule, a conjunction of
``statistic >= t`` and ``statistic <= t``, is grown one condition at a time by
information gain on two thirds of the rows that are left, pruned from its end on the
other third, and kept while it is right more often than not; the rows it
covers are taken out and the next rule is sought.  The list becomes one ordered
Spark conditional expression over the statistics' columns.

Statistics are counted over whole texts inside the tasks; the learner sees a bounded
sample of their rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import _BYTE, _SEP, _powers, mix64, small_side, text_chunks
from tabmine.llm.labels import fold
from tabmine.session import cut_lineage

#: signs counted by ``n_symbols`` (fixed values)
SYMBOLS = "#*$%&|<>"
#: counts of a text, in this order
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_same_next", "n_upper",
          "n_letters", "n_digits", "n_marks", "n_lines"]


def _among(chars: str) -> np.ndarray:
    found = np.zeros(256, dtype=bool)
    found[[ord(c) for c in chars]] = True
    return found


_SYMBOL = _among(SYMBOLS)
_UPPER = _among("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _UPPER | _among("abcdefghijklmnopqrstuvwxyz")
_DIGIT = _among("0123456789")
_MARK = np.zeros(256, dtype=bool)
_MARK[33:127] = True
_MARK &= ~(_LETTER | _DIGIT)


def _repeats(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """How often each ``(row, h)`` occurs."""
    _, inv, n = np.unique(mix64(h + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)),
                          return_inverse=True, return_counts=True)
    return n[inv]


def text_counts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """``COUNTS`` of every text of a run of UTF-8 bytes: an array (text, count)."""
    n, n_docs = len(data), len(starts)
    out = np.zeros((n_docs, len(COUNTS)), dtype=np.int64)
    if n == 0:
        return out

    def per_text(rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=n_docs)

    edge = np.zeros(n + 1, dtype=bool)
    edge[starts[starts < n]] = True
    edge[n] = True
    word = ~_SEP[data]
    owner = np.searchsorted(starts, np.arange(n), side="right") - 1
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last[:-1] &= ~word[1:] | edge[1:n]
    b, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(n + 1)
    acc = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=acc[1:])

    def hashed(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return mix64(mix64((acc[hi] - acc[lo]) * down[lo]) + (hi - lo).astype(np.uint64))

    h, row = hashed(b, e), owner[b]
    m = len(h)
    same = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    twice = np.zeros(m, dtype=bool)
    if m >= 3:
        at = np.flatnonzero(row[2:] == row[:-2])
        triple = mix64(mix64(mix64(h[at]) + h[at + 1]) + h[at + 2])
        again = at[_repeats(row[at], triple) > 1]
        for k in range(3):
            twice[again + k] = True
    line = np.union1d(starts[starts < n], np.flatnonzero(data == 10) + 1)
    line = line[line < n]
    stop = np.append(line[1:], n)
    stop = stop - (data[stop - 1] == 10)
    seen = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(word, out=seen[1:])
    worded = seen[stop] > seen[line]
    line, stop = line[worded], stop[worded]
    line_row = owner[line]
    keys = np.unique(np.stack([line_row.astype(np.uint64), hashed(line, stop)], 1), axis=0)
    lines = per_text(line_row)
    words = np.unique(np.stack([row.astype(np.uint64), h], 1), axis=0)
    out[:, 0] = per_text(row)
    out[:, 1] = per_text(owner[word & ((data & 0xC0) != 0x80)])
    out[:, 2] = per_text(owner[_SYMBOL[data]])
    out[:, 3] = lines - per_text(keys[:, 0].astype(np.int64))
    out[:, 4] = per_text(row[twice])
    out[:, 5] = per_text(words[:, 0].astype(np.int64))
    out[:, 6] = per_text(row[1:][same])
    for k, among in enumerate((_UPPER, _LETTER, _DIGIT, _MARK)):
        out[:, 7 + k] = per_text(owner[among[data]])
    out[:, 11] = lines
    return out


def text_statistics(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``id`` and ``COUNTS`` of every row's whole text (a null text has none of anything)."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            parts = [text_counts(data, starts) for _, data, starts in text_chunks(batch.column("_text"))]
            got = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), *[pa.array(got[:, k]) for k in range(len(COUNTS))]],
                                             names=["_id", *COUNTS])

    out = texts.mapInArrow(run, "_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))
    return out.withColumnRenamed("_id", id_col)


def _per_mille(part: str, whole: str) -> Column:
    return F.floor(1000 * F.col(part) / F.greatest(F.col(whole), F.lit(1))).cast("bigint")


def statistics() -> dict[str, Column]:
    """What rules may test: whole numbers over the columns of ``text_statistics``."""
    return {
        "n_words": F.col("n_words"),
        "chars_per_1000_words": _per_mille("word_chars", "n_words"),
        "symbols_per_mille": _per_mille("n_symbols", "word_chars"),
        "marks_per_mille": _per_mille("n_marks", "word_chars"),
        "upper_per_mille": _per_mille("n_upper", "n_letters"),
        "digits_per_mille": _per_mille("n_digits", "word_chars"),
        "dup_lines_per_mille": _per_mille("n_dup_lines", "n_lines"),
        "repeat_words_per_mille": _per_mille("n_repeat_words", "n_words"),
        "distinct_per_mille": _per_mille("n_distinct", "n_words"),
        "same_next_per_mille": _per_mille("n_same_next", "n_words"),
        "words_per_line": F.floor(F.col("n_words") / F.greatest(F.col("n_lines"), F.lit(1))).cast("bigint"),
    }


@dataclass(frozen=True)
class Condition:
    """``statistic >= value`` or ``statistic <= value``."""

    statistic: str
    sign: str
    value: int

    def holds(self, x: np.ndarray) -> np.ndarray:
        return x >= self.value if self.sign == ">=" else x <= self.value

    def column(self, stats: dict[str, Column]) -> Column:
        c = stats[self.statistic]
        return c >= self.value if self.sign == ">=" else c <= self.value

    def __str__(self) -> str:
        return f"{self.statistic} {self.sign} {self.value}"


@dataclass
class DecisionList:
    """Ordered rules, all for class ``target``; rows that none covers are of the other class."""

    target: int
    rules: list[list[Condition]] = field(default_factory=list)

    def verdict(self, stats: dict[str, Column] | None = None) -> Column:
        """Class of a row as one ordered conditional expression."""
        return self._when(stats, [self.target] * len(self.rules), 1 - self.target)

    def rule_number(self, stats: dict[str, Column] | None = None) -> Column:
        """Number (from 1) of the first rule that covers a row, else null."""
        return self._when(stats, list(range(1, len(self.rules) + 1)), None)

    def _when(self, stats, values, other) -> Column:
        stats = stats or statistics()
        out = None
        for rule, value in zip(self.rules, values, strict=True):
            cond = rule[0].column(stats)
            for c in rule[1:]:
                cond = cond & c.column(stats)
            out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
        return (F.lit(other) if out is None else out.otherwise(F.lit(other))).cast("int")

    def covers(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        return np.any([_covered(r, x, names) for r in self.rules], axis=0) if self.rules else np.zeros(len(x), dtype=bool)

    def __str__(self) -> str:
        lines = [f"if {' and '.join(map(str, r))}: {self.target}" for r in self.rules]
        return "\n".join([*lines, f"else: {1 - self.target}"])


def _covered(rule: list[Condition], x: np.ndarray, names: list[str]) -> np.ndarray:
    ok = np.ones(len(x), dtype=bool)
    for c in rule:
        ok &= c.holds(x[:, names.index(c.statistic)])
    return ok


def _best_condition(x: np.ndarray, y: np.ndarray, w: np.ndarray, names: list[str]) -> Condition | None:
    """The threshold with the greatest gain ``p * (log2(p / (p + n)) - log2(P / (P + N)))``; thresholds lie
    half way between neighbouring values, ties go to the first statistic and the lowest threshold."""
    wp, wn = w * y, w * (1 - y)
    total_p, total_n = wp.sum(), wn.sum()
    before = np.log2(total_p / (total_p + total_n))
    best, gain = None, 1e-9
    for k, name in enumerate(names):
        values, inv = np.unique(x[:, k], return_inverse=True)
        if len(values) < 2:
            continue
        below_p = np.cumsum(np.bincount(inv, weights=wp))[:-1]
        below_n = np.cumsum(np.bincount(inv, weights=wn))[:-1]
        for sign, p, n in (("<=", below_p, below_n), (">=", total_p - below_p, total_n - below_n)):
            with np.errstate(divide="ignore", invalid="ignore"):
                got = np.where(p > 0, p * (np.log2(p / (p + n)) - before), -np.inf)
            i = int(np.argmax(got))
            if got[i] > gain + 1e-9:
                low, high = int(values[i]), int(values[i + 1])
                best, gain = Condition(name, sign, (low + high) // 2 if sign == "<=" else (low + high) // 2 + 1), got[i]
    return best


def learn(x: np.ndarray, y: np.ndarray, w: np.ndarray, names: list[str], least: float = 3.0, most_conditions: int = 5,
          most_rules: int = 30, seed: int = 11) -> DecisionList:
    """Decision list for the rarer class of ``y`` (0 or 1) over the rows of ``x``, weighted by ``w``.

    Rows are put in a defined order first, so the list does not depend on how they arrived.  ``least``: weight of the target's
    rows that a rule has to cover.  Without rows of both classes there are no rules."""
    ones, zeros = w[y == 1].sum(), w[y == 0].sum()
    target = 0 if zeros <= ones else 1
    found = DecisionList(target)
    if min(ones, zeros) <= 0:
        return DecisionList(0)                          # nothing to tell apart: all rows are of class 1
    order = np.lexsort([*x.T[::-1], y])
    x, w, t = x[order], w[order].astype(float), (y[order] == target).astype(float)
    part = np.random.default_rng(seed).random(len(t)) < 2 / 3
    left = np.ones(len(t), dtype=bool)
    while len(found.rules) < most_rules and w[left] @ t[left] >= least:
        grow = left & part
        rule: list[Condition] = []
        inside = grow.copy()
        while len(rule) < most_conditions and w[inside] @ t[inside] > 0 and w[inside] @ (1 - t[inside]) > 0:
            c = _best_condition(x[inside], t[inside], w[inside], names)
            if c is None:
                break
            rule.append(c)
            inside &= c.holds(x[:, names.index(c.statistic)])
        check = left & ~part

        def worth(r: list[Condition]) -> float:
            ok = check & _covered(r, x, names)
            p, n = w[ok] @ t[ok], w[ok] @ (1 - t[ok])
            return (p - n) / (p + n) if p + n else -1.0

        lengths = sorted(range(1, len(rule) + 1), key=lambda k: (-worth(rule[:k]), k))
        rule = rule[:lengths[0]] if lengths else []
        ok = left & _covered(rule, x, names)
        p, n = w[ok] @ t[ok], w[ok] @ (1 - t[ok])
        if not rule or p < least or p <= n or worth(rule) <= 0:
            break
        found.rules.append(rule)
        left &= ~ok
    return found


def labelled_statistics(stats: DataFrame, labels: DataFrame, label: str, mod: int, held: int, per_class: int,
                        id_col: str = "doc_id") -> DataFrame:
    """``(y, w, <statistics>)``: the distinct statistics rows of labelled texts outside the held-out fold, with how many
    texts have them.  Each class is thinned by a hash of the row to ``per_class`` rows in expectation, so the bound
    holds where many rows share one id too.  Ids with labels of both classes, null ids and labels other than 0 and 1 are left out."""
    y = labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label).cast("int").alias("y"))
    y = y.where(F.col("_id").isNotNull() & F.col("y").isin(0, 1)).where(fold("_id", mod) != held)
    y = y.groupBy("_id").agg(F.min("y").alias("y"), F.max("y").alias("_y")).where("y = _y").drop("_y")
    names = list(statistics())
    rows = stats.select(F.col(id_col).alias("_id"), *[c.alias(f"s_{n}") for n, c in statistics().items()])
    rows = rows.join(small_side(cut_lineage(y)), "_id").groupBy("y", *[f"s_{n}" for n in names]).agg(F.count(F.lit(1)).alias("w"))
    rows = cut_lineage(rows)
    counts = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    level = F.pmod(F.xxhash64(*[f"s_{n}" for n in names]), F.lit(1_000_000)) / 1_000_000
    share = F.when(F.col("y") == 1, min(1.0, per_class / max(counts.get(1, 0), 1))).otherwise(min(1.0, per_class / max(counts.get(0, 0), 1)))
    # a thinned class stands for its whole weight
    return rows.where(level < share).select("y", (F.col("w") / share).alias("w"), *[F.col(f"s_{n}").alias(n) for n in names])


def fit_rules(stats: DataFrame, labels: DataFrame, label: str = "quality", mod: int = 5, held: int = 0,
              per_class: int = 20_000, id_col: str = "doc_id", **kw) -> DecisionList:
    """Decision list from at most ``per_class`` statistics rows of each class in expectation (the bound of the fit)."""
    names = list(statistics())
    got = labelled_statistics(stats, labels, label, mod, held, per_class, id_col).toPandas()
    return learn(got[names].to_numpy(np.int64).reshape(-1, len(names)), got["y"].to_numpy(np.int64), got["w"].to_numpy(float), names, **kw)


def quality_rules(docs: DataFrame, labels: DataFrame, label: str = "quality", text_col: str = "text", id_col: str = "doc_id",
                  least_words: int = 50, repeat_percent: int = 50, **fit) -> DataFrame:
    """``(id, COUNTS, base_failed, rule, kept)`` per row of ``docs``.

    ``base_failed``: fewer than ``least_words`` words, or more than ``repeat_percent`` of 100 words in repeated 3-word windows.
    ``rule``: the number of the learned rule that covers the text, if any; ``kept``: neither failed nor of class 0 by the list.
    Null and empty texts have no words and fail the base; a null id is no hindrance (it has no label).  Repeated rows are returned
    as often as they occur; other columns are ignored, so their names cannot clash; an empty table gives no rows.  Where the
    labels do not hold both classes there are no rules and the base alone decides."""
    stats = cut_lineage(text_statistics(docs, text_col, id_col))
    found = fit_rules(stats, labels, label, id_col=id_col, **fit)
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return stats.select(id_col, *COUNTS, failed.alias("base_failed"), found.rule_number().alias("rule"),
                        (~failed & (found.verdict() == 1)).alias("kept"))
