"""Operator 12: importance resampling towards a target distribution.

Word n-grams are hashed into a fixed number of buckets; a bucket's gain is the log
ratio of its smoothed shares in the target texts and in the corpus.  A row's weight is the
sum of its features' gains, read from one array, and Gumbel noise from a hash of
its id makes the highest scores a draw without replacement.

The k-th highest key (score, id, row number) comes from a distributed quickselect: random
rows of the live range are pivots, one aggregate counts the rows below, at and above
each, and the range between two pivots that holds the k-th key lives on.  Only
the winners are sorted and ranked, by range partitions."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import text_chunks
from tabmine.operators.common import prefix_sums
from tabmine.session import cut_lineage

BUCKETS = 10_000
#: pivots of a round: the live range shrinks by about this factor
PIVOTS = 24
#: words up to this many bytes are hashed together, longer ones one by one
_LONG = 48

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32                                      # A-Z only, as the word rule says
_WORD = np.zeros(256, dtype=bool)
_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _crc_table() -> np.ndarray:
    """Step of the (reflected, 0xEDB88320) checksum for every byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_STEP = _crc_table()


def _shifts(top: int) -> np.ndarray:
    """``[n, j, b]``: what byte ``j`` of value ``b`` of a checksum adds once ``n`` zero bytes have followed."""
    out = np.zeros((top + 1, 4, 256), dtype=np.uint32)
    for j in range(4):
        out[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    for n in range(1, top + 1):
        out[n] = _STEP[out[n - 1] & 0xFF] ^ (out[n - 1] >> np.uint32(8))
    return out


_SHIFT = _shifts(_LONG + 1)


def _shift(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    return (_SHIFT[n, 0, crc & 0xFF] ^ _SHIFT[n, 1, (crc >> np.uint32(8)) & 0xFF]
            ^ _SHIFT[n, 2, (crc >> np.uint32(16)) & 0xFF] ^ _SHIFT[n, 3, crc >> np.uint32(24)])


def _joined(left: np.ndarray, right: np.ndarray, n: np.ndarray, far: np.ndarray) -> np.ndarray:
    """Checksums of two strings put together; ``n``: bytes of the right one.  ``far`` holds shifts past ``_LONG``."""
    out = np.zeros(len(left), dtype=np.uint32)
    near = n <= _LONG + 1
    out[near] = _shift(left[near], n[near])
    for i in np.flatnonzero(~near).tolist():
        out[i] = far(int(left[i]), int(n[i]))
    return out ^ right


def _far(crc: int, n: int) -> int:
    """A checksum moved past ``n`` bytes, by steps of the largest tabled shift (doubling beyond)."""
    def times(matrix: np.ndarray, c: np.ndarray) -> np.ndarray:
        return matrix[0, c & 0xFF] ^ matrix[1, (c >> np.uint32(8)) & 0xFF] ^ matrix[2, (c >> np.uint32(16)) & 0xFF] ^ matrix[3, c >> np.uint32(24)]

    c, power = np.array([crc], dtype=np.uint32), _SHIFT[1]
    while n:
        if n & 1:
            c = times(power, c)
        n >>= 1
        if n:
            power = times(power, power)
    return int(c[0])


def features(data: np.ndarray, starts: np.ndarray, buckets: int = BUCKETS, width: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of all runs of 1 to ``width`` words, repeats included, of the texts laid end to end in ``data`` (UTF-8)."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n == 0:
        return none, none
    data = _FOLD[data]
    word = _WORD[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[starts[starts < n]] = True
    edge[n] = True
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:n]
    last[:-1] &= ~word[1:] | edge[1:n]
    b, size = np.flatnonzero(first), np.flatnonzero(last) + 1
    size = size - b
    row = np.searchsorted(starts, b, side="right") - 1
    crc = np.full(len(b), 0xFFFFFFFF, dtype=np.uint32)
    live = np.flatnonzero(size <= _LONG)
    k = 0
    while len(live):
        crc[live] = _STEP[(crc[live] ^ data[b[live] + k]) & 0xFF] ^ (crc[live] >> np.uint32(8))
        k += 1
        live = live[size[live] > k]
    crc ^= np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > _LONG).tolist():
        crc[i] = zlib.crc32(data[b[i]:b[i] + size[i]])
    rows, found = [row], [crc]
    space = np.full(len(b), zlib.crc32(b" "), dtype=np.uint32)
    tail, tail_n, tail_at = _joined(space, crc, size, _far), size + 1, np.arange(len(b))     # " word"
    part, part_n = tail, tail_n
    for m in range(1, width):
        if len(b) <= m:
            break
        # runs of m words, a space before them, behind every word that has m more in its text
        ok = row[:-m] == row[m:]
        head = np.flatnonzero(ok)
        rows.append(row[head])
        found.append(_joined(crc[head], part[head + 1], part_n[head + 1], _far))
        if m + 1 < width:
            at = np.flatnonzero(np.append(ok, np.zeros(m, dtype=bool)))           # " word" put before the run that follows
            longer, longer_n = np.zeros(len(b), dtype=np.uint32), np.zeros(len(b), dtype=np.int64)
            longer[at] = _joined(tail[at], part[at + 1], part_n[at + 1], _far)
            longer_n[at] = tail_n[at] + part_n[at + 1]
            part, part_n = longer, longer_n
    return np.concatenate(rows), (np.concatenate(found) % np.uint32(buckets)).astype(np.int64)


def bucket_counts(texts: DataFrame, text_col: str, buckets: int = BUCKETS, width: int = 3) -> DataFrame:
    """``(bucket, n)``: how many features of all texts fall into each bucket (buckets without any are left out)."""
    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, data, starts in text_chunks(batch.column("_text")):
                total += np.bincount(features(data, starts, buckets, width)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    found = texts.select(F.col(text_col).cast("string").alias("_text")).mapInArrow(run, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """Gain of every bucket in thousandths; the driver gets one row per bucket, a fixed number."""
    s = {r["bucket"]: r["n"] for r in corpus.collect()}
    t = {r["bucket"]: r["n"] for r in target.collect()}
    all_s, all_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((t.get(k, 0) + 1) * all_s / ((s.get(k, 0) + 1) * all_t))) for k in range(buckets)]


def gumbel_noise(id_col: str = "doc_id", seed: int = 42) -> Column:
    """Noise of a row in thousandths, from a hash of ``seed:id`` (a null id counts as empty text)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("bigint")


def _key() -> Column:
    """Composite key of a row: score falling, id rising with null first, row number."""
    return F.struct((-F.col("score")).alias("s"), F.col("_id").alias("i"), F.col("_row").alias("r"))


def _at(p: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("bigint").alias(n) for v, n in zip(p, "sir", strict=True)])


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = 12) -> tuple:
    """The ``k``-th key (from 1) of ``keys(score, _id, _row)`` by distributed quickselect, as ``(-score, _id, _row)``.

    Each round draws ``pivots`` rows of the live range by a hash (a bounded top list), counts the rows before,
    at and after each of them in one aggregate, and goes on between the two that enclose the ``k``-th.  Keys are unique by
    their row number, so a range of at most ``pivots`` rows ends it."""
    low, high, before, turn = None, None, 0, 0          # the k-th lies after low and before high; ``before``: rows up to low
    while True:
        live = keys.select("_row", _key().alias("key"))
        if low is not None:
            live = live.where(F.col("key") > _at(low))
        if high is not None:
            live = live.where(F.col("key") < _at(high))
        drawn = [tuple(r["key"]) for r in live.orderBy(F.xxhash64("_row", F.lit(seed + turn)), "_row").limit(pivots).collect()]
        drawn.sort(key=lambda p: (p[0], p[1] is not None, p[1] or 0, p[2]))
        # pivots up to the row's key and before it: even between two pivots, odd at one
        marks = F.array(*[_at(p) for p in drawn])
        slot = F.size(F.filter(marks, lambda p: p <= F.col("key"))) + F.size(F.filter(marks, lambda p: p < F.col("key")))
        seen = {r["slot"]: r["count"] for r in live.select(slot.alias("slot")).groupBy("slot").count().collect()}
        at = before
        for i, p in enumerate(drawn):
            at += seen.get(2 * i, 0)                    # rows between pivot i - 1 and pivot i
            if at >= k:
                high = p
                break
            at += seen[2 * i + 1]                       # the pivot itself
            if at >= k:
                return p
            low, before = p, at
        turn += 1


def importance_resample(docs: DataFrame, target: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                        target_col: str = "text", least_words: int = 20, percent: int = 5, seed: int = 42,
                        buckets: int = BUCKETS) -> DataFrame:
    """``(id, n_features, weight, score, rank)`` per row of ``docs``: of the rows with at least ``least_words`` words,
    ``percent`` of 100 (rounded down) with the highest scores are ranked 1, 2, 3, ...; ties go to the smaller id; all others have no rank.

    Null and empty texts have no features, weight 0 and are never drawn; they still have a score.  Rows with a null id are
    drawn like others and come first among ties; repeated rows are rows of their own (which of two equal ones comes
    first is left open, their ranks differ).  Other columns are ignored, so their names cannot clash; an
    empty table gives no rows; without target texts all gains follow from the corpus alone."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets), buckets)
    gain = np.array(gains, dtype=np.int64)
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("_text"))

    def run(batches):
        for batch in batches:
            parts = []
            for _, data, starts in text_chunks(batch.column("_text")):
                rows, found = features(data, starts, buckets)
                m = len(starts)
                n = np.bincount(rows, minlength=m)
                # float sums of whole numbers are exact below 2**53
                parts.append((n, np.bincount(rows, weights=gain[found], minlength=m).astype(np.int64)))
            n = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int64)
            weight = np.concatenate([p[1] for p in parts]) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("_id"), pa.array(n.astype(np.int64)), pa.array(weight)],
                                             names=["_id", "n_features", "weight"])

    scored = texts.mapInArrow(run, "_id bigint, n_features bigint, weight bigint")
    scored = scored.withColumn("score", F.col("weight") + gumbel_noise("_id", seed)).withColumn("_row", F.monotonically_increasing_id())
    scored = cut_lineage(scored)
    # n words have 3n - 3 features from two words on
    able = F.col("n_features") >= (3 * least_words - 3 if least_words > 1 else least_words)
    eligible = scored.where(able)
    k = percent * eligible.count() // 100
    none = F.lit(None).cast("bigint").alias("rank")
    out = ["_id", "n_features", "weight", "score"]
    if k == 0:
        return scored.select(F.col("_id").alias(id_col), *out[1:], none)
    last = kth_key(eligible.select("score", "_id", "_row"), k)
    won = able & (_key() <= _at(last))
    winners = scored.where(won).select("*", (-F.col("score")).alias("_down"), F.lit(1).alias("_one"))
    ranked = prefix_sums(winners, ["_down", "_id", "_row"], ["_one"]).select(*out, F.col("cum__one").cast("bigint").alias("rank"))
    return ranked.unionByName(scored.where(~won).select(*out, none)).withColumnRenamed("_id", id_col)
