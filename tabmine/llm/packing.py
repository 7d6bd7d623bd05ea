"""Operator 3: conflict-constrained best-fit packing.

Rows are dealt into shards of bounded expected size by a hash of their id, so a
hot source or a hot group of copies is spread evenly.  In a shard rows are taken
by falling length; open bins are ordered by residual room and carry one bitmap
of sources and one of duplicate clusters.  The search starts at the tightest bin
with enough room and goes on to its successors until one has neither the row's
source nor its cluster; without one a new bin is opened."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHARD_ROWS = 1024


def pack(lengths: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Bin number of every item, items taken in the given order.  ``None`` as source or
    cluster conflicts with nothing."""
    bit: tuple[dict, dict] = ({}, {})
    order: list[tuple[int, int]] = []                   # (residual, bin), ascending
    held: list[list[int]] = []                          # bin -> [source bitmap, cluster bitmap]
    out = []
    for n, s, c in zip(lengths, sources, clusters, strict=True):
        sb = 0 if s is None else 1 << bit[0].setdefault(s, len(bit[0]))
        cb = 0 if c is None else 1 << bit[1].setdefault(c, len(bit[1]))
        at = bisect_left(order, (n, -1))
        while at < len(order) and (held[order[at][1]][0] & sb or held[order[at][1]][1] & cb):
            at += 1
        if at < len(order):
            room, b = order.pop(at)
        else:
            room, b = capacity, len(held)
            held.append([0, 0])
        held[b][0] |= sb
        held[b][1] |= cb
        if room > n:
            insort(order, (room - n, b))
        out.append(b)
    return out


def best_fit(docs: DataFrame, capacity: int = 2048, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", cluster: F.Column | None = None, length: F.Column | None = None,
             shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(id, piece, start, length, bin, bin_offset)``: where every piece of every row goes.

    ``length`` (default: UTF-8 bytes / 4 rounded up, a usual token estimate) longer
    than ``capacity`` is cut into pieces of ``capacity`` and a rest; ``start`` is the
    piece's first unit.  Full pieces fill bins of their own.  ``cluster`` (default: a hash of
    the lower-cased text without white space at its edges) marks copies: no bin
    holds two rows of one cluster or of one source.  Rows of length 0 (null or
    empty text) need no room: one row each with null bin.  Null sources conflict with
    nothing; repeated rows are packed one by one, in different bins; rows with a
    null id are packed too.  Other columns are ignored; an empty table gives none."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("_id"), (length if length is not None else F.ceil(F.octet_length(text) / 4)).cast("bigint").alias("_n"),
        F.col(source_col).cast("string").alias("_s"),
        (cluster if cluster is not None else F.md5(F.lower(F.trim(text)))).cast("string").alias("_c"))
    shards = max(1, math.ceil(docs.count() / shard_rows))
    shard = F.pmod(F.xxhash64(F.col("_id"), F.lit(29)), F.lit(shards))
    if dict(docs.dtypes)[id_col] in ("bigint", "int"):  # rows without an id are spread by their text
        shard = F.when(F.col("_id").isNull(), F.pmod(F.xxhash64("_c", F.lit(31)), F.lit(shards))).otherwise(shard)
    rows = rows.withColumn("_shard", shard).withColumn("_n", F.coalesce("_n", F.lit(0)))
    kind = rows.schema["_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        base = int(pdf["_shard"].iloc[0]) << 24
        pdf = pdf.sort_values(["_n", "_id", "_c"], ascending=[False, True, True], kind="stable")
        found, opened = [], 0
        rest = []
        for i, n, s, c in zip(pdf["_id"], pdf["_n"], pdf["_s"], pdf["_c"], strict=True):
            i = None if pd.isna(i) else i
            if not n:
                found.append((i, 0, 0, 0, None, None))
                continue
            full = n // capacity
            for k in range(full):
                found.append((i, k, k * capacity, capacity, base + opened, 0))
                opened += 1
            if n % capacity:
                rest.append((n % capacity, i, full, s, c))
        rest.sort(key=lambda r: -r[0])
        bins = pack([r[0] for r in rest], [r[3] for r in rest], [r[4] for r in rest], capacity)
        used: dict[int, int] = {}
        for (n, i, k, _, _), b in zip(rest, bins, strict=True):
            at = used.get(b, 0)
            found.append((i, k, k * capacity, n, base + opened + b, at))
            used[b] = at + n
        out = pd.DataFrame(found, columns=["id", "piece", "start", "length", "bin", "bin_offset"], dtype=object)
        return out

    out = rows.groupBy("_shard").applyInPandas(
        run, f"id {kind}, piece int, start bigint, length bigint, bin bigint, bin_offset bigint")
    return out.withColumnRenamed("id", id_col)
