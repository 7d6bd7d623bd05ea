"""Labelled rows for the two classifiers: the fold rule and a bounded sample."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabmine.llm.common import mix64, text_chunks, tidy
from tabmine.llm.jaccard import shingle_sets
from tabmine.session import cut_lineage


def fold(id_col: str, mod: int) -> F.Column:
    """``crc32(id as text) mod`` of a row (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % mod


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int, per_class: int,
                    text_col: str = "text", id_col: str = "doc_id") -> tuple[DataFrame, dict[int, float]]:
    """``(_id, text, y)`` of labelled rows outside the held-out fold, and the class counts
    of all such rows.  Each class is thinned by a hash of the id to ``per_class``
    rows in expectation: the documented bound of a fit.  Null ids and labels
    other than 0 and 1 are left out."""
    y = labels.select(F.col(id_col).cast("bigint").alias("_id"), F.col(label).cast("int").alias("y"))
    y = y.where(F.col("_id").isNotNull() & F.col("y").isin(0, 1)).where(fold("_id", mod) != held).distinct()
    counts = {r["y"]: float(r["count"]) for r in y.groupBy("y").count().collect()}
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    level = F.pmod(F.xxhash64("_id", F.lit(17)), F.lit(1_000_000)) / 1_000_000
    y = cut_lineage(y.where(level < F.when(F.col("y") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), F.col(text_col).cast("string").alias("text"))
    return rows.join(F.broadcast(y), "_id").select("_id", "text", "y"), counts   # at most 2 x per_class rows


def without_copies(sample: DataFrame, seeds: int = 6) -> DataFrame:
    """The sample with one row of each group of near copies: copies share the words of one
    text, which would pass for evidence.  Rows of a class that agree on any of ``seeds``
    min-hashes of 3-word shingles count as copies; the smallest id stays.
    Only the min-hashes of the (bounded) sample reach the driver."""
    def run(batches):
        for pdf in batches:
            mins = np.full((len(pdf), seeds), np.uint64(2**64 - 1))
            for i, data, starts in text_chunks(pa.array(pdf["text"], pa.large_string())):
                rows, sh, sizes = shingle_sets(data, starts, 3)
                has = np.flatnonzero(sizes)
                cut = np.searchsorted(rows, has)
                for k in range(seeds):
                    if len(has):
                        mins[i + has, k] = np.minimum.reduceat(mix64(sh + np.uint64(k * 0x9E3779B97F4A7C15 % 2**64)), cut)
            out = pd.DataFrame(mins.view(np.int64), columns=[f"m{k}" for k in range(seeds)])
            yield out.assign(_id=pdf["_id"].to_numpy(), y=pdf["y"].to_numpy())

    cols = ", ".join(f"m{k} bigint" for k in range(seeds))
    got = sample.mapInPandas(tidy(run), f"{cols}, _id bigint, y int").toPandas().sort_values("_id", kind="stable")
    for k in range(seeds):
        got = got[(got[f"m{k}"] == -1) | ~got.duplicated(["y", f"m{k}"])]
    ids = sample.sparkSession.createDataFrame([(int(i),) for i in sorted(set(got["_id"]))], "_id bigint")
    return sample.join(F.broadcast(ids), "_id").dropDuplicates(["_id", "y"])
