"""Shared building blocks: size-checked broadcast and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabmine.session import cut_lineage

# Largest side we broadcast, measured as text: dictionaries and per-column parameter
# tables are far below this; anything above falls back to a shuffle join.
BROADCAST_MAX_BYTES = 16 << 20


def broadcast_checked(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast ``df`` only after measuring its values (bytes as JSON text);
    otherwise return it as is so the planner picks a shuffle join.  ``df`` must be
    cheap to read (a dictionary, a pinned parameter table)."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    n = df.agg(F.sum(F.octet_length(row))).first()[0] or 0
    return F.broadcast(df) if n <= max_bytes else df


def fitted_side(df: DataFrame) -> DataFrame:
    """Small side of a join that attaches fitted values or a few classes to rows:
    pinned, so it is computed once, then ``broadcast_checked``, so the rows are
    not shuffled on a key of a few values."""
    return broadcast_checked(cut_lineage(df))


def shuffled(df: DataFrame) -> DataFrame:
    """Side of a join that grows with the rows: never broadcast.  A broadcast goes through the driver, and the planner takes
    the size of a pinned table's compressed files for its own; an iterative job would send such tables once a round."""
    return df.hint("merge")


def lookup_join(df: DataFrame, lookup: DataFrame, on: Sequence[str] | str, how: str = "left") -> DataFrame:
    """Dictionary / parameter-table join with no hint: adaptive execution
    measures the lookup side when its shuffle stage finishes and switches to a
    broadcast hash join only if that measured size is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``; a larger side stays a
    shuffle join.  (A row count up front would re-run the lookup's whole plan.)"""
    return df.join(lookup, on=on, how=how)


def scalars(one_row: DataFrame) -> dict:
    """Values of a one-row aggregate (fitted parameters), fetched to the driver:
    one row by construction, like a fitted model's coefficients."""
    row = one_row.first()
    return row.asDict() if row is not None else {c: None for c in one_row.columns}


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the values of a one-row aggregate to every row as literals, so the
    consuming projection stays a codegen'd scan with no join."""
    vals = scalars(one_row)
    types = {f.name: f.dataType for f in one_row.schema.fields}
    return df.select("*", *[F.lit(v).cast(types[k]).alias(k) for k, v in vals.items()])


def with_each(df: DataFrame, few: DataFrame, most: int = 10_000) -> DataFrame:
    """Every row of ``df`` with every row of ``few`` (classes, fitted values of each class: at most ``most`` rows, else an
    error): an array of literals and an explode, so the rows of ``df`` are not shuffled."""
    rows = few.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows to attach to every row")
    types = {f.name: f.dataType for f in few.schema.fields}
    items = F.array(*[F.struct(*[F.lit(r[c]).cast(types[c]).alias(c) for c in few.columns]) for r in rows])
    if not rows:
        return df.select("*", *[F.lit(None).cast(t).alias(c) for c, t in types.items()]).limit(0)
    return df.select("*", F.explode(items).alias("_each")).select(*[F.col(f"`{c}`") for c in df.columns], "_each.*")


def prefix_sums(df: DataFrame, order_cols: Sequence[str], sum_cols: Sequence[str],
                group_cols: Sequence[str] = (), ascending: bool = True,
                num_partitions: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Running (inclusive) sums of ``sum_cols`` within ``group_cols`` in the order
    of ``order_cols`` (which must be unique within a group), without putting a
    whole group into one task.

    Rows are range-partitioned on (group, order) and pinned with a reliable
    checkpoint; each range partition sums its rows; a small table of per-partition
    totals gives every partition its offset; a window bounded by one range
    partition adds the local running sum.  The only unbounded-looking window runs
    over (groups x partitions) rows."""
    g = list(group_cols)
    order = [F.col(c).asc() if ascending else F.col(c).desc() for c in order_cols]
    keys = [*[F.col(c) for c in g], *order]
    # without an explicit count, adaptive execution sizes the range exchange to
    # the data; the partition id is read after the exchange, so it is consistent
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys))
    ranged = ranged.withColumn("_pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    totals = ranged.groupBy(*g, "_pid").agg(*[F.sum(c).alias(f"_t_{c}") for c in sum_cols])
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*g, "_pid", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}")
                                          for c in sum_cols])
    local = Window.partitionBy(*g, "_pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = ranged.join(offsets, on=[*g, "_pid"], how="left")   # groups x partitions rows: AQE broadcasts it
    for c in sum_cols:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_o_{c}") + F.sum(c).over(local))
    return out.drop("_pid", *[f"_o_{c}" for c in sum_cols])
