"""Row filters and column repairs.

Null rules follow the reference (a pandas pipeline), not SQL: a membership
exclusion keeps rows whose value is missing, an inequality keeps missing values,
and duplicate detection treats missing keys as equal."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabmine.operators.common import attach_scalars


def first_per_key(df: DataFrame, key: str | Sequence[str], order: str) -> DataFrame:
    """keep the row with the smallest ``order`` per key (null keys form one
    group).  One hash aggregation: partial ``min`` on each map task, so a hot key
    is collapsed before the shuffle instead of landing whole in one task."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c != order]
    # null order values sort last, as in a sort-then-keep-first
    best = F.min(F.struct(F.col(order).isNull().alias("_null"), F.col(order).alias(order),
                          *[F.col(c) for c in rest])).alias("_first")
    return df.groupBy(*keys).agg(best).select(*keys, "_first.*").drop("_null").select(*df.columns)


def not_in(col: str | Column, values: Sequence) -> Column:
    """Membership exclusion that keeps missing values (pandas ``~isin``)."""
    c = F.col(col) if isinstance(col, str) else col
    return ~F.coalesce(c.isin(*values), F.lit(False))


def drop_codes(df: DataFrame, col: str, codes: Sequence) -> DataFrame:
    """Drop rows whose code is in ``codes``; null codes stay."""
    return df.where(not_in(col, codes))


def drop_value(df: DataFrame, col: str, value) -> DataFrame:
    """drop rows equal to ``value``; null stays."""
    return df.where(~F.col(col).eqNullSafe(F.lit(value)))


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """absent names are ignored."""
    return df.drop(*[c for c in columns if c in df.columns])


def fill_categories(df: DataFrame, fills: Mapping[str, str]) -> DataFrame:
    """explicit category for missing values, only for columns that exist."""
    present = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(present) if present else df


def clean_table(df: DataFrame, key: str, order: str, terminal_col: str, terminal_codes: Sequence,
                invalid_col: str, invalid_value, status_columns: Sequence[str] = (),
                fills: Mapping[str, str] | None = None, nzv_kwargs: Mapping | None = None
                ) -> tuple[DataFrame, DataFrame]:
    """first row per key -> terminal codes out -> invalid value out -> drop
    near-zero-variance status columns -> fill categories.  Dedup runs first, so a
    key whose first row is terminal disappears completely.

    Returns ``(cleaned, nzv)`` where ``nzv`` holds A1 metrics of the status
    columns on the filtered rows.  Deciding which columns to drop needs the
    per-column flags on the driver: one row per column."""
    from tabmine.operators.profile import nzv_metrics

    rows = first_per_key(df, key, order)
    rows = drop_codes(rows, terminal_col, terminal_codes)
    rows = drop_value(rows, invalid_col, invalid_value)
    status = [c for c in status_columns if c in rows.columns]
    if status:
        rows = rows.persist()
        nzv = nzv_metrics(rows, status, **(nzv_kwargs or {}))
        dropped = [r["column"] for r in nzv.where("drop").select("column").collect()]
        rows = drop_columns(rows, dropped)
    else:
        nzv = df.sparkSession.createDataFrame(
            [], "column string, fr double, up double, variance double, dominant_p double, "
                "is_nzv boolean, below_var_thresh boolean, drop boolean")
    return fill_categories(rows, fills or {}), nzv


def head_rows(df: DataFrame, order: str | Sequence[str], n: int, round_digits: int | None = None) -> DataFrame:
    """first ``n`` rows by an explicit order (planned as a top-k, not a full
    sort); doubles optionally rounded for a preview."""
    cols = [order] if isinstance(order, str) else list(order)
    out = df.orderBy(*cols).limit(n)
    if round_digits is not None:
        out = out.select(*[F.round(F.col(f.name), round_digits).alias(f.name)
                           if f.dataType.typeName() in ("double", "float") else F.col(f.name)
                           for f in out.schema.fields])
    return out


def string_equals(col: str, value) -> Column:
    """F14 predicate: the value's text equals ``value``'s text (null matches the
    text 'null', as String(null) does)."""
    text = F.coalesce(F.col(col).cast("string"), F.lit("null"))
    return text == F.lit("null" if value is None else str(value))


def drill_down(df: DataFrame, col: str | None, value, order: str, limit: int = 100) -> DataFrame:
    """matching rows (by text) in ``order``, limited, each carrying the total
    match count; the count is a window-free aggregate joined as one value."""
    matches = df.where(string_equals(col, value)) if col else df
    total = matches.agg(F.count(F.lit(1)).alias("match_count"))
    return attach_scalars(matches.orderBy(order).limit(limit), total)


def browse(deleted: DataFrame | None, kept: DataFrame, col: str | None, value, order: str,
           limit: int = 100) -> DataFrame:
    """optional union of deleted and kept rows, optional col=value filter, limit."""
    rows = kept if deleted is None else deleted.unionByName(kept, allowMissingColumns=True)
    if col:
        rows = rows.where(string_equals(col, value))
    return rows.orderBy(order).limit(limit)


def search_columns(profile: DataFrame, text: str, column: str = "column") -> DataFrame:
    """F16: case-insensitive substring search over column names."""
    return profile.where(F.lower(F.col(column)).contains(text.lower()))


def hide_columns(df: DataFrame, hidden: Sequence[str], collapsed_name: str | None = None) -> DataFrame:
    """drop ``hidden`` columns, optionally replacing them by one C9 summary."""
    from tabmine.functions.derive import active_items

    keep = [c for c in df.columns if c not in set(hidden)]
    extra = [active_items([c for c in hidden if c in df.columns]).alias(collapsed_name)] if collapsed_name else []
    return df.select(*keep, *extra)
