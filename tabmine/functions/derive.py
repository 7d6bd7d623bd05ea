"""Per-row derived columns (C1-C17) as Column expressions.

Everything here is a built-in Spark expression, so it stays inside whole-stage
codegen and works unchanged on a streaming DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# Diagnosis groups, tested in this order; each is (label, closed ranges, single codes).
ICD9_GROUPS = [
    ("Circulatory", [(390, 459)], [785]),
    ("Respiratory", [(460, 519)], [786]),
    ("Digestive", [(520, 579)], [787]),
    ("Diabetes", "floor=250", []),
    ("Injury", [(800, 999)], []),
    ("Musculoskeletal", [(710, 739)], []),
    ("Genitourinary", [(580, 629)], [788]),
    ("Neoplasms", [(140, 239)], []),
]
ICD9_OTHER = "Other"
# Age brackets and their midpoints.
AGE_MIDPOINTS = {
    "[0-10)": 5, "[10-20)": 15, "[20-30)": 25, "[30-40)": 35, "[40-50)": 45,
    "[50-60)": 55, "[60-70)": 65, "[70-80)": 75, "[80-90)": 85, "[90-100)": 95,
}
# Status values that count as a medication change.
CHANGE_VALUES = ["Up", "Down"]
# ---------------------------------------------------------------------------

# A string Python's float() accepts (after trimming), minus inf/nan spellings
# which never fall in a group anyway.
NUMBER_RE = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_ws(col: str | Column) -> Column:
    """Trim all leading/trailing whitespace (Spark's ``trim`` only removes spaces)."""
    return F.regexp_replace(_c(col).cast("string"), r"^\s+|\s+$", "")


def parse_number(col: str | Column) -> Column:
    """Strict numeric parse: null unless the trimmed text is a plain decimal number
    (so ``'250d'`` and ``'nan'`` are not numbers, unlike a bare cast)."""
    s = strip_ws(col)
    return F.when(s.rlike(NUMBER_RE), s.try_cast("double"))


def icd9_group(col: str | Column) -> Column:
    """Diagnosis code -> one of nine groups.  Null, blank, 'nan', 'unknown',
    codes starting with V or E, and non-numbers are Other; ranges compare the
    parsed float, so 459.5 is Other."""
    s = strip_ws(col)
    n = parse_number(col)
    invalid = (s.isNull() | (s == "") | F.lower(s).isin("nan", "unknown")
               | s.startswith("V") | s.startswith("E") | n.isNull())
    expr = F.when(invalid, F.lit(ICD9_OTHER))
    for label, ranges, singles in ICD9_GROUPS:
        if ranges == "floor=250":
            cond = F.floor(n) == 250
        else:
            cond = F.lit(False)
            for lo, hi in ranges:
                cond = cond | n.between(lo, hi)
            for v in singles:
                cond = cond | (n == v)
        expr = expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(ICD9_OTHER))


def age_midpoint(col: str | Column) -> Column:
    """Age bracket -> midpoint (double); anything else -> null."""
    m = F.create_map(*[x for k, v in AGE_MIDPOINTS.items() for x in (F.lit(k), F.lit(float(v)))])
    return F.element_at(m, _c(col).cast("string"))


def change_count(columns: Sequence[str]) -> Column:
    """Number of the given status columns equal to Up or Down (0 if none)."""
    if not columns:
        return F.lit(0)
    total = None
    for c in columns:
        term = F.when(F.col(c).isin(*CHANGE_VALUES), 1).otherwise(0)
        total = term if total is None else total + term
    return total


def binary_target(df: DataFrame, col: str, positive: str) -> Column:
    """C4: 1 where ``col == positive`` else 0 (null -> 0); the column must exist."""
    if col not in df.columns:
        raise ValueError(f"expected target column {col!r}")
    return F.coalesce((F.col(col).cast("string") == F.lit(positive)).cast("int"), F.lit(0))


def _as_number(col: str | Column) -> Column:
    return parse_number(_c(col).cast("string"))


def stay_bucket(col: str | Column) -> Column:
    """<=3 '1-3', <=6 '4-6', else '7+'; non-numeric 'unknown'."""
    n = _as_number(col)
    return (F.when(n.isNull(), "unknown").when(n <= 3, "1-3").when(n <= 6, "4-6").otherwise("7+"))


def visit_bucket(col: str | Column) -> Column:
    """<=0 '0', ==1 '1', else '2+' (so 0.5 -> '2+'); non-numeric 'unknown'."""
    n = _as_number(col)
    return (F.when(n.isNull(), "unknown").when(n <= 0, "0").when(n == 1, "1").otherwise("2+"))


def normalized_id(col: str | Column) -> Column:
    """C7 key: id text normalised through float -> int ('3.0' -> '3'); else null."""
    return _as_number(col).try_cast("bigint").cast("string")


def active_items(columns: Sequence[str], inactive: str = "No", sep: str = ", ") -> Column:
    """C9: 'name: status' for each status column that is present and not ``inactive``."""
    if not columns:
        return F.lit("")
    arr = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns])
    kept = F.filter(arr, lambda x: x["value"].isNotNull() & (x["value"] != inactive))
    return F.array_join(F.transform(kept, lambda x: F.concat(x["name"], F.lit(": "), x["value"])), sep)


def zscore_band(col: str | Column, mean: Column, std: Column) -> Column:
    """C10: 'high' if z > 1, 'low' if z < -1, else null; std 0 or null -> null."""
    z = F.try_divide(_c(col) - mean, F.when(std != 0, std))
    return F.when(z > 1, "high").when(z < -1, "low")


def itemize(columns: Sequence[str], bucketers: Mapping[str, callable] | None = None) -> Column:
    """C11: a row as ``col=value`` items, skipping nulls; ``bucketers`` maps a
    column to a Column function applied first (C5/C6)."""
    bucketers = bucketers or {}
    items = []
    for c in columns:
        v = bucketers[c](F.col(c)) if c in bucketers else F.col(c).cast("string")
        items.append(F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{c}="), v)))
    return F.array_compact(F.array(*items))


def run_signature(model: str | Column, params: str | Column) -> Column:
    """``model::k=v|k=v`` with keys sorted; ``params`` is a map<string,string>."""
    entries = F.array_sort(F.map_entries(_c(params)))
    body = F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    return F.concat(_c(model).cast("string"), F.lit("::"), F.coalesce(body, F.lit("")))
