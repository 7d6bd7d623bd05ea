"""Writers and report I/O (IO5-IO8).

Reports are written as one DataFrame per report section (``df.write.json``), so a
report is produced by the executors that computed it and never passes whole
through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def finite_or_null(col: Column) -> Column:
    """IO8 for one value: NaN and +/-Infinity become null."""
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None)).otherwise(col)


def json_value(col: Column, kind: T.DataType) -> Column:
    """IO8 for a value of any type: every float inside of structs, arrays and maps, however deep, goes through
    ``finite_or_null``; null structs, arrays and maps stay null, and map keys become text."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite_or_null(col).cast(kind)
    if isinstance(kind, T.StructType) and kind.fields:
        inner = F.struct(*[json_value(col[f.name], f.dataType).alias(f.name) for f in kind.fields])
        return F.when(col.isNotNull(), inner)
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: json_value(x, kind.elementType)) if _holds_floats(kind) else col
    if isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            col = F.transform_keys(col, lambda k, _: k.cast("string"))
        return F.transform_values(col, lambda _, v: json_value(v, kind.valueType)) if _holds_floats(kind.valueType) else col
    return col


def _holds_floats(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_floats(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _holds_floats(kind.elementType)
    return isinstance(kind, (T.DoubleType, T.FloatType, T.MapType))


def json_safe(df: DataFrame) -> DataFrame:
    """IO8: NaN and infinities become null in every column, at any depth (JSON has neither)."""
    return df.select(*[json_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def document(**sections: DataFrame | list) -> DataFrame:
    """IO6: a nested report as one row, ``document``: a JSON object with a member per section.  A section is a one-row frame (an
    object) or ``[frame, order columns...]`` (an array of objects in that order).  Only for sections of bounded size; IO8 is applied
    at every depth and nulls are written out."""
    parts = None
    for n, (name, section) in enumerate(sections.items()):
        df, *order = [section] if isinstance(section, DataFrame) else section
        safe = json_safe(df.withColumns({f"_o{i}": _rank_key(o) for i, o in enumerate(order)}))
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
        if order:
            key = F.struct(*[F.col(f"_o{i}") for i in range(len(order))], row.alias("_row"))
            value = F.transform(F.sort_array(F.collect_list(key)), lambda x: x["_row"])
        else:
            value = F.first(row)
        one = safe.agg(F.to_json(value, {"ignoreNullFields": "false"}).alias("json")).select(F.lit(n).alias("n"), F.lit(name).alias("name"), "json")
        parts = one if parts is None else parts.unionByName(one)
    members = F.transform(F.sort_array(F.collect_list(F.struct("n", F.concat(F.lit('"'), "name", F.lit('":'), "json").alias("text")))), lambda x: x["text"])
    return parts.agg(F.concat(F.lit("{"), F.array_join(members, ","), F.lit("}")).alias("document"))


def _rank_key(order: Column | str) -> Column:
    """A column to sort by in rising order; a name with a minus before it falls (numbers only)."""
    if isinstance(order, str):
        return -F.col(order[1:]) if order.startswith("-") else F.col(order)
    return order


def write_document(doc: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO6: a ``document`` as JSON text."""
    doc.select("document").coalesce(1).write.mode(mode).text(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """IO5: parquet by default; ``fmt='csv'`` writes a header row."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """IO6: one report section as JSON lines, with IO8 applied."""
    json_safe(df).write.mode(mode).json(path)


def read_report(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """IO7: read a report section back (declare the schema to skip inference)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
