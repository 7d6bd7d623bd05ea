"""Readers (IO1-IO4).

* delimited files are read with an explicit schema and an explicit missing token;
  nothing is inferred, so a 100 TB read does not start with a sampling pass;
* the lookup file is a small multi-section text file; it is parsed with DataFrame
  functions, and the only ordered window runs over that file's few lines.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_WS = r"^\s+|\s+$"


def min_parallelism(spark: SparkSession) -> int:
    """Total task slots of the application (cores), not the shuffle partition count."""
    return int(spark.sparkContext.defaultParallelism)


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Round-robin the rows over ``partitions`` (default: the application's
    cores) when the scan yields fewer splits than that -- one small file is a
    single split, so every wide operator after it would run in one task.  A
    large table already has many splits and is returned unchanged (no shuffle)."""
    n = partitions or min_parallelism(df.sparkSession)
    return df.repartition(n) if df.rdd.getNumPartitions() < n else df


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet table ``<sf_dir>/<name>.parquet``; ``columns`` prunes the scan
    (the projection reaches the Parquet reader), then ``spread``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df.select(*columns) if columns else df)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, missing_token: str = "?",
                   header: bool = True, sep: str = ",") -> DataFrame:
    """IO1: typed read where only ``missing_token`` (and an unquoted empty field,
    Spark's rule) means missing; tokens such as ``None`` or ``NA`` stay values."""
    return (spark.read.schema(schema).option("header", header).option("sep", sep)
            .option("nullValue", missing_token).option("mode", "PERMISSIVE").csv(path))


def read_delimited_exact(spark: SparkSession, path: str, schema: T.StructType, missing_token: str | None = "?", header: bool = True,
                         sep: str = ",", multi_line: bool = False, empty_is_missing: bool = False) -> DataFrame:
    """IO1 by the exact missing rule: only a field that is ``missing_token`` is missing; an empty field, quoted or not, is the
    empty text; a field that a short row lacks is missing.  Empty text in a column that is no text cannot be a value and is null too.

    Spark's reader takes every unquoted empty field for its null token, so that token is set to a text that no field can
    hold, empty fields are put back afterwards, and the token is compared in the projection.  A row with the wrong number
    of fields comes with its raw record; the separators outside of quotes tell how many fields it has.  ``multi_line``: line
    ends may stand inside quotes (such files are not split)."""
    record, nothing = "_tabmine_record", "\u0000\u0001tabmine\u0001\u0000"
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields] + [T.StructField(record, T.StringType())])
    raw = (spark.read.schema(text).option("header", header).option("enforceSchema", True).option("sep", sep).option("nullValue", nothing)
           .option("emptyValue", "").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", record)
           .option("escape", '"').option("multiLine", multi_line).csv(path))
    outside = F.regexp_replace(F.col(record), r'"(?:[^"]|"")*"', "")
    fields = F.when(F.col(record).isNull(), F.lit(len(schema.fields))).otherwise(F.length(outside) - F.length(F.replace(outside, F.lit(sep), F.lit(""))) + 1)
    out = []
    for i, f in enumerate(schema.fields):
        value = F.col(f"`{f.name}`")
        if not empty_is_missing:
            value = F.when(value.isNull() & (fields > i), F.lit("")).otherwise(value)
        if missing_token is not None:
            value = F.nullif(value, F.lit(missing_token))
        out.append((value if isinstance(f.dataType, T.StringType) else value.try_cast(f.dataType)).alias(f.name))
    return raw.select(*out)


def read_delimited_as_strings(spark: SparkSession, path: str, columns: Sequence[str], missing_token: str = "?",
                              header: bool = True, sep: str = ",") -> DataFrame:
    """IO2: the raw string view used for distinct counts and distribution labels."""
    schema = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    return read_delimited(spark, path, schema, missing_token, header, sep)


def with_missing_token(df: DataFrame, token: str, columns: Iterable[str] | None = None) -> DataFrame:
    """IO2 on an existing table: ``token`` becomes null in the (string) columns."""
    cols = set(columns) if columns is not None else {f.name for f in df.schema.fields
                                                     if isinstance(f.dataType, T.StringType)}
    return df.select(*[F.nullif(F.col(c), F.lit(token)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def read_model_ready(spark: SparkSession, path: str) -> DataFrame:
    """IO4: the persisted model-ready table; a missing path is an error."""
    try:
        return spark.read.parquet(path)
    except Exception as exc:  # AnalysisException: path does not exist
        raise FileNotFoundError(f"model-ready table not found at {path}; write it first") from exc


def _strip(col: Column) -> Column:
    return F.regexp_replace(col, _WS, "")


def parse_lookup_lines(lines: DataFrame, domains: Sequence[str]) -> DataFrame:
    """IO3 on a ``(line_no, value)`` frame: multi-section code file -> long
    ``(domain, id, label)``.

    A line containing a domain name starts that section; blank and ``,`` lines are
    skipped; other lines split on the first comma; the id is normalised through
    float -> int (lines whose id is not a number are skipped); the label loses
    surrounding quotes, then surrounding whitespace.  A repeated id keeps its last
    line."""
    line = _strip(F.col("value"))
    header = F.lit(None).cast("string")
    for d in reversed(list(domains)):
        header = F.when(line.contains(d), F.lit(d)).otherwise(header)
    w = Window.orderBy("line_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    tagged = (lines.select("line_no", line.alias("line"), header.alias("header"))
              .withColumn("domain", F.last("header", ignorenulls=True).over(w)))
    number = r"^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$"
    key_raw = _strip(F.regexp_extract("line", r"^([^,]*),", 1))
    body = tagged.where(F.col("header").isNull() & F.col("domain").isNotNull()
                        & (F.col("line") != "") & (F.col("line") != ",") & F.col("line").contains(","))
    parsed = body.select(
        "domain", "line_no",
        F.when(key_raw.rlike(number), key_raw.try_cast("double").try_cast("bigint").cast("string")).alias("id"),
        _strip(F.regexp_replace(F.regexp_extract("line", r"^[^,]*,(.*)$", 1), r'^"+|"+$', "")).alias("label"),
    ).where(F.col("id").isNotNull())
    return (parsed.groupBy("domain", "id")
            .agg(F.max_by("label", "line_no").alias("label")))


def read_lookup_file(spark: SparkSession, path: str, domains: Sequence[str]) -> DataFrame:
    """IO3: read the lookup file (a single small text file) and parse it."""
    lines = spark.read.text(path).coalesce(1).withColumn("line_no", F.monotonically_increasing_id())
    return parse_lookup_lines(lines, domains)
