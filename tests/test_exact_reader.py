"""The exact missing rule against the csv module; classes attached as literals."""

import csv
import io

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabmine.operators.common import with_each
from tabmine.sources import read_delimited_exact

TEXT = 'id,a,b,c\r\n1,?,,x\r\n2,"","?",None\r\n3,"p,q",NA,"say ""hi"""\r\n4, ,,\r\n5,one\r\n6,a,b,c\r\n7,"x, y",\r\n,,,\r\n'


def strings(n):
    return T.StructType([T.StructField(c, T.StringType()) for c in "iabc"[:n]])


def expected(text, n):
    rows = list(csv.reader(io.StringIO(text)))[1:]
    return [tuple((None if r[k] == "?" else r[k]) if k < len(r) else None for k in range(n)) for r in rows]


def test_missing_token_empty_and_short_rows(spark, tmpdir_path):
    path = f"{tmpdir_path}/t.csv"
    with open(path, "w", newline="") as f:
        f.write(TEXT)
    got = [tuple(r) for r in read_delimited_exact(spark, path, strings(4)).collect()]
    assert got == expected(TEXT, 4)
    plain = read_delimited_exact(spark, path, strings(4), missing_token=None).collect()
    assert plain[0]["a"] == "?" and plain[0]["b"] == ""
    old = read_delimited_exact(spark, path, strings(4), empty_is_missing=True).collect()
    assert old[0]["b"] is None and old[1]["a"] == ""


def test_line_ends_in_quotes(spark, tmpdir_path):
    text = 'i,a,b\n1,"two\nlines",?\n2,"",\n3,"a ""q""\n,b",z\n'
    path = f"{tmpdir_path}/m.csv"
    with open(path, "w", newline="") as f:
        f.write(text)
    got = [tuple(r) for r in read_delimited_exact(spark, path, strings(3), multi_line=True).collect()]
    assert got == expected(text, 3)


def test_types_and_other_separator(spark, tmpdir_path):
    path = f"{tmpdir_path}/n.csv"
    with open(path, "w") as f:
        f.write("n;v;s\n1;2.5;a\n?;;\nx;3;b\n")
    schema = "n int, v double, s string"
    got = [tuple(r) for r in read_delimited_exact(spark, path, T._parse_datatype_string(schema), sep=";").collect()]
    assert got == [(1, 2.5, "a"), (None, None, ""), (None, 3.0, "b")]


def test_with_each(spark):
    df = spark.range(3).withColumn("k", F.lit("x"))
    few = spark.createDataFrame([(1, None), (2, 0.5)], "label int, w double")
    got = with_each(df, few)
    assert got.columns == ["id", "k", "label", "w"] and got.schema["label"].dataType.simpleString() == "int"
    assert sorted(map(str, got.collect())) == sorted(map(str, df.crossJoin(few).collect()))
    assert "Join" not in got._jdf.queryExecution().toString()
    assert with_each(df, few.limit(0)).collect() == []
    with pytest.raises(ValueError, match="more than 1"):
        with_each(df, few, most=1)
