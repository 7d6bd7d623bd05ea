"""Row functions (C1-C11, C16) against the reference's rules."""

from pyspark.sql import functions as F

from tabmine.functions import derive as D


def _one(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_icd9_groups(spark):
    codes = ["390", "459", "459.5", "785", "785.5", "250", "250.83", "251", "999", "999.5", "V57", "E909",
             " 428 ", "", "?", "abc", "250d", "nan", None, "800", "710", "580", "140", "239.9", "460", "520", "788"]
    expect = ["Circulatory", "Circulatory", "Other", "Circulatory", "Other", "Diabetes", "Diabetes", "Other",
              "Injury", "Other", "Other", "Other", "Circulatory", "Other", "Other", "Other", "Other", "Other",
              "Other", "Injury", "Musculoskeletal", "Genitourinary", "Neoplasms", "Other", "Respiratory",
              "Digestive", "Genitourinary"]
    assert _one(spark, codes, D.icd9_group) == expect


def test_age_midpoint(spark):
    vals = ["[0-10)", "[40-50)", "[90-100)", "[100-110)", None, "?"]
    assert _one(spark, vals, D.age_midpoint) == [5.0, 45.0, 95.0, None, None, None]


def test_buckets(spark):
    assert _one(spark, ["1", "3", "3.5", "6", "7", "x", None], D.stay_bucket) == \
        ["1-3", "1-3", "4-6", "4-6", "7+", "unknown", "unknown"]
    assert _one(spark, ["0", "-1", "0.5", "1", "2", "x"], D.visit_bucket) == ["0", "0", "2+", "1", "2+", "unknown"]


def test_normalized_id(spark):
    assert _one(spark, ["3", "3.0", " 4 ", "x", None, "1e1"], D.normalized_id) == ["3", "3", "4", None, None, "10"]


def test_change_count_and_active(spark):
    df = spark.createDataFrame([("Up", "No", "Down"), ("No", None, "Steady"), (None, None, None)], "a string, b string, c string")
    rows = df.select(D.change_count(["a", "b", "c"]).alias("n"), D.active_items(["a", "b", "c"]).alias("s")).collect()
    assert [r["n"] for r in rows] == [2, 0, 0]
    assert [r["s"] for r in rows] == ["a: Up, c: Down", "c: Steady", ""]
    assert df.select(D.change_count([]).alias("n")).first()["n"] == 0


def test_binary_target(spark):
    df = spark.createDataFrame([("<30",), (">30",), ("NO",), (None,)], "readmitted string")
    assert [r[0] for r in df.select(D.binary_target(df, "readmitted", "<30")).collect()] == [1, 0, 0, 0]
    import pytest

    with pytest.raises(ValueError):
        D.binary_target(df, "missing", "<30")


def test_itemize_and_signature(spark):
    df = spark.createDataFrame([("a", None, 3)], "x string, y string, t int")
    items = df.select(D.itemize(["x", "y", "t"], {"t": D.stay_bucket}).alias("i")).first()["i"]
    assert items == ["x=a", "t=1-3"]
    m = spark.createDataFrame([("LR", {"b": "2", "a": "1"})], "m string, p map<string,string>")
    assert m.select(D.run_signature("m", "p")).first()[0] == "LR::a=1|b=2"


def test_zscore_band(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "v double")
    out = [r[0] for r in df.select(D.zscore_band("v", F.lit(5.0), F.lit(2.0))).collect()]
    assert out == ["low", None, "high"]
    out0 = [r[0] for r in df.select(D.zscore_band("v", F.lit(5.0), F.lit(0.0))).collect()]
    assert out0 == [None, None, None]
