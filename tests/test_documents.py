"""One-pass audit and nested documents."""

import json
import math

from tabmine.operators.audit import audit_sample, audit_table, deletion_stats, tag_deletions, top_reasons
from tabmine.sources.sinks import document, json_safe, write_document

ROWS = "id bigint, k bigint, code string, g string, v double"


def table(spark):
    rows = [(i, i % 40, "11" if i % 9 == 0 else "1", "bad" if i % 7 == 0 else None if i % 5 == 0 else "ok", float(i)) for i in range(120)]
    return spark.createDataFrame(rows, ROWS)


def test_observed_counts_equal_the_aggregates(spark):
    df = table(spark)
    args = (df, "k", "id", "code", [11], None, "g", "bad", ["g"])
    a, tagged = audit_table(*args), tag_deletions(*args)
    assert a.stats().collect() == deletion_stats(tagged).collect()
    assert a.reasons().collect() == top_reasons(tagged).collect()
    assert a.sample("id", size=60).collect() == audit_sample(tagged, "id", size=60).collect()
    assert a.sample("id", size=400).count() == 120
    empty = audit_table(df.limit(0), *args[1:])
    assert set(empty.counts.values()) == {0} and empty.sample("id").collect() == []


def test_floats_at_any_depth(spark):
    kind = "a double, s struct<x:double,t:array<struct<y:float,n:string>>>, m map<int,array<double>>, l array<array<double>>, plain array<int>"
    nan, inf = math.nan, math.inf
    rows = [(nan, (1.5, [(inf, "p"), (2.0, None)]), {3: [nan, 4.0]}, [[-inf], [], None], [1]), (1.0, None, None, None, None),
            (None, (None, None), {}, [], [])]
    got = [json.loads(x) for x in json_safe(spark.createDataFrame(rows, kind)).toJSON().collect()]
    assert got[0] == {"s": {"x": 1.5, "t": [{"n": "p"}, {"y": 2.0}]}, "m": {"3": [None, 4.0]}, "l": [[None], [], None], "plain": [1]}
    assert got[1] == {"a": 1.0} and got[2] == {"s": {}, "m": {}, "l": [], "plain": []}


def test_document(spark, tmpdir_path):
    one = spark.createDataFrame([(3, math.inf, 'say "x"')], "n int, v double, t string")
    many = spark.createDataFrame([(2, "b", None), (9, "a", 1.0), (2, "a", math.nan)], "n int, k string, v double")
    doc = document(stats=one, rows=[many, "-n", "k"], none=[many.limit(0), "n"])
    write_document(doc, f"{tmpdir_path}/doc")
    got = json.loads(spark.read.text(f"{tmpdir_path}/doc").first()[0])
    assert got == {"stats": {"n": 3, "v": None, "t": 'say "x"'}, "none": [],
                   "rows": [{"n": 9, "k": "a", "v": 1.0}, {"n": 2, "k": "a", "v": None}, {"n": 2, "k": "b", "v": None}]}
