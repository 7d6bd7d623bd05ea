"""The estimator against plain Python, saving, unseen levels."""

import statistics

import pytest
from pyspark.ml import Pipeline

from tabmine.operators.table_encoder import TableEncoder, TableEncoderModel

SCHEMA = "row_id bigint, ident string, out string, age string, code string, amount double, kind string, s1 string, s2 string"
ENCODER = {"targetCol": "out", "positiveValue": "<30", "statusCols": ["s1", "s2"], "bracketCols": ["age"], "codeCols": ["code"], "dropCols": ["ident"]}


def train_rows(n=60):
    return [(i, f"id{i}", "<30" if i % 3 == 0 else "NO", ["[50-60)", "[60-70)", "?", None][i % 4], ["428", "250.01", "V57", "786"][i % 4],
             None if i % 7 == 0 else float(i * i % 37), [None, "x", "y", "x"][i % 4], ["Up", "No", "Down"][i % 3], "No") for i in range(n)]


def plain(train, rows):
    """Encoded rows ``row_id -> {feature: value}`` by hand."""
    mid = {"[50-60)": 55.0, "[60-70)": 65.0}
    group = {"428": "Circulatory", "250.01": "Diabetes", "V57": "Other", "786": "Respiratory", "820": "Injury"}

    def raw(r):
        return {"age": mid.get(r[3]), "amount": r[5], "n_changed": (r[7] in ("Up", "Down")) + (r[8] in ("Up", "Down"))}, \
               {"code": group[r[4]], "kind": r[6], "s1": r[7]}

    nums, cats = zip(*map(raw, train), strict=True)
    out, levels = {}, {c: {x[c] for x in cats} - {None} for c in cats[0]}
    mode = {c: min((-sum(x[c] == v for x in cats), v) for v in levels[c])[1] for c in levels}
    med = {c: statistics.median([x[c] for x in nums if x[c] is not None]) for c in nums[0]}
    full = {c: [med[c] if x[c] is None else x[c] for x in nums] for c in med}
    for r in rows:
        n, k = raw(r)
        f = {}
        for c in n:
            s = statistics.pstdev(full[c])
            v = med[c] if n[c] is None else n[c]
            f[c] = (v - statistics.fmean(full[c])) / s if s else 0.0
        for c in k:
            v = mode[c] if k[c] is None else k[c]
            if v in levels[c]:
                f[f"{c}_{v}"] = 1.0
        out[r[0]] = f
    return out


def long(model, df):
    got = {}
    for r in model.transform_long(df).collect():
        got.setdefault(r["row_id"], {})[r["feature"]] = r["value"]
    return got


def test_fit_save_load_and_unseen_levels(spark, tmpdir_path):
    train = train_rows()
    test = [(100, "z", "<30", "[60-70)", "820", 5.0, "new", "Steady", "Up"), (101, "z", None, None, "428", None, None, "Up", None)]
    df, new = spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA)
    model = TableEncoder(**ENCODER).fit(df)
    assert model.dropped_columns == ["s2"]
    want = plain(train, train + test)
    got = {**long(model, df), **long(model, new)}
    assert got.keys() == want.keys()
    for i, f in want.items():
        assert got[i].keys() == f.keys() and all(abs(got[i][k] - v) < 1e-9 for k, v in f.items()), i
    path = f"{tmpdir_path}/encoder"
    model.write().overwrite().save(path)
    model.write().overwrite().save(path)
    again = TableEncoderModel.load(path)
    assert again.dropped_columns == ["s2"] and again.feature_names() == model.feature_names()
    assert long(again, new) == long(model, new)
    rows = {r["row_id"]: r for r in again.transform(new).collect()}
    assert rows[100]["label"] == 1 and rows[101]["label"] == 0
    dense = dict(zip(again.feature_names(), rows[100]["features"].toArray().tolist(), strict=True))
    assert {k: v for k, v in dense.items() if v} == pytest.approx({k: v for k, v in want[100].items() if v})


def test_in_a_pipeline_and_without_target(spark):
    df = spark.createDataFrame(train_rows(), SCHEMA)
    fitted = Pipeline(stages=[TableEncoder(**ENCODER)]).fit(df)
    out = fitted.transform(df.drop("out"))
    assert out.columns == ["row_id", "label", "features"] and out.where("label IS NOT NULL").isEmpty()
    with pytest.raises(ValueError, match="amount"):
        fitted.transform(df.drop("amount"))


def test_test_rows_do_not_touch_the_fit(spark):
    train = train_rows()
    df = spark.createDataFrame(train, SCHEMA)
    odd = spark.createDataFrame([(900, "q", "NO", "[0-10)", "820", 1e9, "zzz", "Up", "Up")], SCHEMA)
    model = TableEncoder(**ENCODER).fit(df)
    assert "kind_zzz" not in model.feature_names() and "code_Injury" not in model.feature_names()
    assert long(model, odd)[900]["amount"] > 1e6
