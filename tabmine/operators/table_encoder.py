"""The whole model-ready encoder (P5) as a Spark ML estimator that can be saved.

``TableEncoder.fit(train)`` learns from the training rows alone: near-zero-variance status columns, medians, means and
deviations, most frequent values and levels.  ``TableEncoderModel.transform(rows)`` then applies, to any rows:

1. C3 the number of changed status columns, counted before any of them is dropped;
2. dropped: named columns (identifiers, mostly missing) and the status columns found near-constant on the training rows;
3. C2 bracket texts to midpoints, C1 codes to groups, C4 the target to 0 / 1 (where the rows have one);
4. P1-P4 median-imputed standardised numbers, mode-imputed one-hot categories; a level not seen in training gives zeros.

Learned values live in one small table ``(kind, column, position, text, number)``, which is also the saved form."""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabmine.functions.derive import age_midpoint, binary_target, change_count, icd9_group
from tabmine.operators.encode import EncoderModel, fit_encoder
from tabmine.operators.profile import nzv_metrics
from tabmine.session import cut_lineage

_STATE = "kind string, column string, position int, text string, number double"


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _EncoderParams(Params):
    rowIdCol = _param("rowIdCol", "column that names a row; carried along, never a feature", TypeConverters.toString)
    targetCol = _param("targetCol", "column of the target", TypeConverters.toString)
    positiveValue = _param("positiveValue", "target text that counts as 1", TypeConverters.toString)
    statusCols = _param("statusCols", "columns whose changes are counted and that may be dropped as near-constant", TypeConverters.toListString)
    bracketCols = _param("bracketCols", "columns of bracket texts", TypeConverters.toListString)
    codeCols = _param("codeCols", "columns of diagnosis codes", TypeConverters.toListString)
    dropCols = _param("dropCols", "columns that are never features", TypeConverters.toListString)
    changeCountCol = _param("changeCountCol", "name of the count of changed status columns", TypeConverters.toString)
    labelCol = _param("labelCol", "name of the 0 / 1 target in the output", TypeConverters.toString)
    featuresCol = _param("featuresCol", "name of the feature vector in the output", TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(rowIdCol="row_id", targetCol="target", positiveValue="1", statusCols=[], bracketCols=[], codeCols=[],
                         dropCols=[], changeCountCol="n_changed", labelCol="label", featuresCol="features")

    def _settings(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}

    def _derive(self, df: DataFrame, dropped: list[str]) -> DataFrame:
        """Steps 1 to 3: row id, label (null where the rows have no target) and the features' raw columns."""
        get = self.getOrDefault
        status = [c for c in get("statusCols") if c in df.columns]
        out = df.withColumn(get("changeCountCol"), change_count(status))
        label = binary_target(df, get("targetCol"), get("positiveValue")) if get("targetCol") in df.columns else F.lit(None).cast("int")
        gone = {*get("dropCols"), *dropped, get("targetCol"), get("rowIdCol"), get("labelCol")}
        cols = []
        for c in [x for x in out.columns if x not in gone]:
            if c in get("bracketCols"):
                cols.append(age_midpoint(F.col(f"`{c}`")).alias(c))
            elif c in get("codeCols"):
                cols.append(icd9_group(F.col(f"`{c}`")).alias(c))
            else:
                cols.append(F.col(f"`{c}`"))
        return out.select(F.col(get("rowIdCol")), label.alias(get("labelCol")), *cols)


class TableEncoder(Estimator, _EncoderParams):
    """See the module.  Columns with a numeric type (after step 3) are numbers, all others categories."""

    @keyword_only
    def __init__(self, **kwargs):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TableEncoderModel:
        status = [c for c in self.getOrDefault("statusCols") if c in df.columns]
        dropped = [r["column"] for r in nzv_metrics(df, status).where("drop").collect()] if status else []   # a row a status column
        rows = cut_lineage(self._derive(df, dropped))
        features = [c for c in rows.columns if c not in (self.getOrDefault("rowIdCol"), self.getOrDefault("labelCol"))]
        enc = fit_encoder(rows.select(*features))
        state = [("dropped", c, i, None, None) for i, c in enumerate(dropped)]
        moments = enc.numeric_params.first().asDict() if enc.numeric else {}
        for i, c in enumerate(enc.numeric):
            state += [(kind, c, i, None, moments[f"_{kind}_{c}"]) for kind in ("med", "mean", "std")]
        state += [("mode", c, i, enc.modes.get(c), None) for i, c in enumerate(enc.categorical)]
        spark = df.sparkSession
        levels = enc.levels.select(F.lit("level").alias("kind"), "column", F.col("col_pos").alias("position"), F.col("level").alias("text"),
                                   F.lit(None).cast("double").alias("number"))
        model = TableEncoderModel(cut_lineage(spark.createDataFrame(state, _STATE).unionByName(levels)))
        return model._set(**self._settings())


class TableEncoderModel(Model, _EncoderParams, MLWritable, MLReadable):
    """Fitted ``TableEncoder``; ``state`` holds the learned values."""

    def __init__(self, state: DataFrame | None = None):
        super().__init__()
        self.state = state
        self._encoder: EncoderModel | None = None
        self._dropped: list[str] = []

    def encoder(self) -> EncoderModel:
        if self._encoder is None:
            spark = self.state.sparkSession
            # everything but the levels: a few rows a column
            rows = self.state.where("kind <> 'level'").orderBy("kind", "position").collect()
            numeric = [r["column"] for r in rows if r["kind"] == "med"]
            modes = {r["column"]: r["text"] for r in rows if r["kind"] == "mode"}
            value = {(r["kind"], r["column"]): r["number"] for r in rows}
            if numeric:
                names = [f"_{k}_{c}" for c in numeric for k in ("med", "mean", "std")]
                params = spark.createDataFrame([tuple(value[k, c] for c in numeric for k in ("med", "mean", "std"))],
                                               ", ".join(f"`{n}` double" for n in names))
            else:
                params = spark.range(1).select(F.lit(1).alias("_none"))
            levels = self.state.where("kind = 'level'").select("column", F.col("text").alias("level"), F.col("position").alias("col_pos"),
                                                               F.lit(False).alias("mode_level"))
            self._dropped = [r["column"] for r in rows if r["kind"] == "dropped"]
            self._encoder = EncoderModel(self.getOrDefault("labelCol"), numeric, list(modes), params, levels, modes)
        return self._encoder

    @property
    def dropped_columns(self) -> list[str]:
        """Status columns found near-constant on the training rows."""
        self.encoder()
        return self._dropped

    def feature_names(self) -> list[str]:
        return self.encoder().feature_names()

    def _rows(self, df: DataFrame) -> DataFrame:
        enc = self.encoder()
        rows = self._derive(df, self._dropped)
        lost = [c for c in enc.numeric + enc.categorical if c not in rows.columns]
        if lost:
            raise ValueError(f"rows lack the training columns {lost}")
        return rows.select(self.getOrDefault("rowIdCol"), self.getOrDefault("labelCol"), *enc.numeric, *enc.categorical)

    def transform_long(self, df: DataFrame) -> DataFrame:
        """``(row_id, label, feature, value)``: numbers always, one-hot features where the level is present and known."""
        label = self.getOrDefault("labelCol")
        return self.encoder().transform_long(self._rows(df), self.getOrDefault("rowIdCol"), keep=[label])

    def _transform(self, df: DataFrame) -> DataFrame:
        return self.encoder().transform_vector(self._rows(df), [self.getOrDefault("rowIdCol")], self.getOrDefault("featuresCol"))

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    """Learned values and settings as two Parquet tables below the path, in any store that Spark writes to."""

    def __init__(self, model: TableEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        mode = "overwrite" if self.shouldOverwrite else "error"
        spark = self.model.state.sparkSession
        self.model.state.write.mode(mode).parquet(f"{path}/state")
        spark.createDataFrame([(json.dumps(self.model._settings()),)], "settings string").coalesce(1).write.mode(mode).parquet(f"{path}/settings")

    def save(self, path: str) -> None:
        self.saveImpl(path)


class _Reader(MLReader):
    def load(self, path: str) -> TableEncoderModel:
        spark = SparkSession.getActiveSession()
        settings = json.loads(spark.read.parquet(f"{path}/settings").first()["settings"])
        return TableEncoderModel(spark.read.schema(_STATE).parquet(f"{path}/state"))._set(**settings)
