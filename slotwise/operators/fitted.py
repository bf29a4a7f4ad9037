"""Preparation that is learnt once, saved with the model, and applied to rows that come later.

Category codes, medians and moments are what a model was fitted on; learning them anew from next month's table would give
its columns another meaning. The stages here hold them as small tables, are saved as Parquet beside their parameters, and
work inside a ``PipelineModel`` with Spark's own stages, which then scores raw rows. Codes are applied by a join, so
that there may be many of them. None of them needs the rows it was learnt from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.operators.metrics import scored_rows
from slotwise.operators.models import OPERATION_FEATURES, WEATHER_FEATURES, balanced_weights
from slotwise.operators.prepare import category_table
from slotwise.operators.ranking import column_quantiles, stored
from slotwise.operators.sizing import broadcast_if_small

UNKNOWN = -1  # the code of a missing value


class _Writer(MLWriter):
    def __init__(self, stage: _TableModel):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage.table.write.mode("overwrite").parquet(f"{path}/table")


class _Reader(MLReader):
    def __init__(self, kind: type[_TableModel]):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> _TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage.table = self.sparkSession.read.parquet(f"{path}/table")
        return stage


class _TableModel(Model, MLWritable, MLReadable):
    """A fitted stage whose state is a table."""

    table: DataFrame

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _CodeParams(Params):
    column = Param(Params._dummy(), "column", "values to code", TypeConverters.toString)
    output = Param(Params._dummy(), "output", "name of the codes", TypeConverters.toString)
    missing = Param(Params._dummy(), "missing", "what a missing value counts as; if empty, it has code -1",
                    TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(missing="")

    def text(self) -> Column:
        value, missing = F.col(self.getOrDefault("column")).cast("string"), self.getOrDefault("missing")
        return F.coalesce(value, F.lit(missing)) if missing else value


class CategoryCodes(Estimator, _CodeParams):
    """Alphabetical codes from 0 of the values of a column, as text."""

    @keyword_only
    def __init__(self, *, column: str, output: str, missing: str = ""):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> CategoryCodesModel:
        values = df.select(self.text().alias("valor"))
        model = CategoryCodesModel()
        model.table = stored(category_table(values, "valor", "codigo"))
        return self._copyValues(model)


class CategoryCodesModel(_TableModel, _CodeParams):
    """A missing value gets -1; all values that were not there to learn from share the code after the last."""

    def _transform(self, df: DataFrame) -> DataFrame:
        output, text = self.getOrDefault("output"), self.text()
        codes = self.table.select(F.col("valor").alias("_valor"), F.col("codigo").alias("_codigo"))
        after = self.table.agg(F.coalesce(F.max("codigo") + 1, F.lit(0))).first()[0]
        joined = df.join(broadcast_if_small(codes), text == F.col("_valor"), "left")
        code = F.when(text.isNull(), UNKNOWN).otherwise(F.coalesce("_codigo", F.lit(after)))
        return joined.select(*[df[c] for c in df.columns if c != output], code.cast("long").alias(output))


class _NumberParams(Params):
    columns = Param(Params._dummy(), "columns", "numbers to fill and scale", TypeConverters.toListString)
    prefix = Param(Params._dummy(), "prefix", "of the scaled columns", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(prefix="z_")


class FilledNumbers(Estimator, _NumberParams):
    """Exact medians of the rows to learn from, and mean and population deviation once these fill the gaps."""

    @keyword_only
    def __init__(self, *, columns: Sequence[str], prefix: str = "z_"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FilledNumbersModel:
        columns = self.getOrDefault("columns")
        medians = {r["variable"]: r["m"] for r in column_quantiles(df, columns, [0.5], ["m"]).collect()}  # a row per column
        filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)).cast("double")) for c in columns}
        found = df.agg(*[F.avg(e).alias(f"m_{c}") for c, e in filled.items()],
                       *[F.stddev_pop(e).alias(f"s_{c}") for c, e in filled.items()]).first()
        rows = [(c, medians.get(c), found[f"m_{c}"], found[f"s_{c}"] or 1.0) for c in columns]
        model = FilledNumbersModel()
        model.table = df.sparkSession.createDataFrame(
            rows, "columna string, mediana double, media double, desviacion double")
        return self._copyValues(model)


class FilledNumbersModel(_TableModel, _NumberParams):
    """Numbers filled, and beside them less the mean over the deviation (1 for a constant column)."""

    def _transform(self, df: DataFrame) -> DataFrame:
        learnt = {r["columna"]: r for r in self.table.collect()}  # a row per column
        columns, prefix = self.getOrDefault("columns"), self.getOrDefault("prefix")
        filled = df.withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.lit(learnt[c]["mediana"]).cast("double")) for c in columns})
        return filled.withColumns({
            f"{prefix}{c}": (F.col(c) - F.lit(learnt[c]["media"])) / F.lit(learnt[c]["desviacion"]) for c in columns})


def fit_codes(df: DataFrame, columns: dict[str, str]) -> PipelineModel:
    """Codes of several columns (column: name of its codes), learnt from one table."""
    return Pipeline(stages=[CategoryCodes(column=c, output=o) for c, o in columns.items()]).fit(df)


RISK_NUMBERS = WEATHER_FEATURES + OPERATION_FEATURES
RISK_CODES = {"aerolinea_dgac": "aerolinea_cod", "modelo_avion": "modelo_cod"}
BORDER_TEXT = ["aeropuerto_oaci", "actividad_cod", "tipo_operacion"]


def risk_stages() -> list[Estimator]:
    """Codes and flags of joined flights as they come."""
    flags = SQLTransformer(statement=(
        "SELECT * EXCEPT (es_internacional), CAST(es_internacional AS INT) AS es_internacional, "
        "CAST(coalesce(tipo_operacion = 'D', false) AS INT) AS tipo_operacion_cod FROM __THIS__"))
    return [*[CategoryCodes(column=c, output=o) for c, o in RISK_CODES.items()], flags]


def border_stages() -> list[Estimator]:
    """Label codes, log weight and date parts of cleaned flights."""
    parts = SQLTransformer(statement=(
        "SELECT *, year(dt_operacion) AS year, month(dt_operacion) AS month, ln(1 + pmd) AS pmd_log FROM __THIS__"))
    return [*[CategoryCodes(column=c, output=f"{c}_enc", missing="nan") for c in BORDER_TEXT], parts]


def risk_pipeline(classifier: Estimator, scaled: bool = False) -> Pipeline:
    """From joined flights to probabilities: codes, flags, medians, scaling, features and classifier."""
    inputs = [f"z_{c}" if scaled else c for c in RISK_NUMBERS]
    return Pipeline(stages=[*risk_stages(), FilledNumbers(columns=RISK_NUMBERS),
                            VectorAssembler(inputCols=inputs, outputCol="features"), classifier])


def border_pipeline(classifier: Estimator) -> Pipeline:
    """From cleaned flights to the probability of an international one."""
    numbers = [*[f"{c}_enc" for c in BORDER_TEXT], "pmd_log", "year", "month"]
    return Pipeline(stages=[*border_stages(), FilledNumbers(columns=numbers),
                            VectorAssembler(inputCols=numbers, outputCol="features"), classifier])


def learnt_risk(flights: DataFrame, train: Column) -> PipelineModel:
    """What the risk search prepares its rows with: codes of all flights, medians and moments of the training rows."""
    first = Pipeline(stages=risk_stages()).fit(flights)
    numbers = FilledNumbers(columns=RISK_NUMBERS).fit(first.transform(flights.filter(train)))
    return PipelineModel(stages=[*first.stages, numbers])


def learnt_border(log: DataFrame) -> PipelineModel:
    return Pipeline(stages=border_stages()).fit(log)


def with_model(preparation: PipelineModel, features: Sequence[str], model: Model) -> PipelineModel:
    """A fitted classifier behind the preparation of its rows: one model that scores raw rows."""
    return PipelineModel(stages=[
        *preparation.stages, VectorAssembler(inputCols=list(features), outputCol="features"), model])


def fit_pipeline(pipeline: Pipeline, rows: DataFrame, label: str) -> PipelineModel:
    """Fit on the rows that have a label, both classes weighing the same (column ``peso``)."""
    known = scored_rows(rows.withColumn("_uno", F.lit(1.0)), label, "_uno").drop("_uno")
    return pipeline.fit(balanced_weights(known.withColumn(label, F.col(label).cast("int")), label))
