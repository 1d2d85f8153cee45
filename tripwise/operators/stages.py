"""ML stages of the submission jobs: label scale, F selection, boosted trees, clamp, submission.

All are ML-writable, so one ``PipelineModel`` goes from the raw feature table to the
submission and can be saved and loaded whole.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import Estimator, Model, Pipeline, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (HasFeaturesCol, HasInputCol, HasInputCols, HasLabelCol, HasOutputCol,
                                     HasPredictionCol)
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.operators import boosting
from tripwise.operators.boosting import Booster, BoostParams, Fit
from tripwise.operators.rows import clamp_nonnegative, scaled
from tripwise.operators.selection import f_scores, selected_features
from tripwise.session import ship


def _param(name: str, doc: str, kind):
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class LabelScale(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """The label times a factor (rows without a label keep none)."""

    factor = _param("factor", "what the label is multiplied by", TypeConverters.toFloat)

    def __init__(self, inputCol: str = "y", outputCol: str = "label", factor: float = 10.0):
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol, factor=factor)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getOutputCol(), scaled(self.getInputCol(), self.getOrDefault("factor")))


class _Assembled(HasInputCols, HasOutputCol):
    fill = _param("fill", "what a missing feature counts as", TypeConverters.toFloat)

    def _assemble(self, df: DataFrame) -> DataFrame:
        fill = F.lit(self.getOrDefault("fill"))
        x = F.array(*[F.coalesce(F.nanvl(F.col(c).cast("double"), fill), fill) for c in self.getInputCols()])
        return df.withColumn(self.getOutputCol(), array_to_vector(x))


class Features(Transformer, _Assembled, DefaultParamsReadable, DefaultParamsWritable):
    """Feature columns as one vector; a missing one counts as ``fill``.  Also the model of ``FSelection``."""

    def __init__(self, inputCols: Sequence[str] = (), outputCol: str = "features", fill: float = 0.0):
        super().__init__()
        self._set(inputCols=list(inputCols), outputCol=outputCol, fill=fill)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._assemble(df)


class FSelection(Estimator, _Assembled, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """M1: keep the top ``percentile`` of the feature columns by univariate F, as one vector."""

    percentile = _param("percentile", "share of the features that stay, in percent", TypeConverters.toFloat)

    def __init__(self, inputCols: Sequence[str] = (), labelCol: str = "label", percentile: float = 70.0,
                 outputCol: str = "features", fill: float = 0.0):
        super().__init__()
        self._set(inputCols=list(inputCols), labelCol=labelCol, percentile=percentile, outputCol=outputCol, fill=fill)

    def _fit(self, df: DataFrame) -> Features:
        scores = f_scores(df, self.getInputCols(), self.getLabelCol())
        kept = selected_features(scores, self.getOrDefault("percentile"))
        return Features(kept, self.getOutputCol(), self.getOrDefault("fill"))


class _TreesWriter(MLWriter):
    def __init__(self, model: "BoostedTreesModel"):
        super().__init__()
        self._model = model

    def saveImpl(self, path: str) -> None:
        spark, b = self.sparkSession, self._model.booster
        DefaultParamsWriter.saveMetadata(self._model, path, spark, extraMetadata={"base": b.base})
        rows = [(i, json.dumps(t), json.dumps(x)) for i, (t, x) in enumerate(zip(b.trees, b.losses, strict=True))]
        spark.createDataFrame(rows, "round int, tree string, losses string").coalesce(1).write.parquet(f"{path}/trees")


class _TreesReader(MLReader):
    def load(self, path: str) -> "BoostedTreesModel":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        rows = self.sparkSession.read.parquet(f"{path}/trees").orderBy("round").collect()
        model = BoostedTreesModel(Booster(metadata["base"], [json.loads(r["tree"]) for r in rows],
                                          [json.loads(r["losses"]) for r in rows]))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class BoostedTreesModel(Model, HasFeaturesCol, HasPredictionCol, MLReadable, MLWritable):
    """Fitted boosted trees; adds the prediction column."""

    def __init__(self, booster: Booster | None = None, featuresCol: str = "features", predictionCol: str = "prediction"):
        super().__init__()
        self.booster = booster or Booster(0.0)
        self._set(featuresCol=featuresCol, predictionCol=predictionCol)

    @property
    def getNumTrees(self) -> int:
        return len(self.booster.trees)

    def _transform(self, df: DataFrame) -> DataFrame:
        ship(df.sparkSession)
        score = boosting.staged_predictions([self.booster], [self.getNumTrees])
        return df.withColumn(self.getPredictionCol(), score(boosting.features_array(df, self.getFeaturesCol()))[0])

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreesReader()


class BoostedTrees(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """M3/M4 as an ML estimator.

    ``holdCol`` names a boolean column of rows that only watch; ``watch`` ("train" or
    "held") is the side whose loss decides early stopping; ``state`` a folder that lets
    an interrupted fit go on.
    """

    boosting = _param("boosting", "the BoostParams as JSON", TypeConverters.toString)
    keyCol = _param("keyCol", "the rows' key", TypeConverters.toString)
    holdCol = _param("holdCol", "flag of the rows that only watch ('' : none)", TypeConverters.toString)
    watch = _param("watch", "side whose loss decides early stopping", TypeConverters.toString)
    state = _param("state", "folder of the fit's state ('': a new one)", TypeConverters.toString)

    def __init__(self, params: BoostParams | None = None, featuresCol: str = "features", labelCol: str = "label",
                 predictionCol: str = "prediction", keyCol: str = "terminalno", holdCol: str = "", watch: str = "train",
                 state: str = ""):
        super().__init__()
        self._set(featuresCol=featuresCol, labelCol=labelCol, predictionCol=predictionCol, keyCol=keyCol, holdCol=holdCol,
                  watch=watch, state=state, boosting=json.dumps(asdict(params or BoostParams(rounds=100, eta=0.1))))

    def _fit(self, df: DataFrame) -> BoostedTreesModel:
        params = BoostParams(**json.loads(self.getOrDefault("boosting")))
        hold = self.getOrDefault("holdCol")
        rows = df.withColumn("_part", F.coalesce(F.col(hold), F.lit(False)).cast("int")) if hold else df
        fit = Fit(params, 1 if hold else None, self.getOrDefault("watch"))
        booster, = boosting.boost(rows, [fit], self.getFeaturesCol(), self.getLabelCol(), self.getOrDefault("keyCol"),
                                  part="_part" if hold else None, state=self.getOrDefault("state") or None)
        return BoostedTreesModel(booster, self.getFeaturesCol(), self.getPredictionCol())


class Clamp(Transformer, HasInputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Negative values of a column become 0."""

    def __init__(self, inputCol: str = "prediction"):
        super().__init__()
        self._set(inputCol=inputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn(self.getInputCol(), clamp_nonnegative(self.getInputCol()))


class Submission(Transformer, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """K1's frame: Id and Pred of every row."""

    keyCol = _param("keyCol", "the rows' key", TypeConverters.toString)

    def __init__(self, keyCol: str = "terminalno", predictionCol: str = "prediction"):
        super().__init__()
        self._set(keyCol=keyCol, predictionCol=predictionCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        from tripwise.sources.sinks import submission_frame

        return submission_frame(df, self.getOrDefault("keyCol"), self.getPredictionCol())


def submission_pipeline(features: Sequence[str], params: BoostParams, percentile: float = 70.0, factor: float = 10.0,
                        label: str = "y", key: str = "terminalno", hold: str = "") -> Pipeline:
    """The selection job as one pipeline: feature table -> scaled label -> top features -> trees -> clamp -> Id, Pred."""
    return Pipeline(stages=[
        LabelScale(label, "scaled_label", factor), FSelection(features, "scaled_label", percentile),
        BoostedTrees(params, labelCol="scaled_label", keyCol=key, holdCol=hold), Clamp(), Submission(key)])
