"""Evaluation metrics (E1-E3), prediction variance (A18) and class balance (F2)."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def regression_metrics(df: DataFrame, label: str = "y", pred: str = "pred") -> DataFrame:
    """One row: n, MAE, RMSE and explained variance 1 - var(y - p) / var(y) (population).

    Explained variance is not ``RegressionEvaluator("var")`` (a different quantity).
    With a constant label it is 1.0 for a constant error and 0.0 otherwise (the
    original metric library's definition).
    """
    y, p = F.col(label), F.col(pred)
    err = y - p
    return df.filter(y.isNotNull() & p.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        explained_variance(label, pred).alias("explained_variance"),
    )


def explained_variance(label: str, pred: str) -> Column:
    """E3 as an aggregate: 1 - var(y - p) / var(y)."""
    y = F.col(label)
    var_err, var_y = F.var_pop(y - F.col(pred)), F.var_pop(y)
    return (F.when(var_y > 0, F.lit(1.0) - var_err / var_y)
            .when(var_err == 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def prediction_variance(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Sample and population variance of the predictions."""
    return df.agg(F.var_samp(pred).alias("pred_var_samp"), F.var_pop(pred).alias("pred_var_pop"))


def class_balance(labels: DataFrame, label: str = "y") -> DataFrame:
    """drivers with Y = 0, with Y > 0, and their ratio (NULL when no positive label)."""
    y = F.col(label)
    n0 = F.count_if(y == 0)
    n1 = F.count_if(y > 0)
    return labels.agg(n0.alias("n_zero"), n1.alias("n_positive"),
                      (n0.cast("double") / F.when(n1 > 0, n1.cast("double"))).alias("ratio"))


class ExplainedVarianceEvaluator(Evaluator):
    """E3 as an ML ``Evaluator`` (larger is better), for CrossValidator."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", typeConverter=TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "prediction column",
                          typeConverter=TypeConverters.toString)

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        found = explained_variance(self.getOrDefault(self.labelCol), self.getOrDefault(self.predictionCol))
        row = dataset.agg(found.alias("ev")).first()
        return float("nan") if row["ev"] is None else float(row["ev"])

    def isLargerBetter(self) -> bool:
        return True
