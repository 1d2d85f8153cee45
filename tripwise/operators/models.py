"""Regression models on the driver table.

Boosted trees are grown by ``boosting`` (residual sums merged by Spark, many fits in one
pass).  Ridge maps onto ``LinearRegression`` with the regParam that reproduces the
closed form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.operators import boosting
from tripwise.operators.boosting import PATIENCE, BoostParams, Fit, stop_round  # noqa: F401
from tripwise.operators.metrics import explained_variance
from tripwise.operators.stages import BoostedTrees, Features

# Parameter sets of the original scripts (rounds, learning rate, depth or
# leaf count, least rows of a child, row / column sampling, penalties, least split gain).
# XGB_BAG is also the selection job's set.  Where a library's default applies it is that
# library's: base 0.5 and L2 1, or the mean label and no penalty.
XGB_REFIT = BoostParams(rounds=1000, eta=0.05, min_child=5, subsample=0.8, colsample=0.5, l1=1.0, l2=2.0, early_stop=True)
XGB_LAYER1 = BoostParams(rounds=1000, eta=0.01, min_child=5, colsample=0.6, l2=2.0, min_gain=1.0, early_stop=True)
XGB_BAG = BoostParams(rounds=200, eta=0.01, min_child=5, colsample=0.8, l1=1.0, l2=2.0)
XGB_SKLEARN = BoostParams(rounds=200, eta=0.01, min_child=4, subsample=0.8, colsample=0.8)
XGB_GRID = BoostParams(rounds=350, eta=0.01, min_child=5)
LGB_LEAVES5 = BoostParams(rounds=300, eta=0.01, max_leaves=5, min_child=11, subsample=0.8, resample_every=5, colsample=0.8,
                          l2=0.0, base=None, seed=9)
LGB_REGRESSOR = BoostParams(rounds=720, eta=0.01, max_leaves=5, min_child=11, subsample=0.8, resample_every=5,
                            colsample=0.2319, max_bin=55, l2=0.0, base=None, seed=9)
BASELINE_XGB = BoostParams(rounds=800, eta=0.009, min_child=5, subsample=0.65, colsample=0.35, min_gain=0.1, seed=1123)
# The grid of the original's search.
GRID = {"rounds": [150, 200, 250, 300, 350], "subsample": [0.7, 0.8, 0.9, 1.0], "colsample": [0.7, 0.8, 0.9, 1.0]}


def assembler(features: Sequence[str], out: str = "features") -> Features:
    return Features(features, out)


def fit_gbt(train: DataFrame, features: Sequence[str], label: str, params: BoostParams,
            validation: str | None = None, watch: str = "train", key: str = "terminalno",
            state: str | None = None) -> PipelineModel:
    """Fit boosted trees on the rows whose ``validation`` flag is not true; missing features count as 0.

    The flagged rows only watch.  With ``early_stop`` the loss on ``watch`` decides the
    round to stop at: "train" as in the original, whose watch list ends with the training
    rows, or "held".
    """
    trees = BoostedTrees(params, labelCol=label, keyCol=key, holdCol=validation or "", watch=watch, state=state or "")
    return Pipeline(stages=[assembler(features), trees]).fit(train)


def ridge(train: DataFrame, features: Sequence[str], label: str, alpha: float = 1.0,
          normalize: bool = False) -> PipelineModel:
    """M5: ridge regression equal to the closed form of the original library.

    Plain: regParam = alpha * sd(y) / n without standardisation.
    normalize=True (features scaled by their centred norm): regParam = alpha * sd(y)
    with standardisation.  sd is the population standard deviation of the label.
    """
    data = train.filter(F.col(label).isNotNull())
    st = data.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(label).alias("sd")).first()
    sd = st["sd"] or 0.0
    reg = alpha * sd if normalize else alpha * sd / max(st["n"], 1)
    lr = LinearRegression(featuresCol="features", labelCol=label, predictionCol="prediction",
                          regParam=reg, elasticNetParam=0.0, standardization=normalize,
                          solver="normal", fitIntercept=True)
    return Pipeline(stages=[assembler(features), lr]).fit(data)


def predict(model: PipelineModel, df: DataFrame, key: str = "terminalno", out: str = "pred") -> DataFrame:
    """Score ``df``; output (key, out)."""
    return model.transform(df).select(key, F.col("prediction").alias(out))


def with_validation(df: DataFrame, fraction: float, seed: int, key: str = "terminalno",
                    out: str = "is_valid") -> DataFrame:
    """Reproducible validation flag for early stopping (hash split of the driver key)."""
    from tripwise.operators.split import holdout_split

    return holdout_split(df, fraction=fraction, seed=seed, key=key, out=out)


def grid_scores(train: DataFrame, features: Sequence[str], label: str, base: BoostParams = XGB_GRID,
                grid: dict[str, list] | None = None, folds: int = 3, seed: int = 0, key: str = "terminalno") -> DataFrame:
    """(rounds, subsample, colsample, explained_variance, candidate) of every candidate of the grid.

    The score is the mean over the folds (by hash of the key) of the explained variance
    on the held fold.  Boosting is sequential, so a fit of the most rounds holds those of
    fewer: each sampling pair is fitted once a fold, all of them jointly (48 fits share
    every pass), and one scoring pass gives a held driver's predictions after every
    number of rounds.  ``candidate`` is the place in the grid's order.
    """
    from tripwise.operators.split import HOLDOUT_BUCKETS, hash_bucket

    grid = grid or GRID
    rounds = sorted(grid["rounds"])
    pairs = list(product(grid["subsample"], grid["colsample"]))
    data = assembler(features).transform(train.filter(F.col(label).isNotNull())).select(
        key, F.col(label).cast("double").alias("_y"), "features",
        F.floor(hash_bucket(key, seed) * folds / F.lit(HOLDOUT_BUCKETS)).cast("int").alias("_fold"))
    fits = [Fit(replace(base, rounds=rounds[-1], subsample=s, colsample=c), hold=f) for f in range(folds) for s, c in pairs]
    boosters = boosting.boost(data, fits, label="_y", key=key, part="_fold")
    x = boosting.features_array(data, "features")
    # only the models that have not seen the fold score it
    held = None
    for f in range(folds):
        score = boosting.staged_predictions(boosters[f * len(pairs):(f + 1) * len(pairs)], rounds)
        one = data.filter(F.col("_fold") == f).select("_fold", "_y", F.posexplode(score(x)).alias("i", "p"))
        held = one if held is None else held.unionByName(one)
    by_fold = held.groupBy("_fold", "i").agg(explained_variance("_y", "p").alias("ev"))
    scores = by_fold.groupBy("i").agg(F.avg("ev").alias("explained_variance"))
    order = [(r, s, c) for r in grid["rounds"] for s in grid["subsample"] for c in grid["colsample"]]
    named = [(pairs.index((s, c)) * len(rounds) + rounds.index(r), r, float(s), float(c), n) for n, (r, s, c) in enumerate(order)]
    # one row a candidate
    table = train.sparkSession.createDataFrame(named, "i int, rounds int, subsample double, colsample double, candidate int")
    return table.join(scores, "i", "left").select("rounds", "subsample", "colsample", "explained_variance", "candidate")


def grid_search(train: DataFrame, features: Sequence[str], label: str, base: BoostParams = XGB_GRID,
                grid: dict[str, list] | None = None, folds: int = 3, seed: int = 0,
                key: str = "terminalno") -> tuple[PipelineModel, dict]:
    """The refitted model of the best candidate (ties: first in the grid) and its parameters."""
    best = (grid_scores(train, features, label, base, grid, folds, seed, key)
            .orderBy(F.col("explained_variance").desc_nulls_last(), "candidate").first())
    params = replace(base, rounds=best["rounds"], subsample=best["subsample"], colsample=best["colsample"])
    return fit_gbt(train, features, label, params, key=key), best.asDict()


def watch_list(model: PipelineModel, loss: str = "mae") -> list[tuple[int, str, float]]:
    """(round, side, loss) after every boosting round on the fitted and the held rows; the original watches MAE.

    The losses come with the fit: each block of rounds sums them as it writes its margins.
    """
    found = model.stages[-1].booster.losses
    return [(i, side, x[side][loss]) for side in ("train", "held") for i, x in enumerate(found, 1) if x[side][loss] is not None]
