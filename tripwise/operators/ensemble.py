"""Ensembles: five-model mean (M7) and out-of-fold stacking (M8).

Predictions are always aligned by the driver key, never by position.  Boosted members
and folds are fitted jointly; other learners run as a fixed, small number of
concurrent jobs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.operators import boosting
from tripwise.operators import models as md
from tripwise.operators.boosting import Fit
from tripwise.operators.knn import fold_knn_regress
from tripwise.operators.rows import blend, clamp_nonnegative
from tripwise.operators.split import contiguous_folds
from tripwise.session import checkpoint_dir


def _concurrently(tasks: Sequence[Callable[[], object]], parallelism: int) -> list:
    """Run independent fits as concurrent Spark jobs (results in task order).

    One fit on the driver table uses only as many tasks as the table has
    partitions; submitting the k independent fits together keeps a large
    cluster busy.  Each fit is seeded, so the results do not depend on timing.
    """
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(tasks))) as pool:
        return list(pool.map(lambda t: t(), tasks))


def _mean_of(frames: Sequence[DataFrame], key: str, out: str) -> DataFrame:
    """Per-key mean of the ``pred`` column of several scored frames (union + one aggregate)."""
    u = frames[0].select(key, "pred")
    for f in frames[1:]:
        u = u.unionByName(f.select(key, "pred"))
    return u.groupBy(key).agg(F.avg("pred").alias(out))


def bagged_predictions(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "y",
                       key: str = "terminalno", rounds: int | None = None, parallelism: int = 3) -> DataFrame:
    """M7: mean of five regressors (four boosted-tree sets and normalised ridge).

    As in the original, the second member fits on 80 % of the rows (the rest only
    watches), the others on all.  Sets with equal bins share their passes over the rows,
    and one pass scores all members.  Output: key, pred1..pred5, pred.
    """
    members = [Fit(md.XGB_SKLEARN), Fit(md.XGB_BAG, hold=1), None, Fit(md.LGB_LEAVES5), Fit(md.LGB_REGRESSOR)]
    if rounds:
        members = [m and replace(m, params=m.params.with_rounds(rounds)) for m in members]
    rows = md.assembler(features).transform(md.with_validation(train, 0.2, seed=0, key=key, out="_valid"))
    rows = rows.withColumn("_part", F.col("_valid").cast("int"))
    bins = sorted({m.params.max_bin for m in members if m})
    jobs = [lambda b=b: boosting.boost(rows, [m for m in members if m and m.params.max_bin == b], label=label, key=key,
                                       part="_part") for b in bins]
    *boosted, ridge = _concurrently([*jobs, lambda: md.ridge(train, features, label, alpha=1.0, normalize=True)], parallelism)
    fitted = {b: iter(found) for b, found in zip(bins, boosted, strict=True)}
    boosters = [next(fitted[m.params.max_bin]) for m in members if m]
    score = boosting.staged_predictions(boosters, [max(len(b.trees) for b in boosters)])
    scored = ridge.transform(test)
    scored = scored.select(key, F.col("prediction").alias("_ridge"), score(boosting.features_array(scored, "features")).alias("_p"))
    place = iter(range(4))
    columns = [(F.col("_p")[next(place)] if m else F.col("_ridge")).alias(f"pred{i}") for i, m in enumerate(members, 1)]
    mean = sum((F.col(f"pred{i}") for i in range(1, len(members) + 1)), F.lit(0.0)) / len(members)
    return scored.select(key, *columns).withColumn("pred", mean)


#: Layer 1 of a stack: (rows with their fold, test rows) -> (key, pred) of every row by the
#: models that have not seen it, and (key, layer1_preds) of the test rows by all of them.
Layer = Callable[[DataFrame, DataFrame], tuple[DataFrame, DataFrame]]


def neighbour_layer(features: Sequence[str], neighbours: int, label: str, key: str, k: int) -> Layer:
    """Layer 1 of k-NN regression (M6): one search serves the models of all folds."""

    def layer(folded: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        oof, each = fold_knn_regress(folded, test, features, neighbours, k, id_col=key, label=label)
        clamped = clamp_nonnegative("pred").alias("pred")
        return oof.select(key, clamped), _mean_of([each.select(key, clamped)], key, "layer1_preds")

    return layer


def boosted_layer(params: md.BoostParams, features: Sequence[str], label: str, key: str, k: int) -> Layer:
    """Layer 1 of boosted trees: the k fold models are fitted jointly, and one pass scores each side.

    A fold's rows watch its own model; as in the original the loss of the fitted rows
    decides early stopping.
    """

    def layer(folded: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        rows = md.assembler(features).transform(folded)
        boosters = boosting.boost(rows, [Fit(params, hold=i) for i in range(k)], label=label, key=key, part="fold")
        score = boosting.staged_predictions(boosters, [max(len(b.trees) for b in boosters)])
        asked = md.assembler(features).transform(test)
        own = score(boosting.features_array(rows, "features"))[F.col("fold")]
        oof = rows.select(key, own.alias("pred")).select(key, clamp_nonnegative("pred").alias("pred"))
        every = asked.select(key, score(boosting.features_array(asked, "features")).alias("_p"))
        total = F.aggregate("_p", F.lit(0.0), lambda a, p: a + F.greatest(p, F.lit(0.0)))
        return oof, every.select(key, (total / k).alias("layer1_preds"))

    return layer


def stack(train: DataFrame, test: DataFrame, layer1: Layer, refit_model: Callable[[DataFrame, DataFrame, str], DataFrame],
          label: str = "y", key: str = "terminalno", k: int = 5) -> tuple[DataFrame, DataFrame]:
    """M8 for any base learner.

    ``refit_model(rows, test, label)`` gives the (key, pred) frame of the test rows.  Steps as
    in ``stacked_predictions``.  Returns the submission frame and the trace (K2).
    """
    checkpoint_dir(train.sparkSession)
    folded = contiguous_folds(train, k=k, key=key).checkpoint(eager=True)
    oof, layer1_preds = layer1(folded, test)
    relabelled = (folded.join(oof.withColumnRenamed("pred", "layer1_combine"), key)
                  .withColumn("rawY", F.col(label))
                  .withColumn("newY", blend("layer1_combine", label, 0.3, 0.7))
                  .checkpoint(eager=True))
    second = refit_model(relabelled, test, "newY").withColumnRenamed("pred", "refit")
    final = second.join(layer1_preds, key).select(key, ((F.col("refit") + F.col("layer1_preds")) / 2).alias("pred"),
                                                  "layer1_preds")
    trace = (relabelled.select(key, "rawY", "layer1_combine", "newY")
             .join(final.select(key, "layer1_preds", "pred"), key, "full_outer"))
    return final.select(key, "pred"), trace


def stacked_predictions(train: DataFrame, test: DataFrame, features: Sequence[str], label: str = "y",
                        key: str = "terminalno", k: int = 5, rounds: int | None = None,
                        seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """M8: k-fold stacking, label blending and a refit, at the original's rounds unless ``rounds`` is given.

    1. contiguous folds of the train drivers (W3);
    2. per fold i: fit on the other folds, score fold i (out-of-fold) and the test
       drivers; clamp at 0;
    3. new label 0.3 * oof + 0.7 * y;  refit on all but a 20 % hash hold-out that watches;
    4. final = (refit prediction + mean of the k fold models on test) / 2.

    Returns (submission frame key, pred) and the trace frame (K2) keyed by driver.
    """
    def sized(p: md.BoostParams) -> md.BoostParams:
        return p.with_rounds(rounds) if rounds else p

    def refit_model(rows: DataFrame, test_rows: DataFrame, new_label: str) -> DataFrame:
        model = md.fit_gbt(md.with_validation(rows, 0.2, seed, key=key), features, new_label, sized(md.XGB_REFIT),
                           validation="is_valid", key=key)
        return md.predict(model, test_rows, key)

    layer1 = boosted_layer(sized(md.XGB_LAYER1), features, label, key, k)
    return stack(train, test, layer1, refit_model, label, key, k)
