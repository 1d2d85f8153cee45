"""End-to-end submission jobs, one per original entry point.

Every job: telemetry -> fused driver features (materialised once: selection,
each fit and scoring reuse it) -> selection -> model(s) -> key-aligned
predictions -> one-file CSV sink (optional).  ``rounds`` overrides the
boosting rounds of every fit (the originals' 200-1000 sequential rounds are
the defaults).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwise.config import FeatureConfig
from tripwise.operators import ensemble, models as md
from tripwise.operators.features import FEATURE_SETS, driver_features
from tripwise.operators.knn import knn_regress
from tripwise.operators.rows import clamp_nonnegative, scaled
from tripwise.operators.selection import f_scores, selected_features
from tripwise.sources import sinks
from tripwise.sources.telemetry import split_side
from tripwise.session import checkpoint_dir

KEY = "terminalno"


@dataclass
class FeatureTables:
    train: DataFrame
    test: DataFrame
    features: list[str]


def feature_tables(telemetry: DataFrame, feature_set: str = "61", cfg: FeatureConfig = FeatureConfig()) -> FeatureTables:
    """Driver features for both sides in one pass, checkpointed to the shared folder."""
    checkpoint_dir(telemetry.sparkSession)
    table = driver_features(telemetry, feature_set, cfg).checkpoint(eager=True)
    cols = list(FEATURE_SETS[feature_set])
    return FeatureTables(split_side(table, "train").drop("split"), split_side(table, "test").drop("split"), cols)


def _select(ft: FeatureTables, percentile: float | None, label: str = "y") -> list[str]:
    if percentile is None:
        return ft.features
    return selected_features(f_scores(ft.train, ft.features, label), percentile)


def knn_submission(telemetry: DataFrame, k: int = 5, clamp: bool = True, out: str | None = None) -> DataFrame:
    """E-4: 7 features, distance-weighted k-NN (k=5 with clamp; k=30 without)."""
    ft = feature_tables(telemetry, "7")
    preds = knn_regress(ft.train, ft.test, ft.features, k)
    if clamp:
        preds = preds.withColumn("pred", clamp_nonnegative("pred"))
    if out:
        sinks.commit_submission(preds, out)
    return preds


def select_and_boost_submission(telemetry: DataFrame, percentile: float = 50, params: md.BoostParams = md.LGB_LEAVES5,
                                rounds: int | None = None, out: str | None = None) -> DataFrame:
    """E-2: 61 features, keep the top 50 % by F, boosted trees on 80 % of the drivers (20 % only watch)."""
    ft = feature_tables(telemetry, "61")
    feats = _select(ft, percentile)
    p = params.with_rounds(rounds) if rounds else params
    train = md.with_validation(ft.train, 0.2, seed=0)
    model = md.fit_gbt(train, feats, "y", p, validation="is_valid")
    preds = md.predict(model, ft.test)
    if out:
        sinks.commit_submission(preds, out)
    return preds


def selection_job(telemetry: DataFrame, rounds: int | None = None, out: str | None = None) -> DataFrame:
    """The selection job: 61 features, label x10, top 70 % by F, boosted trees on 80 % of the drivers."""
    ft = feature_tables(telemetry, "61")
    train = md.with_validation(ft.train.withColumn("y10", scaled("y")), 0.2, seed=0)
    feats = selected_features(f_scores(train, ft.features, "y10"), 70)
    p = md.XGB_BAG.with_rounds(rounds) if rounds else md.XGB_BAG
    preds = md.predict(md.fit_gbt(train, feats, "y10", p, validation="is_valid"), ft.test)
    if out:
        sinks.commit_submission(preds, out)
    return preds


def ridge_submission(telemetry: DataFrame, percentile: float = 70, normalize: bool = True, clamp: bool = False,
                     out: str | None = None) -> DataFrame:
    """Ridge path: 61 features, top 70 %, normalised ridge (plain + clamp in the stacking script)."""
    ft = feature_tables(telemetry, "61")
    feats = _select(ft, percentile)
    model = md.ridge(ft.train, feats, "y", alpha=1.0, normalize=normalize)
    preds = md.predict(model, ft.test)
    if clamp:
        preds = preds.withColumn("pred", clamp_nonnegative("pred"))
    if out:
        sinks.commit_submission(preds, out)
    return preds


def bagging_submission(telemetry: DataFrame, rounds: int | None = None, out: str | None = None) -> DataFrame:
    """Bagging path: 61 features, label x10 (not divided back), top 70 %, mean of five models."""
    ft = feature_tables(telemetry, "61")
    train = ft.train.withColumn("y10", scaled("y"))
    feats = selected_features(f_scores(train, ft.features, "y10"), 70)
    preds = ensemble.bagged_predictions(train, ft.test, feats, label="y10", rounds=rounds)
    if out:
        sinks.commit_submission(preds, out)
    return preds


def grid_search_job(telemetry: DataFrame, percentile: float = 50, grid: dict[str, list] | None = None) -> DataFrame:
    """61 features, top 50 % by F, the explained variance of every candidate of the grid."""
    ft = feature_tables(telemetry, "61")
    return md.grid_scores(ft.train, _select(ft, percentile), "y", grid=grid)


def stacking_submission(telemetry: DataFrame, rounds: int | None = None, out: str | None = None,
                        trace_out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """E-1: 42 features, 5-fold stacking with label blending and a refit."""
    ft = feature_tables(telemetry, "42")
    preds, trace = ensemble.stacked_predictions(ft.train, ft.test, ft.features, rounds=rounds)
    if out:
        sinks.commit_submission(preds, out)
    if trace_out:
        sinks.write_trace(trace, trace_out)
    return preds, trace


def baseline_submission(telemetry: DataFrame, model_path: str | None = None, rounds: int | None = None,
                        out: str | None = None, include_id: bool = False,
                        params: md.BoostParams = md.BASELINE_XGB) -> DataFrame:
    """E-3: baseline 36-column set, boosted trees; the model is saved and re-loaded (K3).

    ``params`` is ``BASELINE_XGB`` (first baseline job) or ``LGB_REGRESSOR`` (second one).

    ``include_id=True`` also feeds the driver id to the model, as the original did
    (D18); off by default because an id is not a property of the driving.
    """
    ft = feature_tables(telemetry, "baseline")
    feats = ft.features
    train, test = ft.train, ft.test
    if include_id:
        feats = ["item"] + feats
        train = train.withColumn("item", F.col(KEY).cast("double"))
        test = test.withColumn("item", F.col(KEY).cast("double"))
    p = params.with_rounds(rounds) if rounds else params
    model = md.fit_gbt(train, feats, "target", p)
    if model_path:
        sinks.save_model(model, model_path)
        model = sinks.load_model(model_path)
    preds = md.predict(model, test)
    if out:
        sinks.commit_submission(preds, out)
    return preds

