import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwise.operators import models as md
from tripwise.operators.ensemble import stacked_predictions
from tripwise.sources import sinks

FEATS = ["f1", "f2", "f3"]


def _data(spark, n=80, seed=0):
    rng = np.random.default_rng(seed)
    X = rng.normal(size=(n, 3)) * np.array([1.0, 10.0, 0.1]) + np.array([0.0, 5.0, 1.0])
    y = X @ np.array([0.5, -0.2, 3.0]) + rng.normal(scale=0.3, size=n)
    rows = [(int(i), float(y[i]), *map(float, X[i])) for i in range(n)]
    return spark.createDataFrame(rows, "terminalno bigint, y double, f1 double, f2 double, f3 double"), X, y


def _ridge_closed_form(X, y, alpha, normalize):
    xm, ym = X.mean(axis=0), y.mean()
    Xc = X - xm
    scale = np.sqrt((Xc ** 2).sum(axis=0)) if normalize else np.ones(X.shape[1])
    Xs = Xc / scale
    w = np.linalg.solve(Xs.T @ Xs + alpha * np.eye(X.shape[1]), Xs.T @ (y - ym)) / scale
    return w, ym - xm @ w


@pytest.mark.parametrize("normalize", [False, True])
def test_ridge_matches_closed_form(spark, normalize):
    df, X, y = _data(spark)
    model = md.ridge(df, FEATS, "y", alpha=1.0, normalize=normalize)
    lr = model.stages[-1]
    w, b = _ridge_closed_form(X, y, 1.0, normalize)
    assert np.allclose(lr.coefficients.toArray(), w, rtol=1e-6, atol=1e-8)
    assert lr.intercept == pytest.approx(b, rel=1e-6, abs=1e-8)


def test_gbt_deterministic_and_better_than_constant(spark):
    df, X, y = _data(spark)
    p = md.XGB_BAG.with_rounds(60)
    a = md.predict(md.fit_gbt(df, FEATS, "y", p), df).orderBy("terminalno").collect()
    b = md.predict(md.fit_gbt(df, FEATS, "y", p), df).orderBy("terminalno").collect()
    assert [r["pred"] for r in a] == [r["pred"] for r in b]
    pred = np.array([r["pred"] for r in a])
    assert np.sqrt(((pred - y) ** 2).mean()) < np.std(y)


def test_model_save_load_round_trip(spark, tmp_path):
    df, _, _ = _data(spark)
    model = md.fit_gbt(df, FEATS, "y", md.XGB_BAG.with_rounds(5))
    path = str(tmp_path / "m")
    sinks.save_model(model, path)
    again = sinks.load_model(path)
    a = [r["pred"] for r in md.predict(model, df).orderBy("terminalno").collect()]
    b = [r["pred"] for r in md.predict(again, df).orderBy("terminalno").collect()]
    assert a == b


def test_stacking_shapes(spark):
    df, _, _ = _data(spark, n=60)
    test = df.limit(0).unionByName(df.filter(F.col("terminalno") < 10).withColumn("terminalno", F.col("terminalno") + 1000))
    preds, trace = stacked_predictions(df, test, FEATS, rounds=4)
    p = preds.collect()
    assert len(p) == 10 and all(r["pred"] is not None and np.isfinite(r["pred"]) for r in p)
    t = trace.filter(F.col("rawY").isNotNull())
    assert t.count() == 60  # one out-of-fold prediction per train driver
    assert t.filter(F.col("layer1_combine") < 0).count() == 0


def test_concurrent_fits_equal_sequential(spark):
    from tripwise.operators.ensemble import bagged_predictions

    df, _, _ = _data(spark, n=50, seed=3)
    test = df.filter(F.col("terminalno") < 8).withColumn("terminalno", F.col("terminalno") + 1000)
    a = bagged_predictions(df, test, FEATS, rounds=3, parallelism=1).orderBy("terminalno").collect()
    b = bagged_predictions(df, test, FEATS, rounds=3, parallelism=5).orderBy("terminalno").collect()
    assert [tuple(r) for r in a] == [tuple(r) for r in b]


@pytest.mark.parametrize("include_id", [False, True])
def test_baseline_job_round_trip(spark, tmp_path, include_id):
    from tripwise.plans.submissions import baseline_submission
    from tripwise.sources.telemetry import telemetry_from_dir

    t = telemetry_from_dir(spark, "/root/testdata/sf0.001")
    out = str(tmp_path / "sub")
    preds = baseline_submission(t, model_path=str(tmp_path / "model"), rounds=3, out=out,
                                include_id=include_id).collect()
    test_drivers = {r["terminalno"] for r in t.filter(F.col("split") == "test").select("terminalno").distinct().collect()}
    assert {r["terminalno"] for r in preds} == test_drivers
    assert all(np.isfinite(r["pred"]) for r in preds)
    assert os.path.exists(os.path.join(str(tmp_path / "model"), "metadata"))


def test_held_out_labels_do_not_change_a_fit(spark):
    df, _, _ = _data(spark)
    flagged = md.with_validation(df, 0.3, seed=1)
    other = flagged.withColumn("y", F.when(F.col("is_valid"), F.lit(1000.0)).otherwise(F.col("y")))
    p = md.XGB_BAG.with_rounds(8)
    rows = [[r["pred"] for r in md.predict(md.fit_gbt(d, FEATS, "y", p, validation="is_valid"), df)
             .orderBy("terminalno").collect()] for d in (flagged, other)]
    assert rows[0] == rows[1]


def test_patience():
    losses = [5.0, 4.0, 4.5, 3.0] + [3.5] * 9
    assert md.stop_round(losses) == len(losses)
    assert md.stop_round(losses + [3.5, 1.0, 0.5]) == 14  # ten rounds after the best one
    assert md.stop_round([1.0], 10) == 1


def test_early_stopping_uses_the_watched_side(spark):
    from dataclasses import replace

    df, _, _ = _data(spark)
    flagged = md.with_validation(df, 0.3, seed=1)
    p = replace(md.XGB_REFIT.with_rounds(80), eta=0.9)
    whole = md.fit_gbt(flagged, FEATS, "y", replace(p, early_stop=False), validation="is_valid").stages[-1].booster
    for watch in ("train", "held"):
        model = md.fit_gbt(flagged, FEATS, "y", p, validation="is_valid", watch=watch)
        assert model.stages[-1].getNumTrees == md.stop_round([x[watch]["rmse"] for x in whole.losses])


def test_watch_list_has_mae(spark):
    df, X, y = _data(spark)
    model = md.fit_gbt(df, FEATS, "y", md.XGB_BAG.with_rounds(3))
    rows = md.watch_list(model)
    pred = {r["terminalno"]: r["pred"] for r in md.predict(model, df).collect()}
    mae = np.mean([abs(pred[i] - y[i]) for i in range(len(y))])
    assert rows[-1][2] == pytest.approx(mae) and len(rows) == 3


def test_fits_started_together_ship_the_package_once(monkeypatch):
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace

    from tripwise import session

    added = []

    def add(path):
        time.sleep(0.2)
        if added:  # as Spark does
            raise ValueError(f"File tripwise-core.zip was already registered with a different path (old path = {added[0]})")
        added.append(path)

    monkeypatch.setattr(session, "_SHIPPED", set())
    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="app-1", addPyFile=add))
    with ThreadPoolExecutor(3) as pool:
        list(pool.map(session.ship, [fake] * 3))
    assert len(added) == 1
