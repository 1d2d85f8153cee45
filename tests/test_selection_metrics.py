import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwise.operators.metrics import ExplainedVarianceEvaluator, class_balance, regression_metrics
from tripwise.operators.selection import correlation_matrix, f_scores, select_percentile


def _table(spark, n=60, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.normal(size=n)
    rows = [(int(i), float(y[i]), float(y[i] + rng.normal(scale=0.5)), float(rng.normal()), 3.0,
             float(-2 * y[i] + rng.normal(scale=0.1))) for i in range(n)]
    return spark.createDataFrame(rows, "terminalno bigint, y double, good double, noise double, const double, "
                                       "best double"), rows


def test_f_scores_match_formula(spark):
    df, rows = _table(spark)
    scores = {r["feature"]: r for r in f_scores(df, ["good", "noise", "const", "best"]).collect()}
    arr = np.array([r[1:] for r in rows])
    for j, name in [(1, "good"), (2, "noise"), (4, "best")]:
        r = np.corrcoef(arr[:, j], arr[:, 0])[0, 1]
        assert scores[name]["r"] == pytest.approx(r, rel=1e-9)
        assert scores[name]["f_score"] == pytest.approx(r * r / (1 - r * r) * (len(rows) - 2), rel=1e-7)
    assert scores["const"]["r"] is None and scores["const"]["f_score"] is None


def test_constant_feature_never_selected_before_varying(spark):
    df, _ = _table(spark)
    s = f_scores(df, ["const", "noise", "good", "best"])
    picked = [r["feature"] for r in select_percentile(s, 75).orderBy("selected_rank").collect()]
    assert picked == ["best", "good", "noise"]


def test_correlation_matrix(spark):
    df, rows = _table(spark)
    cm = {(r["a"], r["b"]): r["r"] for r in correlation_matrix(df, ["y", "good", "const"]).collect()}
    arr = np.array([r[1:] for r in rows])
    assert cm[("y", "good")] == pytest.approx(np.corrcoef(arr[:, 0], arr[:, 1])[0, 1], rel=1e-9)
    assert cm[("good", "y")] == cm[("y", "good")]
    assert cm[("y", "const")] is None


def test_metrics_four_rows(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 1.5), (3.0, 3.5), (4.0, 3.0)], "y double, pred double")
    m = regression_metrics(df).collect()[0]
    e = np.array([-0.5, 0.5, -0.5, 1.0])
    assert m["mae"] == pytest.approx(np.abs(e).mean())
    assert m["rmse"] == pytest.approx(np.sqrt((e ** 2).mean()))
    assert m["explained_variance"] == pytest.approx(1 - e.var() / np.var([1, 2, 3, 4]))
    ev = ExplainedVarianceEvaluator(labelCol="y", predictionCol="pred").evaluate(df)
    assert ev == pytest.approx(m["explained_variance"])


def test_class_balance_without_positive_label(spark):
    df = spark.createDataFrame([(0.0,), (0.0,)], "y double")
    r = class_balance(df).collect()[0]
    assert r["n_zero"] == 2 and r["n_positive"] == 0 and r["ratio"] is None


def test_explained_variance_constant_label(spark):
    same = spark.createDataFrame([(1.0, 0.5), (1.0, 0.5)], "y double, pred double")
    other = spark.createDataFrame([(1.0, 0.5), (1.0, 0.7)], "y double, pred double")
    assert regression_metrics(same).collect()[0]["explained_variance"] == 1.0
    assert regression_metrics(other).collect()[0]["explained_variance"] == 0.0


def test_correlation_of_constant_column_is_missing_even_on_diagonal(spark):
    df, _ = _table(spark)
    cm = {(r["a"], r["b"]): r["r"] for r in correlation_matrix(df, ["y", "const"]).collect()}
    assert cm[("const", "const")] is None and cm[("y", "y")] == 1.0


def test_missing_values_in_scores_and_correlations(spark):
    """A missing feature is 0 in the F-scores; a pair's correlation is over the rows that have both."""
    import numpy as np
    import pandas as pd

    from tripwise.operators.selection import correlation_matrix, f_scores

    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"x": rng.normal(size=50), "z": rng.normal(size=50), "c": np.full(50, 7.25), "y": rng.normal(size=50)})
    pdf.loc[10:, "x"] = np.nan
    pdf.loc[::4, "z"] = np.nan
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else float(v) for v in r) for r in pdf.itertuples(index=False)]
    df = spark.createDataFrame(rows, "x double, z double, c double, y double")
    r = {s["feature"]: s for s in f_scores(df, ["x", "z", "c"]).collect()}
    filled = pdf.fillna(0)
    for c in ("x", "z"):
        want = filled[c].corr(filled["y"])
        assert abs(r[c]["r"] - want) < 1e-9 and abs(r[c]["f_score"] - want**2 / (1 - want**2) * 48) < 1e-6
    assert r["c"]["r"] is None
    want = pdf.corr()
    for m in correlation_matrix(df, ["x", "z", "c", "y"]).collect():
        w = want.loc[m["a"], m["b"]]
        assert m["r"] is None if np.isnan(w) else abs(m["r"] - w) < 1e-9, (m, w)
