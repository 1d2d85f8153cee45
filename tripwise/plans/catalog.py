"""Registered queries: name -> (spark, sf_dir) -> DataFrame, plus their SQL oracles.

Every query reads the driver-generated tables under ``sf_dir`` (telemetry is the
adapter view over ``events``) so its work grows with the data.  Doubles are
rounded by ``present`` (6 dp, metres 3 dp) in the same way as the oracle SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.operators import ensemble as en
from tripwise.operators import features as fx
from tripwise.operators import models as md
from tripwise.operators import order as od
from tripwise.operators import rows as rw
from tripwise.operators import selection as sel
from tripwise.operators import split as sp
from tripwise.operators import stages
from tripwise.operators.knn import knn_pairs, knn_regress
from tripwise.operators import splits as ts
from tripwise.operators.metrics import class_balance, prediction_variance, regression_metrics
from tripwise.plans import oracle as o
from tripwise.plans import submissions as sub
from tripwise.session import checkpoint_dir
from tripwise.sources import sinks
from tripwise.sources.telemetry import (
    COLUMNS, clean_telemetry, events_as_telemetry, load_table, order_telemetry_from_dir, read_quarantined, split_side,
    telemetry_from_dir, telemetry_line, union_train_test,
)


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _new_path(spark, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def present(df: DataFrame) -> DataFrame:
    """Round every double column like the oracle does (``oracle.decimals``, ``oracle.nudge``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            dp = o.decimals(f.name)
            cols.append((F.round(F.col(f.name) + F.lit(o.nudge(dp)), dp) + F.lit(0.0)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_from_dir(spark, sf_dir)


def _stats_query(name: str, columns: list[str], blocks: list[str]) -> None:
    """Register a driver-statistics query; an empty ``blocks`` means the SQL is set separately."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fx.driver_statistics(_t(spark, sf_dir), columns))
    register(name, o.blocks_sql(blocks, columns) if blocks else None)(q)


# --- 2.4 aggregations, one per feature block --------------------------------------
_stats_query("speed_features", fx.SPEED, ["speed"])
_stats_query("direction_features", fx.DIRECTION, ["direction"])
_stats_query("acceleration_features", fx.ACCELERATION, ["acc"])
_stats_query("height_features", fx.HEIGHT, ["height", "height_trip"])
_stats_query("gps_features", fx.GPS, ["gps"])
_stats_query("call_state_shares", fx.CALLS, ["call"])
_stats_query("call_state_smoothed", fx.CALLS_SMOOTHED, ["smoothed"])
_stats_query("hour_shares", fx.HOURS, ["hour"])
_stats_query("trip_duration_features", fx.DURATION, ["duration"])
_stats_query("weekday_shares", fx.WEEKDAYS, ["weekday"])
_stats_query("trip_max", fx.TRIPS, ["trips"])
_stats_query("driver_label", ["y"], ["label"])


def _feature_set_query(name: str, fset: str, blocks: list[str]) -> None:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fx.driver_features(_t(spark, sf_dir), fset))
    register(name, o.blocks_sql(blocks, list(fx.FEATURE_SETS[fset]) + ["y"]))(q)


_ALL_61 = ["speed", "direction", "call", "height", "height_trip", "hour", "gps", "trips", "weekday", "acc",
           "duration", "label"]
_feature_set_query("driver_features_61", "61", _ALL_61)
_feature_set_query("driver_features_59", "59", [b for b in _ALL_61 if b != "duration"])
_feature_set_query("driver_features_42", "42",
                   ["speed", "direction", "call", "height", "height_trip", "hour", "gps", "trips", "label"])
_feature_set_query("driver_features_7", "7", ["speed", "direction", "smoothed", "label"])


# =====================================================================================
# 2.1 scans, sources, sinks

ROW_COLS = COLUMNS + ["seq", "split"]
_T_COLS = ", ".join(ROW_COLS)


def _rows_sql(where: str = "TRUE", tail: str = "") -> str:
    return o.rounded_auto(o.with_t(f"SELECT {_T_COLS} FROM t WHERE {where} {tail}"), ROW_COLS)


@register("telemetry_scan", _rows_sql())
def telemetry_scan(spark, sf_dir):
    """The telemetry rows with the canonical schema (no cleaning)."""
    return present(events_as_telemetry(load_table(spark, sf_dir, "events")).select(*ROW_COLS))


@register("telemetry_clean", _rows_sql())
def telemetry_clean(spark, sf_dir):
    """NaN -> NULL on every double column."""
    return present(_t(spark, sf_dir).select(*ROW_COLS))


@register("train_test_union", _rows_sql())
def train_test_union(spark, sf_dir):
    """Train rows and label-less test rows in one frame with a split tag."""
    t = _t(spark, sf_dir)
    train = split_side(t, "train").drop("split")
    test = split_side(t, "test").drop("split", "y")
    return present(union_train_test(train, test).select(*ROW_COLS))


# --- 2.2 projections, filters --------------------------------------------------------
@register("calls_incoming", _rows_sql("callstate = 2"))
def calls_incoming(spark, sf_dir):
    return present(rw.call_state_rows(_t(spark, sf_dir), 2).select(*ROW_COLS))


@register("calls_connected", _rows_sql("callstate = 3"))
def calls_connected(spark, sf_dir):
    return present(rw.call_state_rows(_t(spark, sf_dir), 3).select(*ROW_COLS))


@register("moving_rows", _rows_sql("speed > 5"))
def moving_rows(spark, sf_dir):
    return present(rw.moving_rows(_t(spark, sf_dir)).select(*ROW_COLS))


@register("positive_rows", _rows_sql("y IS NULL OR y <> 0"))
def positive_rows(spark, sf_dir):
    return present(rw.positive_rows(_t(spark, sf_dir)).select(*ROW_COLS))


@register("haversine_rows", o.rounded_auto(
    o.with_t(f"SELECT terminalno, seq, {o.hav('longitude', 'latitude')} AS hdis FROM t"),
    ["terminalno", "seq", "hdis"]))
def haversine_rows(spark, sf_dir):
    """Distance of every row to the anchor."""
    return present(rw.with_distance(_t(spark, sf_dir)).select("terminalno", "seq", "hdis"))


@register("scaled_label", o.rounded_auto(
    o.with_t("SELECT terminalno, max(y) AS y, max(y) * 10.0::DOUBLE AS y10 FROM t "
             "WHERE split = 'train' GROUP BY terminalno"), ["terminalno", "y", "y10"]))
def scaled_label(spark, sf_dir):
    """Label x10 per train driver."""
    labels = fx.driver_statistics(split_side(_t(spark, sf_dir), "train").drop("split"), ["y"])
    return present(labels.withColumn("y10", rw.scaled("y")))


# --- 2.4 aggregations -----------------------------------------------------------------
_stats_query("direction_overview", ["direction_var_mean", "direction_var_min", "direction_var_max"], [])
ORACLE["direction_overview"] = o.rounded_auto(
    o.with_t(f"SELECT {o.K}, avg(dv) AS direction_var_mean, min(dv) AS direction_var_min, "
             f"max(dv) AS direction_var_max FROM trip GROUP BY {o.K}", o.TRIP_CTE),
    ["split", "terminalno", "direction_var_mean", "direction_var_min", "direction_var_max"])

_stats_query("trip_distinct", ["num_of_trips"], [])
ORACLE["trip_distinct"] = o.rounded_auto(
    o.with_t(f"SELECT {o.K}, count(DISTINCT trip_id) AS num_of_trips FROM t GROUP BY {o.K}"),
    ["split", "terminalno", "num_of_trips"])


@register("trip_distinct_approx", o.with_t(
    f"SELECT {o.K}, count(DISTINCT trip_id) AS num_of_trips, TRUE AS within_bound FROM t GROUP BY {o.K}"))
def trip_distinct_approx(spark, sf_dir):
    """A13 by HLL sketches: whether the estimate is within three standard errors of the exact count."""
    both = fx.driver_statistics(_t(spark, sf_dir), ["num_of_trips", "num_of_trips_approx"])
    near = F.abs(F.col("num_of_trips_approx") - F.col("num_of_trips")) <= 3 * fx.TRIP_SKETCH_ERROR * F.col("num_of_trips")
    return both.select("split", "terminalno", "num_of_trips", near.alias("within_bound"))


@register("trip_direction_variance", o.rounded_auto(
    o.with_t(f"SELECT {o.K}, trip_id, dv FROM trip", o.TRIP_CTE), ["split", "terminalno", "trip_id", "dv"]))
def trip_direction_variance(spark, sf_dir):
    """A4: per-trip direction variance (0 for trips with fewer than two values)."""
    return present(fx.trip_table(_t(spark, sf_dir)).select("split", "terminalno", "trip_id", "dv"))


_OVERVIEW = ["speed_max", "speed_min", "speed_mean", "y_mean"]


@register("speed_overview", o.rounded_auto(
    o.with_t("SELECT terminalno, max(speed) AS speed_max, min(speed) AS speed_min, avg(speed) AS speed_mean, "
             "avg(y) AS y_mean FROM t WHERE split = 'train' GROUP BY terminalno ORDER BY terminalno LIMIT 10"),
    ["terminalno"] + _OVERVIEW))
def speed_overview(spark, sf_dir):
    """A2 + L1: speed max/min/mean and mean Y of the first 10 train drivers in key order."""
    train = split_side(_t(spark, sf_dir), "train").drop("split")
    return present(fx.driver_statistics(train, _OVERVIEW).orderBy("terminalno").limit(10))


@register("driver_count", o.with_t("SELECT split, count(DISTINCT terminalno) AS drivers FROM t GROUP BY split"))
def driver_count(spark, sf_dir):
    """Distinct drivers per side."""
    return _t(spark, sf_dir).groupBy("split").agg(F.count_distinct("terminalno").alias("drivers"))


@register("telemetry_profile", o.with_t(
    "SELECT split, count(*) AS rows, count(DISTINCT terminalno) AS drivers, "
    "(SELECT count(*) FROM (SELECT DISTINCT terminalno, trip_id FROM t t2 WHERE t2.split = t.split)) AS trips "
    "FROM t GROUP BY split"))
def telemetry_profile(spark, sf_dir):
    """Rows, drivers and trips per side, rolled up (split, driver, trip) -> (split, driver) -> split."""
    trips = _t(spark, sf_dir).groupBy("split", "terminalno", "trip_id").agg(F.count(F.lit(1)).alias("rows"))
    drivers = trips.groupBy("split", "terminalno").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("trips"))
    return drivers.groupBy("split").agg(F.sum("rows").alias("rows"), F.count("terminalno").alias("drivers"),
                                        F.sum("trips").alias("trips"))


# --- 2.5 windows ----------------------------------------------------------------------
@register("speed_diff_rows", o.rounded_auto(
    o.with_t("SELECT terminalno, trip_id, seq, coalesce(speed - lag(speed) OVER (PARTITION BY split, terminalno, "
             "trip_id ORDER BY time NULLS FIRST, seq), 0.0::DOUBLE) AS speed_diff FROM t"),
    ["terminalno", "trip_id", "seq", "speed_diff"]))
def speed_diff_rows(spark, sf_dir):
    """In-trip speed difference per row (time-sliced window + slice links)."""
    return present(rw.speed_diffs(_t(spark, sf_dir)).select("terminalno", "trip_id", "seq", "speed_diff"))


_START = ["start_lon", "start_lat", "first_y", "dis"]


@register("start_point", o.rounded_auto(
    o.with_t(f"SELECT {o.K}, longitude AS start_lon, latitude AS start_lat, y AS first_y, "
             f"{o.hav('longitude', 'latitude')} AS dis FROM t "
             f"QUALIFY row_number() OVER (PARTITION BY {o.K} ORDER BY time NULLS FIRST, seq) = 1"),
    ["split", "terminalno"] + _START))
def start_point(spark, sf_dir):
    """First record per driver (min over (time, seq), an aggregate, no sort)."""
    return present(fx.driver_statistics(_t(spark, sf_dir), _START))


def _train_drivers(spark, sf_dir):
    return split_side(_t(spark, sf_dir), "train").select("terminalno").distinct()


_FOLDS_SQL = """folds AS (
  SELECT terminalno, CAST(least(floor(rk / (n // 5)), 4) AS INTEGER) AS fold
  FROM (SELECT terminalno, row_number() OVER (ORDER BY terminalno) - 1 AS rk, count(*) OVER () AS n
        FROM (SELECT DISTINCT terminalno FROM t WHERE split = 'train')))"""


@register("contiguous_folds", o.with_t("SELECT terminalno, fold FROM folds", _FOLDS_SQL))
def contiguous_folds(spark, sf_dir):
    """5 contiguous folds of the train drivers in key order (tail in the last fold)."""
    return sp.contiguous_folds(_train_drivers(spark, sf_dir), 5)


@register("fold_complement_table", o.with_t(
    "SELECT f.terminalno, CAST(i.held_fold AS INTEGER) AS held_fold FROM folds f, range(5) i(held_fold) "
    "WHERE f.fold <> i.held_fold", _FOLDS_SQL))
def fold_complement_table(spark, sf_dir):
    """J5 as an anti-join with the table of folds."""
    drivers = _train_drivers(spark, sf_dir)
    return sp.fold_complement_table(drivers, sp.contiguous_folds(drivers, 5), 5).select("terminalno", "held_fold")


@register("fold_complement", o.with_t(
    "SELECT f.terminalno, f.fold, CAST(i.held_fold AS INTEGER) AS held_fold FROM folds f, "
    "range(5) i(held_fold) WHERE f.fold <> i.held_fold", _FOLDS_SQL))
def fold_complement(spark, sf_dir):
    """Per held-out fold i, the drivers it trains on."""
    return sp.fold_complement(sp.contiguous_folds(_train_drivers(spark, sf_dir), 5), 5)


@register("holdout_split", o.with_t(
    f"SELECT terminalno, {o.holdout_sql('terminalno', 0, 0.2)} AS holdout "
    "FROM (SELECT DISTINCT terminalno FROM t WHERE split = 'train')"))
def holdout_split(spark, sf_dir):
    """M2: reproducible 20 % hold-out of train drivers (md5 hash, seed 0)."""
    return sp.holdout_split(_train_drivers(spark, sf_dir), 0.2, seed=0)


# --- 2.6 sort / limit -----------------------------------------------------------------
@register("telemetry_head", _rows_sql(tail="ORDER BY time NULLS FIRST, seq LIMIT 5"))
def telemetry_head(spark, sf_dir):
    """L2: first five rows in (time, seq) order."""
    return present(od.first_rows(_t(spark, sf_dir).select(*ROW_COLS), 5,
                                 [F.col("time").asc_nulls_first(), F.col("seq").asc()]))


@register("telemetry_tail", _rows_sql(tail="ORDER BY time DESC NULLS LAST, seq DESC LIMIT 5"))
def telemetry_tail(spark, sf_dir):
    """L2: last five rows in (time, seq) order."""
    return present(od.last_rows(_t(spark, sf_dir).select(*ROW_COLS), 5, ["time", "seq"]))


@register("drivers_in_order", o.with_t(
    "SELECT terminalno, first_seq, row_number() OVER (ORDER BY first_seq, terminalno) - 1 AS position "
    "FROM (SELECT terminalno, min(seq) AS first_seq FROM t GROUP BY terminalno)"))
def drivers_in_order(spark, sf_dir):
    """L3: drivers in order of first appearance (distributed global rank)."""
    return od.drivers_in_order(_t(spark, sf_dir))


# --- 2.9 selection ----------------------------------------------------------------------
def _f_scores_sql(feature_set: str, columns: list[str]) -> list[str]:
    unp = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {i} AS feature_index, coalesce(CAST({c} AS DOUBLE), 0) AS x, y FROM feat WHERE split = 'train'"
        for i, c in enumerate(columns))
    return o.feature_ctes("feat", feature_set, columns) + [
        f"long AS ({unp})",
        "stats AS (SELECT feature, feature_index, count(y) AS n, CASE WHEN stddev_pop(x) * stddev_pop(y) > 0 "
        "THEN covar_pop(x, y) / (stddev_pop(x) * stddev_pop(y)) END AS r FROM long GROUP BY feature, feature_index)",
        "scores AS (SELECT feature, feature_index, n, r, CASE WHEN r IS NULL THEN NULL "
        "WHEN abs(r) >= 1 THEN 'inf'::DOUBLE ELSE r * r / (1 - r * r) * (n - 2) END AS f_score FROM stats)",
    ]


def _train_features(spark, sf_dir, fset: str = "61"):
    t = _t(spark, sf_dir)
    return fx.driver_features(split_side(t, "train"), fset)


@register("feature_f_scores", o.rounded_auto(
    o.with_t("SELECT feature, feature_index, n, r, f_score FROM scores", *_f_scores_sql("61", fx.FEATURES_61)),
    ["feature", "feature_index", "n", "r", "f_score"]))
def feature_f_scores(spark, sf_dir):
    """M1: Pearson r and univariate F of each of the 61 features against Y (one aggregate)."""
    return present(sel.f_scores(_train_features(spark, sf_dir), fx.FEATURES_61))


def _selection_sql(p: int) -> str:
    keep = int(len(fx.FEATURES_61) * p / 100)
    return o.with_t(
        f"SELECT feature, feature_index, selected_rank FROM (SELECT feature, feature_index, "
        f"row_number() OVER (ORDER BY f_score DESC NULLS LAST, feature_index) - 1 AS selected_rank FROM scores) "
        f"WHERE selected_rank < {keep}", *_f_scores_sql("61", fx.FEATURES_61))


def _selection_query(p: int):
    def q(spark, sf_dir):
        scores = sel.f_scores(_train_features(spark, sf_dir), fx.FEATURES_61)
        return sel.select_percentile(scores, p, m=len(fx.FEATURES_61)).withColumn("selected_rank", F.col("selected_rank").cast("bigint"))
    return q


register("feature_selection_50", _selection_sql(50))(_selection_query(50))
register("feature_selection_70", _selection_sql(70))(_selection_query(70))


_CORR_COLS = fx.FEATURES_61 + ["y"]


def _corr_sql() -> str:
    unp = " UNION ALL ".join(f"SELECT terminalno, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM feat "
                             f"WHERE split = 'train'" for c in _CORR_COLS)
    ctes = o.feature_ctes("feat", "61", fx.FEATURES_61) + [f"long AS ({unp})"]
    body = ("SELECT l.name AS a, r.name AS b, CASE WHEN min(l.v) < max(l.v) AND min(r.v) < max(r.v) THEN corr(l.v, r.v) END AS r "
            "FROM long l JOIN long r USING (terminalno) "
            "GROUP BY l.name, r.name")
    return o.rounded(o.with_t(body, *ctes), keep=["a", "b"], d4=["r"])


@register("feature_corr", _corr_sql())
def feature_corr(spark, sf_dir):
    """K5: correlation matrix of the 61 features and the label over train drivers."""
    return present(sel.correlation_matrix(_train_features(spark, sf_dir), _CORR_COLS))


# --- class balance, k-NN, metrics -------------------------------------------------------
@register("class_balance", o.rounded_auto(o.with_t(
    "SELECT CAST(count_if(y = 0) AS BIGINT) AS n_zero, CAST(count_if(y > 0) AS BIGINT) AS n_positive, "
    "CASE WHEN count_if(y > 0) > 0 THEN CAST(count_if(y = 0) AS DOUBLE) / CAST(count_if(y > 0) AS DOUBLE) END "
    "AS ratio FROM (SELECT terminalno, max(y) AS y FROM t WHERE split = 'train' GROUP BY terminalno)"),
    ["n_zero", "n_positive", "ratio"]))
def class_balance_q(spark, sf_dir):
    """drivers with Y = 0 vs Y > 0 and their ratio."""
    labels = fx.driver_statistics(split_side(_t(spark, sf_dir), "train").drop("split"), ["y"])
    return present(class_balance(labels))


def _knn_tables(spark, sf_dir):
    from tripwise.plans.submissions import feature_tables

    ft = feature_tables(_t(spark, sf_dir), "7")  # one pass for both sides, checkpointed
    return ft.train, ft.test


def _knn_sql(k: int, body: str, cols: list[str], extra: list[str] = ()) -> str:
    ctes = o.feature_ctes("feat", "7", fx.FEATURES_7) + o.knn_ctes("feat", fx.FEATURES_7, k) + list(extra)
    return o.rounded_auto(o.with_t(body, *ctes), cols)


@register("knn_pairs", _knn_sql(5, "SELECT test_id, train_id, dist, nb, label FROM knn_top",
                                ["test_id", "train_id", "dist", "nb", "label"]))
def knn_pairs_q(spark, sf_dir):
    """J6 + W4: the 5 nearest train drivers of every test driver (exact, no cross join)."""
    train, test = _knn_tables(spark, sf_dir)
    return present(knn_pairs(train, test, fx.FEATURES_7, 5).withColumn("nb", F.col("nb").cast("bigint")))


@register("knn5_predictions", _knn_sql(5, "SELECT terminalno, greatest(pred, 0.0::DOUBLE) AS pred FROM knn_pred",
                                       ["terminalno", "pred"]))
def knn5_predictions(spark, sf_dir):
    """M6 (k = 5) + P6 clamp."""
    train, test = _knn_tables(spark, sf_dir)
    return present(knn_regress(train, test, fx.FEATURES_7, 5).withColumn("pred", rw.clamp_nonnegative("pred")))


@register("knn30_predictions", _knn_sql(30, "SELECT terminalno, pred FROM knn_pred", ["terminalno", "pred"]))
def knn30_predictions(spark, sf_dir):
    """M6 (k = 30), no clamp."""
    train, test = _knn_tables(spark, sf_dir)
    return present(knn_regress(train, test, fx.FEATURES_7, 30))


@register("submission", _knn_sql(5, "SELECT terminalno AS Id, greatest(pred, 0.0::DOUBLE) AS Pred FROM knn_pred",
                                 ["Id", "Pred"]))
def submission(spark, sf_dir):
    """K1: the Id,Pred frame of the k-NN job (written with one part file by ``sinks``)."""
    return present(sinks.submission_frame(knn5_predictions(spark, sf_dir)))


@register("submission_file", _knn_sql(5, "SELECT terminalno AS Id, greatest(pred, 0.0::DOUBLE) AS Pred FROM knn_pred",
                                      ["Id", "Pred"]))
def submission_file(spark, sf_dir):
    """K1 as one committed file, read back."""
    path = _new_path(spark, "submission") + ".csv"
    sinks.commit_submission(knn5_predictions(spark, sf_dir), path)
    return spark.read.schema("Id bigint, Pred double").option("header", True).csv(path)


@register("pred_variance", _knn_sql(
    5, "SELECT var_samp(greatest(pred, 0.0::DOUBLE)) AS pred_var_samp, "
       "var_pop(greatest(pred, 0.0::DOUBLE)) AS pred_var_pop FROM knn_pred", ["pred_var_samp", "pred_var_pop"]))
def pred_variance(spark, sf_dir):
    """Variance of the k-NN test predictions."""
    train, test = _knn_tables(spark, sf_dir)
    preds = knn_regress(train, test, fx.FEATURES_7, 5).withColumn("pred", rw.clamp_nonnegative("pred"))
    return present(prediction_variance(preds))


def _eval_sql() -> str:
    hold = o.holdout_sql("terminalno", 0, 0.2)
    ctes = (o.feature_ctes("feat0", "7", fx.FEATURES_7)
            + [f"feat AS (SELECT *, {hold} AS holdout FROM feat0 WHERE split = 'train')"]
            + o.knn_ctes("feat", fx.FEATURES_7, 5, train_filter="NOT holdout", test_filter="holdout"))
    body = ("SELECT count(*) AS n, avg(abs(f.y - p.pred)) AS mae, sqrt(avg((f.y - p.pred) * (f.y - p.pred))) AS rmse, "
            "CASE WHEN var_pop(f.y) > 0 THEN 1 - var_pop(f.y - p.pred) / var_pop(f.y) "
            "WHEN var_pop(f.y - p.pred) = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS explained_variance "
            "FROM (SELECT terminalno, greatest(pred, 0.0::DOUBLE) AS pred FROM knn_pred) p JOIN feat f USING (terminalno)")
    return o.rounded_auto(o.with_t(body, *ctes), ["n", "mae", "rmse", "explained_variance"])


@register("eval_metrics", _eval_sql())
def eval_metrics(spark, sf_dir):
    """MAE, RMSE, explained variance of k-NN (k = 5) on a 20 % hash hold-out of train drivers."""
    train, _ = _knn_tables(spark, sf_dir)
    feats = sp.holdout_split(train, 0.2, seed=0)
    fit, held = feats.filter(~F.col("holdout")), feats.filter(F.col("holdout"))
    preds = knn_regress(fit, held, fx.FEATURES_7, 5).withColumn("pred", rw.clamp_nonnegative("pred"))
    return present(regression_metrics(preds.join(held.select("terminalno", "y"), "terminalno")))


# --- CSV with bad lines ----------------------------------------------------------------------
# every so many events a line is spoilt: text in a number, the last field missing, one field too many
_SPOILT = {"text": 97, "short": 89, "long": 83}


@register("csv_quarantine", o.rounded_auto(o.with_t(
    f"SELECT 'good' AS kind, terminalno, count(*) AS n, max(speed) AS speed_max, avg(height) AS height_mean FROM t "
    f"WHERE split = 'train' AND {' AND '.join(f'seq % {m} <> 0' for m in _SPOILT.values())} GROUP BY terminalno "
    f"UNION ALL SELECT 'rejected', NULL, count(*), NULL, NULL FROM t "
    f"WHERE split = 'train' AND ({' OR '.join(f'seq % {m} = 0' for m in _SPOILT.values())})"),
    ["kind", "terminalno", "n", "speed_max", "height_mean"]))
def csv_quarantine(spark, sf_dir):
    """The train telemetry as CSV with spoilt lines, read with the bad ones set aside."""
    train = split_side(_t(spark, sf_dir), "train")
    text, short, long = (F.col("seq") % m == 0 for m in _SPOILT.values())
    spoilt = train.withColumn("longitude", F.when(text, F.lit("n/a")).otherwise(F.col("longitude").cast("string")))
    line = (F.when(short, F.regexp_replace("line", ",[^,]*$", "")).when(long, F.concat("line", F.lit(",7")))
            .otherwise(F.col("line")))
    path = _new_path(spark, "telemetry-csv")
    spoilt.withColumn("line", telemetry_line()).select(line.alias("value")).write.text(path)
    good, rejects = read_quarantined(spark, path, _new_path(spark, "telemetry-rejects"), header=False, max_share=0.1)
    stats = clean_telemetry(good).groupBy("terminalno").agg(
        F.count(F.lit(1)).alias("n"), F.max("speed").alias("speed_max"), F.avg("height").alias("height_mean"))
    none = F.lit(None)
    rejected = rejects.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("rejected").alias("kind"), none.cast("bigint").alias("terminalno"), "n", none.cast("double").alias("speed_max"),
        none.cast("double").alias("height_mean"))
    return present(stats.select(F.lit("good").alias("kind"), "terminalno", "n", "speed_max", "height_mean").unionByName(rejected))


# --- baseline feature set -----------------------------------------------------------------
def _baseline_sql() -> str:
    cols = fx.BASELINE_FEATURES
    body = f"""SELECT {o.K},
      coalesce(CAST(count(DISTINCT trip_id) AS BIGINT), -1) AS num_of_trips,
      CAST(count(*) AS BIGINT) AS num_of_records,
      {", ".join(f"coalesce({o._share(f'callstate = {k}')}, -1.0) AS num_of_state_{k}" for k in range(5))},
      coalesce(avg(speed), -1.0) AS mean_speed,
      coalesce(var_samp(speed), -1.0) AS var_speed,
      coalesce(avg(height), -1.0) AS mean_height,
      {", ".join(f"coalesce({o._share(f'hr = {h}')}, -1.0) AS h{h}" for h in range(24))},
      coalesce(arg_min({o.hav('longitude', 'latitude')}, (time, seq)), -1.0) AS dis,
      CASE WHEN split = 'test' THEN -1.0 ELSE coalesce(arg_min(y, (time, seq)), -1.0) END AS target
    FROM t GROUP BY {o.K}"""
    return o.rounded_auto(o.with_t(body), ["split", "terminalno"] + cols + ["target"])


@register("baseline_features", _baseline_sql())
def baseline_features(spark, sf_dir):
    """The 36-column baseline set, missing -> -1, target."""
    return present(fx.driver_features(_t(spark, sf_dir), "baseline"))


# =====================================================================================
# models, ensembles, sinks.  Every registered fit runs the original's rounds.


@register("gbt_predictions")
def gbt_predictions(spark, sf_dir):
    """M3: 61 features, label x10, top 70 % by F, 200 rounds on 80 % of the drivers."""
    return sub.selection_job(_t(spark, sf_dir))


@register("gbt_leafy_predictions")
def gbt_leafy_predictions(spark, sf_dir):
    """M4: 61 features, top 50 %, 300 rounds of the leaf-count set on 80 % of the drivers."""
    return sub.select_and_boost_submission(_t(spark, sf_dir), 50, md.LGB_LEAVES5)


@register("ridge_predictions")
def ridge_predictions(spark, sf_dir):
    """M5: normalised ridge on the top 70 % of the 61 features."""
    return sub.ridge_submission(_t(spark, sf_dir), 70, normalize=True)


@register("clamped_preds")
def clamped_preds(spark, sf_dir):
    """Plain ridge (alpha 1) on the 42 features with negative predictions clamped."""
    ft = sub.feature_tables(_t(spark, sf_dir), "42")
    model = md.ridge(ft.train, ft.features, "y", alpha=1.0, normalize=False)
    preds = md.predict(model, ft.test, out="raw")
    return preds.withColumn("pred", rw.clamp_nonnegative("raw"))


@register("bagged_predictions")
def bagged_predictions(spark, sf_dir):
    """M7: mean of five models on the label-scaled, 70 %-selected 61 features, at the original's rounds."""
    return sub.bagging_submission(_t(spark, sf_dir))


@register("baseline_predictions")
def baseline_predictions(spark, sf_dir):
    """E-3 + K3: baseline set, 800 rounds, model saved to and re-loaded from the checkpoint folder."""
    return sub.baseline_submission(_t(spark, sf_dir), model_path=_new_path(spark, "baseline"))


@register("baseline_leafy_predictions")
def baseline_leafy_predictions(spark, sf_dir):
    """Second baseline job: the 36-column set with the 720-round leaf-count regressor."""
    return sub.baseline_submission(_t(spark, sf_dir), params=md.LGB_REGRESSOR)


# a few rounds small enough to spell out in SQL; exact cuts for up to 65,536 distinct values
_BOOST_SQL = replace(md.XGB_BAG, rounds=3, max_depth=2, eta=0.3, colsample=1.0, max_bin=1 << 16)


@register("boosted_rounds", o.rounded_auto(o.with_t(
    "SELECT terminalno, split, margin AS pred FROM boosted", *o.feature_ctes("feat", "7", fx.FEATURES_7),
    *o.boosted_ctes(fx.FEATURES_7, _BOOST_SQL)), ["terminalno", "split", "pred"]))
def boosted_rounds(spark, sf_dir):
    """M3 by value: three boosting rounds of depth 2 on the 7 features, scored on both sides."""
    ft = sub.feature_tables(_t(spark, sf_dir), "7")
    model = md.fit_gbt(ft.train, ft.features, "y", _BOOST_SQL)
    sides = [md.predict(model, rows).withColumn("split", F.lit(side)) for side, rows in (("train", ft.train), ("test", ft.test))]
    return present(sides[0].unionByName(sides[1]))


def _split_scores_sql() -> str:
    feats = fx.FEATURES_61
    ctes = o.feature_ctes("feat", "61", feats)
    long = " UNION ALL ".join(f"SELECT terminalno, {i} AS f, coalesce({c}, 0)::DOUBLE AS x FROM feat WHERE split = 'train'"
                              for i, c in enumerate(feats))
    ctes += [f"lx AS ({long})",
             "cuts AS (SELECT f, x, x + (lead(x) OVER (PARTITION BY f ORDER BY x) - x) / 2 AS cut "
             "FROM (SELECT DISTINCT f, x FROM lx) QUALIFY cut IS NOT NULL)",
             "names AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(feats)) + ") v(f, feature))"]
    ctes += o.split_ctes("best", "SELECT terminalno, 0 AS node, 0.5::DOUBLE - y AS r FROM feat WHERE split = 'train'", feats,
                         md.XGB_BAG, "node, f")
    return o.rounded_auto(o.with_t("SELECT feature, f AS feature_index, gain, CAST(hl AS BIGINT) AS left_rows, "
                                   "CAST(h AS BIGINT) AS n_rows FROM best JOIN names USING (f)", *ctes),
                          ["feature", "feature_index", "gain", "left_rows", "n_rows"])


@register("split_scores", _split_scores_sql())
def split_scores(spark, sf_dir):
    """M3's first split in relational form: every feature's best cut of the train drivers (exact, no bins)."""
    rows = sub.feature_tables(_t(spark, sf_dir), "61").train.withColumn("residual", F.lit(md.XGB_BAG.base) - F.col("y"))
    found = ts.best_splits(rows, fx.FEATURES_61, "residual", md.XGB_BAG, per_feature=True)
    return present(found.select("feature", "feature_index", "gain", "left_rows", "n_rows"))


@register("saved_pipeline_submission")
def saved_pipeline_submission(spark, sf_dir):
    """K3: scale, selection, 200 rounds, clamp and submission as one pipeline, saved, loaded and applied to the feature table."""
    ft = sub.feature_tables(_t(spark, sf_dir), "61")
    path = _new_path(spark, "pipeline-model")
    sinks.save_model(stages.submission_pipeline(ft.features, md.XGB_BAG).fit(ft.train), path)
    return sinks.load_model(path).transform(ft.test)


@register("stacked_predictions")
def stacked_predictions(spark, sf_dir):
    """M8, M9: 42 features, 5 folds of 1000 rounds with patience 10, label blending, refit of 1000 rounds."""
    return sub.stacking_submission(_t(spark, sf_dir))[0]


@register("stack_trace")
def stack_trace(spark, sf_dir):
    """K2 of the boosted stack: rawY, layer1_combine, newY of train drivers, layer1_preds and pred of test drivers."""
    return sub.stacking_submission(_t(spark, sf_dir))[1]


@register("grid_search")
def grid_search(spark, sf_dir):
    """All 80 candidates x 3 folds, scored by explained variance."""
    return sub.grid_search_job(_t(spark, sf_dir))


@register("random_submission", o.with_t(
    "SELECT terminalno AS Id, (('0x' || substr(md5('0:' || CAST(terminalno AS VARCHAR)), 1, 8))::BIGINT % 1000000) "
    "/ 1000000.0::DOUBLE AS Pred FROM (SELECT DISTINCT terminalno FROM t WHERE split = 'test')"))
def random_submission(spark, sf_dir):
    """K4 + U2: one row per distinct driver with a seeded hash-uniform prediction."""
    return sinks.random_submission(split_side(_t(spark, sf_dir), "test"), seed=0)


@register("gbt_watch_list")
def gbt_watch_list(spark, sf_dir):
    """Per-round MAE on the 80 % part and the 20 % hash hold-out over the original's 300 rounds."""
    ft = sub.feature_tables(_t(spark, sf_dir), "61")
    flagged = md.with_validation(ft.train, 0.2, seed=0)
    model = md.fit_gbt(flagged, ft.features, "y", md.LGB_LEAVES5, validation="is_valid")
    side = {"train": "train", "held": "valid"}
    rows = [(i, side[s], loss) for i, s, loss in md.watch_list(model)]
    return spark.createDataFrame(rows, "round int, side string, loss double")


# --- ridge by closed form, stacking with k-NN: SQL-expressible versions of the model flow ----
_RIDGE_2 = ["speed_mean", "height_mean"]


def _ridge_2_sql() -> str:
    x1, x2 = _RIDGE_2
    body = f"""SELECT terminalno, raw, greatest(raw, 0.0::DOUBLE) AS pred FROM (
      SELECT f.terminalno, -0.5::DOUBLE + m.my + b1 * (f.x1 - m.m1) + b2 * (f.x2 - m.m2) AS raw
      FROM (SELECT terminalno, coalesce({x1}, 0) AS x1, coalesce({x2}, 0) AS x2 FROM feat WHERE split = 'test') f, m, b)"""
    return o.rounded_auto(o.with_t(body, *o.feature_ctes("feat", "42", ["speed_mean", "height_mean"]), f"""m AS (
      SELECT avg(x1) AS m1, avg(x2) AS m2, avg(y) AS my, count(*) AS n, var_pop(x1) * count(*) + 1 AS a11,
             covar_pop(x1, x2) * count(*) AS a12, var_pop(x2) * count(*) + 1 AS a22,
             covar_pop(x1, y) * count(*) AS c1, covar_pop(x2, y) * count(*) AS c2
      FROM (SELECT coalesce({x1}, 0) AS x1, coalesce({x2}, 0) AS x2, y FROM feat WHERE split = 'train' AND y IS NOT NULL))""",
        "b AS (SELECT (c1 * a22 - c2 * a12) / (a11 * a22 - a12 * a12) AS b1, "
        "(c2 * a11 - c1 * a12) / (a11 * a22 - a12 * a12) AS b2 FROM m)"), ["terminalno", "raw", "pred"])


@register("ridge_2_predictions", _ridge_2_sql())
def ridge_2_predictions(spark, sf_dir):
    """M5 + P6: plain ridge (alpha 1) on two features, lowered by 0.5 so that the clamp meets negative values."""
    ft = sub.feature_tables(_t(spark, sf_dir), "42")
    model = md.ridge(ft.train, _RIDGE_2, "y", alpha=1.0, normalize=False)
    preds = md.predict(model, ft.test, out="raw").withColumn("raw", F.col("raw") - F.lit(0.5))
    return present(preds.withColumn("pred", rw.clamp_nonnegative("raw")))


_STACK_K = 3


def _knn_stack_sql() -> str:
    feats = fx.FEATURES_7
    ctes = o.feature_ctes("feat", "7", feats) + [
        _FOLDS_SQL, "trainf AS (SELECT feat.*, fold FROM feat JOIN folds USING (terminalno) WHERE split = 'train')"]

    def nearest(name: str, queries: str, rows: str, label: str) -> list[str]:
        """Prediction of each (fold, query) from the k nearest rows of the other folds."""
        d = " + ".join(f"(coalesce(q.{c}, 0) - coalesce(r.{c}, 0)) * (coalesce(q.{c}, 0) - coalesce(r.{c}, 0))" for c in feats)
        return [f"{name}_top AS (SELECT * FROM (SELECT q.fold, q.terminalno, r.{label} AS label, sqrt({d}) AS dist, "
                f"row_number() OVER (PARTITION BY q.fold, q.terminalno ORDER BY sqrt({d}), r.terminalno) AS nb "
                f"FROM ({queries}) q JOIN ({rows}) r ON q.fold <> r.fold) WHERE nb <= {_STACK_K})",
                f"{name} AS (SELECT fold, terminalno, greatest(0.0::DOUBLE, CASE WHEN count_if(dist = 0) > 0 "
                "THEN avg(CASE WHEN dist = 0 THEN label END) ELSE sum(CASE WHEN dist <> 0 THEN label / dist END) / "
                f"sum(CASE WHEN dist <> 0 THEN 1.0 / dist END) END) AS pred FROM {name}_top GROUP BY fold, terminalno)"]

    tests = "SELECT f.*, i.fold FROM feat f, range(5) i(fold) WHERE f.split = 'test'"
    ctes += nearest("oof", "SELECT * FROM trainf", "SELECT * FROM trainf", "y")
    ctes += nearest("fold_test", tests, "SELECT * FROM trainf", "y")
    ctes += ["layer1 AS (SELECT terminalno, avg(pred) AS layer1_preds FROM fold_test GROUP BY terminalno)",
             "relab AS (SELECT t.*, o.pred AS layer1_combine, 0.3::DOUBLE * o.pred + 0.7::DOUBLE * t.y AS newY "
             "FROM trainf t JOIN oof o USING (terminalno))"]
    ctes += nearest("refit", "SELECT *, -1 AS fold FROM feat WHERE split = 'test'", "SELECT * FROM relab", "newY")
    body = ("SELECT terminalno, y AS rawY, layer1_combine, newY, NULL::DOUBLE AS layer1_preds, NULL::DOUBLE AS pred FROM relab "
            "UNION ALL SELECT terminalno, NULL, NULL, NULL, layer1_preds, (r.pred + layer1_preds) / 2 "
            "FROM layer1 JOIN refit r USING (terminalno)")
    return o.rounded_auto(o.with_t(body, *ctes), ["terminalno", "rawY", "layer1_combine", "newY", "layer1_preds", "pred"])


@register("knn_stack_trace", _knn_stack_sql())
def knn_stack_trace(spark, sf_dir):
    """M8's flow (W3, J5, U3, P8, P9, K2) with a 3-NN base learner: the stacking trace."""
    ft = sub.feature_tables(_t(spark, sf_dir), "7")

    def refit_model(rows, test, label):
        # the refit's predictions are clamped like the layer's
        preds = knn_regress(rows, test, ft.features, _STACK_K, label=label)
        return preds.withColumn("pred", rw.clamp_nonnegative("pred"))

    layer1 = en.neighbour_layer(ft.features, _STACK_K, "y", "terminalno", 5)
    _, trace = en.stack(ft.train, ft.test, layer1, refit_model)
    return present(trace)


# --- missing values and keys ------------------------------------------------------------------
_GAPS = {"speed": 7, "direction": 5, "trip_id": 11, "terminalno": 13}


def _with_gaps(t):
    """The telemetry with a fixed share of missing speeds, directions, trips and drivers (by seq)."""
    return t.withColumns({c: F.when(F.col("seq") % m != 0, F.col(c)) for c, m in _GAPS.items()})


# the original's grouping: rows without a driver or trip belong to no group of it
_GAP_T = o.TELEMETRY_CTE.replace("t AS (", "t0 AS (", 1) + ", t AS (SELECT * REPLACE (" + ", ".join(
    f"CASE WHEN seq % {m} <> 0 THEN {c} END AS {c}" for c, m in _GAPS.items()) + ") FROM t0 WHERE seq % 13 <> 0)"
_GAP_ACC = f"""acc AS (
  SELECT {o.K}, CASE WHEN trip_id IS NULL THEN 0.0::DOUBLE ELSE coalesce(speed - lag(speed) OVER (
    PARTITION BY {o.K}, trip_id ORDER BY time NULLS FIRST, seq), 0.0::DOUBLE) END AS a FROM t)"""


def _gap_feature_ctes() -> list[str]:
    ctes = [o.TRIP_CTE.replace(f"FROM t GROUP BY {o.K}, trip_id", f"FROM t WHERE trip_id IS NOT NULL GROUP BY {o.K}, trip_id"),
            _GAP_ACC] + [f"b_{b} AS ({o.BLOCK_SQL[b]})" for b in _ALL_61]
    joins = " ".join(f"LEFT JOIN b_{b} USING ({o.K})" for b in _ALL_61[1:])
    return ctes + [f"feat AS (SELECT {o.K}, {', '.join(fx.FEATURES_61)}, y FROM b_{_ALL_61[0]} {joins})"]


@register("gap_features_61", o.rounded_auto(
    o.with_t(f"SELECT {o.K}, {', '.join(fx.FEATURES_61)}, y FROM feat", *_gap_feature_ctes(), telemetry=_GAP_T),
    ["split", "terminalno", *fx.FEATURES_61, "y"]))
def gap_features_61(spark, sf_dir):
    """A20 on telemetry with missing speeds, directions, trips and drivers."""
    return present(fx.driver_features(_with_gaps(_t(spark, sf_dir)), "61"))


@register("gap_f_scores", o.rounded_auto(o.with_t(
    "SELECT feature, feature_index, n, r, f_score FROM scores",
    *_gap_feature_ctes(), *_f_scores_sql("61", fx.FEATURES_61)[-3:], telemetry=_GAP_T),
    ["feature", "feature_index", "n", "r", "f_score"]))
def gap_f_scores(spark, sf_dir):
    """M1 on the gap telemetry: a missing feature counts as 0."""
    train = split_side(_with_gaps(_t(spark, sf_dir)), "train")
    return present(sel.f_scores(fx.driver_features(train, "61"), fx.FEATURES_61))


_GAP_CORR = ["speed_mean", "direction_var_mean", "acc_gap", "y"]


@register("gap_corr", o.rounded(o.with_t(
    "SELECT l.name AS a, r.name AS b, corr(l.v, r.v) AS r FROM long l JOIN long r USING (terminalno) GROUP BY l.name, r.name",
    *_gap_feature_ctes(),
    "g AS (SELECT terminalno, speed_mean, direction_var_mean, y, CASE WHEN terminalno % 3 <> 0 THEN mean_acc END AS acc_gap "
    "FROM feat WHERE split = 'train')",
    "long AS (" + " UNION ALL ".join(f"SELECT terminalno, '{c}' AS name, CAST({c} AS DOUBLE) AS v FROM g" for c in _GAP_CORR) + ")",
    telemetry=_GAP_T), keep=["a", "b"], d4=["r"]))
def gap_corr(spark, sf_dir):
    """K5 on the gap telemetry: each pair's correlation is over the drivers that have both values."""
    feats = fx.driver_features(split_side(_with_gaps(_t(spark, sf_dir)), "train"), "61")
    feats = feats.withColumn("acc_gap", F.when(F.col("terminalno") % 3 != 0, F.col("mean_acc")))
    return present(sel.correlation_matrix(feats, _GAP_CORR))


# --- second, larger fixture: order lines as telemetry (customer -> order -> line) ---------


@register("order_features_61", o.blocks_sql(_ALL_61, list(fx.FEATURES_61) + ["y"], telemetry=o.ORDER_TELEMETRY_CTE))
def order_features_61(spark, sf_dir):
    """A20 on the order-line adapter: the fused 61-feature chain behind an orders-lineitem join."""
    return present(fx.driver_features(order_telemetry_from_dir(spark, sf_dir), "61"))
