import math
import random

import pytest
from pyspark.sql import functions as F

from telemetry_rows import telemetry
from tripwise.config import FeatureConfig
from tripwise.operators import features as fx
from tripwise.operators.rows import speed_diffs

SUN_2350 = 1704671400  # 2024-01-07 23:50:00 UTC, a Sunday


def stats(df, cols, cfg=FeatureConfig()):
    return {r["terminalno"]: r.asDict() for r in fx.driver_statistics(df, cols, cfg).collect()}


def test_one_row_trip(spark):
    df = telemetry(spark, [dict(time=100, speed=12.0, direction=30.0, height=5.0)])
    s = stats(df, fx.DIRECTION + fx.HEIGHT + fx.DURATION + fx.ACCELERATION)[1]
    assert s["direction_var_max"] == 0.0 and s["height_var_mean"] == 0.0
    assert s["time_duration_max"] == 0 and s["time_duration_mean"] == 0.0
    assert s["max_acc"] == 0.0 and s["min_acc"] == 0.0 and s["var_acc"] == 0.0


def test_baseline_one_record_driver_var_speed_is_minus_one(spark):
    df = telemetry(spark, [dict(terminalno=2, time=5, speed=30.0, y=1.5)])
    row = fx.driver_features(df, "baseline").collect()[0]
    assert row["var_speed"] == -1.0
    assert row["num_of_records"] == 1 and row["num_of_trips"] == 1
    assert row["target"] == 1.5


def test_missing_speed_mid_trip(spark):
    df = telemetry(spark, [dict(time=1, speed=10.0), dict(time=2, speed=None), dict(time=3, speed=30.0)])
    diffs = [r["speed_diff"] for r in speed_diffs(df).orderBy("seq").collect()]
    assert diffs == [0.0, 0.0, 0.0]
    s = stats(df, ["speed_mean"] + fx.ACCELERATION)[1]
    assert s["speed_mean"] == 20.0 and s["max_acc"] == 0.0 and s["mean_acc"] == 0.0


def test_nan_speed_is_missing(spark):
    df = telemetry(spark, [dict(time=1, speed=10.0), dict(time=2, speed=float("nan"))])
    s = stats(df, ["speed_max", "speed_mean"])[1]
    assert s["speed_max"] == 10.0 and s["speed_mean"] == 10.0


def test_missing_call_state_counts_in_denominator(spark):
    df = telemetry(spark, [dict(callstate=0), dict(callstate=None, seq=1, time=1), dict(callstate=1, time=2)])
    s = stats(df, fx.CALLS)[1]
    assert s["count0"] == pytest.approx(1 / 3) and s["count1"] == pytest.approx(1 / 3)


def test_smoothed_call_share(spark):
    df = telemetry(spark, [dict(callstate=c, time=i) for i, c in enumerate([0, 0, 1, 2])])
    s = stats(df, fx.CALLS_SMOOTHED)[1]
    assert s["count1_s"] == pytest.approx(1 / 3) and s["count2_s"] == pytest.approx(1 / 3)
    assert s["count3_s"] == 0.0


def test_trip_over_midnight_takes_max_weekday(spark):
    df = telemetry(spark, [dict(time=SUN_2350), dict(time=SUN_2350 + 1200)])
    s = stats(df, fx.WEEKDAYS)[1]
    assert s["sun"] == 1.0 and s["mon"] == 0.0


def test_unknown_direction_kept_by_default(spark):
    df = telemetry(spark, [dict(time=1, direction=-1.0), dict(time=2, direction=90.0)])
    kept = stats(df, ["direction_var_max"])[1]["direction_var_max"]
    dropped = stats(df, ["direction_var_max"], FeatureConfig(drop_unknown_direction=True))[1]["direction_var_max"]
    assert kept == pytest.approx(((-1 - 44.5) ** 2 + (90 - 44.5) ** 2) / 1)
    assert dropped == 0.0


def test_non_dense_trip_ids(spark):
    df = telemetry(spark, [dict(trip_id=t, time=i) for i, t in enumerate([1, 2, 9])])
    s = stats(df, ["trip_max", "num_of_trips"])[1]
    assert s["trip_max"] == 9 and s["num_of_trips"] == 3


def test_time_zone_parameter(spark):
    df = telemetry(spark, [dict(time=1476923580)])
    utc = stats(df, fx.HOURS)[1]
    sh = stats(df, fx.HOURS, FeatureConfig(tz="Asia/Shanghai"))[1]
    assert utc["hour0"] == 1.0 and sh["hour8"] == 1.0


def test_duplicate_timestamps_ordered_by_seq(spark):
    df = telemetry(spark, [dict(time=5, speed=10.0, seq=2), dict(time=5, speed=40.0, seq=1)])
    diffs = {r["seq"]: r["speed_diff"] for r in speed_diffs(df).collect()}
    assert diffs == {1: 0.0, 2: -30.0}


def _random_rows(n=400, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        rows.append(dict(
            terminalno=rnd.randint(1, 6), trip_id=rnd.randint(1, 4),
            time=rnd.randint(0, 4) * 3600 + rnd.choice([0, 1799, 3599, 3600]) + rnd.randint(0, 3),
            speed=rnd.choice([None, float("nan")] + [round(rnd.uniform(0, 60), 2)] * 8),
            direction=round(rnd.uniform(-1, 360), 1), height=round(rnd.uniform(0, 100), 1),
            callstate=rnd.choice([0, 1, 2, 3, 4, None]), y=float(rnd.randint(0, 3)) / 2,
            longitude=113 + rnd.random(), latitude=22 + rnd.random(), seq=i))
    for r in rows[::37]:
        r["time"] = None  # rows without TIME come first in their trip
    return rows


def test_slices_equal_whole_trips(spark):
    """Time-sliced speed differences equal the whole-trip window, row by row and aggregated."""
    df = telemetry(spark, _random_rows())
    cols = fx.FEATURES_61 + ["var_speed"]
    a = {r["terminalno"]: r for r in fx.driver_statistics(df, cols, FeatureConfig(trip_split_seconds=1800)).collect()}
    b = {r["terminalno"]: r for r in fx.driver_statistics(df, cols, FeatureConfig(trip_split_seconds=None)).collect()}
    assert a.keys() == b.keys()
    for k in a:
        for c in cols:
            x, y = a[k][c], b[k][c]
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-9, abs=1e-9), (k, c)
    r1 = {r["seq"]: r["speed_diff"] for r in speed_diffs(df, FeatureConfig(trip_split_seconds=600)).collect()}
    r2 = {r["seq"]: r["speed_diff"] for r in speed_diffs(df, FeatureConfig(trip_split_seconds=None)).collect()}
    assert r1 == pytest.approx(r2)


def test_fused_equals_unfused(spark):
    df = telemetry(spark, _random_rows(200, seed=3))
    fused = {r["terminalno"]: r for r in fx.driver_features(df, "61").collect()}
    unfused = {r["terminalno"]: r for r in fx.unfused_feature_blocks(df).collect()}
    for k in fused:
        for c in fx.FEATURES_61 + ["y"]:
            x, y = fused[k][c], unfused[k][c]
            assert (x is None and y is None) or x == pytest.approx(y, rel=1e-12), (k, c)


def test_shares_sum_to_one(spark):
    # the invariant holds when TIME is complete (a row without TIME has no hour)
    df = telemetry(spark, [r for r in _random_rows(300, seed=5) if r["time"] is not None])
    for r in fx.driver_features(df, "61").collect():
        assert sum(r[h] for h in fx.HOURS) == pytest.approx(1.0)
        assert sum(r[d] for d in fx.WEEKDAYS) == pytest.approx(1.0)


def test_fused_plan_has_six_exchanges(spark):
    """One of driver partials, two of trip partials, three behind the rows' speeds; the joins add none."""
    import re

    df = fx.driver_features(telemetry(spark, _random_rows(50)), "61")
    plan = df._jdf.queryExecution().executedPlan().toString()  # initial adaptive plan, not executed
    assert plan.count("Exchange hashpartitioning") <= 6
    assert "SortAggregate" not in plan
    # the ordered window reads key, trip, time, seq and speed only
    below = plan[plan.index("Window"):].split("Exchange hashpartitioning")
    rows = next(x for x in below[1:] if "Aggregate" not in x.split("\n")[1])
    assert not re.search("height|longitude|latitude|callstate|direction", rows.split("\n")[1])


def test_trip_sketches_merge_and_hold_their_bound(spark):
    rows = spark.range(60_000).select(
        (F.col("id") % 3).alias("terminalno"), F.when(F.col("id") % 3 < 2, F.col("id") % 20_011).otherwise(F.col("id") % 50).alias("trip_id"))
    rows = rows.unionByName(spark.createDataFrame([(7, None), (None, 5)], "terminalno bigint, trip_id bigint"))
    exact = {r[0]: r[1] for r in rows.filter("terminalno is not null").groupBy("terminalno").agg(F.count_distinct("trip_id")).collect()}
    halves = [fx.trip_sketches(rows.filter(F.coalesce(F.col("trip_id") % 2, F.lit(0)) == i)) for i in (0, 1)]
    merged = {r["terminalno"]: r["num_of_trips_approx"] for r in fx.trips_approx(fx.merged_sketches(*halves)).collect()}
    whole = {r["terminalno"]: r["num_of_trips_approx"] for r in fx.trips_approx(fx.trip_sketches(rows)).collect()}
    assert merged.keys() == whole.keys() == exact.keys() and merged[7] == 0 and whole[2] == exact[2] == 50
    for k, n in exact.items():
        for got in (merged[k], whole[k]):
            assert abs(got - n) <= 3 * fx.TRIP_SKETCH_ERROR * n
    sizes = fx.trip_sketches(rows).select(F.max(F.length("trip_sketch"))).first()[0]
    assert sizes < 5000


def test_result_independent_of_partitioning(spark):
    df = telemetry(spark, _random_rows(300, seed=11))
    a = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
               for r in fx.driver_features(df, "61").collect())
    b = sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
               for r in fx.driver_features(df.repartition(7, "seq"), "61").collect())
    assert a == b


def test_distance_to_anchor_is_zero_at_anchor(spark):
    from tripwise.config import ANCHOR_LAT, ANCHOR_LON

    df = telemetry(spark, [dict(longitude=ANCHOR_LON, latitude=ANCHOR_LAT)])
    s = stats(df, ["dis_max"])[1]
    assert s["dis_max"] == pytest.approx(0.0, abs=1e-6)
    one_degree = telemetry(spark, [dict(longitude=ANCHOR_LON, latitude=ANCHOR_LAT + 1.0)])
    assert stats(one_degree, ["dis_max"])[1]["dis_max"] == pytest.approx(6371000 * math.pi / 180, rel=1e-9)


def test_driver_only_blocks_shuffle_once(spark):
    df = telemetry(spark, _random_rows(50))
    for cols in (fx.SPEED, fx.GPS, fx.CALLS + fx.HOURS, ["y", "trip_max"]):
        plan = fx.driver_statistics(df, cols)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1, cols


def test_first_record_order(spark):
    big = 2 ** 62
    df = telemetry(spark, [
        dict(terminalno=1, time=20, seq=-big, longitude=1.0), dict(terminalno=1, time=10, seq=big, longitude=2.0),
        dict(terminalno=1, time=10, seq=5, longitude=3.0, y=2.5),
        dict(terminalno=2, time=None, seq=9, longitude=4.0), dict(terminalno=2, time=0, seq=0, longitude=5.0),
    ])
    s = stats(df, ["start_lon", "first_y"])
    assert s[1]["start_lon"] == 3.0 and s[1]["first_y"] == 2.5
    assert s[2]["start_lon"] == 4.0
    plan = fx.driver_statistics(df, ["start_lon", "dis"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


@pytest.mark.parametrize("split_seconds", [0, 3600])
def test_missing_drivers_and_trips(spark, split_seconds):
    """Rows without a driver make no driver; rows without a trip count for the driver, not as a trip."""
    rows = [dict(terminalno=1, trip_id=1, time=10, direction=1.0, speed=1.0, height=1.0),
            dict(terminalno=1, trip_id=1, time=20, direction=3.0, speed=4.0, height=1.0),
            dict(terminalno=1, trip_id=None, time=30, direction=0.0, speed=50.0, height=9.0),
            dict(terminalno=1, trip_id=None, time=90000, direction=10.0, speed=90.0, height=20.0),
            dict(terminalno=None, trip_id=1, time=30, direction=0.0, speed=50.0),
            dict(terminalno=2, trip_id=None, time=30, direction=5.0, speed=7.0)]
    df = telemetry(spark, rows)
    out = {r["terminalno"]: r for r in fx.driver_statistics(
        df, ["direction_var_mean", "direction_var_max", "height_var_max", "time_duration_max", "num_of_trips",
             "speed_max", "num_of_records", "max_acc", "mean_acc", "mon"], FeatureConfig(trip_split_seconds=split_seconds)).collect()}
    assert set(out) == {1, 2}
    one, two = out[1], out[2]
    assert (one["direction_var_mean"], one["direction_var_max"], one["height_var_max"]) == (2.0, 2.0, 0.0)
    assert (one["time_duration_max"], one["num_of_trips"], one["speed_max"], one["num_of_records"]) == (10, 1, 90.0, 4)
    assert (one["max_acc"], one["mean_acc"]) == (3.0, 0.75)
    assert two["direction_var_mean"] is None and two["mon"] is None and two["max_acc"] == 0.0
    assert {r["trip_id"] for r in fx.trip_table(df).collect()} == {1}
