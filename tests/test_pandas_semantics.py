"""The fused Spark chain against a direct pandas computation of the same definitions,
on random rows with missing / NaN values, duplicate timestamps and trips that
cross slice boundaries."""

import numpy as np
import pandas as pd
import pytest

from telemetry_rows import telemetry
from tripwise.config import ANCHOR_LAT, ANCHOR_LON, FeatureConfig
from tripwise.operators import features as fx


def _rows(seed, n=500):
    rng = np.random.default_rng(seed)
    speed = np.round(rng.uniform(0, 80, n), 2)
    speed[rng.random(n) < 0.1] = np.nan
    call = rng.integers(0, 5, n).astype(float)
    call[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({
        "terminalno": rng.integers(1, 9, n),
        "trip_id": rng.integers(1, 5, n),
        "time": 1704067200 + rng.integers(0, 6, n) * 86400 + rng.integers(0, 20000, n),
        "longitude": 113 + rng.random(n), "latitude": 22 + rng.random(n),
        "direction": np.round(rng.uniform(-1, 360, n), 1), "height": np.round(rng.uniform(0, 90, n), 1),
        "speed": speed, "callstate": call, "y": (rng.integers(0, 4, n) / 2.0), "seq": np.arange(n),
    })


def _haversine(lon, lat):
    lam1, phi1, lam2, phi2 = map(np.radians, (lon, lat, ANCHOR_LON, ANCHOR_LAT))
    a = np.sin((phi2 - phi1) / 2) ** 2 + np.cos(phi1) * np.cos(phi2) * np.sin((lam2 - lam1) / 2) ** 2
    return 2 * np.arcsin(np.sqrt(a)) * 6371000.0


def _expected(p: pd.DataFrame) -> pd.DataFrame:
    p = p.sort_values(["time", "seq"]).copy()
    p["hour"] = (p.time // 3600) % 24
    p["wd"] = (p.time // 86400 + 3) % 7
    p["dis"] = _haversine(p.longitude, p.latitude)
    p["acc"] = p.groupby(["terminalno", "trip_id"]).speed.diff().fillna(0.0)
    by_d, by_t = p.groupby("terminalno"), p.groupby(["terminalno", "trip_id"])
    n = by_d.size()
    e = pd.DataFrame(index=n.index)
    e["speed_max"], e["speed_mean"] = by_d.speed.max(), by_d.speed.mean()
    dv, hv = by_t.direction.var().fillna(0.0), by_t.height.var().fillna(0.0)
    e["direction_var_max"], e["direction_var_mean"] = dv.groupby(level=0).max(), dv.groupby(level=0).mean()
    for k in range(5):
        e[f"count{k}"] = (p.callstate == k).groupby(p.terminalno).sum() / n
    e["height_mean"] = by_d.height.mean()
    e["height_var_max"], e["height_var_mean"] = hv.groupby(level=0).max(), hv.groupby(level=0).mean()
    for h in range(24):
        e[f"hour{h}"] = (p.hour == h).groupby(p.terminalno).sum() / n
    e["height_max"], e["height_min"] = by_d.height.max(), by_d.height.min()
    e["lon_max"], e["lon_min"] = by_d.longitude.max(), by_d.longitude.min()
    e["lat_max"], e["lat_min"] = by_d.latitude.max(), by_d.latitude.min()
    e["lat_mean"], e["lon_mean"] = by_d.latitude.mean(), by_d.longitude.mean()
    e["dis_mean"], e["dis_min"], e["dis_max"] = by_d.dis.mean(), by_d.dis.min(), by_d.dis.max()
    e["trip_max"] = by_d.trip_id.max()
    twd = by_t.wd.max()
    for k, name in enumerate(fx.WEEKDAYS):
        e[name] = (twd == k).groupby(level=0).mean()
    e["max_acc"], e["min_acc"], e["mean_acc"] = by_d.acc.max(), by_d.acc.min(), by_d.acc.mean()
    e["var_acc"] = by_d.acc.var().fillna(0.0)
    dur = by_t.time.max() - by_t.time.min()
    e["time_duration_max"], e["time_duration_mean"] = dur.groupby(level=0).max(), dur.groupby(level=0).mean()
    e["y"] = by_d.y.max()
    return e


@pytest.mark.parametrize("seed,split", [(0, 3600), (1, 600), (2, None)])
def test_61_features_match_pandas(spark, seed, split):
    p = _rows(seed)
    rows = [{k: (None if isinstance(v, float) and np.isnan(v) and k == "callstate" else v)
             for k, v in r.items()} for r in p.to_dict("records")]
    for r in rows:
        for k in ("terminalno", "trip_id", "time", "seq"):
            r[k] = int(r[k])
        r["callstate"] = None if r["callstate"] is None else int(r["callstate"])
    df = telemetry(spark, rows)
    got = fx.driver_features(df, "61", FeatureConfig(trip_split_seconds=split)).toPandas().set_index("terminalno")
    exp = _expected(p)
    for c in fx.FEATURES_61 + ["y"]:
        np.testing.assert_allclose(got.loc[exp.index, c].astype(float), exp[c].astype(float), rtol=1e-9,
                                   atol=1e-9, err_msg=c)
