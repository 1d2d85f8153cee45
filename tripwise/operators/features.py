"""Per-driver feature tables from telemetry rows, as one fused aggregation chain.

The original computed every feature block with its own group-by and then merged
the blocks on the driver key (one shuffle per block plus a join per merge).  Here
every block only contributes aggregate expressions to a single chain:

    rows --(key, trip[, time slice])--> trip partials --(key)--> one row per driver

* Trip-level statistics (direction/height variance, duration, weekday) are
  computed from mergeable partials (count, mean, M2, max, min, sums, counts).
* Driver-level statistics over rows (speed, gps, call-state and hour shares)
  are merged from the same trip partials, so no second pass over the rows.
* The only ordered operator, the in-trip speed difference, runs as a window over
  (key, trip, time // trip_split_seconds) slices; the first row of each slice is
  linked to the last row of the previous slice with a second, tiny window over
  slice summaries.  A trip holding a large share of all rows is thereby spread
  over many tasks.  Partial aggregation absorbs a driver holding many rows.

Each output names the partial families it needs, and only those are built, so
a two-column block runs a two-column chain.  What needs the order of the rows (the speed
difference) moves rows, with the five columns it reads; what needs trips moves trip
partials and everything else driver partials, both combined before their exchange.  The
three chains meet on the driver.  Aggregates are written as SQL
expression strings: one JVM call each, all evaluated inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.config import FeatureConfig
from tripwise.functions.geo import haversine_m, haversine_m_sql
from tripwise.functions.timeparts import hour_of_day, weekday

KEY = "terminalno"
TRIP = "trip_id"

# ---------------------------------------------------------------------------
# Fixed output names (the original's names, made unique where it relied on
# frame-library suffixes): 24 hour shares, 7 weekday shares, 5 call shares.
HOURS = [f"hour{h}" for h in range(24)]
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
CALLS = [f"count{k}" for k in range(5)]
CALLS_SMOOTHED = ["count1_s", "count2_s", "count3_s"]

SPEED = ["speed_max", "speed_mean"]
DIRECTION = ["direction_var_max", "direction_var_mean"]
HEIGHT = ["height_mean", "height_var_max", "height_var_mean"]
GPS = ["height_max", "height_min", "lon_max", "lon_min", "lat_max", "lat_min",
       "lat_mean", "lon_mean", "dis_mean", "dis_min", "dis_max"]
GPS_SHORT = GPS[:6]
TRIPS = ["trip_max"]
ACCELERATION = ["max_acc", "min_acc", "mean_acc", "var_acc"]
DURATION = ["time_duration_max", "time_duration_mean"]

FEATURES_61 = (SPEED + DIRECTION + CALLS + HEIGHT + HOURS + GPS + TRIPS + WEEKDAYS
               + ACCELERATION + DURATION)
FEATURES_59 = [c for c in FEATURES_61 if c not in DURATION]
FEATURES_42 = SPEED + DIRECTION + CALLS + ["height_mean", "height_var_mean"] + HOURS + GPS_SHORT + TRIPS
FEATURES_7 = SPEED + DIRECTION + CALLS_SMOOTHED

# Baseline set: its own names for a subset of the driver statistics.
BASELINE_FEATURES = (["num_of_trips", "num_of_records"]
                     + [f"num_of_state_{k}" for k in range(5)]
                     + ["mean_speed", "var_speed", "mean_height"]
                     + [f"h{h}" for h in range(24)] + ["dis"])

FEATURE_SETS = {
    "61": FEATURES_61,
    "59": FEATURES_59,
    "42": FEATURES_42,
    "7": FEATURES_7,
    "baseline": BASELINE_FEATURES,
}


# outputs that need a statistic per trip (and so the trip level of the chain)
NEEDS_TRIPS = frozenset(DIRECTION + ["direction_var_min", "height_var_max", "height_var_mean"] + DURATION
                        + WEEKDAYS + ACCELERATION + ["num_of_trips"])


def group_keys(df: DataFrame) -> list[str]:
    """Driver key, plus the train/test tag when present (a driver may be on both sides)."""
    return (["split"] if "split" in df.columns else []) + [KEY]


# ---------------------------------------------------------------------------
# partial families: aggregates from rows (unit level) and merges of partials

_SUMMED = ["spd", "hgt", "lon", "lat", "dis", "y"]
_EXTREMES = ["spd", "hgt", "lon", "lat", "dis", "tim"]
_MOMENTS = {"spdm": "spd", "dirm": "dir", "hgtm": "hgt"}
ALL_FAMILIES = frozenset({"rows", "calls", "hours", "wd", "ymax", "seq", "first", "acc"} | set(_MOMENTS)
                         | {f"{p}_sum" for p in _SUMMED} | {f"{p}_ext" for p in _EXTREMES})


#: Size of the distinct-trip sketches (2^k registers) and the relative standard error that it gives.
TRIP_SKETCH_LOG2 = 12
TRIP_SKETCH_ERROR = 1.04 / 2 ** (TRIP_SKETCH_LOG2 / 2)


def _moments_unit(p: str, x: str) -> list[str]:
    return [f"count({x}) AS {p}_n", f"avg({x}) AS {p}_mean",
            f"coalesce(var_pop({x}) * count({x}), 0D) AS {p}_m2"]


def _s1(p: str) -> str:
    return f"sum(CASE WHEN {p}_n > 0 THEN {p}_n * {p}_mean END)"


def _m2_merged(p: str) -> str:
    """Merged M2 of sub-groups: sum M2_i + sum n_i mean_i^2 - (sum n_i mean_i)^2 / N (one pass)."""
    s2 = f"sum(CASE WHEN {p}_n > 0 THEN {p}_n * {p}_mean * {p}_mean END)"
    return f"coalesce(greatest(sum({p}_m2) + {s2} - {_s1(p)} * {_s1(p)} / nullif(sum({p}_n), 0), 0D), 0D)"


def _moments_merge(p: str) -> list[str]:
    return [f"sum({p}_n) AS {p}_n", f"{_s1(p)} / nullif(sum({p}_n), 0) AS {p}_mean", f"{_m2_merged(p)} AS {p}_m2"]


def _family_unit(fam: str) -> list[str]:
    """Aggregates of one unit (trip or trip slice) straight from rows."""
    if fam == "rows":
        return ["count(1) AS n_rows"]
    if fam.endswith("_sum"):
        p = fam[:-4]
        return [f"count({p}) AS {p}_cnt", f"sum({p}) AS {p}_sum"]
    if fam.endswith("_ext"):
        p = fam[:-4]
        return [f"max({p}) AS {p}_max", f"min({p}) AS {p}_min"]
    if fam in _MOMENTS:
        return _moments_unit(fam, _MOMENTS[fam])
    if fam == "calls":
        return [f"count_if(callstate = {k}) AS c{k}" for k in range(5)]
    if fam == "hours":
        return [f"count_if(hr = {h}) AS hr{h}" for h in range(24)]
    if fam == "wd":
        return ["max(wd) AS wd_max"]
    if fam == "ymax":
        return ["max(y) AS y_max"]
    if fam == "tripset":
        return [f"hll_sketch_agg({TRIP}, {TRIP_SKETCH_LOG2}) AS trip_sketch"]
    if fam == "seq":
        return ["min(seq) AS seq_min"]
    if fam == "first":
        # earliest record of the unit in (time, seq) order, with its values
        return ["min(first_key) AS first_key"] + [f"min_by({c}, first_key) AS first_{c}" for c in ("lon", "lat", "y")]
    if fam == "acc":
        return _moments_unit("acc", "acc_x") + ["max(acc_x) AS acc_max", "min(acc_x) AS acc_min"]
    raise KeyError(fam)


def _family_merge(fam: str) -> list[str]:
    """Aggregates that merge unit partials into a coarser group."""
    if fam == "rows":
        return ["sum(n_rows) AS n_rows"]
    if fam.endswith("_sum"):
        p = fam[:-4]
        return [f"sum({p}_cnt) AS {p}_cnt", f"sum({p}_sum) AS {p}_sum"]
    if fam.endswith("_ext"):
        p = fam[:-4]
        return [f"max({p}_max) AS {p}_max", f"min({p}_min) AS {p}_min"]
    if fam in _MOMENTS:
        return _moments_merge(fam)
    if fam == "calls":
        return [f"sum(c{k}) AS c{k}" for k in range(5)]
    if fam == "hours":
        return [f"sum(hr{h}) AS hr{h}" for h in range(24)]
    if fam == "wd":
        return ["max(wd_max) AS wd_max"]
    if fam == "ymax":
        return ["max(y_max) AS y_max"]
    if fam == "tripset":
        return ["hll_union_agg(trip_sketch) AS trip_sketch"]
    if fam == "seq":
        return ["min(seq_min) AS seq_min"]
    if fam == "first":
        return ["min(first_key) AS first_key"] + [f"min_by(first_{c}, first_key) AS first_{c}"
                                                  for c in ("lon", "lat", "y")]
    if fam == "acc":
        return _moments_merge("acc") + ["max(acc_max) AS acc_max", "min(acc_min) AS acc_min"]
    raise KeyError(fam)


def _exprs(strings: Iterable[str]) -> list[Column]:
    return [F.expr(s) for s in strings]


# ---------------------------------------------------------------------------
# driver-level outputs: (families needed, SQL aggregate over trip partials)

def _var_samp(p: str) -> str:
    return f"CASE WHEN {p}_n >= 2 THEN {p}_m2 / ({p}_n - 1) END"


def _mean(p: str) -> str:
    return f"sum({p}_sum) / nullif(sum({p}_cnt), 0)"


def _share(count: str, total: str) -> str:
    return f"CAST({count} AS DOUBLE) / CAST({total} AS DOUBLE)"


def _outputs(cfg: FeatureConfig) -> dict[str, tuple[set[str], str]]:
    # rows without a trip form no trip (the original's grouping drops missing keys)
    trip = f"{TRIP} IS NOT NULL"
    dir_var = f"CASE WHEN {trip} THEN coalesce({_var_samp('dirm')}, 0D) END"
    hgt_var = f"CASE WHEN {trip} THEN coalesce({_var_samp('hgtm')}, 0D) END"
    duration = f"CASE WHEN {trip} THEN tim_max - tim_min END"
    out: dict[str, tuple[set[str], str]] = {
        "speed_max": ({"spd_ext"}, "max(spd_max)"),
        "speed_min": ({"spd_ext"}, "min(spd_min)"),
        "speed_mean": ({"spd_sum"}, _mean("spd")),
        "direction_var_max": ({"dirm"}, f"max({dir_var})"),
        "direction_var_min": ({"dirm"}, f"min({dir_var})"),
        "direction_var_mean": ({"dirm"}, f"avg({dir_var})"),
        "height_mean": ({"hgt_sum"}, _mean("hgt")),
        "height_var_max": ({"hgtm"}, f"max({hgt_var})"),
        "height_var_mean": ({"hgtm"}, f"avg({hgt_var})"),
        "height_max": ({"hgt_ext"}, "max(hgt_max)"),
        "height_min": ({"hgt_ext"}, "min(hgt_min)"),
        "lon_max": ({"lon_ext"}, "max(lon_max)"),
        "lon_min": ({"lon_ext"}, "min(lon_min)"),
        "lat_max": ({"lat_ext"}, "max(lat_max)"),
        "lat_min": ({"lat_ext"}, "min(lat_min)"),
        "lat_mean": ({"lat_sum"}, _mean("lat")),
        "lon_mean": ({"lon_sum"}, _mean("lon")),
        "dis_mean": ({"dis_sum"}, _mean("dis")),
        "dis_min": ({"dis_ext"}, "min(dis_min)"),
        "dis_max": ({"dis_ext"}, "max(dis_max)"),
        "trip_max": (set(), f"max({TRIP})"),
        "time_duration_max": ({"tim_ext"}, f"max({duration})"),
        "time_duration_mean": ({"tim_ext"}, f"avg({duration})"),
        "num_of_trips": (set(), f"count({TRIP})"),
        "num_of_trips_approx": ({"tripset"}, "hll_sketch_estimate(hll_union_agg(trip_sketch))"),
        "num_of_records": ({"rows"}, "sum(n_rows)"),
        "y": ({"ymax"}, "max(y_max)"),
        "y_mean": ({"y_sum"}, _mean("y")),
        "start_lon": ({"first"}, "min_by(first_lon, first_key)"),
        "start_lat": ({"first"}, "min_by(first_lat, first_key)"),
        "first_y": ({"first"}, "min_by(first_y, first_key)"),
        "first_seq": ({"seq"}, "min(seq_min)"),
        "var_speed": ({"spdm"}, f"CASE WHEN sum(spdm_n) >= 2 THEN {_m2_merged('spdm')} / (sum(spdm_n) - 1) END"),
        "max_acc": ({"acc"}, "max(acc_max)"),
        "min_acc": ({"acc"}, "min(acc_min)"),
        "mean_acc": ({"acc"}, f"{_s1('acc')} / nullif(sum(acc_n), 0)"),
        "var_acc": ({"acc"}, f"coalesce(CASE WHEN sum(acc_n) >= 2 THEN {_m2_merged('acc')} / (sum(acc_n) - 1) END, 0D)"),
        "dis": ({"first"}, haversine_m_sql("min_by(first_lon, first_key)", "min_by(first_lat, first_key)",
                                           cfg.anchor_lon, cfg.anchor_lat, cfg.earth_radius_km)),
    }
    for k in range(5):
        out[f"count{k}"] = ({"calls", "rows"}, _share(f"sum(c{k})", "sum(n_rows)"))
        out[f"num_of_state_{k}"] = out[f"count{k}"]
    for k in (1, 2, 3):
        out[f"count{k}_s"] = ({"calls", "rows"}, _share(f"sum(c{k})", "sum(n_rows) - sum(c0) + 1"))
    for h in range(24):
        out[f"hour{h}"] = ({"hours", "rows"}, _share(f"sum(hr{h})", "sum(n_rows)"))
        out[f"h{h}"] = out[f"hour{h}"]
    for k, name in enumerate(WEEKDAYS):
        out[name] = ({"wd"}, _share(f"count_if(wd_max = {k} AND {trip})", f"nullif(count({TRIP}), 0)"))
    out["mean_speed"] = out["speed_mean"]
    out["mean_height"] = out["height_mean"]
    return out


# ---------------------------------------------------------------------------
# rows -> trip partials

# (time, seq) order as ONE exact number, so "first record" is a min_by with numeric
# buffers (hash aggregation) instead of a min over a struct (sort aggregation):
# key = time * 2e19 + (seq + 1e19); exact for any 64-bit seq and |time| < 1e18,
# rows without TIME first.
FIRST_KEY = ("CAST(coalesce(time, -1000000000000000000) AS DECIMAL(38,0)) * "
             "CAST(20000000000000000000 AS DECIMAL(38,0)) + "
             "(CAST(coalesce(seq, 0) AS DECIMAL(38,0)) + CAST(10000000000000000000 AS DECIMAL(38,0)))")


# windows over which a driver's rows without a trip are spread
ORPHAN_SPREAD = 1024


def _row_columns(df: DataFrame, cfg: FeatureConfig, families: set[str]) -> DataFrame:
    """The rows' own columns that ``families`` need; rows without a driver belong to no driver."""
    direction = F.col("direction")
    if cfg.drop_unknown_direction:
        direction = F.when(direction >= 0, direction)
    need = lambda *fams: bool(families & set(fams))
    first, acc = need("first"), need("acc")
    place = need("dis_sum", "dis_ext") or first
    cols = [*group_keys(df), TRIP]
    cols += [F.col(c) for c, used in (("time", acc or first or need("tim_ext", "hours", "wd")), ("seq", acc or first or need("seq")),
                                      ("y", first or need("ymax", "y_sum")), ("callstate", need("calls"))) if used]
    cols += [c.alias(n) for n, c, used in (
        ("spd", F.col("speed"), acc or need("spd_sum", "spd_ext", "spdm")), ("dir", direction, need("dirm")),
        ("hgt", F.col("height"), need("hgt_sum", "hgt_ext", "hgtm")),
        ("lon", F.col("longitude"), place or need("lon_sum", "lon_ext")),
        ("lat", F.col("latitude"), place or need("lat_sum", "lat_ext"))) if used]
    return df.filter(F.col(KEY).isNotNull()).select(*cols)


def _derived(rows: DataFrame, cfg: FeatureConfig, families: set[str]) -> DataFrame:
    """Columns computed from the rows' own ones: after the exchange of the rows, so that none of them moves."""
    cols = []
    if "tim_ext" in families:
        cols.append(F.col("time").alias("tim"))
    if families & {"dis_sum", "dis_ext"}:
        cols.append(haversine_m("lon", "lat", cfg.anchor_lon, cfg.anchor_lat, cfg.earth_radius_km).alias("dis"))
    if "hours" in families:
        cols.append(hour_of_day("time", cfg.tz).alias("hr"))
    if "wd" in families:
        cols.append(weekday("time", cfg.tz).alias("wd"))
    if "first" in families:
        cols.append(F.expr(FIRST_KEY).alias("first_key"))
    return rows.select("*", *cols) if cols else rows


def trip_partials(df: DataFrame, cfg: FeatureConfig = FeatureConfig(),
                  families: Iterable[str] | None = None) -> DataFrame:
    """One row per (keys, trip) with the mergeable partials of ``families`` (default: all).

    Rows without a driver are left out.  A driver's rows without a trip are one unit of
    a NULL trip: driver-level statistics merge it, trip-level ones leave it out, and
    the speed difference of its rows is 0.
    """
    fams = (set(families) if families is not None else set(ALL_FAMILIES)) | {"rows"}
    keys = group_keys(df)
    rows = _row_columns(df, cfg, fams)
    trip_keys = keys + [TRIP]
    ordered = sorted(fams)
    unit = [s for f in ordered for s in _family_unit(f)]
    if "acc" not in fams:
        return _derived(rows, cfg, fams).groupBy(*trip_keys).agg(*_exprs(unit))

    order = [F.col("time").asc_nulls_first(), F.col("seq").asc()]
    known = F.col(TRIP).isNotNull()
    # rows without a trip follow no order: their windows are spread by a hash
    spread = F.pmod(F.xxhash64("seq"), F.lit(ORPHAN_SPREAD))
    if not cfg.trip_split_seconds:
        # whole trip in one window partition; first row of a trip: difference 0
        w = Window.partitionBy(*trip_keys, F.when(~known, spread)).orderBy(*order)
        rows = rows.withColumn("acc_x", F.when(known, F.coalesce(F.col("spd") - F.lag("spd").over(w), F.lit(0.0)))
                               .otherwise(F.lit(0.0)))
        return _derived(rows, cfg, fams).groupBy(*trip_keys).agg(*_exprs(unit))

    # time-sliced trips: differences inside a slice, links between slices below
    width = int(cfg.trip_split_seconds)
    rows = rows.withColumn("slice", F.when(known, F.floor(F.col("time") / F.lit(width))).otherwise(spread))
    w = Window.partitionBy(*trip_keys, "slice").orderBy(*order)
    is_head = F.lag("seq").over(w).isNull()
    rows = rows.select(
        "*",
        F.when(~is_head, F.when(known, F.coalesce(F.col("spd") - F.lag("spd").over(w), F.lit(0.0)))
               .otherwise(F.lit(0.0))).alias("acc_x"),
        F.when(is_head, F.col("spd")).alias("head_x"),
        F.when(F.lead("seq").over(w).isNull(), F.col("spd")).alias("tail_x"),
    )
    # numeric aggregates only (hash aggregate, codegen): a slice's first and last
    # speed are the single non-null head_x / tail_x of the slice, NULL if missing
    slices = _derived(rows, cfg, fams).groupBy(*trip_keys, "slice").agg(
        *_exprs(unit),
        F.expr("max(head_x) AS head_spd"),
        F.expr("max(tail_x) AS tail_spd"),
    )
    # the link difference of each slice: its first row minus the previous slice's
    # last row (0 for the trip's first slice, 0 when either speed is missing)
    ws = Window.partitionBy(*trip_keys).orderBy(F.col("slice").asc_nulls_first())
    link = F.when(~known | F.lag(F.lit(1)).over(ws).isNull(), F.lit(0.0)).otherwise(
        F.coalesce(F.col("head_spd") - F.lag("tail_spd").over(ws), F.lit(0.0)))
    slices = slices.withColumn("link", link)
    n, mean, m2, b = F.col("acc_n"), F.col("acc_mean"), F.col("acc_m2"), F.col("link")
    acc_cols = {"acc_n", "acc_mean", "acc_m2", "acc_max", "acc_min", "link", "head_spd", "tail_spd"}
    slices = slices.select(
        *[c for c in slices.columns if c not in acc_cols],
        (n + 1).alias("acc_n"),
        F.when(n == 0, b).otherwise((n * mean + b) / (n + 1)).alias("acc_mean"),
        F.when(n == 0, F.lit(0.0)).otherwise(m2 + (b - mean) * (b - mean) * n / (n + 1)).alias("acc_m2"),
        F.greatest(F.col("acc_max"), b).alias("acc_max"),
        F.least(F.col("acc_min"), b).alias("acc_min"),
    )
    return slices.groupBy(*trip_keys).agg(*_exprs(s for f in ordered for s in _family_merge(f)))


# ---------------------------------------------------------------------------
# driver level

def driver_statistics(
    df: DataFrame,
    columns: Sequence[str],
    cfg: FeatureConfig = FeatureConfig(),
) -> DataFrame:
    """One row per driver (and split tag, when present) with ``columns``, in order.

    ``df`` is cleaned telemetry (see ``sources.telemetry``).  Any name of
    ``_outputs`` may be requested; the feature sets are lists of them.
    """
    columns = list(columns)
    outputs = _outputs(cfg)
    unknown = [c for c in columns if c not in outputs]
    if unknown:
        raise ValueError(f"unknown driver statistics: {unknown}")
    levels = [[c for c in columns if _level(c, outputs) == n] for n in range(3)]
    chains = [_chain(df, own, outputs, cfg) for own in levels if own]
    out = chains[0]
    for more in chains[1:]:  # the same drivers on every side, partitioned alike
        out = out.join(more, group_keys(df))
    return out.select(*group_keys(df), *columns)


def _level(column: str, outputs: dict[str, tuple[set[str], str]]) -> int:
    """What a statistic needs of the rows: 0 sums over a driver, 1 sums over a trip, 2 the order of a trip's rows."""
    return 2 if "acc" in outputs[column][0] else 1 if column in NEEDS_TRIPS else 0


def _chain(df: DataFrame, columns: Sequence[str], outputs: dict[str, tuple[set[str], str]], cfg: FeatureConfig) -> DataFrame:
    """The aggregation chain of statistics of one level, with the columns and partials they need and no others."""
    families = set().union(*(outputs[c][0] for c in columns))
    keys = group_keys(df)
    final = [F.expr(f"{outputs[c][1]} AS `{c}`") for c in columns]
    if not any(c in NEEDS_TRIPS for c in columns):
        # driver-level statistics only: the partials of a whole driver are built
        # straight from rows (one exchange); the outputs then aggregate a single
        # partial row per driver on the same partitioning (no second exchange)
        fams = sorted(families | {"rows"})
        rows = _derived(_row_columns(df, cfg, set(fams)), cfg, set(fams))
        unit = rows.groupBy(*keys).agg(*_exprs(s for f in fams for s in _family_unit(f)),
                                      F.expr(f"max({TRIP}) AS {TRIP}"))
        return unit.groupBy(*keys).agg(*final)
    trips = trip_partials(df, cfg, families)
    return trips.groupBy(*keys).agg(*final)


def driver_features(
    df: DataFrame,
    feature_set: str | Iterable[str] = "61",
    cfg: FeatureConfig = FeatureConfig(),
    with_label: bool = True,
) -> DataFrame:
    """The feature table of a named set (``61``, ``59``, ``42``, ``7``, ``baseline``).

    The label column ``y`` is max(Y) per driver (NULL on the test side).  The
    ``baseline`` set follows its own conventions: label = Y of the driver's
    first record, missing features -> -1, and -1 as the label of test drivers.
    """
    cols = list(FEATURE_SETS[feature_set]) if isinstance(feature_set, str) else list(feature_set)
    if feature_set == "baseline":
        out = driver_statistics(df, cols + ["first_y"], cfg)
        filled = out.fillna(-1, subset=cols)
        target = F.coalesce(F.col("first_y"), F.lit(-1.0))
        if "split" in df.columns:
            target = F.when(F.col("split") == "test", F.lit(-1.0)).otherwise(target)
        return filled.withColumn("target", target).drop("first_y")
    extra = ["y"] if with_label else []
    return driver_statistics(df, cols + extra, cfg)


def trip_sketches(df: DataFrame) -> DataFrame:
    """A13 as a mergeable sketch: one row per driver with ``trip_sketch``, an HLL sketch of its trip ids.

    At most some 2^k bytes a driver whatever its trips, and sketches of different days,
    regions or streams merge (``merged_sketches``) without the rows.  One exchange of partial
    sketches; rows without a trip count none.
    """
    return df.filter(F.col(KEY).isNotNull()).groupBy(*group_keys(df)).agg(
        F.hll_sketch_agg(F.col(TRIP).cast("bigint"), TRIP_SKETCH_LOG2).alias("trip_sketch"))


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    """The drivers' sketches over all of ``sketches``."""
    every = sketches[0]
    for s in sketches[1:]:
        every = every.unionByName(s)
    return every.groupBy(*group_keys(every)).agg(F.hll_union_agg("trip_sketch").alias("trip_sketch"))


def trips_approx(sketches: DataFrame) -> DataFrame:
    """(keys, num_of_trips_approx): estimates within three standard errors (3 * TRIP_SKETCH_ERROR) of the exact count
    in all but some 0.3 % of cases; small counts are exact."""
    return sketches.select(*group_keys(sketches), F.hll_sketch_estimate("trip_sketch").alias("num_of_trips_approx"))


def trip_table(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """A4: one row per trip: rows, direction and height variance (0 for < 2 values),
    duration (max - min TIME) and the trip's weekday (max over its rows)."""
    keys = group_keys(df)
    trips = trip_partials(df, cfg, {"rows", "dirm", "hgtm", "tim_ext", "wd"}).filter(F.col(TRIP).isNotNull())
    return trips.select(
        *keys, TRIP, "n_rows",
        F.expr(f"coalesce({_var_samp('dirm')}, 0D) AS dv"),
        F.expr(f"coalesce({_var_samp('hgtm')}, 0D) AS hv"),
        F.expr("tim_max - tim_min AS duration"),
        F.col("wd_max").alias("wd"),
    )


def join_features(*frames: DataFrame, on: Sequence[str] = (KEY,)) -> DataFrame:
    """J1 as a public operator: inner equi-join of feature frames on the driver key.

    The fused ``driver_features`` never needs it; it exists for frames that come
    from elsewhere.  Each join is a shuffle (or a broadcast chosen by the planner).
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.join(f, list(on), "inner")
    return out


def unfused_feature_blocks(df: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """The block-per-group-by form (one aggregation per block, then joins).

    Kept only as the honest comparison for the bench; same result as
    ``driver_features(df, "61")``.
    """
    blocks = [SPEED, DIRECTION, CALLS, HEIGHT, HOURS, GPS, TRIPS, WEEKDAYS, ACCELERATION, DURATION]
    frames = [driver_statistics(df, b, cfg) for b in blocks] + [driver_statistics(df, ["y"], cfg)]
    return join_features(*frames, on=group_keys(df))
