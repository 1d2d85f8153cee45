"""Row-level operators: ordered speed difference (W1), filters (F1-F4), label and
prediction arithmetic (P6-P9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.config import FeatureConfig
from tripwise.functions.geo import haversine_m
from tripwise.operators.features import TRIP, group_keys



def _order() -> list[Column]:
    return [F.col("time").asc_nulls_first(), F.col("seq").asc()]


def speed_diffs(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), out: str = "speed_diff") -> DataFrame:
    """SPEED minus the previous row's SPEED in the same trip, (time, seq) order.

    First row of a trip, or a missing speed on either side: 0 (D6).  With
    ``cfg.trip_split_seconds`` the window runs per (trip, time slice) and the
    first row of each slice is linked to the last row of the previous slice
    through a window over the (small) slice summaries, joined back on the slice.
    """
    keys = group_keys(df) + [TRIP]
    if not cfg.trip_split_seconds:
        w = Window.partitionBy(*keys).orderBy(*_order())
        return df.withColumn(out, F.coalesce(F.col("speed") - F.lag("speed").over(w), F.lit(0.0)))
    width = int(cfg.trip_split_seconds)
    # Rows with a missing key have no trip to difference in (0, as the original's
    # key grouping gave).  Filtering both join branches the same way keeps their
    # plans identical below the shuffle, so the rows are exchanged once and reused.
    known = None
    for k in keys:
        known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
    orphans = df.filter(~known).withColumn(out, F.lit(0.0))
    # rows without TIME form the first slice of their trip (sentinel slice number)
    rows = df.filter(known).withColumn("_slice", F.coalesce(F.floor(F.col("time") / F.lit(width)),
                                                            F.lit(-(2 ** 63)).cast("bigint")))
    w = Window.partitionBy(*keys, "_slice").orderBy(*_order())
    rows = rows.select(
        "*",
        F.lag("seq").over(w).isNull().alias("_head"),
        F.coalesce(F.col("speed") - F.lag("speed").over(w), F.lit(0.0)).alias("_d"),
        F.when(F.lead("seq").over(w).isNull(), F.col("speed")).alias("_tail_x"),
    )
    # per slice: first and last speed (numeric aggregates on the hash path)
    slices = rows.groupBy(*keys, "_slice").agg(
        F.max(F.when(F.col("_head"), F.col("speed"))).alias("_first"),
        F.max("_tail_x").alias("_tail"))
    ws = Window.partitionBy(*keys).orderBy("_slice")
    links = slices.select(
        *keys, "_slice",
        F.when(F.lag(F.lit(1)).over(ws).isNull(), F.lit(0.0))
         .otherwise(F.coalesce(F.col("_first") - F.lag("_tail").over(ws), F.lit(0.0))).alias("_link"))
    # every slice has its link row: inner equi-join on (keys, slice)
    joined = rows.join(links, on=keys + ["_slice"], how="inner")
    diff = F.when(F.col("_head"), F.col("_link")).otherwise(F.col("_d"))
    linked = joined.withColumn(out, diff).drop("_slice", "_head", "_d", "_tail_x", "_link")
    return linked.unionByName(orphans.select(*linked.columns))


def with_distance(df: DataFrame, cfg: FeatureConfig = FeatureConfig(), out: str = "hdis") -> DataFrame:
    """Distance in metres of every row to the configured anchor."""
    return df.withColumn(out, haversine_m("longitude", "latitude", cfg.anchor_lon, cfg.anchor_lat,
                                          cfg.earth_radius_km))


def call_state_rows(df: DataFrame, state: int) -> DataFrame:
    """rows in one call state (2 = incoming, 3 = connected)."""
    return df.filter(F.col("callstate") == F.lit(state))


def moving_rows(df: DataFrame, min_speed: float = 5.0) -> DataFrame:
    """rows with SPEED above a threshold (pushed into the scan by Catalyst)."""
    return df.filter(F.col("speed") > F.lit(float(min_speed)))


def positive_rows(df: DataFrame) -> DataFrame:
    """drop zero-claim rows; rows without a label (test side) are kept."""
    return df.filter(F.col("y").isNull() | (F.col("y") != F.lit(0.0)))


def scaled(c: Column | str, factor: float = 10.0) -> Column:
    """Label scaled before fitting (predictions stay on that scale unless divided back)."""
    c = F.col(c) if isinstance(c, str) else c
    return c * F.lit(float(factor))


def clamp_nonnegative(c: Column | str) -> Column:
    """Negative predictions -> 0 (NULL stays NULL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isNull(), c).otherwise(F.greatest(c, F.lit(0.0)))


def blend(a: Column | str, b: Column | str, wa: float, wb: float) -> Column:
    """Weighted sum of two aligned columns (alignment by key join, never by position)."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return a * F.lit(float(wa)) + b * F.lit(float(wb))
