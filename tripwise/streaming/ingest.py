"""Structured Streaming ingest of telemetry files into per-driver running totals.

The driver-level statistics that are plain sums / extremes / counts over rows
(speed, height and position extremes and means, call-state and hour shares,
record count, last trip id, label, an HLL sketch of the trips) are maintained incrementally: each micro-batch
is partially aggregated with the same partial families as the batch chain and
merged into the streaming state keyed by driver.  The state holds one row per
driver.  Trip-level statistics (variances per trip, durations, weekdays) need a
closed trip, which the telemetry does not signal; they stay in the batch chain.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwise.config import FeatureConfig
from tripwise.operators.features import KEY, _derived, _family_unit, _row_columns
from tripwise.sources.telemetry import COLUMNS, TEST_SCHEMA, TRAIN_SCHEMA, clean_telemetry

_FAMILIES = ["rows", "spd_sum", "spd_ext", "hgt_sum", "hgt_ext", "lon_sum", "lon_ext", "lat_sum", "lat_ext",
             "dis_sum", "dis_ext", "calls", "hours", "ymax", "tripset"]

# driver-level outputs as projections of the running totals
_PROJECTIONS = {
    "speed_max": "spd_max", "speed_min": "spd_min", "speed_mean": "spd_sum / nullif(spd_cnt, 0)",
    "height_max": "hgt_max", "height_min": "hgt_min", "height_mean": "hgt_sum / nullif(hgt_cnt, 0)",
    "lon_max": "lon_max", "lon_min": "lon_min", "lon_mean": "lon_sum / nullif(lon_cnt, 0)",
    "lat_max": "lat_max", "lat_min": "lat_min", "lat_mean": "lat_sum / nullif(lat_cnt, 0)",
    "dis_max": "dis_max", "dis_min": "dis_min", "dis_mean": "dis_sum / nullif(dis_cnt, 0)",
    "num_of_records": "n_rows", "trip_max": "trip_max", "y": "y_max",
    "num_of_trips_approx": "hll_sketch_estimate(trip_sketch)",
    **{f"count{k}": f"CAST(c{k} AS DOUBLE) / CAST(n_rows AS DOUBLE)" for k in range(5)},
    **{f"count{k}_s": f"CAST(c{k} AS DOUBLE) / CAST(n_rows - c0 + 1 AS DOUBLE)" for k in (1, 2, 3)},
    **{f"hour{h}": f"CAST(hr{h} AS DOUBLE) / CAST(n_rows AS DOUBLE)" for h in range(24)},
}
STREAMED = list(_PROJECTIONS)


def telemetry_stream(spark: SparkSession, path: str, labelled: bool = True, fmt: str = "csv",
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming scan of telemetry files with the explicit schema (never inferred)."""
    reader = spark.readStream.schema(TRAIN_SCHEMA if labelled else TEST_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        df = reader.option("header", True).csv(path)
    else:
        df = reader.format(fmt).load(path)
    if not labelled:
        df = df.withColumn("y", F.lit(None).cast("double"))
    return clean_telemetry(df.select(*COLUMNS).withColumn("seq", F.lit(0).cast("bigint")))


def driver_totals(stream: DataFrame, cfg: FeatureConfig = FeatureConfig()) -> DataFrame:
    """Running per-driver statistics of a telemetry stream (one state row per driver).

    Use with output mode ``update`` (or ``complete`` for small tests); the
    micro-batch partial aggregation runs before the state-store shuffle.
    """
    rows = _derived(_row_columns(stream, cfg, set(_FAMILIES)), cfg, set(_FAMILIES))
    aggs = [F.expr(s) for f in _FAMILIES for s in _family_unit(f)] + [F.max("trip_id").alias("trip_max")]
    totals = rows.groupBy(KEY).agg(*aggs)
    return totals.select(KEY, *[F.expr(f"{e} AS `{name}`") for name, e in _PROJECTIONS.items()])


def write_driver_totals(totals: DataFrame, path: str, checkpoint_location: str | None = None,
                        available_now: bool = True):
    """Keep a Parquet snapshot of the running driver totals up to date.

    Complete output mode (the state is one row per driver).  Each micro-batch writes a
    snapshot of its own at ``path/batch=<id>``; ``read_snapshot`` reads the newest
    complete one, so neither a reader nor a crash between two batches sees half of one.
    The stream's own checkpoint defaults to a folder for this output path below
    ``<spark.checkpoint.dir>/streams``, so a restarted query resumes where it stopped.
    Returns the started query.
    """
    from tripwise.session import checkpoint_dir

    spark = totals.sparkSession
    name = hashlib.md5(path.encode()).hexdigest()
    location = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/driver_totals-{name}"

    def snapshot(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id:010d}")

    writer = (totals.writeStream.outputMode("complete").foreachBatch(snapshot)
              .option("checkpointLocation", location))
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The driver totals of the newest batch whose snapshot is complete (it has its ``_SUCCESS`` mark)."""
    jvm, hadoop = spark._jvm, spark._jsc.hadoopConfiguration()
    marks = jvm.org.apache.hadoop.fs.Path(f"{path}/batch=*/_SUCCESS")
    found = marks.getFileSystem(hadoop).globStatus(marks) or []
    done = sorted(str(f.getPath().getParent().toString()) for f in found)
    if not done:
        raise ValueError(f"no complete snapshot at {path}")
    return spark.read.parquet(done[-1])
