"""Sinks: submission CSV (K1), stacking trace (K2), model save/load (K3),
random baseline submission (K4), correlation matrix CSV (K5)."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tripwise.sources import files


def submission_frame(preds: DataFrame, key: str = "terminalno", pred: str = "pred") -> DataFrame:
    """K1 content: ``Id bigint, Pred double``, one row per driver (duplicates removed)."""
    return (preds.select(F.col(key).cast("bigint").alias("Id"), F.col(pred).cast("double").alias("Pred"))
            .dropDuplicates(["Id"]))


def write_submission(preds: DataFrame, path: str, key: str = "terminalno", pred: str = "pred",
                     single_file: bool = True) -> None:
    """K1: CSV with header ``Id,Pred``, one part file as the original's contract asks.

    The frame is one row per driver, so a single writer task is bounded by the
    driver count, not by the telemetry volume; ``single_file=False`` writes one part
    file a partition for driver tables too large for that.
    """
    frame = submission_frame(preds, key, pred)
    (frame.coalesce(1) if single_file else frame).write.mode("overwrite").option("header", True).csv(path)


def commit_submission(preds: DataFrame, path: str, key: str = "terminalno", pred: str = "pred") -> int:
    """K1 as the original leaves it: ONE file named ``path`` with header ``Id,Pred``; returns its rows.

    The part file is written to a staging folder beside it, read back and counted
    against what was written, and only then renamed over ``path``: a job that fails
    before leaves the old file as it was, and a reader never sees half a file.  The
    staging folder goes in any case.
    """
    spark = preds.sparkSession
    staging = f"{path}.staging-{uuid.uuid4().hex}"
    try:
        sent = Observation()
        frame = submission_frame(preds, key, pred).observe(sent, F.count(F.lit(1)).alias("n"))
        frame.coalesce(1).write.option("header", True).csv(staging)
        parts = [n for n in files.names(spark, staging) if n.startswith("part-")]
        found = spark.read.schema("Id bigint, Pred double").option("header", True).csv(staging).count()
        if len(parts) != 1 or found != sent.get["n"]:
            raise RuntimeError(f"{staging}: {len(parts)} files with {found} rows instead of one with {sent.get['n']}")
        files.replace(spark, f"{staging}/{parts[0]}", path)
    finally:
        files.delete(spark, staging)
    return found


def write_trace(trace: DataFrame, path: str) -> None:
    """K2: stacking trace (rawY, layer1_combine, newY, layer1_preds, pred) keyed by driver."""
    trace.write.mode("overwrite").option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    """K3: persist a fitted pipeline (replaces the original's pickle file)."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def random_submission(telemetry: DataFrame, seed: int = 0, key: str = "terminalno") -> DataFrame:
    """K4: every distinct driver once, with a uniform prediction in [0, 1) by a hash of the key and the seed.

    The same whatever the partitioning (``rand`` is not).  Rows without a driver make none.
    """
    from tripwise.operators.split import HOLDOUT_BUCKETS, hash_bucket

    ids = telemetry.select(F.col(key).cast("bigint").alias("Id")).filter(F.col("Id").isNotNull()).distinct()
    return ids.withColumn("Pred", hash_bucket("Id", seed) / F.lit(float(HOLDOUT_BUCKETS)))


def write_correlations(corr: DataFrame, path: str) -> None:
    """K5: correlation matrix (long form a, b, r) as CSV."""
    corr.write.mode("overwrite").option("header", True).csv(path)
