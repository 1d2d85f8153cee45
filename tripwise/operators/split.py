"""Reproducible hold-out split (M2), contiguous k-fold (W3) and fold complement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.operators.order import global_rank


# the hold-out share is taken in millionths
HOLDOUT_BUCKETS = 1_000_000


def hash_bucket(key: Column | str, seed: int, buckets: int = HOLDOUT_BUCKETS) -> Column:
    """Stable bucket 0..buckets-1 of a key: md5 of ``seed:key``, first 32 bits.

    Independent of partitioning and executor count (``randomSplit`` is not).
    """
    key = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"))), 1, 8), 16, 10)
    return F.pmod(h.cast("bigint"), F.lit(buckets))


def holdout_split(df: DataFrame, fraction: float = 0.2, seed: int = 0, key: str = "terminalno",
                  out: str = "holdout") -> DataFrame:
    """M2: tag each driver as hold-out (True) with probability ``fraction``."""
    return df.withColumn(out, hash_bucket(key, seed) < F.lit(int(round(fraction * HOLDOUT_BUCKETS))))


def contiguous_folds(df: DataFrame, k: int = 5, key: str = "terminalno", out: str = "fold") -> DataFrame:
    """Folds of consecutive drivers in key order; the N % k tail joins the last fold.

    fold = least(floor(rank / floor(N / k)), k - 1); rank and N come from one pass of the
    distributed global rank.
    """
    ranked = global_rank(df, [key], out="_rank", total="_rows")
    n = ranked.agg(F.max("_rows")).first()[0] or 0  # from the ranked checkpoint, not from ``df``
    if n < k:
        raise ValueError(f"{n} drivers cannot fill {k} folds")
    return ranked.withColumn(
        out, F.least(F.floor(F.col("_rank") / F.lit(n // k)), F.lit(k - 1)).cast("int")).drop("_rank", "_rows")


def fold_complement(folds: DataFrame, k: int = 5, fold_col: str = "fold", out: str = "held_fold") -> DataFrame:
    """For each fold i, the training rows of the other folds (one row per (i, driver))."""
    return (folds.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            .filter(F.col(out) != F.col(fold_col)))


def fold_complement_table(rows: DataFrame, folds: DataFrame, k: int = 5, key: str = "terminalno", fold_col: str = "fold",
                          out: str = "held_fold") -> DataFrame:
    """J5 for folds that are a table (key, fold): for each fold i, the rows that are not in it.

    A left anti-join of (i, row) with the table; rows that the table does not name are in
    no fold, so they train for all.  The table's side is hashed (it has a key and a number
    a row); rows without a key stay.
    """
    each = rows.withColumn(out, F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    held = folds.select(F.col(key).alias("_key"), F.col(fold_col).alias("_fold")).hint("shuffle_hash")
    return each.join(held, (F.col(key) == F.col("_key")) & (F.col(out) == F.col("_fold")), "left_anti")
