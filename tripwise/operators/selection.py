"""Univariate feature selection (M1) and the correlation matrix (K5).

All correlations come from ONE aggregate over the driver table (covar_pop and
stddev_pop per feature), so selection is a single pass whatever the width.
``corr`` itself is avoided: under ANSI mode it raises on a constant column.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pearson(x: Column, y: Column) -> Column:
    den = F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(den > 0, F.covar_pop(x, y) / den)


def f_scores(df: DataFrame, features: Sequence[str], label: str = "y") -> DataFrame:
    """Per feature: n, Pearson r with the label, univariate regression F (one pass over the table).

    F = r^2 / (1 - r^2) * (n - 2); constant feature -> r and F NULL (ranked last),
    |r| = 1 -> F = +inf (ranked first).  A missing feature counts as 0, as in the
    fits (``models.prepared``), so all terms are over the same n drivers; |r| is cut
    to 1 only against rounding.  Output: feature, feature_index, n, r, f_score.
    """
    data = df.filter(F.col(label).isNotNull())
    # long form inside the stage: (feature, index, x, y) per driver, then one small
    # grouped aggregate (m groups, partial-aggregated before the shuffle)
    pairs = ", ".join(f"'{c}', {i}, coalesce(CAST(`{c}` AS DOUBLE), 0D)" for i, c in enumerate(features))
    long = data.selectExpr(f"CAST(`{label}` AS DOUBLE) AS _y",
                           f"stack({len(features)}, {pairs}) AS (feature, feature_index, _x)")
    grouped = long.groupBy("feature", "feature_index").agg(
        F.expr("count(_y) AS n"),
        F.expr("CASE WHEN stddev_pop(_x) * stddev_pop(_y) > 0 "
               "THEN greatest(-1D, least(1D, covar_pop(_x, _y) / (stddev_pop(_x) * stddev_pop(_y)))) END AS r"))
    f = F.expr("CASE WHEN r IS NULL THEN CAST(NULL AS DOUBLE) WHEN abs(r) >= 1 THEN CAST('Infinity' AS DOUBLE) "
               "ELSE r * r / (1D - r * r) * (CAST(n AS DOUBLE) - 2D) END")
    return grouped.select("feature", "feature_index", "n", "r", f.alias("f_score"))


def select_percentile(scores: DataFrame, percentile: float, m: int | None = None) -> DataFrame:
    """Top floor(m * p / 100) features by F (desc, NULL last), ties by feature index.

    ``scores`` has one row per feature (m rows, counted when not given), so the
    window runs on m rows.
    """
    from pyspark.sql import Window

    m = scores.count() if m is None else m
    keep = int(m * percentile / 100)
    w = Window.orderBy(F.col("f_score").desc_nulls_last(), F.col("feature_index").asc())
    return (scores.withColumn("selected_rank", F.row_number().over(w) - 1)
            .filter(F.col("selected_rank") < keep)
            .select("feature", "feature_index", "selected_rank"))


def selected_features(scores: DataFrame, percentile: float) -> list[str]:
    """Selected names in original feature order (a list of at most m names)."""
    rows = select_percentile(scores, percentile).orderBy("feature_index").collect()
    return [r["feature"] for r in rows]


# partitions whose sums meet on the driver (each of fixed size, 5 m x m matrices)
CORR_PARTITIONS = 64


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """K5: Pearson r of every pair of ``columns`` (features and label), long form.

    Pairwise complete: the r of (a, b) is over the rows that have both, as the
    original's frame library computes it.  Every partition sums five m x m
    matrices over its centred rows (n, x, x^2, y, x y of each pair); only those of at
    most ``CORR_PARTITIONS`` partitions reach the driver.  A column that is constant
    over a pair's rows gives NULL.  Output: a, b, r (both orders and the diagonal).
    """
    cols = list(columns)
    m = len(cols)
    data = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    centre = data.agg(*[F.avg(c).alias(c) for c in cols]).first()
    mean = np.array([centre[c] or 0.0 for c in cols])

    def sums(batches):
        n, sx, sxx, sxy = (np.zeros((m, m)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([np.asarray(batch.column(i).to_numpy(zero_copy_only=False), dtype="float64")
                                 for i in range(m)]) - mean
            there = ~np.isnan(x)
            x, mask = np.where(there, x, 0.0), there.astype("float64")
            n += mask.T @ mask
            sx += x.T @ mask
            sxx += (x * x).T @ mask
            sxy += x.T @ x
        flat = np.stack([n, sx, sxx, sxy]).tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([flat], pa.binary())], names=["sums"])

    total = np.zeros((4, m, m))
    for r in data.coalesce(CORR_PARTITIONS).mapInArrow(sums, "sums binary").toLocalIterator():
        total += np.frombuffer(r["sums"]).reshape(4, m, m)
    n, sx, sxx, sxy = total
    with np.errstate(all="ignore"):
        cov = sxy - sx * sx.T / n
        var = sxx - sx * sx / n  # of a over the rows that also have b
        # what rounding leaves of a constant column
        var = np.where(var > 1e-12 * np.maximum(sxx, n * (mean * mean)[:, None]) * 1e-3, var, 0.0)
        r = np.clip(cov / np.sqrt(var * var.T), -1.0, 1.0)
    rows = [(a, b, float(r[i, j]) if n[i, j] > 0 and var[i, j] > 0 and var[j, i] > 0 else None)
            for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")
