"""One round of regression-tree splits in relational form (M3, M4): the exact reference of ``boosting``.

For every node and feature the residuals are summed by value, running sums in the order
of the values give what lies left of each cut, and the cut of the largest gain wins.  No
bins: a cut lies between any two neighbouring values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwise.operators.boosting import LEAST_GAIN, BoostParams
from tripwise.operators.order import running_sums

#: Gains are compared after rounding, so that sums of another order do not decide.
GAIN_PLACES = 9


def _score(g: str, h: str, p: BoostParams) -> Column:
    shrunk = F.greatest(F.abs(F.col(g)) - F.lit(p.l1), F.lit(0.0))
    return F.when(F.col(h) + F.lit(p.l2) > 0, shrunk * shrunk / (F.col(h) + F.lit(p.l2))).otherwise(0.0)


def best_splits(rows: DataFrame, features: Sequence[str], residual: str, p: BoostParams, node: str | None = None,
                per_feature: bool = False) -> DataFrame:
    """(node, feature, feature_index, threshold, gain, left_rows, left_sum, n_rows, total_sum): each node's best split.

    ``residual`` is prediction minus label (rows without one take no part), ``node`` an int
    column (none: one node 0); a missing feature counts as 0.  A row goes left if its
    value is below the threshold, the midpoint of two neighbouring values of the whole
    table.  Ties: the first feature, then the lowest threshold.  Nodes without a valid
    split of positive gain give no row.  ``per_feature`` keeps each feature's best.
    """
    data = rows.filter(F.col(residual).isNotNull())
    pairs = ", ".join(f"'{c}', {i}, coalesce(nanvl(CAST(`{c}` AS DOUBLE), 0D), 0D) + 0D" for i, c in enumerate(features))
    own = F.col(node).cast("int") if node else F.lit(0)
    long = data.select(own.alias("node"), F.col(residual).cast("double").alias("r"), *features).selectExpr(
        "node", "r", f"stack({len(features)}, {pairs}) AS (feature, feature_index, x)")
    sums = long.groupBy("node", "feature", "feature_index", "x").agg(F.sum("r").alias("g"), F.count(F.lit(1)).alias("h"))
    totals = data.groupBy(own.alias("node")).agg(F.sum(residual).alias("total_sum"), F.count(F.lit(1)).alias("n_rows"))
    # the next larger value in the whole table: the values in order, joined with the ones a place ahead
    values = long.select("feature_index", "x").distinct().withColumn("one", F.lit(1))
    placed = running_sums(values, ["feature_index"], ["x"], {"place": "one"}).select("feature_index", "x", "place")
    ahead = placed.select("feature_index", F.col("x").alias("next_x"), (F.col("place") - 1).alias("place"))
    cuts = placed.join(ahead, ["feature_index", "place"]).select(
        "feature_index", "x", (F.col("x") + (F.col("next_x") - F.col("x")) / 2).alias("threshold"))
    left = running_sums(sums, ["node", "feature_index"], ["x"], {"left_sum": "g", "left_rows": "h"})
    found = left.join(cuts, ["feature_index", "x"]).join(totals, "node")
    found = found.withColumns({"right_sum": F.col("total_sum") - F.col("left_sum"), "right_rows": F.col("n_rows") - F.col("left_rows")})
    least = max(p.min_child, 1)
    found = found.filter((F.col("left_rows") >= least) & (F.col("right_rows") >= least))
    gain = _score("left_sum", "left_rows", p) + _score("right_sum", "right_rows", p) - _score("total_sum", "n_rows", p)
    found = found.withColumn("gain", F.round(gain, GAIN_PLACES)).filter(F.col("gain") > LEAST_GAIN)
    first = F.struct(-F.col("gain"), "feature_index", "threshold")
    columns = ["feature", "feature_index", "threshold", "gain", "left_rows", "left_sum", "n_rows", "total_sum"]
    by = ["node", "feature_index"] if per_feature else ["node"]
    best = found.groupBy(*by).agg(F.min_by(F.struct(*columns), first).alias("best"))
    return best.select("node", "best.*")
