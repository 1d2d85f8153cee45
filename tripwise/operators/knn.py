"""Exact k-nearest-neighbour regression (J6, W4, M6) without a cross join.

Distance: Euclidean over the raw (unscaled) feature columns.  Neighbour order:
(distance, train id).  Weights 1/distance; when some neighbours are at distance
0, only those count (their plain mean) - the rule of the original library.

Plan (all distributed; only the feature variances and counts reach the driver):

1. tiles: train is ranked along the feature with the largest variance (distributed
   global rank) and cut into strips; each strip is ranked along the second one and cut
   into buckets of ``m >= k`` consecutive rows; m does not grow with the table, and strips
   and the buckets of one grow with the square root of it.  Tables of few buckets are one
   strip, ranked along the first feature.  A bucket's box has the extremes of every feature.
2. bound: each test point meets the m train rows of its home bucket (that of the last
   train row at or below it in both rankings); its k-th smallest distance there is
   R >= the true k-th neighbour distance.
3. boxes: the test point meets the boxes of the strips that hold train rows within
   [p - R, p + R], widened by a relative margin against rounding, and of its home strip.
   The distance to a box is at most that to any of its rows, also after rounding, as both
   are computed alike; boxes beyond R are left out.
4. exact: the test point meets the rows of the boxes that remain; only ``distance <= R``
   decides.  The k best per test point are kept before and after the exchange on the
   test point.

Places of values among the train rows come from ranging both sides together
(``order.place_among``), so no array of bucket edges exists.  Buckets hold m train rows
whatever the skew; the rows of a bucket that many test points meet are a skewed
join partition, and the group limit behind that join needs no distribution of its
own, so AQE may split it.

Folds (``fold_knn_regress``): each part of the train rows has its own strips and buckets, so every
point meets a home bucket in each part it searches.  All folds' models share one pass: a
test point's R is the largest of its models', its k best rows of each part hold every
model's k best.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.operators.order import BELOW, UP_TO, place_among
from tripwise.session import checkpoint_dir


def _distance(a: str, b: str, features: Sequence[str]) -> Column:
    s = None
    for c in features:
        d = F.col(f"{a}.{c}") - F.col(f"{b}.{c}")
        s = d * d if s is None else s + d * d
    return F.sqrt(s)


def _box_distance(q: str, box: str, features: Sequence[str]) -> Column:
    s = None
    for c in features:
        d = F.greatest(F.col(f"{box}.lo.{c}") - F.col(f"{q}.{c}"), F.col(f"{q}.{c}") - F.col(f"{box}.hi.{c}"), F.lit(0.0))
        s = d * d if s is None else s + d * d
    return F.sqrt(s)


# rows of a bucket and buckets of a strip, at least, and the margin of a window's edges relative to their size
BUCKET_ROWS, STRIP_BUCKETS = 64, 64
EDGE_MARGIN = 1e-12


# parts a query searches: all of them for one answer, or all of them with an answer without each one in turn
WHOLE, EACH = -1, -2


def _rows_of(df: DataFrame, feats: Sequence[str], *ids: Column) -> DataFrame:
    return df.select(*ids, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in feats])


def _fit_rows(df: DataFrame, feats: Sequence[str], k: int, train_id: str, label: str, part: Column) -> DataFrame:
    """train_id, part, label and features of the rows that can be among the k nearest of any point, checkpointed.

    Rows of equal features are equally far from every point, so of those of a part only
    the k of smallest id count: pairs do not grow with the copies of a row.
    """
    rows = _rows_of(df, feats, F.col(train_id).alias("train_id"), part.alias("part"), F.col(label).cast("double").alias("label"))
    # the planner keeps k rows of each task before the exchange
    alike = Window.partitionBy("part", *feats).orderBy("train_id")
    return rows.withColumn("_r", F.row_number().over(alike)).where(F.col("_r") <= k).drop("_r").checkpoint(eager=True)


def _candidates(tr: DataFrame, te: DataFrame, feats: Sequence[str], k: int, parts: int, bucket_rows: int | None,
                strip_buckets: int | None) -> DataFrame:
    """(test_id, left, train_id, part, label, dist): train rows that hold every query's k nearest.

    ``tr``: as ``_fit_rows`` gives them.  ``te``: test_id, left, part and
    features, a row for each part a query searches; ``left`` is the part it leaves out,
    WHOLE (none), or EACH: the rows hold the k nearest without any one of the parts.
    """
    # one small row a part
    stats = tr.groupBy("part").agg(F.count(F.lit(1)).alias("_n")).collect()
    spread = tr.agg(*[F.var_pop(c).alias(c) for c in feats]).first()
    axes = sorted(feats, key=lambda c: -(spread[c] or 0.0))
    axis, second = axes[0], axes[min(1, len(axes) - 1)]
    n = [0] * parts
    for row in stats:
        n[row["part"]] = row["_n"]
    least = sum(n) - max(n) if parts > 1 else sum(n)
    if least < k:
        raise ValueError(f"k={k} neighbours requested from {least} train rows")
    m = max(4 * k, bucket_rows or BUCKET_ROWS)
    nb = [max(1, x // m) for x in n]  # a part's last bucket takes the remainder: every bucket has >= m rows (or all)
    wide = [strip_buckets or max(STRIP_BUCKETS, math.isqrt(x)) for x in nb]
    ns = [max(1, x // w) for x, w in zip(nb, wide, strict=True)]  # as a part's last strip does
    one_strip = max(ns) == 1

    def own(values: Sequence[int]) -> Column:
        """The value of the row's part."""
        return F.lit(values[0]) if parts == 1 else F.array(*[F.lit(v) for v in values])[F.col("part")]

    def before(values: Sequence[int]) -> Column:
        """The sum of the earlier parts' values: numbers go on from part to part."""
        return own([sum(values[:i]) for i in range(parts)])

    def place(rank: Column, size: Sequence[int], count: Sequence[int]) -> Column:
        inside = F.greatest(rank - before(n), F.lit(0))
        return before(count) + F.least(F.floor(inside / own(size)), own([x - 1 for x in count]))

    def strip_of(rank: Column) -> Column:
        return place(rank, [w * m for w in wide], ns)

    def bucket_of(rank: Column) -> Column:
        return place(rank, [m] * parts, nb)

    train_id = tr.schema["train_id"].dataType
    query = ["test_id", "left"]

    def placed(rows: DataFrame, points: DataFrame, key: Column) -> tuple[DataFrame, DataFrame]:
        """Both with ``_r``: ranks of the train rows, and train rows up to each point."""
        asked = points.withColumns({"_key": key, "_side": F.lit(UP_TO), "train_id": F.lit(None).cast(train_id)})
        ranked, at = place_among(rows.withColumn("_key", key), asked, "_key", "train_id", "_side", "_r")
        return ranked.drop("_key"), at.drop("_key", "_side", "train_id")

    # 1. the tiles of train, and the home strip and bucket of test
    if one_strip:
        tr, te = (side.withColumn("strip", before(ns).cast("bigint")) for side in (tr, te))
        ranked, at = placed(tr, te, F.struct("part", axis))
    else:
        ranked, at = placed(tr, te, F.struct("part", axis))
        ranked = ranked.withColumn("strip", strip_of(F.col("_r"))).drop("_r")
        at = at.withColumn("strip", strip_of(F.col("_r") - 1)).drop("_r")
        ranked, at = placed(ranked, at, F.struct("strip", second))
    tr_b = ranked.withColumn("bucket", bucket_of(F.col("_r"))).drop("_r")
    first = before(nb) + (F.col("strip") - before(ns)) * own(wide)
    te_h = at.withColumn("bucket", F.greatest(bucket_of(F.col("_r") - 1), first)).drop("_r")

    # 2. first bound R from the home buckets
    cand = te_h.alias("q").join(tr_b.alias("t"), on=F.col("q.bucket") == F.col("t.bucket"))
    cand = cand.select("q.test_id", "q.left", "q.part", _distance("q", "t", feats).alias("dist"))
    # k-th smallest distance: top k per test point (a partial group limit runs
    # before the shuffle, so only k distances per test point and part move), then max
    wr = Window.partitionBy(*query, *["part"] * (parts > 1)).orderBy("dist")
    cand = cand.withColumn("_r", F.row_number().over(wr)).where(F.col("_r") <= k)
    if parts == 1:
        radius = cand.groupBy(*query).agg(F.max("dist").alias("radius"))
    else:
        near = cand.groupBy(*query).agg(F.array_sort(F.collect_list(F.struct("dist", "part"))).alias("_d"))
        without = [F.expr(f"get(filter(_d, x -> x.part <> {i}), {k - 1}).dist") for i in range(parts)]
        radius = near.select(*query, F.when(F.col("left") == EACH, F.greatest(*without))
                             .otherwise(F.get("_d", F.lit(k - 1))["dist"]).alias("radius"))

    # 3. boxes within R, in the strips with train rows in the widened window and the home strip
    bounded = te_h.join(radius, query).withColumnRenamed("bucket", "home")
    if one_strip:
        met = bounded
    else:
        bounded = bounded.checkpoint(eager=True)
        margin = F.lit(EDGE_MARGIN) * (F.abs(axis) + F.col("radius"))
        window = F.array(F.struct((F.col(axis) - F.col("radius") - margin).alias("p"), F.lit(BELOW).alias("_side")),
                         F.struct((F.col(axis) + F.col("radius") + margin).alias("p"), F.lit(UP_TO).alias("_side")))
        edges = bounded.select(*query, "part", F.explode(window).alias("_e")).select(
            *query, "part", F.struct("part", "_e.p").alias("p"), "_e._side", F.lit(None).cast(train_id).alias("train_id"))
        _, cut = place_among(tr.select("train_id", F.struct("part", F.col(axis).alias("p")).alias("p")), edges, "p",
                             "train_id", "_side", "_r")
        spans = cut.groupBy(*query, "part").agg(
            F.max(F.when(F.col("_side") == BELOW, strip_of(F.col("_r")))).alias("s1"),
            F.max(F.when(F.col("_side") == UP_TO, strip_of(F.col("_r") - 1))).alias("s2"))
        met = bounded.join(spans, [*query, "part"]).withColumn("strip", F.explode(F.sequence(
            F.least("s1", "strip"), F.greatest("s2", "strip"))))
    boxes = tr_b.groupBy("strip", "bucket").agg(*[
        F.struct(*[of(c).alias(c) for c in feats]).alias(side) for side, of in (("lo", F.min), ("hi", F.max))])
    if one_strip:  # fewer than 2 * wide boxes a part
        boxes = F.broadcast(boxes)
    q = (met.alias("q").join(boxes.alias("x"), on=F.col("q.strip") == F.col("x.strip"))
         .where(_box_distance("q", "x", feats) <= F.col("q.radius"))
         .select("q.test_id", "q.left", "q.radius", "x.bucket", *[f"q.{c}" for c in feats]))
    # 4. exact candidates
    return q.alias("q").join(tr_b.alias("t"), on=F.col("q.bucket") == F.col("t.bucket")).select(
        F.col("q.test_id").alias("test_id"), F.col("q.left").alias("left"), F.col("t.train_id").alias("train_id"),
        F.col("t.part").alias("part"), F.col("t.label").alias("label"), _distance("q", "t", feats).alias("dist"),
        F.col("q.radius"),
    ).where(F.col("dist") <= F.col("radius")).drop("radius")


def _best(pairs: DataFrame, k: int, *by: str) -> DataFrame:
    # the planner keeps the k best of each task before the exchange on the test point
    w = Window.partitionBy(*by).orderBy(F.col("dist").asc(), F.col("train_id").asc())
    return pairs.withColumn("nb", F.row_number().over(w) - 1).where(F.col("nb") < k)


def knn_pairs(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    k: int,
    id_col: str = "terminalno",
    label: str = "y",
    bucket_rows: int | None = None,
    strip_buckets: int | None = None,
) -> DataFrame:
    """The k nearest train rows of every test row.

    Output: test_id, train_id, dist, nb (0-based neighbour rank), label.
    """
    feats = list(features)
    checkpoint_dir(train.sparkSession)
    # one row per driver on each side: materialised once (shared checkpoint folder)
    # so the small planning actions below do not recompute the feature chain
    tr = _fit_rows(train, feats, k, id_col, label, F.lit(0))
    te = _rows_of(test, feats, F.col(id_col).alias("test_id"), F.lit(WHOLE).alias("left"), F.lit(0).alias("part"))
    pairs = _candidates(tr, te, feats, k, 1, bucket_rows, strip_buckets)
    return _best(pairs, k, "test_id").select("test_id", "train_id", "dist", "nb", "label")


def _weighted(pairs: DataFrame, *by: str) -> DataFrame:
    """``by`` and pred: the distance-weighted mean label of each group of neighbours."""
    zero = F.col("dist") == 0.0
    agg = pairs.groupBy(*by).agg(
        F.count_if(zero).alias("_nz"),
        F.avg(F.when(zero, F.col("label"))).alias("_zmean"),
        F.sum(F.when(~zero, F.col("label") / F.col("dist"))).alias("_wy"),
        F.sum(F.when(~zero, F.lit(1.0) / F.col("dist"))).alias("_w"),
    )
    return agg.select(*by, F.when(F.col("_nz") > 0, F.col("_zmean")).otherwise(F.col("_wy") / F.col("_w")).alias("pred"))


def knn_regress(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    k: int,
    id_col: str = "terminalno",
    label: str = "y",
    out: str = "pred",
    **kw,
) -> DataFrame:
    """M6: distance-weighted mean label of the k nearest train rows, per test row."""
    pairs = knn_pairs(train, test, features, k, id_col=id_col, label=label, **kw)
    return _weighted(pairs, "test_id").select(F.col("test_id").alias(id_col), F.col("pred").alias(out))


def fold_knn_regress(
    folded: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    k: int,
    folds: int,
    id_col: str = "terminalno",
    label: str = "y",
    fold: str = "fold",
    bucket_rows: int | None = None,
    strip_buckets: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """M6 for the models of all folds, in one pass: model i has the rows whose ``fold`` (0 to folds - 1) is not i.

    Returns (``id_col``, pred) of every row by the model that has not seen it, and
    (``id_col``, ``fold``, pred) of every test row by each model; both as ``knn_regress`` gives them.
    """
    feats = list(features)
    checkpoint_dir(folded.sparkSession)
    tr = _fit_rows(folded, feats, k, id_col, label, F.col(fold).cast("int"))
    every = F.array(*[F.lit(i) for i in range(folds)])
    held = _rows_of(folded, feats, F.col(id_col).alias("test_id"), F.col(fold).cast("int").alias("left"))
    asked = _rows_of(test, feats, F.col(id_col).alias("test_id"), F.lit(EACH).alias("left"))
    te = held.unionByName(asked).withColumn("part", F.explode(F.array_except(every, F.array("left"))))
    pairs = _candidates(tr, te, feats, k, folds, bucket_rows, strip_buckets)
    # the k best of each part first: all that any model can need
    each = F.when(F.col("left") == EACH, F.array_except(every, F.array("part"))).otherwise(F.array("left"))
    models = _best(pairs, k, "test_id", "left", "part").withColumn("model", F.explode(each))
    preds = _weighted(_best(models, k, "test_id", "left", "model"), "test_id", "left", "model").checkpoint(eager=True)
    of_test = F.col("left") == EACH
    return (preds.filter(~of_test).select(F.col("test_id").alias(id_col), "pred"),
            preds.filter(of_test).select(F.col("test_id").alias(id_col), F.col("model").alias(fold), "pred"))
