import pytest
from pyspark.sql import functions as F

from tripwise.operators.order import global_rank
from tripwise.operators.split import contiguous_folds, fold_complement, holdout_split


def test_seven_drivers_five_folds(spark):
    df = spark.createDataFrame([(i,) for i in [30, 10, 20, 70, 50, 60, 40]], "terminalno bigint")
    folds = {r["terminalno"]: r["fold"] for r in contiguous_folds(df, 5).collect()}
    assert [folds[k] for k in sorted(folds)] == [0, 1, 2, 3, 4, 4, 4]


def test_too_few_drivers(spark):
    df = spark.createDataFrame([(i,) for i in range(4)], "terminalno bigint")
    with pytest.raises(ValueError):
        contiguous_folds(df, 5)


def test_each_driver_in_one_fold_and_complement(spark):
    df = spark.range(103).withColumnRenamed("id", "terminalno")
    folds = contiguous_folds(df, 5)
    assert folds.count() == 103 and folds.select("terminalno").distinct().count() == 103
    comp = fold_complement(folds, 5)
    assert comp.count() == 103 * 4
    assert comp.filter(F.col("fold") == F.col("held_fold")).count() == 0


def test_global_rank_is_dense_and_ordered(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("k"))
    ranks = sorted((r["k"], r["rank"]) for r in global_rank(df, ["k"], partitions=6).collect())
    assert [r for _, r in ranks] == list(range(5000))


def test_holdout_independent_of_layout(spark):
    df = spark.range(500).withColumnRenamed("id", "terminalno")
    a = {r["terminalno"]: r["holdout"] for r in holdout_split(df, 0.2, seed=0).collect()}
    b = {r["terminalno"]: r["holdout"] for r in holdout_split(df.repartition(9), 0.2, seed=0).collect()}
    assert a == b
    assert 60 < sum(a.values()) < 140
    c = {r["terminalno"]: r["holdout"] for r in holdout_split(df, 0.2, seed=1).collect()}
    assert a != c


def test_fold_table_complement_equals_the_filter(spark):
    from tripwise.operators.split import fold_complement_table

    df = spark.range(57).withColumnRenamed("id", "terminalno")
    folds = contiguous_folds(df, 5).select("terminalno", "fold")
    rows = df.unionByName(spark.createDataFrame([(1000,), (None,), (3,)], "terminalno bigint"))  # unnamed, no key, repeated
    joined = fold_complement_table(rows, folds, 5)
    got = sorted((r["held_fold"], str(r["terminalno"])) for r in joined.collect())
    want = [(r["held_fold"], str(r["terminalno"])) for r in fold_complement(folds, 5).collect()]
    want += [(i, x) for i in range(5) for x in ("1000", "None")] + [(i, "3") for i in range(1, 5)]
    assert got == sorted(want)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "HashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


def test_running_sums_across_partitions(spark):
    from tripwise.operators.order import running_sums

    df = spark.range(0, 900, 1, 7).select((F.col("id") % 3).alias("g"), (F.col("id") * 7919 % 1009).alias("k"),
                                          (F.col("id") % 11).alias("v")).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    got = sorted(((r["g"] or 0, r["k"], r["s"], r["n"]) for r in
                  running_sums(df.withColumn("one", F.lit(1)), ["g"], ["k"], {"s": "v", "n": "one"}, partitions=6).collect()))
    want, s, n = [], {}, {}
    for g, k, v in sorted((r["g"] or 0, r["k"], r["v"]) for r in df.collect()):
        s[g], n[g] = s.get(g, 0) + v, n.get(g, 0) + 1
        want.append((g, k, s[g], n[g]))
    assert got == want


def test_relational_split_is_the_boosted_root(spark):
    import numpy as np
    from dataclasses import replace

    from tripwise.operators import boosting as bo
    from tripwise.operators.splits import best_splits

    rng = np.random.default_rng(4)
    cols = ["a", "b", "c"]
    rows = [(i, float(rng.normal()), None if i % 9 == 0 else float(np.round(rng.normal(), 1)), 1.0) for i in range(150)]
    df = spark.createDataFrame([(*r, float(r[1] > 0.2) + 0.3 * (r[2] or 0.0)) for r in rows], "terminalno bigint, a double, b double, c double, y double")
    p = bo.BoostParams(rounds=1, eta=1.0, max_depth=2, min_child=5, l2=2.0, l1=1.0)
    x = df.select("terminalno", F.col("y").alias("label"), F.array(*[F.coalesce(c, F.lit(0.0)) for c in cols]).alias("features"))
    tree = bo.boost(x, [bo.Fit(p)])[0].trees[0]
    root = best_splits(df.withColumn("r", p.base - F.col("y")), cols, "r", p).first()
    assert (root["feature_index"], root["threshold"]) == (tree["feature"][0], tree["threshold"][0])
    # the nodes of the next level, each by its own rows
    side = F.when(F.coalesce(cols[tree["feature"][0]], F.lit(0.0)) < tree["threshold"][0], 1).otherwise(2)
    level = {r["node"]: r for r in best_splits(df.withColumn("r", p.base - F.col("y")).withColumn("n", side), cols, "r", p, node="n").collect()}
    for node in (1, 2):
        if tree["feature"][node] >= 0:
            assert (level[node]["feature_index"], level[node]["threshold"]) == (tree["feature"][node], tree["threshold"][node])
    assert tree["feature"][1] >= 0 or tree["feature"][2] >= 0
    assert best_splits(df.withColumn("r", F.lit(None).cast("double")), cols, "r", p).count() == 0
    assert best_splits(df.withColumn("r", F.col("y")), ["c"], "r", replace(p, min_child=1)).count() == 0  # constant
