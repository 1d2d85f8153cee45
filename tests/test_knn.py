import numpy as np
import pytest
from pyspark.sql import functions as F

from tripwise.operators.ensemble import neighbour_layer
from tripwise.operators.knn import _fit_rows, fold_knn_regress, knn_pairs, knn_regress

FEATS = ["a", "b", "c"]


def _frames(spark, train, test):
    tr = spark.createDataFrame([(int(i), float(y), *map(float, x)) for i, (x, y) in enumerate(train)],
                               "terminalno bigint, y double, a double, b double, c double")
    te = spark.createDataFrame([(int(1000 + i), *map(float, x)) for i, x in enumerate(test)],
                               "terminalno bigint, a double, b double, c double")
    return tr, te


def _brute(train, test, k):
    X = np.array([x for x, _ in train])
    Y = np.array([y for _, y in train])
    out = {}
    for i, q in enumerate(test):
        d = np.sqrt(((X - np.array(q)) ** 2).sum(axis=1))
        order = sorted(range(len(d)), key=lambda j: (d[j], j))[:k]
        dd, yy = d[order], Y[order]
        if (dd == 0).any():
            pred = yy[dd == 0].mean()
        else:
            pred = (yy / dd).sum() / (1 / dd).sum()
        out[1000 + i] = (order, pred)
    return out


@pytest.mark.parametrize("k,seed,bucket_rows,strip", [(5, 0, None, None), (30, 1, None, 1), (3, 2, 4, 3)])
def test_exact_against_brute_force(spark, k, seed, bucket_rows, strip):
    rng = np.random.default_rng(seed)
    train = [((rng.normal(0, 50), rng.normal(0, 1), rng.integers(0, 3)), float(rng.integers(0, 5)) / 2)
             for _ in range(150)]
    train += [((0.0, 0.0, 0.0), 1.0)] * 20  # a hot spot of identical rows
    test = [tuple(rng.normal(0, 40, 3)) for _ in range(25)] + [(0.0, 0.0, 0.0), train[3][0]]
    tr, te = _frames(spark, train, test)
    expect = _brute(train, test, k)
    pairs = knn_pairs(tr, te, FEATS, k, bucket_rows=bucket_rows, strip_buckets=strip).collect()
    got = {}
    for r in pairs:
        got.setdefault(r["test_id"], []).append((r["nb"], r["train_id"]))
    for tid, (order, _) in expect.items():
        assert [t for _, t in sorted(got[tid])] == order
    preds = {r["terminalno"]: r["pred"] for r in knn_regress(tr, te, FEATS, k, bucket_rows=bucket_rows).collect()}
    for tid, (_, pred) in expect.items():
        assert preds[tid] == pytest.approx(pred, rel=1e-9)


def test_zero_distance_neighbour_gives_its_label(spark):
    train = [((1.0, 2.0, 3.0), 2.5), ((1.0, 2.0, 4.0), 0.0), ((9.0, 9.0, 9.0), 1.0),
             ((5.0, 5.0, 5.0), 1.0), ((7.0, 1.0, 0.0), 0.5), ((3.0, 3.0, 3.0), 0.0)]
    tr, te = _frames(spark, train, [(1.0, 2.0, 3.0)])
    assert knn_regress(tr, te, FEATS, 5).collect()[0]["pred"] == 2.5


def test_k_larger_than_train_rejected(spark):
    tr, te = _frames(spark, [((0.0, 0.0, 0.0), 1.0)] * 3, [(1.0, 1.0, 1.0)])
    with pytest.raises(ValueError):
        knn_pairs(tr, te, FEATS, 5)


def test_no_cartesian_product_in_plan(spark):
    rng = np.random.default_rng(4)
    train = [(tuple(rng.normal(0, 1, 3)), 1.0) for _ in range(40)]
    tr, te = _frames(spark, train, [tuple(rng.normal(0, 1, 3)) for _ in range(5)])
    for strip in (None, 1):
        plan = knn_pairs(tr, te, FEATS, 5, bucket_rows=8, strip_buckets=strip)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("strip", [None, 1])
def test_ties_at_a_rounded_edge(spark, strip):
    """All bound distances tie at R = p - hi, where p - R rounds above hi: the home bucket still counts."""
    low, p = 0.013436424411240122, 1.8474337369372327
    r = p - low
    values = [low] * 8 + [p + 0.5 * r] + [1000.0 + i for i in range(7)]
    tr = spark.createDataFrame([(i, 1.0, v) for i, v in enumerate(values)], "terminalno bigint, y double, a double")
    te = spark.createDataFrame([(99, p)], "terminalno bigint, a double")
    got = sorted((x["nb"], x["train_id"]) for x in knn_pairs(tr, te, ["a"], 2, bucket_rows=8, strip_buckets=strip).collect())
    assert got == [(0, 8), (1, 0)]


@pytest.mark.parametrize("seed,strip", [(1, None), (2, 2)])
def test_gaps_ties_and_points_outside(spark, seed, strip):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.integers(0, 6, 60) / 3.0, 50 + rng.integers(0, 4, 40) / 7.0, [200.0] * 15])
    test = np.concatenate([[-100.0, 500.0, 25.0, 50.0, 200.0], rng.uniform(-10, 220, 40), values[:10]])
    train = [((float(v), 0.0, 0.0), 1.0) for v in values]
    tr, te = _frames(spark, train, [(float(v), 0.0, 0.0) for v in test])
    want = _brute(train, [(float(v), 0.0, 0.0) for v in test], 5)
    got = {}
    for x in knn_pairs(tr, te, FEATS, 5, bucket_rows=20, strip_buckets=strip).collect():
        got.setdefault(x["test_id"], []).append((x["nb"], x["train_id"]))
    assert {k: [t for _, t in sorted(v)] for k, v in got.items()} == {k: v[0] for k, v in want.items()}


@pytest.mark.parametrize("seed,bucket_rows,strip", [(5, None, None), (6, 4, 2)])
def test_folds_share_one_search(spark, seed, bucket_rows, strip):
    """Every fold's model gives what a search of its own rows gives, however the folds lie."""
    rng = np.random.default_rng(seed)
    # a fold far from the others, one of four rows, and rows alike in several folds
    folds = [0] * 70 + [1] * 60 + [2] * 4 + [3] * 56
    train = [(tuple(rng.normal(500 * (f == 1), 20, 3)) if rng.random() < 0.7 else (1.0, 2.0, 3.0), float(rng.integers(0, 9)))
             for f in folds]
    test = [tuple(rng.normal(0, 40, 3)) for _ in range(12)] + [(1.0, 2.0, 3.0), (500.0, 500.0, 500.0), train[80][0]]
    tr = spark.createDataFrame([(i, f, y, *map(float, x)) for i, (f, (x, y)) in enumerate(zip(folds, train, strict=True))],
                               "terminalno bigint, fold int, y double, a double, b double, c double")
    te = _frames(spark, train, test)[1]
    oof, each = fold_knn_regress(tr, te, FEATS, 3, 4, bucket_rows=bucket_rows, strip_buckets=strip)
    got = {r["terminalno"]: r["pred"] for r in oof.collect()}
    got_test = {(r["fold"], r["terminalno"]): r["pred"] for r in each.collect()}
    want, want_test = {}, {}
    for f in range(4):
        own = [i for i, g in enumerate(folds) if g != f]
        rows = [train[i] for i in own]
        held = [i for i, g in enumerate(folds) if g == f]
        found = _brute(rows, [train[i][0] for i in held] + test, 3)
        want |= {i: found[1000 + j][1] for j, i in enumerate(held)}
        want_test |= {(f, 1000 + j): found[1000 + len(held) + j][1] for j in range(len(test))}
    assert got == pytest.approx(want) and got_test == pytest.approx(want_test)
    with pytest.raises(ValueError):
        fold_knn_regress(tr.filter("fold = 2"), te, FEATS, 3, 4)


def test_stacking_searches_once_for_all_folds(spark):
    """Jobs of the first layer do not grow with the folds."""
    rng = np.random.default_rng(7)
    tr, te = _frames(spark, [(tuple(rng.normal(0, 9, 3)), 1.0) for _ in range(80)], [tuple(rng.normal(0, 9, 3)) for _ in range(9)])

    def jobs(k):
        group = f"layer-{k}"
        spark.sparkContext.setJobGroup(group, group)
        folded = tr.withColumn("fold", (F.col("terminalno") % k).cast("int"))
        oof, out = neighbour_layer(FEATS, 3, "y", "terminalno", k)(folded, te)
        assert oof.count() == 80 and out.count() == 9
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(8) <= jobs(2)


def test_pairs_do_not_grow_with_copies(spark):
    """Of rows with the same features only k meet a point."""
    rows = [((1.0, 2.0, 3.0), float(i)) for i in range(4000)] + [((9.0, 9.0, 9.0), 1.0), ((-0.0, 0.0, 9.0), 1.0), ((0.0, 0.0, 9.0), 1.0)]
    tr, te = _frames(spark, rows, [(1.0, 2.0, 3.0), (9.0, 9.0, 8.0)])
    kept = _fit_rows(tr, FEATS, 3, "terminalno", "y", F.lit(0))
    assert sorted(r["train_id"] for r in kept.collect()) == [0, 1, 2, 4000, 4001, 4002]
    got = sorted((r["test_id"], r["nb"], r["train_id"]) for r in knn_pairs(tr, te, FEATS, 3).collect())
    assert got == [(1000, 0, 0), (1000, 1, 1), (1000, 2, 2), (1001, 0, 4000), (1001, 1, 0), (1001, 2, 1)]
