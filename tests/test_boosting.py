"""Boosted trees against an independent brute force, and the same trees however the work is cut."""

import json
import math
import subprocess
import sys
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from tripwise.operators import boosting as bo
from tripwise.operators import models as md
from tripwise.operators import stages
from tripwise.operators.boosting import BoostParams, Fit

M = 4


def table(spark, n=90, seed=0, ties=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, M))
    if ties:
        x[:, 1] = np.round(x[:, 1])
        x[:, 3] = 2.5  # constant
    y = np.where(x[:, 0] > 0.3, 2.0, -1.0) + x[:, 1] * 0.5 + rng.normal(scale=0.2, size=n)
    rows = [(i, float(y[i]), [float(v) for v in x[i]], int(i % 3)) for i in range(n)]
    df = spark.createDataFrame(rows, "terminalno bigint, label double, features array<double>, part int")
    return df, x, y


def shrunk(g, l1):
    return math.copysign(max(abs(g) - l1, 0.0), g)


def brute_tree(x, g, p, cuts):
    """Exhaustive search on the rows themselves; nested (feature, threshold, left, right) or a leaf value."""
    def score(rows):
        return shrunk(g[rows].sum(), p.l1) ** 2 / (len(rows) + p.l2) if len(rows) else 0.0

    def best(rows):
        found = (0.0, None)
        for f in range(x.shape[1]):
            for t in cuts[f]:
                left, right = rows[x[rows, f] < t], rows[x[rows, f] >= t]
                if min(len(left), len(right)) >= max(p.min_child, 1):
                    gain = score(left) + score(right) - score(rows)
                    if gain > found[0] + 1e-9:
                        found = (gain, (f, t, left, right))
        return found if found[0] > 1e-6 else (0.0, None)

    def leaf(rows):
        return -p.eta * shrunk(g[rows].sum(), p.l1) / (len(rows) + p.l2)

    tree = {"rows": np.arange(len(x)), "depth": 0}
    leaves = [tree]
    while leaves:
        for n in leaves:
            if "offer" not in n:
                n["offer"] = best(n["rows"])
        if p.max_leaves is None:
            todo = [n for n in leaves if n["offer"][1] and n["depth"] < p.max_depth]
        else:
            todo = sorted((n for n in leaves if n["offer"][1]), key=lambda n: -n["offer"][0])[:1] if len(leaves) < p.max_leaves else []
        if not todo:
            break
        for n in todo:
            f, t, left, right = n["offer"][1]
            n["split"] = (f, t)
            n["children"] = [{"rows": r, "depth": n["depth"] + 1} for r in (left, right)]
            leaves.remove(n)
            leaves += n["children"]

    def pruned(n):
        if "children" not in n:
            return leaf(n["rows"])
        left, right = map(pruned, n["children"])
        if not isinstance(left, tuple) and not isinstance(right, tuple) and n["offer"][0] < p.min_gain:
            return leaf(n["rows"])
        return (*n["split"], left, right)

    return pruned(tree)


def apply_tree(tree, x):
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, t, left, right = tree
    return np.where(x[:, f] < t, apply_tree(left, x), apply_tree(right, x))


def brute(x, y, p, rows=None):
    rows = np.arange(len(x)) if rows is None else rows
    cuts = [(lambda v: v[:-1] + (v[1:] - v[:-1]) / 2)(np.unique(x[:, f])) for f in range(x.shape[1])]
    margin = np.full(len(x), y[rows].mean() if p.base is None else p.base)
    out = []
    for _ in range(p.rounds):
        margin = margin + apply_tree(brute_tree(x[rows], (margin - y)[rows], p, cuts), x)
        out.append(margin)
    return out


def staged(b, x):
    return list((b.base + np.cumsum(bo.tree_outputs(b.trees, x), axis=1)).T)


P = BoostParams(rounds=6, eta=0.3, min_child=5)
SETS = [P, replace(P, l1=3.0, l2=2.0), replace(P, max_leaves=5, l2=0.0, base=None), replace(P, min_gain=4.0, rounds=8),
        replace(P, max_depth=1, min_child=1), replace(P, max_depth=6, min_child=1, rounds=3)]


@pytest.mark.parametrize("ties", [True, False])
def test_trees_equal_brute_force(spark, ties):
    df, x, y = table(spark, ties=ties)
    found = bo.boost(df, [Fit(p) for p in SETS])
    for p, b in zip(SETS, found, strict=True):
        assert len(b.trees) == p.rounds
        for got, want in zip(staged(b, x), brute(x, y, p), strict=True):
            assert got == pytest.approx(want, abs=1e-7)


def test_held_rows_only_watch(spark):
    df, x, y = table(spark)
    for b, hold in zip(bo.boost(df, [Fit(P, hold=h) for h in range(3)], part="part"), range(3), strict=True):
        rows = np.flatnonzero(np.arange(len(x)) % 3 != hold)
        want = brute(x, y, P, rows)
        for got, w, loss in zip(staged(b, x), want, b.losses, strict=True):
            assert got == pytest.approx(w, abs=1e-7)
            for side, own in (("train", rows), ("held", np.setdiff1d(np.arange(len(x)), rows))):
                e = (w - y)[own]
                assert loss[side]["mae"] == pytest.approx(np.abs(e).mean(), abs=1e-6)
                assert loss[side]["rmse"] == pytest.approx(np.sqrt((e * e).mean()), abs=1e-6)


SAMPLED = [replace(P, subsample=0.7, colsample=0.6, seed=3), replace(P, subsample=0.8, resample_every=2, max_leaves=4), P]


def trees(boosters):
    return [json.dumps(b.trees) for b in boosters]


def test_same_trees_however_the_work_is_cut(spark):
    df, _, _ = table(spark, n=200)
    fits = [Fit(p, hold=1) for p in SAMPLED]
    whole = bo.boost(df, fits, part="part")
    assert trees(bo.boost(df.repartition(5), fits, part="part", block_rounds=2)) == trees(whole)
    # several blocks: a job a level, merged by a shuffle
    assert trees(bo.boost(df.repartition(7), fits, part="part", block_rows=40, block_rounds=3)) == trees(whole)
    # one at a time
    assert [trees(bo.boost(df, [f], part="part"))[0] for f in fits] == trees(whole)


def test_samples_have_the_asked_share(spark):
    h = np.arange(20000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = bo._uniform(h, 1, 0), bo._uniform(h, 1, 2)
    assert abs((a < 0.7).mean() - 0.7) < 0.02 and abs(((a < 0.5) & (b < 0.5)).mean() - 0.25) < 0.02
    assert [len(bo._drawn_features(61, replace(P, colsample=c), 4)) for c in (0.01, 0.5, 1.0)] == [1, 30, 61]


def test_stops_by_patience_within_a_block(spark):
    df, _, _ = table(spark, n=120)
    p = replace(P, rounds=120, eta=0.9, min_child=1)
    whole, = bo.boost(df, [Fit(p, hold=1)], part="part")
    stop = bo.stop_round([x["held"]["rmse"] for x in whole.losses])
    assert stop < 120
    stopped, = bo.boost(df, [Fit(replace(p, early_stop=True), hold=1, watch="held")], part="part", block_rounds=7)
    assert len(stopped.trees) == stop and trees([stopped])[0] == json.dumps(whole.trees[:stop])
    # by the fitted rows' loss, as in the original, it goes on while that improves
    other, = bo.boost(df, [Fit(replace(p, early_stop=True), hold=1)], part="part", block_rounds=7)
    assert len(other.trees) == bo.stop_round([x["train"]["rmse"] for x in whole.losses]) > stop


def test_an_interrupted_fit_goes_on(spark, tmp_path, monkeypatch):
    df, _, _ = table(spark)
    fits = [Fit(replace(p, rounds=r)) for p, r in zip(SAMPLED, (9, 4, 12), strict=True)]
    want = trees(bo.boost(df, fits))
    state = str(tmp_path / "state")
    advance, seen = bo._Run._advance, []

    def killed(self, done):
        if len(seen) == 2:
            raise KeyboardInterrupt
        seen.append(self.rounds)
        advance(self, done)

    monkeypatch.setattr(bo._Run, "_advance", killed)
    with pytest.raises(KeyboardInterrupt):
        bo.boost(df, fits, state=state, block_rounds=3)
    monkeypatch.setattr(bo._Run, "_advance", lambda self, done: (seen.append(self.rounds), advance(self, done)))
    assert trees(bo.boost(df, fits, state=state, block_rounds=3)) == want
    assert seen == [0, 3, 6, 9]  # no block was fitted twice
    assert trees(bo.boost(df, fits, state=state)) == want and len(seen) == 4  # a finished one is only read
    with pytest.raises(ValueError, match="other fits"):
        bo.boost(df, fits[:1], state=state)


def test_bins_are_exact_or_at_even_ranks(spark):
    rng = np.random.default_rng(1)
    x = np.stack([rng.integers(0, 40, 3000), rng.normal(size=3000) * 100], axis=1).astype(float)
    df = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>").repartition(4)
    few, many = bo.bin_edges(df, 2, 256)
    v = np.unique(x[:, 0])
    assert few == pytest.approx(v[:-1] + (v[1:] - v[:-1]) / 2)
    assert len(many) == 255
    shares = np.diff(np.searchsorted(np.sort(x[:, 1]), many)) / 3000
    assert shares.max() < 1.5 / 256 + 1 / 3000
    assert bo.bin_edges(df, 2, 1 << 16)[1] == pytest.approx((lambda v: v[:-1] + (v[1:] - v[:-1]) / 2)(np.unique(x[:, 1])))
    # two neighbouring doubles
    assert bo._cuts(np.array([1.0, np.nextafter(1.0, 2)]), np.ones(2), 256)[0] == np.nextafter(1.0, 2)


def test_staged_predictions_in_one_pass(spark):
    df, x, _ = table(spark)
    found = bo.boost(df, [Fit(P), Fit(replace(P, rounds=3))])
    score = bo.staged_predictions(found, [1, 3, 6])
    got = np.array([r["p"] for r in df.orderBy("terminalno").select(score("features").alias("p")).collect()])
    a, b = (np.array(staged(m, x)) for m in found)
    assert got == pytest.approx(np.stack([a[0], a[2], a[5], b[0], b[2], b[2]], axis=1), abs=1e-12)


def test_no_rows_or_labels(spark):
    df, _, _ = table(spark)
    assert [b.trees for b in bo.boost(df.filter("false"), [Fit(P)])] == [[]]
    assert [b.trees for b in bo.boost(df.withColumn("label", F.lit(None).cast("double")), [Fit(P)])] == [[]]
    # rows without a label do not count
    some = df.withColumn("label", F.when(F.col("terminalno") % 2 == 0, F.col("label")))
    assert trees(bo.boost(some, [Fit(P)])) == trees(bo.boost(some.filter("label is not null"), [Fit(P)]))


def test_one_pipeline_from_features_to_submission(spark, tmp_path):
    df, x, y = table(spark, ties=False)
    cols = [f"f{i}" for i in range(M)]
    raw = df.select("terminalno", F.col("label").alias("y"), *[F.col("features")[i].alias(c) for i, c in enumerate(cols)])
    raw = raw.withColumn("f0", F.when(F.col("terminalno") % 7 != 0, F.col("f0")))
    model = stages.submission_pipeline(cols, replace(P, subsample=0.8), percentile=50).fit(raw)
    assert len(model.stages[1].getInputCols()) == 2
    rows = model.transform(raw.drop("y").withColumn("y", F.lit(None).cast("double"))).orderBy("Id").collect()
    assert [r["Id"] for r in rows] == list(range(90)) and min(r["Pred"] for r in rows) >= 0
    assert max(r["Pred"] for r in rows) > 8  # the label is scaled by ten
    path, data = str(tmp_path / "model"), str(tmp_path / "data")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert [tuple(r) for r in again.transform(raw).orderBy("Id").collect()] == [tuple(r) for r in rows]
    assert again.stages[2].booster.losses == model.stages[2].booster.losses
    raw.write.parquet(data)
    # a session that has never seen the fit
    code = ("import sys; from tripwise.session import local_session; import tripwise.operators.stages; "
            "from pyspark.ml import PipelineModel; s = local_session(2); "
            f"m = PipelineModel.load({path!r}); d = m.transform(s.read.parquet({data!r})).orderBy('Id'); "
            "print('ROWS', [tuple(r) for r in d.collect()])")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=md.__file__.rsplit("/", 3)[0])
    assert f"ROWS {[tuple(r) for r in rows]}" in out.stdout, out.stderr[-2000:]


def test_grid_equals_brute_force(spark):
    df, x, y = table(spark, n=60, ties=False)
    cols = [f"f{i}" for i in range(M)]
    raw = df.select("terminalno", F.col("label").alias("y"), *[F.col("features")[i].alias(c) for i, c in enumerate(cols)])
    base = replace(P, rounds=1)
    grid = {"rounds": [2, 5], "subsample": [1.0], "colsample": [1.0]}
    got = {r["rounds"]: r["explained_variance"] for r in md.grid_scores(raw, cols, "y", base, grid).collect()}
    from tripwise.operators.split import HOLDOUT_BUCKETS, hash_bucket

    fold = np.array([r[0] for r in raw.orderBy("terminalno").select(
        F.floor(hash_bucket("terminalno", 0) * 3 / F.lit(HOLDOUT_BUCKETS))).collect()])
    want = {}
    for n in (2, 5):
        ev = []
        for f in range(3):
            own = fold == f
            e = brute(x, y, replace(base, rounds=n), np.flatnonzero(~own))[-1][own] - y[own]
            ev.append(1 - e.var() / y[own].var())
        want[n] = np.mean(ev)
    assert got == pytest.approx(want, abs=1e-6)
    model, best = md.grid_search(raw, cols, "y", base, grid)
    assert best["rounds"] == max(want, key=want.get) == model.stages[-1].getNumTrees
    # all sampling pairs share the passes
    wide = md.grid_scores(raw, cols, "y", base, {"rounds": [2, 4], "subsample": [0.7, 1.0], "colsample": [0.5, 1.0]}).collect()
    assert sorted(r["candidate"] for r in wide) == list(range(8)) and all(r["explained_variance"] is not None for r in wide)


def test_several_blocks_need_no_job_a_level(spark, monkeypatch):
    df, _, _ = table(spark, n=200)
    fits = [Fit(p, hold=h) for p in SAMPLED for h in (0, 1)]
    want = trees(bo.boost(df, fits, part="part", block_rows=40, block_rounds=3))

    def by_job(self, upto):
        raise AssertionError("a job a level")

    monkeypatch.setattr(bo._Run, "_trees_by_job", by_job)
    assert trees(bo.boost(df, fits, part="part", block_rows=40, fit_rows=200, block_rounds=3)) == want
    with pytest.raises(AssertionError, match="a job a level"):
        bo.boost(df, fits, part="part", block_rows=40, fit_rows=199)
