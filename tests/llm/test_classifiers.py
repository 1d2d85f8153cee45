import numpy as np
import pyarrow as pa
import pytest
from helpers import frame, prose, seeded
from pyspark.sql import functions as F

from tripwise.llm import quality as ql
from tripwise.llm import toxicity as tx

DDL = "doc_id long, text string, score string, predicted string"


def brute_segments(x):
    c = np.concatenate([[0], np.cumsum(x)])
    best = (0.0, 0, 0)
    for i in range(len(x)):
        for j in range(i + 1, len(x) + 1):
            if c[j] - c[i] > best[0] + 1e-9:
                best = (c[j] - c[i], i, j)
    if not best[0]:
        return []
    return (brute_segments(x[:best[1]]) + [(best[1], best[2])]
            + [(i + best[2], j + best[2]) for i, j in brute_segments(x[best[2]:])])


def test_segments_equal_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(200):
        x = rng.normal(-0.4, 1.5, rng.integers(0, 25))
        assert [(a, b) for a, b, _ in tx.segments(x)] == brute_segments(x)
    at, gain = np.array([2, 4, 30]), np.array([3.0, 2.0, 4.0])
    dense = np.full(40, -0.5)
    dense[at] = gain
    assert [(a, b) for a, b, _ in tx.sparse_segments(at, gain, 0.5)] == [(a, b) for a, b, _ in tx.segments(dense)]


def corpus(kind):
    rng = seeded(11)
    rows, labels = [], []
    for i in range(600):
        text, bad = prose(rng, rng.randint(30, 150)), i % 4 == 0
        if bad and kind == "quality":
            w = text.split()
            text = [" ".join(x.upper() + "!!" for x in w), " ".join(w[:3] * 20), " ".join(x + "###" for x in w)][i // 4 % 3]
        if bad and kind == "toxic":
            w = text.split()
            for _ in range(4):
                w.insert(rng.randrange(len(w)), rng.choice(["grumbag", "snotface", "blorken", "blorkif", "blorkun"]))
            text = " ".join(w)
        rows.append((i, text, "s", "p"))
        labels.append((i, int(bad) if kind == "toxic" else int(not bad), 9))
    extra = [(1000, None, "s", "p"), (1001, "", "s", "p"), (1002, " \n ", "s", "p"), (None, "some words", "s", "p"), rows[1],
             (1003, "long " * 30000, "s", "p")]
    return rows + extra, labels + [(None, 1, 9), (3, None, 9), (5000, 1, 9), labels[0]]


def test_quality_held_out(spark):
    rows, labels = corpus("quality")
    docs, known = frame(spark, rows, DDL), frame(spark, labels, "doc_id long, quality int, toxic int")
    train = F.col("doc_id") % 5 != 0
    got = ql.classify(docs, known, train).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    truth = {a: b for a, b, _ in labels}
    held = got[(got.doc_id % 5 == 0) & (got.doc_id < 600)]
    assert (held.predicted == held.doc_id.map(truth)).mean() >= 0.97
    assert (got.predicted == (got.score >= 0.3)).all()
    assert ql.keep_good(docs, known, train).columns == docs.columns
    one = ql.classify(docs, known.filter("quality = 1"), train).toPandas()
    assert (one.score == 1).all()
    assert (ql.classify(docs, known.filter("false"), train).toPandas().score == 0.5).all()
    assert ql.classify(docs.filter("false"), known, train).count() == 0


def test_statistics_are_finite():
    texts = pa.array(["", " ", "a", "A!! A!! A!!", "é | ü | é\n\n", "x" * 5000], pa.large_string())
    s = ql.statistics(texts)
    assert s.shape == (6, len(ql.STATISTICS)) and np.isfinite(s).all()
    assert (ql.statistics(texts.slice(3, 2)) == s[3:5]).all()


def test_toxicity_held_out(spark):
    rows, labels = corpus("toxic")
    docs, known = frame(spark, rows, DDL), frame(spark, labels, "doc_id long, toxic int, quality int")
    got = tx.detect(docs, known, F.col("doc_id") % 5 != 0).toPandas()
    assert len(got) == len(rows) and got.score.between(0, 1).all()
    truth = {a: b for a, b, _ in labels}
    held = got[(got.doc_id % 5 == 0) & (got.doc_id < 600)]
    assert (held.predicted == held.doc_id.map(truth)).mean() >= 0.97
    for r in got[(got.doc_id < 600) & (got.predicted == 1)].itertuples():
        words = rows[int(r.doc_id)][1].split()
        for p in r.passages:
            assert any(w[:4] in ("grum", "snot", "blor") for w in words[p["start"]:p["end"]])
    assert (got[got.doc_id.isin([1000, 1001, 1002])].predicted == 0).all()
    assert (tx.detect(docs, known.filter("toxic = 0"), F.lit(True)).toPandas().score == 0).all()
    assert tx.detect(docs.filter("false"), known, F.lit(True)).count() == 0


def brute_isotonic(y, w):
    """max over begins of min over ends of the weighted mean."""
    n = len(y)
    mean = [[np.average(y[a:b + 1], weights=w[a:b + 1]) if b >= a else None for b in range(n)] for a in range(n)]
    return np.array([max(min(mean[a][b] for b in range(i, n)) for a in range(i + 1)) for i in range(n)])


def test_isotonic_equals_brute_force():
    from tripwise.llm.common import calibrated, isotonic

    rng = np.random.default_rng(2)
    for _ in range(30):
        n = int(rng.integers(1, 25))
        x, y, w = np.sort(rng.choice(1000, n, replace=False)).astype(float), rng.random(n).round(1), rng.integers(1, 9, n).astype(float)
        assert calibrated(*isotonic(x, y, w), x) == pytest.approx(brute_isotonic(y, w))


def test_quality_fit_equals_a_dense_solve(spark):
    """Standardisation, weighted normal equations, ridge and calibration against numpy over all rows at once."""
    rows, labels = corpus("quality")
    docs, known = frame(spark, rows, DDL), frame(spark, labels, "doc_id long, quality int, toxic int")
    labelled = ql.bounded_labels(known, "quality", F.col("doc_id") % 5 != 0, 10**6)
    model = ql.fit(docs.repartition(5), labelled, features=24)
    own = docs.join(labelled, "doc_id").withColumn("cal", F.pmod(F.xxhash64(F.lit(29), "doc_id"), F.lit(4)) == 0).toPandas()
    y, cal = own.y.to_numpy(float), own.cal.to_numpy(bool)
    x = ql.statistics(pa.array(own.text.fillna(""), pa.large_string()))
    assert model.mean == pytest.approx(x.mean(0)) and model.scale == pytest.approx(np.maximum(x.std(0), 1e-6))
    z = np.clip((x - x.mean(0)) / np.maximum(x.std(0), 1e-6), -8, 8)
    phi = np.column_stack([np.ones(len(x)), np.sqrt(2 / 24) * np.cos(z @ model.freq + model.phase)])
    share = y.mean()
    w = np.where(y > 0.5, 0.5 / share, 0.5 / (1 - share)) * ~cal
    a, b = phi.T @ (phi * w[:, None]), phi.T @ (w * (2 * y - 1))
    want = np.linalg.solve(a + ql.RIDGE * np.trace(a) / 25 * np.eye(25), b)
    assert model.weights == pytest.approx(want, rel=1e-6, abs=1e-9)
    # the kernel that the features approximate, of the two widths
    d = len(ql.STATISTICS)
    many = ql.QualityModel(np.zeros(d), np.ones(d), *(lambda r, n: (r.normal(size=(d, n)) / (np.where(np.arange(n) % 2, 1.0, 2.5) * np.sqrt(d)),
                           r.uniform(0, 2 * np.pi, n)))(np.random.default_rng(0), 40_000), np.zeros(0), np.zeros(1), np.zeros(1))
    u = np.random.default_rng(1).normal(size=(2, d))
    gap = ((u[0] - u[1]) ** 2).sum()
    exact = np.mean([np.exp(-gap / (2 * (s * np.sqrt(d)) ** 2)) for s in (1.0, 2.5)])
    f = many.features(u)[:, 1:]
    assert f[0] @ f[1] == pytest.approx(exact, abs=0.03)
    # calibration: shares of fixed score bins, isotonic
    raw = phi @ want
    bins = np.clip(np.floor((raw + 2) / 4 * ql.BINS), 0, ql.BINS - 1)[cal]
    at, n = np.unique(bins, return_counts=True)
    ones = np.array([y[cal][bins == i].sum() for i in at])
    smooth = (ones + 0.5 * share) / (n + 0.5)
    assert ql.calibrated(model.edges, model.values, (at + 1) / ql.BINS * 4 - 2) == pytest.approx(brute_isotonic(smooth, n.astype(float)))


def test_toxic_odds_and_significance_follow_from_counts(spark):
    """Dirichlet log-odds of every unit of the model from plain counts of texts; lambda solves its equation."""
    rows, labels = corpus("toxic")
    docs, known = frame(spark, rows, DDL), frame(spark, labels, "doc_id long, quality int, toxic int")
    known = known.withColumn("toxic", F.col("quality"))
    labelled = ql.bounded_labels(known, "toxic", F.col("doc_id") % 4 != 2, 10**6)
    y = {r.doc_id: r.y for r in labelled.collect()}
    model = tx.fit(docs.repartition(4), labelled)
    sets = []
    for i, text, *_ in rows:
        w = tx.Words(pa.array([text or ""], pa.large_string()))
        sets.append((i, {tx.unit_hash(u) for f in w.forms for u in tx.units(f)}))
    n1 = sum(y.values())
    n0 = len(y) - n1
    assert len(model.hashes) > 3 and list(model.hashes) == sorted(model.hashes)
    for h, odds in zip(model.hashes, model.odds, strict=True):
        c1 = sum(h in s for i, s in sets if y.get(i) == 1)
        c0 = sum(h in s for i, s in sets if y.get(i) == 0)
        prior = sum(h in s for _, s in sets) / len(rows) * tx.PRIOR + 1e-3
        want = np.log((c1 + prior) / (n1 + tx.PRIOR - c1 + 1e-3)) - np.log((c0 + prior) / (n0 + tx.PRIOR - c0 - prior + 1e-3))
        assert odds == pytest.approx(min(want, 8.0))
    shares = np.array([0.01, 0.002])
    gains = np.array([4.0, 6.0])
    lam = tx._lambda(gains, shares, 0.3)
    assert (shares * np.exp(lam * gains)).sum() + (1 - shares.sum()) * np.exp(-lam * 0.3) == pytest.approx(1, abs=1e-6)


def test_statistics_do_not_depend_on_the_neighbours():
    rng = seeded(4)
    texts = [prose(rng, rng.randint(0, 60)) + "\n" * rng.randint(0, 3) + "a b a b" * rng.randint(0, 2) for _ in range(300)]
    whole = ql.statistics(pa.array(texts, pa.large_string()))
    alone = np.concatenate([ql.statistics(pa.array([t], pa.large_string())) for t in texts])
    assert whole == pytest.approx(alone, abs=1e-12)
