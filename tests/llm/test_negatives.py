import math

import numpy as np
from helpers import frame, seeded
from pyspark.sql import functions as F

from tripwise.llm import negatives

DDL = "vec_id long, embedding array<double>, label int, floor string, cluster int"


def brute(vectors, n_positives=5, n_negatives=5):
    seen = {}
    for i, v, label, *_ in sorted((r for r in vectors if r[0] is not None and r[2] is not None and r[1]
                                   and all(c is not None and math.isfinite(c) for c in r[1])), key=lambda r: (r[0], r[2], r[1])):
        seen.setdefault(i, (label, [math.floor(256 * c) for c in v]))
    out = set()
    for a, (la, x) in seen.items():
        if a % 100:
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y, strict=True)), i, lb == la) for i, (lb, y) in seen.items()
                        if i != a and len(y) == len(x))
        for ps, p in [(-s, i) for s, i, alike in scored if alike][:n_positives]:
            ok = [(-s, i) for s, i, alike in scored if not alike and 80 * ps <= -100 * s <= 100 * ps][:n_negatives]
            out |= {(a, p, n + 1, i, ps, s) for n, (s, i) in enumerate(ok)}
    return out


def mined(df):
    rows = negatives.integer_vectors(df)
    return negatives.mine(rows, rows.filter(F.col("vec_id") % 100 == 0))


def result(df):
    got = [tuple(r) for r in mined(df).collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_equals_brute_force_over_many_blocks_and_chunks(spark, monkeypatch):
    for name, size in (("BLOCK_ANCHORS", 4), ("CHUNK_ROWS", 30), ("PIECE_ANCHORS", 2), ("STEP", 7), ("CLUSTER_ANCHORS", 2)):
        monkeypatch.setattr(negatives, name, size)
    rng = seeded(11)
    centres = [[rng.gauss(0, 0.2) for _ in range(6)] for _ in range(4)]
    vectors = [(10 * i, [c + rng.gauss(0, 0.1) for c in rng.choice(centres)], rng.randrange(3), "x", 1) for i in range(240)]
    vectors += [(5000 + i, vectors[7][1], i % 3, "x", 1) for i in range(80)]  # ties, a third of them alike
    vectors += [(100, vectors[3][1], 2, "x", 1), vectors[0], vectors[0], (None, vectors[1][1], 1, "x", 1),
                (9001, None, 1, "x", 1), (9002, [None] + [0.1] * 5, 1, "x", 1), (9003, [float("nan")] * 6, 1, "x", 1),
                (9004, [float("inf")] * 6, 1, "x", 1), (9005, vectors[2][1], None, "x", 1), (9006, [], 1, "x", 1),
                (9100, [0.5, 0.25], 1, "x", 1), (9101, [0.5, 0.3], 1, "x", 1), (9102, [0.5, 0.26], 2, "x", 1),
                (9200, [0.0] * 6, 1, "x", 1), (9300, [-1e-20] * 6, 1, "x", 1), (9400, [0.7] * 3, 1, "x", 1)]
    want = brute(vectors)
    assert len(want) > 100 and result(frame(spark, vectors, DDL)) == want


def test_whole_numbers_beyond_doubles(spark):
    big = float(1 << 21)
    vectors = [(100, [big + 1 / 256, big], 1, "", 0), (1, [big + 2 / 256, big + 1 / 256], 1, "", 0), (2, [big, big + 2 / 256], 1, "", 0),
               (3, [big + 1 / 256, big - 1 / 256], 2, "", 0), (4, [big, big], 2, "", 0), (5, [big + 3 / 256, big - 3 / 256], 2, "", 0)]
    want = brute(vectors)
    assert want and max(r[4] for r in want) > 1 << 53
    assert result(frame(spark, vectors, DDL)) == want


def test_empty_tables_and_lone_rows(spark):
    assert result(frame(spark, [], DDL)) == set()
    assert result(frame(spark, [(100, [0.5], 1, "", 0)], DDL)) == set()
    # fewer positives and negatives than asked for: all of them
    few = [(100, [0.5], 1, "", 0), (1, [0.5], 1, "", 0), (2, [0.45], 2, "", 0), (3, [0.1], 2, "", 0)]
    assert result(frame(spark, few, DDL)) == brute(few) and len(brute(few)) == 1


def test_bounds_hold():
    rng = np.random.default_rng(5)
    x, u = rng.normal(size=(300, 5)) * rng.uniform(0, 9, (300, 1)), rng.normal(size=(20, 5)) + 2
    x[3] = u[4] = 0
    bounds, lengths = negatives.angular_bounds(u, x)
    assert (x @ u.T <= bounds[:, None] * lengths[None] + 1e-9).all()
    # members of one direction: the bound is the product itself
    same = np.outer(np.arange(1.0, 4), u[0])
    bounds, lengths = negatives.angular_bounds(same, x)
    assert np.allclose(bounds[:, None] * lengths[None], x @ same.T, atol=1e-4)
