import math

from helpers import frame, seeded
from pyspark.sql import functions as F

from tripwise.llm import topk

DDL = "vec_id long, embedding array<float>, score int, rank int"


def test_top_k_equals_brute_force(spark):
    rng = seeded(1)
    vectors = [(i, [rng.gauss(0, 0.3) for _ in range(8)], 1, 1) for i in range(150)]
    vectors += [(200 + i, vectors[7][1], 1, 1) for i in range(60)]  # ties
    vectors += [(500, None, 1, 1), (550, [None] + [0.1] * 7, 1, 1), (600, [float("nan")] * 8, 1, 1), (650, [float("inf")] * 8, 1, 1),
                (None, vectors[3][1], 1, 1), vectors[0], (700, [0.5, 0.25], 1, 1), (701, [1.0, 1.0], 1, 1), (750, [], 1, 1),
                (800, [0.5] * 3, 1, 1)]
    rows = topk.quantised(frame(spark, vectors, DDL))
    got = {(r.query_id, r.rank): (r.vec_id, r.score)
           for r in topk.top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5, pivots=6, chunk_rows=40).collect()}
    seen = {}
    for i, v, *_ in spark.createDataFrame(vectors, DDL).collect():
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            seen[i] = [math.floor(256 * x) for x in v]
    want = {}
    for q, x in seen.items():
        if q % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in seen.items() if i != q and len(y) == len(x)))
            want |= {(q, n + 1): (i, -s) for n, (s, i) in enumerate(best[:5])}
    assert got == want
    empty = rows.filter("false")
    assert topk.top_k(empty, empty).count() == 0


def test_scores_beyond_doubles_are_whole_numbers(spark):
    """Components near 2^30 give products that doubles cannot tell apart."""
    big = 1 << 22
    vectors = [(0, [big + 1 / 256, float(big)]), (1, [big + 2 / 256, big + 1 / 256]), (2, [float(big), big + 2 / 256]),
               (3, [big + 3 / 256, big - 1 / 256]), (4, [big + 1 / 256, big + 1 / 256]), (5, [float(-big), 1.0])]
    rows = topk.quantised(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"))
    got = [(r.vec_id, r.score) for r in topk.top_k(rows, rows.filter("vec_id = 0"), 4, pivots=2).orderBy("rank").collect()]
    x = {i: [math.floor(256 * c) for c in v] for i, v in vectors}
    want = sorted(((-sum(a * b for a, b in zip(x[0], x[i], strict=True)), i) for i in x if i), key=lambda p: p)[:4]
    assert got == [(i, -s) for s, i in want] and max(s for _, s in got) > 1 << 60
