"""Hard-negative mining with shared candidate lists of anchor clusters.

Anchors are clustered by direction.  For the members of a cluster with mean direction c,
all within the angle t of it, a row x at the angle s from c has the inner product
|u| |x| cos(max(0, s - t)) with a member u at most.  Each cluster sorts the candidates by
that angular bound once; every member walks the list until the next bound proves that
no later row can enter its result, so the results are exact, ties included.

Anchors are dealt to blocks of bounded size, in which the pieces of a cluster stay
together; rows are dealt to chunks of bounded size.  Each (block, chunk) pair is one
group, and only k rows for each anchor and positive leave it.  The first chunk of a
label is searched first; its results are the floor from which the rest is searched.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import written

#: Anchors of a block, rows of a chunk, and anchors of a piece of a cluster.
BLOCK_ANCHORS, CHUNK_ROWS, PIECE_ANCHORS = 1024, 4096, 128
#: The centroids are fitted on so many anchors at most (those of smallest hash); all anchors are clustered.
FIT_ANCHORS, CLUSTER_ANCHORS, MAX_CLUSTERS, FIT_ROUNDS = 4096, 32, 64, 6
#: Rows of a list that are evaluated at once.
STEP = 512
#: Below this product of two rows' lengths float sums of integer products are exact.
_EXACT = float(1 << 52)


def integer_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
                    scale: int = 256) -> DataFrame:
    """(vec_id long, label long, dim int, x array<double>): each component c becomes floor(scale * c).

    Rows with a null id or label, a null or empty vector or one that holds a null or
    non-finite component take no part.  Of rows that share an id the one of smallest
    label, then vector, stays, so repeated rows count once.  Components stay doubles: a
    floored double is an integer without loss.
    """
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                      F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("m")))
    # floor() gives a long; larger doubles are whole anyway
    floored = F.transform("m.v", lambda c: F.when(F.abs(c * scale) < _EXACT, F.floor(c * scale).cast("double"))
                          .otherwise(c * scale))
    return rows.select("vec_id", "m.label", F.size("m.v").alias("dim"), floored.alias("x"))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 (those of length 0 stay)."""
    top = np.abs(x).max(axis=-1, keepdims=True, initial=0)
    x = np.divide(x, top, out=np.zeros_like(x), where=top > 0)
    length = np.sqrt((x * x).sum(-1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def fit_centroids(sample: np.ndarray) -> np.ndarray:
    """Spherical k-means over the sample's directions, from evenly spaced rows."""
    u = _unit(sample)
    k = max(1, min(MAX_CLUSTERS, len(u) // CLUSTER_ANCHORS))
    c = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(FIT_ROUNDS):
        own = (u @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, own, u)
        c = np.where(np.bincount(own, minlength=k)[:, None] > 0, _unit(sums), c)
    return c


def clustered(anchors: DataFrame) -> DataFrame:
    """``anchors`` with the number of the nearest centroid; vector lengths that the sample lacks are one cluster each."""
    sample = anchors.select("x").orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ANCHORS).collect()
    by_dim: dict[int, list] = {}
    for r in sample:
        by_dim.setdefault(len(r["x"]), []).append(r["x"])
    centroids = {d: fit_centroids(np.array(xs, np.float64)) for d, xs in by_dim.items()}

    def run(batches):
        for b in batches:
            of = {d: c.T for d, c in centroids.items()}
            own = [int((_unit(np.array(x)) @ of[len(x)]).argmax()) if len(x) in of else 0
                   for x in b.column(b.schema.get_field_index("x")).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own, pa.int32())], names=[*b.schema.names, "cluster"])

    return anchors.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in anchors.dtypes) + ", cluster int")


def angular_bounds(members: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bound, length) of the rows ``x`` for a cluster: |x| cos(max(0, s - t)), and of the members |u|.

    Slightly raised, so rounding never lowers a bound below the true value.
    """
    u, v = _unit(members), _unit(x)
    lengths = np.sqrt((members * members).sum(1))
    real = lengths > 0
    centre = _unit(u[real].sum(0)) if real.any() else np.zeros(x.shape[1])
    # a centre of length 0 tells nothing: the whole half-circle is allowed
    spread = np.arccos(np.clip((u[real] @ centre).min(initial=1.0), -1, 1)) if centre.any() else np.pi
    apart = np.arccos(np.clip(v @ centre, -1, 1))
    size = np.sqrt((x * x).sum(1))
    return size * np.minimum(1.0, np.cos(np.maximum(0.0, apart - spread - 1e-7)) + 1e-9), lengths


def products(x: np.ndarray, u: np.ndarray) -> np.ndarray:
    """(rows, members) inner products; whole numbers beyond the exact range of doubles are multiplied as integers."""
    top = np.abs(x).max(initial=0) * np.abs(u).max(initial=0) * max(1, x.shape[1])
    if top < _EXACT:
        return x @ u.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(x) @ whole(u).T


def _walk(x: np.ndarray, members: np.ndarray, stop):
    """(members, rows of the list, products) step by step in bound order, for the members that ``stop`` lets go on."""
    bounds, lengths = angular_bounds(members, x)
    order = np.argsort(-bounds, kind="stable")
    active = np.arange(len(members))
    for at in range(0, len(order), STEP):
        raised = lengths[active] * bounds[order[at]]
        active = active[~stop(active, raised + np.abs(raised) * 1e-9 + 1e-6)]
        if not len(active):
            return
        take = order[at:at + STEP]
        yield active, take, products(x[take], members[active])


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """The places of the k largest scores, ties by smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def _under(score: float) -> float:
    """No more than the score, whatever a double rounds it to."""
    return float(score) - abs(float(score)) * 1e-12


def walk_positives(a_ids, u, floors, ids, x, k):
    """(member, id, score): each member's k best other rows of score at least its floor."""
    found_i = [np.zeros(0, np.int64)] * len(u)
    found_s: list[np.ndarray] = [np.zeros(0)] * len(u)
    least = np.array([-np.inf if f is None else _under(f) for f in floors])

    def stop(active, bound):
        return bound < least[active]

    for active, take, s in _walk(x, u, stop):
        for j, m in enumerate(active):
            ok = (ids[take] != a_ids[m]) & (s[:, j] >= least[m])
            i, v = np.concatenate([found_i[m], ids[take][ok]]), np.concatenate([found_s[m], s[ok, j]])
            best = _best(i, v, k)
            found_i[m], found_s[m] = i[best], v[best]
            if len(best) == k:
                least[m] = max(least[m], _under(v[best[-1]]))
    return [(m, int(i), int(s)) for m in range(len(u)) for i, s in zip(found_i[m], found_s[m], strict=True)]


def in_window(scores: np.ndarray, positive: int, low: int, high: int) -> np.ndarray:
    """Which scores satisfy low * positive <= 100 * score <= high * positive, in whole numbers."""
    least, most = -(-low * positive // 100), high * positive // 100
    return (scores >= least) & (scores <= most)


def walk_negatives(a_ids, a_labels, u, wanted, ids, labels, x, k, low, high):
    """(member, positive's place, id, score): for each positive score of a member its k best rows in the window."""
    found_i = [np.zeros(0, np.int64)] * len(u)
    found_s: list[np.ndarray] = [np.zeros(0)] * len(u)
    # a window that no score satisfies (a negative positive score) wants nothing
    open_for = [[p for p in ps if low * p <= high * p] for ps in wanted]
    least = np.array([_under(min(-(-low * p // 100) for p in ps)) if ps else np.inf for ps in open_for])
    most = np.array([-_under(-max(high * p // 100 for p in ps)) if ps else -np.inf for ps in open_for])

    def stop(active, bound):
        done = bound < least[active]
        for j in np.flatnonzero(~done):
            m = active[j]
            # every window is full of rows that no later one can outdo
            done[j] = all(bound[j] < -(-low * p // 100) or
                          np.count_nonzero(in_window(found_s[m], p, low, high) & (found_s[m] > bound[j])) >= k
                          for p in open_for[m])
        return done

    for active, take, s in _walk(x, u, stop):
        for j, m in enumerate(active):
            ok = np.flatnonzero((labels[take] != a_labels[m]) & (s[:, j] >= least[m]) & (s[:, j] <= most[m]))
            if len(ok):
                found_i[m] = np.concatenate([found_i[m], ids[take][ok]])
                found_s[m] = np.concatenate([found_s[m], s[ok, j]])
    out = []
    for m in range(len(u)):
        for place, p in enumerate(wanted[m]):
            w = np.flatnonzero(in_window(found_s[m], p, low, high))
            w = w[_best(found_i[m][w], found_s[m][w], k)]
            out += [(m, place, int(found_i[m][i]), int(found_s[m][i])) for i in w]
    return out


def _sized(df: DataFrame, by: list[str], size: int, name: str) -> DataFrame:
    """(by, name): the number of pieces of at most about ``size`` rows."""
    return df.groupBy(*by).agg(F.ceil(F.count("*") / F.lit(size)).cast("int").alias(name))


def _blocks(anchors: DataFrame, by: list[str]) -> DataFrame:
    """``anchors`` with block and blocks (of the same ``by``); a cluster's pieces are dealt whole."""
    pieces = _sized(anchors, [*by, "cluster"], PIECE_ANCHORS, "pieces")
    piece = F.pmod(F.xxhash64("vec_id"), F.col("pieces"))
    return (anchors.join(pieces, [*by, "cluster"]).join(_sized(anchors, by, BLOCK_ANCHORS, "blocks"), by)
            .withColumn("block", F.pmod(F.xxhash64("cluster", piece), F.col("blocks")).cast("int")).drop("pieces"))


def _paired(anchors: DataFrame, rows: DataFrame, by: list[str], run, schema: str) -> DataFrame:
    """Every block of anchors with every chunk of rows of the same ``by``: one group each."""
    keys = [*by, "block", "chunk"]
    if "chunks" not in rows.columns:
        rows = rows.join(_sized(rows, by, CHUNK_ROWS, "chunks"), by).withColumn(
            "chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    blocked = _blocks(anchors, by)
    left = (blocked.join(rows.groupBy(*by).agg(F.max("chunks").alias("chunks"), F.min("chunk").alias("first")), by)
            .withColumn("chunk", F.explode(F.sequence("first", F.col("chunks") - 1))).drop("blocks", "chunks", "first"))
    right = (rows.join(_sized(anchors, by, BLOCK_ANCHORS, "blocks"), by)
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks", "chunks"))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, schema)


def _clusters(block: pa.Table):
    """(places, vectors) of each cluster of a block."""
    x = _matrix(block["x"], block["dim"][0].as_py())
    cluster = block["cluster"].to_numpy()
    for c in np.unique(cluster):
        at = np.flatnonzero(cluster == c)
        yield at, x[at]


def _ranked(found: DataFrame, keys: list[str], order: list, k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def positives(anchors: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score): each anchor's k best other rows of its label."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, x = right["vec_id"].to_numpy(), _matrix(right["x"], right["dim"][0].as_py())
            a_ids, floors = left["vec_id"].to_numpy(), left["floor"].to_pylist()
            for at, u in _clusters(left):
                found += [(int(a_ids[at[m]]), i, s) for m, i, s in
                          walk_positives(a_ids[at], u, [floors[i] for i in at], ids, x, k)]
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "positive_id", "positive_score"), cols, strict=True)})

    by, schema = ["dim", "label"], "anchor_id long, positive_id long, positive_score long"
    dealt = (rows.join(_sized(rows, by, CHUNK_ROWS, "chunks"), by)
             .withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int")))
    unbounded = anchors.withColumn("floor", F.lit(None).cast("long"))
    order = [F.col("positive_score").desc(), "positive_id"]
    first = written(_ranked(_paired(unbounded, dealt.filter("chunk = 0").withColumn("chunks", F.lit(1)), by, run, schema),
                            ["anchor_id"], order, k), "negatives-first")
    # an anchor's k-th best so far is a floor for all other chunks
    floors = first.filter(F.col("rank") == k).select(F.col("anchor_id").alias("vec_id"), F.col("positive_score").alias("floor"))
    bounded = anchors.join(floors, "vec_id", "left").select(*anchors.columns, "floor")
    rest = _paired(bounded, dealt.filter("chunk > 0"), by, run, schema)
    return _ranked(first.drop("rank").unionByName(rest), ["anchor_id"], order, k).drop("rank")


def negatives(anchors: DataFrame, rows: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """(anchor_id, positive_id, negative_id, positive_score, negative_score): the k best of each chunk in each window.

    ``anchors`` carry ``positives``: array<struct<positive_id, positive_score>>.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            ids, labels = right["vec_id"].to_numpy(), right["label"].to_numpy()
            x = _matrix(right["x"], right["dim"][0].as_py())
            a_ids, a_labels, given = left["vec_id"].to_numpy(), left["label"].to_numpy(), left["positives"].to_pylist()
            for at, u in _clusters(left):
                wanted = [[p["positive_score"] for p in given[i]] for i in at]
                for m, place, i, s in walk_negatives(a_ids[at], a_labels[at], u, wanted, ids, labels, x, k, low, high):
                    p = given[at[m]][place]
                    found.append((int(a_ids[at[m]]), p["positive_id"], i, p["positive_score"], s))
        cols = list(zip(*found, strict=True)) or [(), (), (), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(
            ("anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"), cols, strict=True)})

    return _paired(anchors, rows, ["dim"], run,
                   "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")


def mine(rows: DataFrame, anchors: DataFrame, n_positives: int = 5, n_negatives: int = 5, low: int = 80,
         high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` and ``anchors`` are (vec_id, label, dim, x) as ``integer_vectors`` gives them, anchors
    being rows.  An anchor's positives are its ``n_positives`` best other rows of the same
    label by inner product (ties: smaller id; all, if fewer); for each the first
    ``n_negatives`` rows of other labels with low * positive_score <= 100 * negative_score
    <= high * positive_score follow, best first, with their rank from 1.  Only vectors of
    equal length meet.  A positive without such a row gives no row; empty tables give none.
    Scores beyond 64 bits are an error.
    """
    rows = written(rows.select("vec_id", "label", "dim", "x"), "negatives-rows")
    anchors = written(clustered(anchors.select("vec_id", "label", "dim", "x")), "negatives-anchors")
    best = positives(anchors, rows, n_positives)
    packed = best.groupBy("anchor_id").agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    ready = written(anchors.join(packed, anchors["vec_id"] == packed["anchor_id"]).drop("anchor_id"), "negatives-positives")
    found = negatives(ready, rows, n_negatives, low, high)
    return _ranked(found, ["anchor_id", "positive_id"], [F.col("negative_score").desc(), "negative_id"], n_negatives).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
