"""Exact top-k search by inner product with a pivot table.

Every row keeps its distances to P fixed pivots.  For a query q and a row x each
pivot p gives the lower bound |d(q, p) - d(x, p)| on d(q, x); with the norms the
largest of them gives an upper bound on the inner product
(|q|^2 + |x|^2 - d^2) / 2.  Rows are evaluated in bound order until the next bound
is below the k-th best score, so the result is exact, ties included.

Queries and rows are cut into chunks of bounded size; each (query chunk, row
chunk) pair is one group, and only k rows a query leave it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import written

#: Rows of a chunk, on either side.
CHUNK_ROWS = 4096
#: Pivots (rows of the table itself, those of smallest hash).
PIVOTS = 24
#: Candidates evaluated at once, in bound order.
STEP = 256


def quantised(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = 256) -> DataFrame:
    """(vec_id, x): each component c becomes floor(scale * c), c as double.

    Null ids, null or empty vectors and vectors holding a null or non-finite
    component take no part; fully repeated rows count once.
    """
    v = F.col("v")
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return (df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .filter(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0) & finite)
            .select("vec_id", F.transform(v, lambda c: F.floor(c * F.lit(scale)).cast("long")).alias("x"))
            .distinct())


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int, kind=np.float64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=kind).reshape(-1, dim)


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] - 2.0 * (x @ pivots.T) + (pivots * pivots).sum(1)[None]
    return np.sqrt(np.maximum(square, 0.0))


def search_chunk(q_ids: np.ndarray, q: np.ndarray, q_piv: np.ndarray, ids: np.ndarray, x: np.ndarray,
                 x_piv: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, row, score) of each query's k best rows of this chunk, in bound order with exact stopping."""
    whole_q, whole_x, q, x = q, x, q.astype(np.float64), x.astype(np.float64)
    norms, out = (x * x).sum(1), []
    # sums of products beyond the exact range of doubles are taken in whole numbers
    exact = np.abs(x).max(initial=0) * np.abs(q).max(initial=0) * max(1, x.shape[1]) < 2.0 ** 52
    integer = np.frompyfunc(int, 1, 1)
    x_table = np.ascontiguousarray(x_piv.T)
    for qid, vec, whole, dist in zip(q_ids, q, whole_q, q_piv, strict=True):
        lower = np.zeros(len(x))
        for p in range(len(x_table)):
            np.maximum(lower, np.abs(x_table[p] - dist[p]), out=lower)
        lower = np.maximum(lower - 1e-6, 0.0)
        sizes = vec @ vec + norms
        # raised by more than the terms' rounding
        bound = np.floor((sizes - lower * lower) / 2 + 1e-3 + 1e-9 * sizes)
        bound[ids == qid] = -np.inf
        order = np.argsort(-bound, kind="stable")
        best_s, best_i = np.zeros(0, np.float64 if exact else object), np.zeros(0, np.int64)
        for at in range(0, len(order), STEP):
            if bound[order[at]] == -np.inf or len(best_s) == k and bound[order[at]] < best_s[-1]:
                break
            take = order[at:at + STEP]
            take = take[bound[take] > -np.inf]
            scores = x[take] @ vec if exact else integer(whole_x[take]) @ integer(whole)
            s = np.concatenate([best_s, scores])
            i = np.concatenate([best_i, ids[take]])
            keep = np.lexsort((i, -s))[:k] if exact else np.array(sorted(range(len(s)), key=lambda n: (-s[n], i[n]))[:k], np.int64)
            best_s, best_i = s[keep], i[keep]
        out += [(int(qid), int(i), int(s)) for i, s in zip(best_i, best_s, strict=True)]
    return out


def _matcher(dim: int, width: int, k: int):
    """The task for one (query chunk, row chunk) pair."""

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = search_chunk(
                left["vec_id"].to_numpy(), _matrix(left["x"], dim, np.int64), _matrix(left["table"], width),
                right["vec_id"].to_numpy(), _matrix(right["x"], dim, np.int64), _matrix(right["table"], width), k)
        cols = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "vec_id", "score"), cols,
                                                                    strict=True)})

    return match


def top_k(rows: DataFrame, queries: DataFrame, k: int = 5, pivots: int = PIVOTS,
          chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest integer inner product with each query.

    ``rows`` and ``queries`` are (vec_id long, x array<long>); only vectors of equal
    length meet; rows with the query's own id are left out; ties go to the smaller
    vec_id; a query with fewer candidates returns all of them, one with none no row.
    """
    rows = written(rows.withColumn("dim", F.size("x")), "topk-rows")
    queries = written(queries.withColumn("dim", F.size("x")), "topk-queries")
    counts = {r["dim"]: (r["n"], 0) for r in rows.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    for r in queries.groupBy("dim").agg(F.count("*").alias("n")).collect():
        counts[r["dim"]] = (counts.get(r["dim"], (0, 0))[0], r["n"])
    spark, parts = rows.sparkSession, []
    for dim, (n, m) in sorted(counts.items()):
        if not n or not m:
            continue
        rc, qc = -(-n // chunk_rows), -(-m // chunk_rows)
        h = F.xxhash64("vec_id")
        # the pivots: a fixed number of rows, those of smallest hash
        piv = np.array([r["x"] for r in rows.filter(F.col("dim") == dim).orderBy(h, "vec_id", "x")
                        .limit(pivots).collect()], dtype=np.float64)

        def with_table(batches, piv=piv, dim=dim):
            for b in batches:
                d = _distances(_matrix(b.column(1), dim), piv)
                yield pa.RecordBatch.from_arrays(
                    [*b.columns, pa.array(list(d), pa.list_(pa.float64()))], names=["vec_id", "x", "c", "table"])

        def pivoted(df, chunks):
            cut = df.filter(F.col("dim") == dim).select("vec_id", "x", F.pmod(h, F.lit(chunks)).cast("long").alias("c"))
            return cut.mapInArrow(with_table, "vec_id long, x array<long>, c long, table array<double>")

        r_side = (pivoted(rows, rc).withColumn("qc", F.explode(F.sequence(F.lit(0), F.lit(qc - 1))))
                  .withColumnRenamed("c", "rc").withColumn("rc", F.col("rc").cast("int")))
        q_side = (pivoted(queries, qc).withColumn("rc", F.explode(F.sequence(F.lit(0), F.lit(rc - 1))))
                  .withColumnRenamed("c", "qc").withColumn("qc", F.col("qc").cast("int")))

        parts.append(q_side.groupBy("qc", "rc").cogroup(r_side.groupBy("qc", "rc"))
                     .applyInArrow(_matcher(dim, len(piv), k), "query_id long, vec_id long, score long"))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
