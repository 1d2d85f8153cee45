"""Ordering operators: distributed global rank, head/tail, first-appearance order (L1-L3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwise.session import checkpoint_dir

# monotonically_increasing_id: partition in the upper bits, place in the partition in the lower 33
_LOCAL_BITS = 33


def numbered(df: DataFrame, order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by ``order``, with ``_part`` and ``_local`` (0-based place in the partition).

    Checkpointed to the shared folder, so that every later pass sees the same
    partitioning, also after a lost executor.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return with_place(ranged).checkpoint(eager=True)


def with_place(df: DataFrame, part: str = "_part", local: str = "_local") -> DataFrame:
    """Partition number and 0-based place in the partition of every row (no exchange)."""
    mid = F.monotonically_increasing_id()
    return (df.withColumn("_mid", mid)
            .withColumns({part: F.shiftright("_mid", _LOCAL_BITS).cast("int"),
                          local: F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))}).drop("_mid"))


def offsets(rows: DataFrame, out: str = "_offset") -> DataFrame:
    """(_part, out, _total): rows before each partition of ``numbered`` rows, and of all; one row a partition."""
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition, so the windows without a key are bounded by the number of partitions
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(out),
                         F.sum("_n").over(Window.partitionBy()).alias("_total"))


def global_rank(df: DataFrame, order: Sequence[str], out: str = "rank", partitions: int | None = None,
                total: str | None = None) -> DataFrame:
    """0-based position of every row in the total order of ``order`` (keys must be unique).

    A global ``row_number()`` window sorts everything in one task.  Instead:
    range-partition and sort within partitions, number the rows inside each
    partition, and join the row counts of the earlier partitions (a table of one
    row a partition).  All on the JVM, in one pass over ``df``.  ``total`` names
    an optional column with the number of rows.
    """
    rows = numbered(df, order, partitions)
    # bounded by the number of partitions
    placed = rows.join(F.broadcast(offsets(rows)), "_part").withColumn(out, F.col("_offset") + F.col("_local"))
    if total:
        placed = placed.withColumn(total, F.col("_total"))
    return placed.drop("_part", "_local", "_offset", "_total")


def running_sums(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: dict[str, str],
                 partitions: int | None = None) -> DataFrame:
    """``df`` with running sums (the row included) of columns within each group of ``by``, in the order of ``order``.

    ``sums`` maps new names to summed columns; rows of equal order must not occur.  A window
    over a group would sum it in one task.  Instead the rows are range-partitioned by
    (by, order); sums inside a partition get those of the group's earlier partitions (a
    table of one row a group and partition).  A group of any size is spread.
    """
    rows = numbered(df, [*by, *order], partitions)
    within = Window.partitionBy("_part", *by).orderBy("_local").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = rows.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"),
                        *[F.coalesce(F.sum(f"_{n}").over(earlier), F.lit(0)).alias(f"_{n}") for n in sums])
    local = rows.select("*", *[F.sum(c).over(within).alias(n) for n, c in sums.items()])
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("_part") == F.col("_of")]
    joined = local.join(base, same, "left")
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in sums])


# order of equal values in ``place_among``: a query that counts the rows below its value, the rows, one that also counts equals
BELOW, ROW, UP_TO = 0, 1, 2


def place_among(rows: DataFrame, queries: DataFrame, key: str, tie: str, side: str, out: str) -> tuple[DataFrame, DataFrame]:
    """The places of ``queries`` among ``rows``, and of the rows among themselves, in the order of ``key``.

    Both have ``key`` and ``tie``; a query's column ``side`` is BELOW or UP_TO.  Returns
    (rows with their 0-based rank, queries with the number of rows below or up to
    their value) as column ``out``.  Both sides are ranged together: in a partition
    the rows before a query are its place among all less its place among the queries.
    One exchange; no value reaches the driver.
    """
    both = numbered(rows.withColumn(side, F.lit(ROW)).unionByName(queries, allowMissingColumns=True), [key, side, tie])
    counts = both.groupBy("_part").agg(F.count_if(F.col(side) == ROW).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row a partition
    base = F.broadcast(counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")))
    # a filter keeps partitions and their order, so places among one side follow
    own = with_place(both.filter(F.col(side) == ROW).drop("_part"), "_part", "_own").join(base, "_part")
    asked = with_place(both.filter(F.col(side) != ROW).drop("_part"), "_part", "_own").join(base, "_part")
    drop = ["_part", "_own", "_local", "_offset"]
    return (own.withColumn(out, F.col("_offset") + F.col("_own")).drop(*drop, side).select(*rows.columns, out),
            asked.withColumn(out, F.col("_offset") + F.col("_local") - F.col("_own")).drop(*drop).select(*queries.columns, out))


def first_rows(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """L2: the first ``n`` rows in ``order`` (a top-k: each task keeps n, then one merge)."""
    return df.orderBy(*order).limit(n)


def last_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """L2: the last ``n`` rows in ``order``."""
    return df.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def drivers_in_order(df: DataFrame, key: str = "terminalno") -> DataFrame:
    """L3: distinct drivers with their first ingest position and order of first appearance."""
    first = df.groupBy(key).agg(F.min("seq").alias("first_seq"))
    return global_rank(first, ["first_seq", key], out="position")
