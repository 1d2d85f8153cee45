"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are cut into blocks of equal bytes.  With target weight w the
i-th block (from 0) has the release time floor(i / w) and the deadline
ceil((i + 1) / w); scheduling the earliest deadline among the released blocks, one
block a slot, keeps every source within one block of its share at all times.
Weights are exact ratios of integers, so no rounding adds up however many slots there
are.  One task schedules the blocks (not the rows) and holds one block a source; the
rows meet its table by source and block.  No row or block passes the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping
from fractions import Fraction
from itertools import islice
from math import lcm

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwise.llm.common import written

#: Bytes of text in a block.
BLOCK_BYTES = 1 << 18
#: Rows of a source that are ordered together.
CHUNK_ROWS = 8192
#: Slots of a period of rounded weights, at least, and for each source.
PERIOD, PERIOD_EACH = 1024, 16
#: Blocks of the schedule that are sent on together.
SCHEDULE_ROWS = 1 << 16
#: Target weights of the registered query and the pipeline: the sources' block counts to this power, in
#: parts of a thousand blocks.  Below 1 it lowers the share of large sources and raises that of small ones.
TEMPERATURE, TEMPERED_PARTS = 0.7, 1000
#: The per-source table is held on the driver; more sources are an error.
MAX_SOURCES = 1 << 16


def quotas(weights: Mapping[str, float], period: int | None = None) -> tuple[int, dict[str, int]]:
    """(Q, blocks a period by source): weights rounded to parts of Q by largest remainder, one at least."""
    if any(w <= 0 for w in weights.values()):
        raise ValueError("target weights must be positive")
    q = period or max(PERIOD, PERIOD_EACH * len(weights))
    if len(weights) > q:
        raise ValueError("a period needs a slot for every source")
    names, total = sorted(weights), float(sum(weights.values()))
    exact = {s: weights[s] / total * q for s in names}
    parts = {s: max(1, int(exact[s])) for s in names}
    spare = q - sum(parts.values())
    while spare:
        order = sorted(names, key=lambda s: (parts[s] - exact[s], s))
        if spare < 0:
            order = [s for s in reversed(order) if parts[s] > 1]
        for s in order[:abs(spare)]:
            parts[s] += 1 if spare > 0 else -1
        spare = q - sum(parts.values())
    return q, parts


def exact_quotas(weights: Mapping[str, object]) -> tuple[int, dict[str, int]]:
    """(Q, blocks in Q slots by source): the weights themselves as integers."""
    exact = {s: Fraction(w if isinstance(w, int | Fraction) else float(w)) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("target weights must be positive")
    scale = lcm(*(w.denominator for w in exact.values()))
    parts = {s: int(w * scale) for s, w in exact.items()}
    return sum(parts.values()), parts


def pfair(q: int, parts: Mapping[str, int], blocks: Mapping[str, int]) -> Iterator[tuple[str, int, int]]:
    """(source, block, slot) of all blocks by slot: earliest deadline first over Pfair windows of weights parts / q."""
    waiting = [(0, s, 0) for s in parts if blocks[s]]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    t = 0
    while waiting or ready:
        if not ready:
            t = max(t, waiting[0][0])
        while waiting and waiting[0][0] <= t:
            _, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(i + 1) * q // parts[s]), s, i))
        deadline, s, i = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a block misses its deadline")
        yield s, i, t
        if i + 1 < blocks[s]:
            heapq.heappush(waiting, ((i + 1) * q // parts[s], s, i + 1))
        t += 1


def pfair_period(q: int, parts: Mapping[str, int]) -> dict[str, list[int]]:
    """The slots of each source's blocks in one period of q slots."""
    slots: dict[str, list[int]] = {s: [] for s in sorted(parts)}
    for s, _, t in pfair(q, parts, parts):
        slots[s].append(t)
    return slots


def schedule(spark: SparkSession, q: int, parts: Mapping[str, int], blocks: Mapping[str, int]) -> DataFrame:
    """(mix_name, block, slot) of every block, made in one task and sent on in batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            placed = pfair(q, parts, blocks) if b.num_rows else iter(())
            while some := list(islice(placed, SCHEDULE_ROWS)):
                names, which, slots = zip(*some, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(which, pa.int64()),
                                                  pa.array(slots, pa.int64())], names=["mix_name", "block", "slot"])

    return spark.range(0, 1, 1, 1).mapInArrow(run, "mix_name string, block long, slot long")


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, block_bytes: int = BLOCK_BYTES,
        chunk_rows: int = CHUNK_ROWS, period: int | None = None, temperature: float | None = None) -> DataFrame:
    """The rows of ``docs`` with their place in the mix; every row is kept.

    ``docs`` has doc_id, source and text (or its UTF-8 length as mix_bytes) and any
    other columns.  Adds block (of the source), slot (of the mix), slot_bytes (the
    row's offset in its block) and exact_mix (whether all sources still have blocks
    at that slot: there the shares are within one block of the targets).  Reading
    by (slot, slot_bytes, doc_id) gives the mix; columns of ``docs`` of these names are
    replaced.  Without ``weights`` the targets are the sources' shares of the blocks, so all
    sources end together; with ``temperature`` t the t-th powers of their block counts.  The weights
    are kept exactly; with ``period`` they are rounded to parts of it.  A source
    that runs out leaves slots empty.  A null source is a source of its own
    (weights key None); a weight for a source without rows is ignored; a source
    without a weight is an error.  Rows of no text take no space.  Within a source
    the order is that of a hash of the id.
    """
    own = "mix_bytes" in docs.columns
    size = F.col("mix_bytes") if own else F.octet_length(F.col("text").cast("string"))
    name = F.concat(F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.lit("+")),
                    F.coalesce(F.col("source").cast("string"), F.lit("")))
    rows = docs.withColumns({"mix_bytes": F.coalesce(size, F.lit(0)).cast("long"), "mix_name": name,
                             "mix_hash": F.xxhash64(F.col("doc_id").cast("string"))})
    sources = {r["mix_name"]: r for r in rows.groupBy("mix_name").agg(
        F.count("*").alias("n"), F.sum("mix_bytes").alias("b")).limit(MAX_SOURCES + 1).collect()}
    if len(sources) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    ends = {s: -(-max(1, r["b"]) // block_bytes) for s, r in sources.items()}  # blocks of the source
    if weights is None and temperature is not None:
        targets = {s: max(1, round(TEMPERED_PARTS * n ** temperature)) for s, n in ends.items()}
    elif weights is None:
        targets = dict(ends)
    else:
        given = {("-" if k is None else f"+{k}"): v for k, v in weights.items()}
        missing = sorted(set(sources) - set(given))
        if missing:
            raise ValueError(f"no target weight for {missing[:5]}")
        targets = {s: given[s] for s in sources}
    spark = docs.sparkSession
    q, parts = (quotas(targets, period) if period else exact_quotas(targets)) if sources else (1, {})
    # from its release on, a block that a source does not have is missing
    horizon = min((ends[s] * q // parts[s] for s in sources), default=0)
    if any(ends[s] * q // parts[s] >= 1 << 62 for s in sources):
        raise ValueError("a target weight is too small for its source's blocks: slots exceed 64 bits")
    plan = spark.createDataFrame([(s, ends[s], max(1, -(-sources[s]["n"] // chunk_rows))) for s in parts],
                                 "mix_name string, mix_blocks long, mix_chunks long")
    slots = written(schedule(spark, q, parts, ends), "mix-slots")
    # bounded by MAX_SOURCES, checked above
    rows = (rows.join(F.broadcast(plan), "mix_name")
            .withColumn("mix_chunk", F.pmod("mix_hash", "mix_chunks")))
    sums = rows.groupBy("mix_name", "mix_chunk").agg(F.sum("mix_bytes").alias("b"))
    before = Window.partitionBy("mix_name").orderBy("mix_chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = written(sums.select("mix_name", "mix_chunk", F.coalesce(F.sum("b").over(before), F.lit(0)).alias("mix_base")),
                    "mix-bases")
    local = (Window.partitionBy("mix_name", "mix_chunk").orderBy("mix_hash", "doc_id", "mix_bytes")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = rows.withColumn("mix_at", F.coalesce(F.sum("mix_bytes").over(local), F.lit(0)))
    placed = placed.join(bases, ["mix_name", "mix_chunk"]).withColumn("mix_at", F.col("mix_at") + F.col("mix_base"))
    # rows of no text may lie at the end of the last block
    placed = placed.withColumn("block", F.least(F.floor(F.col("mix_at") / block_bytes).cast("long"), F.col("mix_blocks") - 1))
    placed = placed.withColumn("slot_bytes", F.col("mix_at") - F.col("block") * block_bytes)
    placed = placed.drop("slot").join(slots, ["mix_name", "block"])
    placed = placed.withColumn("exact_mix", F.col("slot") < F.lit(horizon))
    drop = ["mix_name", "mix_hash", "mix_chunk", "mix_blocks", "mix_chunks", "mix_base", "mix_at"]
    return placed.drop(*drop, *([] if own else ["mix_bytes"]))


def in_mix_order(mixed: DataFrame) -> DataFrame:
    """The rows of ``mix`` range-partitioned and sorted by their place, so files written in order hold the mix."""
    return mixed.repartitionByRange("slot", "slot_bytes", "doc_id").sortWithinPartitions("slot", "slot_bytes", "doc_id")
