"""Sharding by extendible hashing.

A directory indexed by the first bits of a row's hash points to shards.  A shard
over its byte limit splits on the next bit, and only it, until every shard fits.
Bucket sizes at every depth come from one aggregate of the rows at a fixed depth,
so the splits are found without passing the rows again.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripwise.llm.common import written

#: Production byte limit of a shard.
SHARD_BYTES = 1 << 20
#: Bits of the hash.
HASH_BITS = 60
#: Bits by which the first pass is finer than an even split would need.
SLACK_BITS = 5


_OUT = ("shard_id", "shard_depth", "overflow", "shard_bytes", "shard_rows", "sh_slot", "sh_prefix", "sh_chained",
        "sh_pid", "sh_rn", "sh_base")


def hashed(docs: DataFrame) -> DataFrame:
    """The rows with sh_hash (60 bits of the md5 of doc_id, a colon and the text) and sh_bytes (UTF-8 length).

    Null ids and texts hash as empty.
    """
    ident = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.withColumns({
        "sh_hash": F.conv(F.substring(F.md5(ident), 1, HASH_BITS // 4), 16, 10).cast("long"),
        "sh_bytes": F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long"),
    })


def _directory(rows: DataFrame, limit: int, low: int, depth: int) -> DataFrame:
    """(sh_slot, shard_depth, sh_prefix, shard_bytes, shard_rows, sh_chained): the directory at ``depth`` bits.

    rows: (sh_hash, n, b) with buckets already known to be too large at depth low - 1.
    A bucket is final if it fits or holds one hash only; its directory entries all
    point to it.  Entries of buckets still too large at ``depth`` have a null shard_depth.
    """
    slot = F.shiftright("sh_hash", HASH_BITS - depth)
    fine = written(rows.groupBy(slot.alias("slot")).agg(
        F.sum("b").alias("b"), F.sum("n").alias("n"), F.min("sh_hash").alias("lo"), F.max("sh_hash").alias("hi")),
        "shard-slots")
    level = (fine.withColumn("d", F.explode(F.sequence(F.lit(low), F.lit(depth))))
             .withColumn("prefix", F.expr(f"shiftright(slot, {depth} - d)")))
    sizes = level.groupBy("d", "prefix").agg(F.sum("b").alias("b"), F.sum("n").alias("n"), F.min("lo").alias("lo"),
                                             F.max("hi").alias("hi"))
    sizes = written(sizes.withColumn("final", (F.col("b") <= limit) | (F.col("lo") == F.col("hi"))), "shard-sizes")
    parents = sizes.filter("NOT final").select((F.col("d") + 1).alias("d"), F.col("prefix").alias("parent"))
    split = (sizes.withColumn("parent", F.shiftright("prefix", 1)).join(parents, ["d", "parent"])
             .unionByName(sizes.filter(F.col("d") == low).withColumn("parent", F.lit(None).cast("long"))))
    open_ends = split.filter(F.col("d") == depth) if depth < HASH_BITS else split.filter("false")
    leaves = split.filter("final").unionByName(open_ends.filter("NOT final"))
    span = F.expr(f"shiftleft(1L, {depth} - d)")
    entry = F.explode(F.sequence(F.col("prefix") * span, F.col("prefix") * span + span - 1))
    return (leaves.withColumn("slot", entry).join(fine.select("slot"), "slot", "left_semi")
            .select(F.col("slot").alias("sh_slot"), F.when(F.col("final"), F.col("d")).alias("shard_depth"),
                    F.col("prefix").alias("sh_prefix"), F.col("b").alias("shard_bytes"),
                    F.col("n").alias("shard_rows"),
                    ((F.col("b") > limit) & (F.col("n") > 1) & F.col("final")).alias("sh_chained")))


def assign(keyed: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """Rows of ``hashed`` with their shard.

    Adds shard_id (the bucket's prefix bits, '' at depth 0), shard_depth, overflow
    and shard_bytes (of the whole bucket).  A bucket whose rows all have one hash
    (repeated rows, or a single text over the limit) cannot split: its rows go to
    numbered overflow shards (overflow 0, 1, ...) of as many rows as fit, one at least.
    """
    if limit < 1:
        raise ValueError("the byte limit must be positive")
    keyed = keyed.drop(*_OUT)
    total = keyed.agg(F.sum("sh_bytes")).first()[0] or 0
    low, depth = 0, min(HASH_BITS, max(1, math.ceil(math.log2(total / limit + 1)) + SLACK_BITS))
    parts, rest = [], keyed
    while True:
        open_rows = rest.groupBy("sh_hash").agg(F.count("*").alias("n"), F.sum("sh_bytes").alias("b"))
        directory = written(_directory(open_rows, limit, low, depth), "shard-directory")
        slotted = rest.withColumn("sh_slot", F.shiftright("sh_hash", HASH_BITS - depth))
        parts.append(slotted.join(directory.filter("shard_depth IS NOT NULL"), "sh_slot"))
        unfinished = directory.filter("shard_depth IS NULL").select("sh_slot")
        if depth == HASH_BITS or unfinished.isEmpty():
            break
        rest = slotted.join(unfinished, "sh_slot", "left_semi").drop("sh_slot")
        low, depth = depth + 1, min(HASH_BITS, depth + 8)
    placed = parts[0]
    for p in parts[1:]:
        placed = placed.unionByName(p)
    bits = F.expr("CASE WHEN shard_depth = 0 THEN '' ELSE lpad(bin(sh_prefix), shard_depth, '0') END")
    placed = placed.withColumn("shard_id", bits)
    plain = placed.filter("NOT sh_chained").withColumn("overflow", F.lit(0))
    return plain.unionByName(_chained(placed.filter("sh_chained"), limit)).drop("sh_chained", "sh_slot", "sh_prefix")


def _chained(rows: DataFrame, limit: int) -> DataFrame:
    """Overflow shards of buckets of one hash: the rows are numbered in two levels, first within a
    partition of the input and then by the partitions' counts, so that no task holds a bucket."""
    part = rows.withColumn("sh_pid", F.spark_partition_id())
    within = Window.partitionBy("sh_hash", "sh_pid").orderBy("sh_bytes")
    local = part.withColumn("sh_rn", F.row_number().over(within) - 1)
    sizes = part.groupBy("sh_hash", "sh_pid").agg(F.count("*").alias("m"))
    before = Window.partitionBy("sh_hash").orderBy("sh_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("sh_hash", "sh_pid", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("sh_base"))
    fit = F.greatest(F.lit(1), F.floor(F.lit(limit) / F.greatest("sh_bytes", F.lit(1)))).cast("long")
    return (local.join(offsets, ["sh_hash", "sh_pid"])
            .withColumn("overflow", F.floor((F.col("sh_base") + F.col("sh_rn")) / fit).cast("int"))
            .drop("sh_pid", "sh_rn", "sh_base"))


def shard(docs: DataFrame, limit: int = SHARD_BYTES) -> DataFrame:
    """The rows of ``docs`` with shard_id, shard_depth, overflow, shard_bytes, shard_rows, sh_hash and sh_bytes.

    Needs doc_id and text; other columns are kept, but one named like an added
    column is replaced by it.  Null ids and texts count as empty, repeated rows are
    all kept, an empty table gives no rows.
    """
    return assign(hashed(docs), limit)


def write_shards(docs: DataFrame, path: str, limit: int = SHARD_BYTES) -> None:
    """Write the rows as Parquet, one folder a shard (shard=<bits>.<overflow>)."""
    placed = shard(docs, limit).withColumn("shard", F.concat_ws(".", "shard_id", "overflow"))
    keep = [c for c in docs.columns] + ["shard"]
    placed.select(*keep).repartition("shard").write.partitionBy("shard").parquet(path)


def oracle_sql(limit: int = SHARD_BYTES, depths: int = 16) -> str:
    """DuckDB SQL for (doc_id, shard_id, shard_depth, n_bytes, shard_bytes, shard_rows) of ``documents``."""
    return f"""
    WITH k AS (
      SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT AS b,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
      FROM documents),
    lv AS (SELECT k.*, d, h >> (60 - d) AS p FROM k, (SELECT unnest(range(0, {depths} + 1))::INT AS d)),
    sz AS (SELECT d, p, sum(b)::BIGINT AS sb, count(*)::BIGINT AS n, min(h) AS lo, max(h) AS hi FROM lv GROUP BY d, p),
    fin AS (SELECT lv.doc_id, lv.h, lv.b, lv.d, lv.p, sz.sb, sz.n,
                   row_number() OVER (PARTITION BY lv.doc_id, lv.h ORDER BY lv.d) AS r
            FROM lv JOIN sz USING (d, p) WHERE sz.sb <= {limit} OR sz.lo = sz.hi)
    SELECT doc_id, CASE WHEN d = 0 THEN '' ELSE lpad(bin(p), d, '0') END AS shard_id, d AS shard_depth,
           b AS n_bytes, sb AS shard_bytes, n AS shard_rows
    FROM fin WHERE r = 1"""
