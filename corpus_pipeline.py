"""The corpus pipeline: quality filter, near-duplicate removal, decontamination, mixing, sharding.

``run`` applies the stages to ``documents``; each stage's rows are written as Parquet
in the shared folder and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripwise.llm import decontaminate, mixing, near_dup, quality, sharding
from tripwise.llm.common import ROW, crc_fold, ship, table, whole_row, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (fitted on the labelled ones among ``docs``)."""
    ship(spark)
    train = crc_fold("doc_id", quality.FOLDS) != quality.HELD_OUT
    return quality.keep_good(docs, table(spark, sf_dir, "labels"), train)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    ship(spark)
    return near_dup.representatives(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix; the written files, read in order, hold it."""
    ship(spark)
    sized = docs.select("doc_id", "source", F.octet_length(F.col("text").cast("string")).alias("mix_bytes"), whole_row(docs))
    return mixing.in_mix_order(mixing.mix(sized, temperature=mixing.TEMPERATURE)).select(f"{ROW}.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with shard_id, overflow and position in the shard, which follows the mix.

    The order of the mix is that of the files and of the rows in them; rows that are
    not read from files keep the order in which Spark numbers them.  Columns of ``docs``
    of these three names are replaced.
    """
    ship(spark)
    own = ["doc_id", "text", whole_row(docs)]
    try:
        placed = docs.select(*own, F.col("_metadata.file_path").alias("mix_file"), F.col("_metadata.row_index").alias("mix_row"))
    except AnalysisException:
        placed = docs.select(*own, F.lit("").alias("mix_file"), F.monotonically_increasing_id().alias("mix_row"))
    sharded = sharding.assign(sharding.hashed(placed).drop("doc_id", "text"))
    # a shard is bounded by its byte limit
    order = Window.partitionBy("shard_id", "overflow").orderBy("mix_file", "mix_row")
    added = ["shard_id", "overflow", "position"]
    columns = [F.col(f"{ROW}.`{c}`") for c in docs.columns if c not in added]
    return sharded.withColumn("position", F.row_number().over(order) - 1).select(*columns, *added)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: The stages are not SQL-expressible; tests hold them against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
