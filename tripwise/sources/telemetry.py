"""Telemetry scan (S1-S5), train/test union (U1) and the test-table adapter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwise.functions.timeparts import epoch_seconds_of_ntz

# Canonical column names, in file order (lower-cased upstream header).
COLUMNS = [
    "terminalno", "time", "trip_id", "longitude", "latitude",
    "direction", "height", "speed", "callstate", "y",
]

TRAIN_SCHEMA = T.StructType([
    T.StructField("terminalno", T.LongType()),
    T.StructField("time", T.LongType()),
    T.StructField("trip_id", T.LongType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("direction", T.DoubleType()),
    T.StructField("height", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("callstate", T.IntegerType()),
    T.StructField("y", T.DoubleType()),
])
TEST_SCHEMA = T.StructType([f for f in TRAIN_SCHEMA.fields if f.name != "y"])

DOUBLE_COLUMNS = ["longitude", "latitude", "direction", "height", "speed", "y"]


def read_telemetry(spark: SparkSession, path: str, labelled: bool = True, fmt: str = "csv") -> DataFrame:
    """Scan telemetry with an explicit schema (never inferred).

    CSV files carry a header; the header names are replaced by the canonical
    ones positionally (S4).  A malformed field or line is an error (FAILFAST), not a
    silent NULL.  Test files have no Y: the column is added as NULL so both sides
    share one schema (S3).  ``seq`` records ingest order and breaks ties of equal TIME:
    the files by path, then the splits of a file by their start, then the rows of a
    split (Spark hands out splits by size, so the row ids alone would not follow the files).
    """
    schema = TRAIN_SCHEMA if labelled else TEST_SCHEMA
    reader = spark.read.schema(schema)
    if fmt == "csv":
        df = reader.option("header", True).option("mode", "FAILFAST").csv(path)
    else:
        df = reader.format(fmt).load(path)
    if not labelled:
        df = df.withColumn("y", F.lit(None).cast("double"))
    return _in_file_order(df.select(
        *COLUMNS, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row")), *COLUMNS).drop("record")


# rows of a split that ``seq`` leaves room for
_SPLIT_BITS = 40
#: File splits (a path and three numbers each) whose list is broadcast.
MAX_BROADCAST_SPLITS = 100_000


def _splits(df: DataFrame) -> DataFrame:
    """(_f, _s, _first, _place, _before): each file split's first row id, its place among all splits, and the
    rows of its file in earlier splits.

    A row for each file block (a second pass over the files).
    """
    splits = df.groupBy("_file", "_start").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    order = Window.orderBy("_file", "_start")  # one row a file split
    earlier = Window.partitionBy("_file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select(F.col("_file").alias("_f"), F.col("_start").alias("_s"), "_first",
                         (F.row_number().over(order) - 1).cast("bigint").alias("_place"),
                         F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))


def _in_file_order(df: DataFrame, *columns: str) -> DataFrame:
    """``columns`` with ``seq``, from file, split start and row id: the split's place among all splits, then the
    place in the split; and with ``record``, the row's number in its file, from 1.

    The list of splits is joined back on the split; it is broadcast up to
    MAX_BROADCAST_SPLITS splits, beyond that the planner chooses the join.
    """
    seq = F.shiftleft(F.col("_place"), _SPLIT_BITS) + (F.col("_row") - F.col("_first"))
    record = F.col("_before") + F.col("_row") - F.col("_first") + 1
    # a split is a whole file or fills a partition
    few = len(df.inputFiles()) + df.rdd.getNumPartitions() <= MAX_BROADCAST_SPLITS
    splits = F.broadcast(_splits(df)) if few else _splits(df)
    return (df.join(splits, (F.col("_file") == F.col("_f")) & (F.col("_start") == F.col("_s")))
            .select(*columns, seq.alias("seq"), record.alias("record")))


class TooManyRejects(ValueError):
    """More lines were set aside than the caller allows."""


def read_quarantined(spark: SparkSession, path: str, rejects_path: str, labelled: bool = True, header: bool = True,
                     max_share: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """S1 with bad lines set aside: (good rows as ``read_telemetry`` gives them, rejected lines).

    A line whose fields do not parse, or of too few or too many fields, is rejected: the
    table written to ``rejects_path`` has file, record (the line's number in the file, from
    1) and line.  One pass writes it and counts all lines; if more than
    ``max_share`` of them are bad, ``TooManyRejects`` is raised and nothing else is read.
    Empty lines are skipped; no field holds a line break.
    """
    fields = (TRAIN_SCHEMA if labelled else TEST_SCHEMA).fields
    schema = T.StructType([*fields, T.StructField("_line", T.StringType())])
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_row"))
    numbered = _in_file_order(lines, "value", "_file")
    if header:
        numbered = numbered.filter(F.col("record") > 1)
    # the CSV reader would leave out the fields that nobody asks for, and with them their errors
    parsed = F.from_csv("value", schema.simpleString()[len("struct<"):-1].replace(":", " "),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_line"})
    placed = numbered.filter(F.trim("value") != "").select(parsed.alias("r"), "_file", "record", "seq").select(
        "r.*", "_file", "record", "seq")
    if not labelled:
        placed = placed.withColumn("y", F.lit(None).cast("double"))
    seen = Observation()
    (placed.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(F.col("_line").isNotNull()).alias("bad"))
     .filter(F.col("_line").isNotNull()).select(F.col("_file").alias("file"), "record", F.col("_line").alias("line"))
     .write.mode("overwrite").parquet(rejects_path))
    n, bad = seen.get["n"], seen.get["bad"]
    if bad > max_share * n:
        raise TooManyRejects(f"{bad} of {n} lines of {path} are bad, see {rejects_path}")
    rejects = spark.read.schema("file string, record bigint, line string").parquet(rejects_path)
    return placed.filter(F.col("_line").isNull()).select(*COLUMNS, "seq"), rejects


def telemetry_line(labelled: bool = True) -> Column:
    """A row's CSV line, in the file's column order (a missing value is an empty field)."""
    cols = [c for c in COLUMNS if labelled or c != "y"]
    return F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])


def clean_telemetry(df: DataFrame) -> DataFrame:
    """NaN -> NULL on every double column.

    Spark aggregates skip NULL but propagate NaN, while the original frame
    library skipped both; after this step the two agree.
    """
    out = []
    for name in df.columns:
        if name in DOUBLE_COLUMNS:
            c = F.col(name)
            out.append(F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def union_train_test(train: DataFrame, test: DataFrame) -> DataFrame:
    """One frame with a ``split`` tag; a missing Y on the test side becomes NULL."""
    return train.withColumn("split", F.lit("train")).unionByName(
        test.withColumn("split", F.lit("test")), allowMissingColumns=True
    )


def split_side(df: DataFrame, side: str) -> DataFrame:
    """The ``train`` or ``test`` part of a union (replaces positional slicing)."""
    return df.filter(F.col("split") == F.lit(side))


# --- adapter: driver-generated tables -> telemetry -------------------------------

# Fixed values of the test adapter (event type -> call state).
CALLSTATE_OF_EVENT = {"view": 0, "click": 1, "signup": 2, "purchase": 3, "error": 4}


def _callstate(event_type: Column) -> Column:
    out = None
    for name, code in CALLSTATE_OF_EVENT.items():
        out = (F.when(event_type == name, F.lit(code)) if out is None
               else out.when(event_type == name, F.lit(code)))
    return out.cast("int")


def events_as_telemetry(events: DataFrame, test_modulus: int = 5) -> DataFrame:
    """Deterministic telemetry view over the ``events`` table (FIXTURES.md).

    Drivers with ``user_id % test_modulus == 0`` form the test side and lose
    their label.  Output: the canonical columns plus ``seq`` and ``split``.
    """
    e = events
    eid, uid = F.col("event_id"), F.col("user_id")
    is_test = (uid % F.lit(test_modulus)) == F.lit(0)
    label = F.greatest(F.lit(0).cast("bigint"), (uid * F.lit(37)) % F.lit(11) - F.lit(6)) * F.lit(0.5)
    return e.select(
        uid.alias("terminalno"),
        epoch_seconds_of_ntz("ts").alias("time"),
        (F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) + F.lit(1)).cast("bigint").alias("trip_id"),
        (F.lit(113.5) + ((eid * F.lit(7919)) % F.lit(10000)) / F.lit(10000.0)).alias("longitude"),
        (F.lit(22.3) + ((eid * F.lit(104729)) % F.lit(10000)) / F.lit(20000.0)).alias("latitude"),
        (F.get_json_object("props", "$.k").cast("int") * F.lit(3.6)).alias("direction"),
        (((eid * F.lit(37)) % F.lit(1000)) / F.lit(10.0)).alias("height"),
        F.col("value").alias("speed"),
        _callstate(F.col("event_type")).alias("callstate"),
        F.when(is_test, F.lit(None).cast("double")).otherwise(label.cast("double")).alias("y"),
        eid.alias("seq"),
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def telemetry_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned telemetry union (both sides) derived from ``sf_dir/events``."""
    return clean_telemetry(events_as_telemetry(load_table(spark, sf_dir, "events")))


def lineitem_as_telemetry(orders: DataFrame, lineitem: DataFrame, test_modulus: int = 5) -> DataFrame:
    """Second, larger test adapter: order lines as telemetry rows (customer -> order -> line).

    driver = o_custkey, trip = l_orderkey (joined on the order key), time = ship
    date plus a part-derived second of the day, speed = quantity, direction =
    discount * 3600, height = tax * 1000, call state = line number mod 5.
    """
    o = orders.select(F.col("o_orderkey"), F.col("o_custkey"))
    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
                         "l_tax", "l_shipdate")
    j = li.join(o, li["l_orderkey"] == o["o_orderkey"], "inner")
    cust = F.col("o_custkey")
    is_test = (cust % F.lit(test_modulus)) == F.lit(0)
    label = F.greatest(F.lit(0).cast("bigint"), (cust * F.lit(37)) % F.lit(11) - F.lit(6)) * F.lit(0.5)
    ship = F.col("l_shipdate").cast("timestamp_ntz")
    return j.select(
        cust.alias("terminalno"),
        (epoch_seconds_of_ntz(ship) + (F.col("l_partkey") * F.lit(37)) % F.lit(86400)).alias("time"),
        F.col("l_orderkey").alias("trip_id"),
        (F.lit(113.5) + (F.col("l_partkey") % F.lit(10000)) / F.lit(10000.0)).alias("longitude"),
        (F.lit(22.3) + (F.col("l_suppkey") % F.lit(100)) / F.lit(200.0)).alias("latitude"),
        (F.col("l_discount") * F.lit(3600.0)).alias("direction"),
        (F.col("l_tax") * F.lit(1000.0)).alias("height"),
        F.col("l_quantity").alias("speed"),
        (F.col("l_linenumber") % F.lit(5)).cast("int").alias("callstate"),
        F.when(is_test, F.lit(None).cast("double")).otherwise(label.cast("double")).alias("y"),
        (F.col("l_orderkey") * F.lit(8) + F.col("l_linenumber")).alias("seq"),
        F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split"),
    )


#: Order lines of a partition: what a task joins and sorts does not grow with the table.
PARTITION_LINES = 1 << 19


def order_telemetry_from_dir(spark: SparkSession, sf_dir: str, partition_lines: int = PARTITION_LINES) -> DataFrame:
    """The cleaned order-line telemetry derived from ``sf_dir/orders`` and ``sf_dir/lineitem``.

    Both tables are dealt by the order key into partitions of some ``partition_lines`` lines
    (the session's number of them if that is more); an order is a trip, so the features'
    steps by trip stay in them.
    """
    orders, lineitem = load_table(spark, sf_dir, "orders"), load_table(spark, sf_dir, "lineitem")
    # counted from the files' footers
    parts = -(-lineitem.count() // partition_lines)
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        orders, lineitem = orders.repartition(parts, "o_orderkey"), lineitem.repartition(parts, "l_orderkey")
    return clean_telemetry(lineitem_as_telemetry(orders, lineitem))
