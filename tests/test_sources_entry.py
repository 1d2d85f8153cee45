import glob
import os

from pyspark.sql import functions as F

import __spark_entry__ as entry
from tripwise.sources import sinks
from tripwise.sources.telemetry import read_telemetry, split_side, union_train_test


def test_csv_scan_with_header_and_schema(spark, tmp_path):
    train = tmp_path / "train.csv"
    train.write_text("TERMINALNO,TIME,TRIP_ID,LONGITUDE,LATITUDE,DIRECTION,HEIGHT,SPEED,CALLSTATE,Y\n"
                     "1,1476923580,1,113.9,22.5,90,10.5,30.2,0,0.5\n"
                     "1,1476923590,1,113.9,22.5,-1,10.5,NaN,1,0.5\n")
    test = tmp_path / "test.csv"
    test.write_text("TERMINALNO,TIME,TRIP_ID,LONGITUDE,LATITUDE,DIRECTION,HEIGHT,SPEED,CALLSTATE\n"
                    "7,1476923580,3,113.9,22.5,90,10.5,12.0,2\n")
    tr = read_telemetry(spark, str(train))
    te = read_telemetry(spark, str(test), labelled=False)
    assert tr.columns == te.columns
    u = union_train_test(tr, te)
    assert u.count() == 3
    assert split_side(u, "test").collect()[0]["y"] is None
    assert tr.filter(F.col("direction") < 0).count() == 1


def test_submission_single_file(spark, tmp_path):
    preds = spark.createDataFrame([(1, 0.5), (2, 0.25), (2, 0.25)], "terminalno bigint, pred double")
    out = str(tmp_path / "sub")
    sinks.write_submission(preds, out)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(parts) == 1
    lines = open(parts[0]).read().strip().splitlines()
    assert lines[0] == "Id,Pred" and len(lines) == 3


def test_entry_contract(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "speed_max" in df.columns
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60


def test_jobs_write_one_file_per_submission(spark, tmp_path):
    from tripwise.plans import submissions as jobs
    from tripwise.sources.telemetry import telemetry_from_dir

    t = telemetry_from_dir(spark, "/root/testdata/sf0.001")
    n_test = t.filter(F.col("split") == "test").select("terminalno").distinct().count()
    jobs.knn_submission(t, k=5, out=str(tmp_path / "knn"))
    jobs.ridge_submission(t, 70, out=str(tmp_path / "ridge"))
    for name in ("knn", "ridge"):
        lines = (tmp_path / name).read_text().strip().splitlines()
        assert lines[0] == "Id,Pred" and len(lines) == n_test + 1


def test_parquet_scan(spark, tmp_path):
    rows = [(1, 1476923580, 1, 113.9, 22.5, 90.0, 10.5, float("nan"), 0, 0.5)]
    df = spark.createDataFrame(rows, "terminalno bigint, time bigint, trip_id bigint, longitude double, "
                                     "latitude double, direction double, height double, speed double, "
                                     "callstate int, y double")
    df.write.parquet(str(tmp_path / "t"))
    from tripwise.sources.telemetry import clean_telemetry

    got = clean_telemetry(read_telemetry(spark, str(tmp_path / "t"), fmt="parquet")).collect()[0]
    assert got["speed"] is None and got["seq"] is not None and got["y"] == 0.5


HEAD = "TERMINALNO,TIME,TRIP_ID,LONGITUDE,LATITUDE,DIRECTION,HEIGHT,SPEED,CALLSTATE,Y\n"


def test_seq_follows_the_files(spark, tmp_path):
    """Spark hands out the larger file first; seq still follows the paths."""
    from tripwise.sources.telemetry import read_telemetry

    (tmp_path / "a.csv").write_text(HEAD + "1,100,1,113.9,22.5,90,10.5,30.0,0,0.5\n")
    (tmp_path / "b.csv").write_text(HEAD + "".join(f"2,{200 + i},1,113.9,22.5,90,10.5,30.0,0,0.5\n" for i in range(50)))
    rows = read_telemetry(spark, str(tmp_path)).orderBy("seq").collect()
    assert [r["time"] for r in rows] == [100] + [200 + i for i in range(50)]


def test_malformed_lines_are_errors(spark, tmp_path):
    import pytest

    from tripwise.sources.telemetry import read_telemetry

    (tmp_path / "a.csv").write_text(HEAD + "1,100,1,not a number,22.5,90,10.5,30.0,0,0.5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_telemetry(spark, str(tmp_path)).collect()


def test_checkpoint_folder_must_be_named_on_a_cluster():
    import pytest

    from tripwise.session import checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_random_submission_is_the_same_whatever_the_partitions(spark):
    from tripwise.sources.sinks import random_submission

    df = spark.range(40).selectExpr("id % 20 AS terminalno")
    a, b = (sorted(map(tuple, random_submission(d, seed=3).collect())) for d in (df.repartition(7), df.coalesce(1)))
    assert a == b and len(a) == 20 and all(0 <= p < 1 for _, p in a)


def test_submission_in_several_files(spark, tmp_path):
    from tripwise.sources.sinks import write_submission

    preds = spark.range(100).selectExpr("id AS terminalno", "id * 1.0D AS pred")
    write_submission(preds, str(tmp_path / "one"))
    write_submission(preds.repartition(4), str(tmp_path / "many"), single_file=False)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    assert spark.read.option("header", True).csv(str(tmp_path / "many")).count() == 100


def test_committed_submission_replaces_the_old_file(spark, tmp_path):
    path = tmp_path / "out" / "sub.csv"
    preds = spark.createDataFrame([(1, 0.5), (2, 0.25), (2, 0.25)], "terminalno bigint, pred double")
    assert sinks.commit_submission(preds, str(path)) == 2
    assert sorted(path.read_text().split()) == ["1,0.5", "2,0.25", "Id,Pred"]
    assert sinks.commit_submission(preds.limit(1), str(path)) == 1 and len(path.read_text().split()) == 2
    assert sinks.commit_submission(preds.filter("false"), str(path)) == 0
    assert [f.name for f in path.parent.iterdir() if not f.name.endswith(".crc")] == ["sub.csv"]


def test_failed_submission_leaves_the_old_file(spark, tmp_path, monkeypatch):
    import pytest

    path = tmp_path / "sub.csv"
    preds = spark.createDataFrame([(1, 0.5)], "terminalno bigint, pred double")
    sinks.commit_submission(preds, str(path))
    old = path.read_text()

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(sinks.files, "replace", killed)  # the job dies before the rename
    with pytest.raises(KeyboardInterrupt):
        sinks.commit_submission(preds.withColumn("pred", F.lit(9.0)), str(path))
    monkeypatch.undo()
    with pytest.raises(Exception, match="(?i)divi"):  # a task fails
        sinks.commit_submission(preds.select("terminalno", F.expr("1D / (terminalno - 1)").alias("pred")), str(path))
    assert path.read_text() == old
    assert [f.name for f in tmp_path.iterdir() if not f.name.endswith(".crc")] == ["sub.csv"]


def test_bad_lines_are_set_aside(spark, tmp_path):
    import pytest

    from tripwise.sources.telemetry import TooManyRejects, read_quarantined

    src = tmp_path / "in"
    src.mkdir()
    good = "1,{},1,113.9,22.5,90,10.5,30.0,0,0.5\n"
    bad = {3: "1,1,1,n/a,22.5,90,10.5,30.0,0,0.5\n", 6: "1,2,1,113.9\n", 8: "1,3,1,113.9,22.5,90,10.5,30.0,0,0.5,7\n",
           9: "1,4,1,113.9,22.5,90,10.5,30.0,0.5,0.5\n"}
    lines = [bad.get(i, good.format(100 + i)) for i in range(2, 12)]
    (src / "a.csv").write_text(HEAD + "".join(lines))
    (src / "b.csv").write_text(HEAD + "\n" + "".join(good.format(200 + i) for i in range(40)) + "2,300,1,,,,,NaN,,\n")
    rows, rejects = read_quarantined(spark, str(src), str(tmp_path / "bad"), max_share=0.1)
    got = sorted((r["file"].rsplit("/", 1)[1], r["record"], r["line"] + "\n") for r in rejects.collect())
    assert got == [("a.csv", i, line) for i, line in bad.items()]
    kept = rows.orderBy("seq").collect()
    assert [r["time"] for r in kept] == [100 + i for i in range(2, 12) if i not in bad] + [200 + i for i in range(40)] + [300]
    assert kept[-1]["longitude"] is None and kept[-1]["y"] is None and kept[0]["speed"] == 30.0
    with pytest.raises(TooManyRejects, match="4 of 51"):
        read_quarantined(spark, str(src), str(tmp_path / "bad2"), max_share=0.05)
    assert spark.read.parquet(str(tmp_path / "bad2")).count() == 4  # they can be looked at
    # a file cut into many splits keeps its line numbers
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows, rejects = read_quarantined(spark, str(src), str(tmp_path / "bad3"), max_share=0.1)
        assert sorted((r["file"].rsplit("/", 1)[1], r["record"], r["line"] + "\n") for r in rejects.collect()) == got
        assert [r["time"] for r in rows.orderBy("seq").collect()] == [r["time"] for r in kept]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # test files have no label; an empty file has no lines
    (tmp_path / "t.csv").write_text("1,100,1,113.9,22.5,90,10.5,30.0,0\n")
    (tmp_path / "none.csv").write_text("")
    rows, rejects = read_quarantined(spark, str(tmp_path / "t.csv"), str(tmp_path / "bad4"), labelled=False, header=False)
    assert rows.count() == 1 and rows.first()["y"] is None and rejects.count() == 0
    assert [d.count() for d in read_quarantined(spark, str(tmp_path / "none.csv"), str(tmp_path / "bad5"))] == [0, 0]


def test_order_lines_are_dealt_by_their_number(spark, tmp_path):
    import datetime

    from tripwise.operators import features as fx
    from tripwise.sources.telemetry import order_telemetry_from_dir

    day = datetime.date(2024, 1, 1)
    spark.createDataFrame([(i, i % 7) for i in range(50)], "o_orderkey bigint, o_custkey bigint").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.createDataFrame(
        [(i % 50, i, i % 9, i // 50 + 1, float(i % 40), 0.01 * (i % 10), 0.01 * (i % 8), day + datetime.timedelta(i % 30))
         for i in range(200)],
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber bigint, l_quantity double, l_discount double, "
        "l_tax double, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    few = order_telemetry_from_dir(spark, str(tmp_path))
    many = order_telemetry_from_dir(spark, str(tmp_path), partition_lines=10)
    assert many.rdd.getNumPartitions() == 20  # of ten lines, though the session has 8 partitions
    assert many.count() == 200

    def rows(t):
        return [[round(v, 9) if isinstance(v, float) else v for v in r]
                for r in fx.driver_features(t, "61").orderBy("terminalno").collect()]

    assert rows(many) == rows(few) and len(rows(few)) == 7
