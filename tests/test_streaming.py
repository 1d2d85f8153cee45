import pytest

from tripwise.operators import features as fx
from tripwise.sources.telemetry import read_telemetry
from tripwise.streaming.ingest import STREAMED, driver_totals, telemetry_stream

HEADER = "TERMINALNO,TIME,TRIP_ID,LONGITUDE,LATITUDE,DIRECTION,HEIGHT,SPEED,CALLSTATE,Y\n"


def test_stream_totals_equal_batch(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    lines = []
    for i in range(60):
        lines.append(f"{i % 4},{1476923580 + 37 * i},{i % 3},{113.5 + i / 100},{22.4 + i / 200},{i * 5 % 360},"
                     f"{i % 17}.5,{(i * 7) % 50}.25,{i % 5},{(i % 4) / 2}\n")
    for part in range(3):
        (src / f"part{part}.csv").write_text(HEADER + "".join(lines[part * 20:(part + 1) * 20]))
    q = (driver_totals(telemetry_stream(spark, str(src), max_files_per_trigger=1))
         .writeStream.outputMode("complete").format("memory").queryName("driver_totals")
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    streamed = {r["terminalno"]: r for r in spark.sql("SELECT * FROM driver_totals").collect()}
    batch_in = read_telemetry(spark, str(src))
    batch = {r["terminalno"]: r for r in fx.driver_statistics(batch_in, STREAMED).collect()}
    assert streamed.keys() == batch.keys()
    for k in batch:
        for c in STREAMED:
            assert streamed[k][c] == pytest.approx(batch[k][c], rel=1e-12), (k, c)


def test_snapshot_sink_resumes(spark, tmp_path):
    from tripwise.streaming.ingest import read_snapshot, write_driver_totals

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text(HEADER + "1,1476923580,1,113.9,22.5,90,10.5,30.0,0,0.5\n")
    out, ck = str(tmp_path / "snap"), str(tmp_path / "ck")
    q = write_driver_totals(driver_totals(telemetry_stream(spark, str(src))), out, ck)
    q.awaitTermination(120)
    assert read_snapshot(spark, out).collect()[0]["num_of_records"] == 1
    (src / "b.csv").write_text(HEADER + "1,1476923590,1,113.9,22.5,90,10.5,50.0,1,0.5\n"
                                        "2,1476923590,4,113.9,22.5,90,10.5,10.0,1,0.0\n")
    q = write_driver_totals(driver_totals(telemetry_stream(spark, str(src))), out, ck)
    q.awaitTermination(120)
    rows = {r["terminalno"]: r for r in read_snapshot(spark, out).collect()}
    assert rows[1]["num_of_records"] == 2 and rows[1]["speed_mean"] == 40.0
    assert rows[2]["num_of_records"] == 1
