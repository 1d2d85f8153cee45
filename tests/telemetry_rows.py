"""Telemetry frames out of hand-made rows."""

from tripwise.sources.telemetry import TRAIN_SCHEMA, clean_telemetry

ROW_FIELDS = [f.name for f in TRAIN_SCHEMA.fields] + ["seq"]
ROW_DDL = ("terminalno bigint, time bigint, trip_id bigint, longitude double, latitude double, direction double, "
           "height double, speed double, callstate int, y double, seq bigint")


def telemetry(spark, rows):
    """Rows as dicts (missing keys: defaults) -> cleaned telemetry frame."""
    defaults = dict(terminalno=1, time=0, trip_id=1, longitude=113.9, latitude=22.5, direction=0.0, height=0.0,
                    speed=0.0, callstate=0, y=0.0)
    out = []
    for i, r in enumerate(rows):
        d = {**defaults, **r}
        d.setdefault("seq", i)
        out.append(tuple(d[c] for c in ROW_FIELDS))
    return clean_telemetry(spark.createDataFrame(out, ROW_DDL))
