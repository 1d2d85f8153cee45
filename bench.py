"""

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Per query: one warm-up run, then BENCH_RUNS timed runs (median).  A run executes
the whole plan into the no-op sink.  Prints ONE JSON line.  Rows read, shuffle bytes
and exchanges are those of the whole last run (checkpoints and planning jobs
included), from Spark's event log in a scratch folder.
"""

from __future__ import annotations

import glob
import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402


def _session(cpus: str, events: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tripwise-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(4, int(cpus) * 2)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", f"file://{events}")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _exchanges(node: dict) -> int:
    return (node["nodeName"] == "Exchange") + sum(map(_exchanges, node["children"]))


def logged(events: str, spans: dict[str, tuple[float, float]]) -> dict[str, dict[str, int]]:
    """Rows read, shuffle bytes and exchanges of each query's span, from the event log."""
    out = {k: {"rows_read": 0, "shuffle_bytes": 0, "exchanges": 0} for k in spans}
    plans: dict[int, tuple[str, int]] = {}

    def at(ms: float) -> str | None:
        return next((k for k, (a, b) in spans.items() if a <= ms / 1000 <= b), None)

    for line in (x for p in glob.glob(f"{events}/*") for x in open(p, errors="replace")):
        if not line.startswith("{"):
            continue
        e = json.loads(line)
        kind = e["Event"].rpartition(".")[2]
        if kind == "SparkListenerTaskEnd" and e.get("Task Metrics") and (k := at(e["Task Info"]["Launch Time"])):
            m = e["Task Metrics"]
            out[k]["rows_read"] += m["Input Metrics"]["Records Read"]
            out[k]["shuffle_bytes"] += m["Shuffle Write Metrics"]["Shuffle Bytes Written"]
        elif "sparkPlanInfo" in e:  # the last plan of an execution is the one that ran
            known = plans.get(e["executionId"])
            k = known[0] if known else at(e.get("time", 0))
            if k:
                plans[e["executionId"]] = (k, _exchanges(e["sparkPlanInfo"]))
    for k, n in plans.values():
        out[k]["exchanges"] += n
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "4")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    events = tempfile.mkdtemp(prefix="tripwise-bench-events-")
    spark = _session(cpus, events)

    from tripwise.operators import features as fx
    from tripwise.operators import models as md
    from tripwise.plans import catalog
    from tripwise.plans.submissions import feature_tables
    from tripwise.session import checkpoint_dir
    from tripwise.sources.telemetry import telemetry_from_dir

    checkpoint_dir(spark)

    def fused(s, d):
        return fx.driver_features(telemetry_from_dir(s, d), "61")

    def unfused(s, d):
        return fx.unfused_feature_blocks(telemetry_from_dir(s, d))

    def gbt50(s, d):
        # as the jobs do: features materialised once, then fit and score
        ft = feature_tables(telemetry_from_dir(s, d), "61")
        model = md.fit_gbt(ft.train, fx.FEATURES_61, "y", md.XGB_BAG.with_rounds(50))
        return md.predict(model, ft.test)

    q = catalog.QUERIES
    bench = {
        "driver_features_61": fused,
        "driver_features_61_unfused": unfused,
        "order_features_61": q["order_features_61"],
        "feature_f_scores": q["feature_f_scores"],
        "knn30_predictions": q["knn30_predictions"],
        "knn_pairs": q["knn_pairs"],
        "speed_diff_rows": q["speed_diff_rows"],
        "baseline_features": q["baseline_features"],
        "gbt_fit_50_rounds": gbt50,
    }
    timings, spans = {}, {}
    for name, fn in bench.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            began, t0 = time.time(), time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
            spans[name] = (began, time.time())
        timings[name] = round(statistics.median(samples), 3)
    spark.stop()
    work = logged(events, spans)
    headline = [k for k in timings if k != "driver_features_61_unfused"]
    sf = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings[k] for k in headline), 3),
        "unit": "sec",
        "queries": timings,
        "work": work,
        "sf": float(sf.group(1)) if sf else None,
        "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
