"""Write PLANS.md: the physical plans of the headline queries as they ran.

    python scripts/show_plans.py [--sf-dir DIR] [--out PLANS.md]

Each query runs whole, into the no-op sink, with an event log in a scratch folder; the
final adaptive plan of every SQL execution of the run is written, those behind
checkpoints included.  Broadcast joins are off, which is the shape the plans take when
the driver tables are too large to broadcast.
"""

from __future__ import annotations

import argparse
import glob
import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from tripwise.operators import features as fx  # noqa: E402
from tripwise.plans import catalog  # noqa: E402
from tripwise.session import checkpoint_dir  # noqa: E402
from tripwise.sources.telemetry import telemetry_from_dir  # noqa: E402

HEADLINE = ["driver_features_61", "order_features_61", "speed_features", "baseline_features", "speed_diff_rows",
            "feature_f_scores", "feature_corr", "knn_pairs", "contiguous_folds", "drivers_in_order"]
OPS = ("Exchange", "BroadcastExchange", "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin",
       "CartesianProduct", "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window", "WindowGroupLimit",
       "Sort", "ArrowEvalPython", "MapInArrow", "Generate", "TakeOrderedAndProject")


def tree(description: str) -> str:
    """The plan tree of a formatted description, final adaptive plan only."""
    text = description.replace("== Physical Plan ==", "").split("\n\n(1)")[0]
    return text.split("+- == Initial Plan ==")[0].strip()


def summary(plan: str) -> str:
    counts = {op: len(re.findall(rf"(?<![A-Za-z]){op}(?![A-Za-z])", plan)) for op in OPS}
    return ", ".join(f"{op} {n}" for op, n in counts.items() if n) or "no exchange, join or aggregate"


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    args = ap.parse_args()
    events = tempfile.mkdtemp(prefix="tripwise-plans-")
    spark = (SparkSession.builder.master("local[4]").appName("tripwise-plans")
             .config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{events}")
             .config("spark.eventLog.compress", "false").config("spark.eventLog.rolling.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    frames = {name: (lambda n=name: catalog.QUERIES[n](spark, args.sf_dir)) for name in HEADLINE}
    frames["driver_features_61_unfused"] = lambda: fx.unfused_feature_blocks(telemetry_from_dir(spark, args.sf_dir))
    spans = {}
    for name, make in frames.items():
        began = time.time() * 1000
        make().write.format("noop").mode("overwrite").save()
        spans[name] = (began, time.time() * 1000)
    spark.stop()
    plans: dict[int, str] = {}
    started: dict[int, float] = {}
    for line in (x for p in glob.glob(f"{events}/*") for x in open(p, errors="replace")):
        e = json.loads(line)
        if "physicalPlanDescription" in e:  # the last one of an execution is the one that ran
            plans[e["executionId"]] = tree(e["physicalPlanDescription"])
            started.setdefault(e["executionId"], e.get("time", 0))
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `scripts/show_plans.py` at `{args.sf_dir}` on local[4], broadcast joins off: the final",
           "adaptive plan of every SQL execution of a run (jobs behind checkpoints included).", ""]
    for name, (a, b) in spans.items():
        own = [plans[i] for i in sorted(plans) if a <= started[i] <= b and "Scan ExistingRDD" != plans[i]]
        out += [f"## {name}", "", f"Operators: {summary(chr(10).join(own))}", ""]
        for plan in own:
            out += ["```", plan, "```", ""]
    with open(args.out, "w") as fh:
        fh.write("\n".join(out))
    print(f"wrote {args.out}")


if __name__ == "__main__":
    main()
