"""Hot-key behaviour, measured from Spark's event log.

    python scripts/skew_report.py [sf_dir]

Builds a copy of ``lineitem`` in which a third of the rows share one key
(``l_orderkey = -1, l_linenumber = 1``), written as 16 files, then runs each
operator and reports, from the event log, the largest number of shuffle
records any single task read (the rows a hot key forces into one task), next
to the total shuffle records of the query.  AQE partition coalescing is off
here so that every shuffle partition is its own task.
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

from strata.operators import quality as Q  # noqa: E402
from strata.operators.dedup import keep_one_per_key  # noqa: E402
from strata.operators.reshape import reconcile  # noqa: E402
from strata.operators.star import orphan_summary  # noqa: E402
from strata.session import build_session  # noqa: E402

KEYS = ["l_orderkey", "l_linenumber"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="strata-skew-")
    logs = f"{scratch}/events"
    os.makedirs(logs)
    spark = build_session("local[8]", "skew-report", 16, {
        "spark.checkpoint.dir": scratch, "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false",
        # one task per shuffle partition, so the largest read shows the hottest partition
        "spark.sql.adaptive.coalescePartitions.enabled": "false"})
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = F.pmod(F.xxhash64("l_partkey", "l_suppkey", "l_quantity"), F.lit(3)) == 0
    skewed = li.withColumns({"l_orderkey": F.when(hot, F.lit(-1)).otherwise(F.col("l_orderkey")),
                             "l_linenumber": F.when(hot, F.lit(1)).otherwise(F.col("l_linenumber"))})
    path = f"{scratch}/lineitem_skewed"
    skewed.repartition(16).write.parquet(path)
    data = spark.read.parquet(path)
    n_rows = data.count()
    n_hot = data.filter(F.col("l_orderkey") == -1).count()
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")

    w = Window.partitionBy(*KEYS).orderBy(F.col("l_shipdate").desc())
    naive = (data.withColumn("__n", F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
                 .filter("__n = 1").drop("__n"))          # a non-rank window: no partial limit possible
    runs = {
        "dedup keep_one_per_key (partial WindowGroupLimit)": keep_one_per_key(data, KEYS),
        "naive window dedup (no map-side reduction)": naive,
        "duplicate_summary (partial aggregation)": Q.duplicate_summary(data, KEYS),
        "orphan_summary (tagged aggregation)": orphan_summary(data, orders, ["l_orderkey"], ["o_orderkey"]),
        "reconcile vs itself minus hot rows (tagged aggregation)": reconcile(data, data.filter("l_orderkey <> -1")),
    }
    for label, df in runs.items():
        spark.sparkContext.setJobDescription(label)
        df.write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_label, per_stage = {}, defaultdict(list)
    files = [f for f in glob.glob(f"{logs}/**/*", recursive=True)
             if os.path.isfile(f) and os.path.basename(f).startswith(("events", "local-", "app-"))]
    for f in files:
        with open(f) as fh:
            for line in fh:
                e = json.loads(line)
                if e["Event"] == "SparkListenerJobStart":
                    label = (e.get("Properties") or {}).get("spark.job.description")
                    for sid in e.get("Stage IDs", []):
                        stage_label[sid] = label
                elif e["Event"] == "SparkListenerTaskEnd":
                    m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                    per_stage[e["Stage ID"]].append(m.get("Total Records Read", 0))
    print(f"rows: {n_rows:,}, rows on the hot key: {n_hot:,} ({n_hot / n_rows:.0%}), 16 input files\n")
    print("| operator | largest shuffle read by one task (records) | total shuffle records read |")
    print("|---|---|---|")
    for label in runs:
        reads = [r for sid, rs in per_stage.items() if stage_label.get(sid) == label for r in rs]
        print(f"| {label} | {max(reads, default=0):,} | {sum(reads):,} |")


if __name__ == "__main__":
    main()
