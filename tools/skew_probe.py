"""Hot-key probe: one subscriber holds a third of all events.

Builds a skewed copy of the usage feeds from the test tables (every event
with event_id % 3 = 0 is reassigned to one subscriber), runs the session and
usage jobs through the noop sink, and reads Spark's event log (written to a
scratch folder) to report, per stage, the total records read from shuffle and
the largest single task's share. With ``--copies`` that third is moreover one and the same record repeated, with ``--nobody`` it has no subscriber.
Usage: python tools/skew_probe.py [sf_dir] [--copies] [--nobody]
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


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="meterflow-eventlog-")
    from meterflow.session import build_session
    spark = build_session("skew-probe", master="local[8]", shuffle_partitions=32,
                          extra={"spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": logdir, "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    # The probe data is small: without this AQE merges everything into one or
    # two tasks and the key distribution is invisible.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    from meterflow.operators import sessions, usage
    from meterflow.sources.fixtures import load

    hot = None if "--nobody" in sys.argv else "27999999999"

    copies = "--copies" in sys.argv

    def skew(df):
        # event_id is gone after the adapter; use a stable hash of the row instead.
        df = df.withColumn("_h", F.pmod(F.xxhash64(*df.columns), F.lit(3)))
        h = F.col("_h")
        df = df.withColumn("msisdn", F.when(h == 0, F.lit(hot).cast("string")).otherwise(F.col("msisdn")))
        if copies:
            # A third of all rows become copies of one and the same record.
            ts = "event_datetime" if "event_datetime" in df.columns else "start_time"
            df = df.withColumn("tower_id", F.when(h == 0, F.lit(1)).otherwise(F.col("tower_id"))) \
                   .withColumn(ts, F.when(h == 0, F.lit("2024-01-02 03:04:05").cast("timestamp_ntz"))
                               .otherwise(F.col(ts)))
        return df.drop("_h")

    d, v = skew(load(spark, sf, "cdr_data")), skew(load(spark, sf, "cdr_voice"))
    total = d.count() + v.count()
    hot_rows = sum(x.where(F.col("msisdn").eqNullSafe(F.lit(hot).cast("string"))).count() for x in (d, v))
    jobs = {"tower_sessions": lambda: sessions.tower_sessions(d, v),
            "usage_rollup": lambda: usage.usage_rollup(d, v),
            "daily_costs": lambda: usage.daily_costs(usage.daily_type_usage(d, v)),
            # Contrast only: lag over a plain per-subscriber window.
            "naive_lag": lambda: sessions.interactions(d, v).select(
                "*", F.lag("tower_id").over(Window.partitionBy("msisdn").orderBy("event_datetime")).alias("p"))}
    marks = {}
    for name, fn in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
        marks[name] = True
    spark.stop()

    stage_job, job_group = {}, {}
    tasks = defaultdict(list)
    for path in [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]:
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_job[sid] = g
                elif ev == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    recs = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                    tasks[e["Stage ID"]].append(recs)
    print(f"events: {total}, hot subscriber: {hot_rows} ({hot_rows / total:.0%})")
    print(f"{'job':16s} {'stage':>5s} {'tasks':>5s} {'shuffle recs':>12s} {'max task':>9s} {'max share':>9s}")
    for sid in sorted(tasks):
        g = stage_job.get(sid)
        recs = tasks[sid]
        s = sum(recs)
        if g in jobs and s > 0:
            print(f"{g:16s} {sid:5d} {len(recs):5d} {s:12d} {max(recs):9d} {max(recs) / s:9.1%}")


if __name__ == "__main__":
    main()
