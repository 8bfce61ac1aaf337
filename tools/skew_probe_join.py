"""Hot right-side key in the CRM fan-out join: a third of all accounts share one
phone number. Compares a plain LEFT JOIN with ``operators.joins.left_join``
under sort-merge joins (as at cluster scale), with AQE's skew thresholds
scaled down to the probe's size, and reports per-task output records of the
join stage from the event log. Usage: python tools/skew_probe_join.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="meterflow-eventlog-")
    from meterflow.session import build_session
    spark = build_session("skew-probe-join", master="local[8]", shuffle_partitions=32, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true", "spark.eventLog.dir": logdir,
        "spark.eventLog.compress": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"})
    spark.sparkContext.setLogLevel("ERROR")
    from meterflow.operators import crm
    from meterflow.operators.joins import left_join
    from meterflow.sources.fixtures import load

    hot = "2700000001"
    acc = load(spark, sf, "accounts")
    acc = acc.withColumn("phone_number", F.when(F.col("account_id") % 3 == 0, F.lit(hot)).otherwise(F.col("phone_number")))
    info = crm.account_info(acc, load(spark, sf, "addresses"), load(spark, sf, "devices"))
    bal = crm.running_balance(crm.hourly_costs(load(spark, sf, "cdr_data"), load(spark, sf, "cdr_voice")))
    b = bal.select("msisdn", "hour", *crm.COST_COLUMNS)
    jobs = {"plain_left_join": lambda: b.join(info, b.msisdn == info.phone_number, "left"),
            "skew_safe_left_join": lambda: left_join(b, info, ["msisdn"], ["phone_number"])}
    counts = {}
    for name, fn in jobs.items():
        spark.sparkContext.setJobGroup(name, name)
        df = fn()
        qe = df._jdf.queryExecution()
        counts[name] = qe.toRdd().count()
        if "--plan" in sys.argv:
            print(name, spark.conf.get("spark.sql.shuffle.partitions"))
            print("\n".join(l[:160] for l in qe.executedPlan().toString().split("== Initial Plan ==")[0].splitlines()
                            if "Join" in l or "Exchange" in l or "ShuffleRead" in l or "skew" in l.lower()))
    spark.stop()

    stage_job, per_task = {}, defaultdict(list)
    files = [p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)]
    for path in files:
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e.get("Stage IDs", []):
                        stage_job.setdefault(sid, g)
                elif e.get("Event") == "SparkListenerTaskEnd":
                    m = e.get("Task Metrics") or {}
                    per_task[e["Stage ID"]].append(((m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0),
                                                    (m.get("Output Metrics") or {}).get("Records Written", 0)))
    print(f"join output rows: {counts}")
    print(f"{'join':20s} {'stage':>5s} {'tasks':>5s} {'records read':>12s} {'max task':>9s} {'max share':>9s}")
    for sid in sorted(per_task):
        g = stage_job.get(sid)
        recs = [r for r, _ in per_task[sid]]
        s = sum(recs)
        if g in jobs and s > 0:
            print(f"{g:20s} {sid:5d} {len(recs):5d} {s:12d} {max(recs):9d} {max(recs) / s:9.1%}")


if __name__ == "__main__":
    main()
