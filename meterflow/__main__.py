"""Command line: ``python -m meterflow marts|persist|usage|serving ...`` (spark-submit friendly)."""

from __future__ import annotations

import argparse


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="meterflow")
    sub = p.add_subparsers(dest="cmd", required=True)
    m = sub.add_parser("marts", help="full refresh of the marts from raw tables")
    m.add_argument("--raw", required=True)
    m.add_argument("--out", help="parquet root; default: catalog database prepared_layers")
    s = sub.add_parser("persist", help="topics and change feeds -> raw tables (runs until stopped)")
    s.add_argument("--raw", required=True)
    s.add_argument("--work", required=True)
    u = sub.add_parser("usage", help="topics, or CSV drops by way of topics -> daily usage serving table (runs until stopped)")
    u.add_argument("--drops")
    u.add_argument("--serving", required=True)
    u.add_argument("--work", required=True)
    u.add_argument("--summary")
    w = sub.add_parser("serving", help="summary topic -> serving table (runs until stopped)")
    w.add_argument("--serving", required=True)
    w.add_argument("--work", required=True)
    w.add_argument("--summary", help="folder of the summary topic, with --format json")
    for x, fmt in ((s, "kafka"), (u, "json"), (w, "json")):
        x.add_argument("--format", default=fmt, choices=["kafka", "json"])
        x.add_argument("--bootstrap")
        x.add_argument("--topics-path")
    a = p.parse_args(argv)
    if a.cmd == "usage" and not (a.drops or a.topics_path or a.format == "kafka"):
        p.error("usage needs --drops, --topics-path or --format kafka")

    from .plans import jobs
    from .session import build_session
    spark = build_session("meterflow-" + a.cmd)
    if a.cmd == "marts":
        jobs.refresh_marts(spark, a.raw, a.out)
    elif a.cmd == "persist":
        jobs.start_persistence(spark, a.raw, a.work, a.format, a.topics_path, a.bootstrap)
        spark.streams.awaitAnyTermination()     # any stream failing stops the service
    elif a.cmd == "serving":
        jobs.start_serving_writer(spark, a.serving, a.work, a.format, a.summary, a.bootstrap)
        spark.streams.awaitAnyTermination()
    else:
        jobs.start_usage_service(spark, a.drops, a.serving, a.work, summary_path=a.summary, fmt=a.format,
                                 topics_path=a.topics_path, bootstrap=a.bootstrap)
        spark.streams.awaitAnyTermination()     # usage or quarantine failing stops the service


if __name__ == "__main__":
    main()
