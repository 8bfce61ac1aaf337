"""End to end: topics → persistence streams → raw tables → mart refresh."""

from meterflow import schemas
from meterflow.plans import jobs
from meterflow.sinks import topics as topic_sink
from meterflow.sinks.keyed import read_keyed
from meterflow.sources import cdc as cdc_src, topics
from meterflow.sources.fixtures import load

SF = "/root/testdata/sf0.001"


def test_persistence_then_marts(spark, tmp_dir):
    tp = f"{tmp_dir}/topics"
    msgs = (topic_sink.to_messages(load(spark, SF, "cdr_data_wire"), topics.CDR_DATA_TOPIC, "msisdn")
            .unionByName(topic_sink.to_messages(load(spark, SF, "cdr_voice_wire"), topics.CDR_VOICE_TOPIC, "msisdn"))
            .unionByName(topic_sink.to_messages(load(spark, SF, "tick_wire"), topics.TICK_TOPIC, None)))
    for table, name in (("accounts", "account_changes"), ("addresses", "address_changes"),
                        ("devices", "device_changes")):
        msgs = msgs.unionByName(cdc_src.to_change_events(load(spark, SF, name), schemas.CDC_ROWS[table],
                                                         schemas.CDC_KEYS[table], table))
    topic_sink.write_messages(msgs, "json", tp)
    raw, work = f"{tmp_dir}/raw", f"{tmp_dir}/work"
    for q in jobs.start_persistence(spark, raw, work, "json", tp, available_now=True):
        assert q.awaitTermination(300)
        assert q.exception() is None
    for table, row in schemas.CDC_ROWS.items():
        assert read_keyed(spark, f"{raw}/{table}", schemas.CDC_KEYS[table], row).count() > 0
    assert spark.read.parquet(f"{raw}/cdr_data").count() == load(spark, SF, "cdr_data_wire").count() - \
        spark.read.parquet(f"{raw}/_quarantine/cdr_data").count()
    out = f"{tmp_dir}/marts"
    jobs.refresh_marts(spark, raw, out)
    for name in jobs.MARTS:
        assert spark.read.parquet(f"{out}/{name}").count() > 0
    # The same refresh through the command line (reuses the active session).
    from meterflow.__main__ import main
    main(["marts", "--raw", raw, "--out", f"{tmp_dir}/marts_cli"])
    assert spark.read.parquet(f"{tmp_dir}/marts_cli/crm_flattened").count() == \
        spark.read.parquet(f"{out}/crm_flattened").count()
