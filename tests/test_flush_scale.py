"""The flush with many days of a subscriber, with micro-batches and looks longer than the bounded time, and with days that have expired."""
import json
from datetime import datetime

import pytest
from pyspark.sql import Row, functions as F

from meterflow.operators import serving, usage
from meterflow.plans import catalog
from meterflow.sources.fixtures import load
from meterflow.streaming import flush
from meterflow.streaming.flush import DAY_MS, IdleFlush, day_end_ms

IN = Row("msisdn", "date", "category", "usage_type", "first", "second")


class Value:
    def __init__(self, handle, ttl):
        self.handle, self.ttl, self.value, self.expires = handle, ttl, None, None

    def get(self):
        self.handle.calls += 1
        return None if self.ttl and self.expires is not None and self.expires <= self.handle.now else self.value

    def update(self, value):
        self.handle.calls += 1
        self.value, self.expires = value, self.handle.now + (self.ttl or 0)

    def clear(self):
        self.handle.calls += 1
        self.value = None


class Handle:
    """One subscriber's state: every call is counted, and ``at`` runs the micro-batch of a time as Spark does."""

    def __init__(self, processor):
        self.processor, self.calls, self.timers, self.now, self.watermark = processor, 0, set(), 0, 0
        processor.init(self)

    def getValueState(self, name, schema, ttlDurationMs=None):
        return Value(self, ttlDurationMs)

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getCurrentWatermarkInMs(self):
        return self.watermark

    def at(self, now, watermark=0, *rows):
        self.now, self.watermark = now, watermark
        out = list(self.processor.handleInputRows(("271",), iter([IN("271", *r) for r in rows]), self)) if rows else []
        for t in sorted(t for t in self.timers if t <= now):
            out += self.processor.handleExpiredTimer(("271",), self, None)
            self.timers.discard(t)
        return sorted((r.kind, r.date, sum(v["up"] for v in json.loads(r.value)["data_usage"].values())) for r in out)


def test_state_calls_do_not_grow_with_the_days_of_a_subscriber():
    dates = [f"2024-01-{d:02d}" for d in range(1, 31)]
    h = Handle(IdleFlush(1000, 5000, DAY_MS))
    assert h.at(10_000, 0, *[(d, "data", "text", i, 0) for i, d in enumerate(dates)]) == []
    assert h.calls <= 4 and h.timers == {11_000}
    h.calls = 0
    assert h.at(11_000, day_end_ms(dates[-2])) == [("summary", d, i) for i, d in enumerate(dates)]
    assert h.calls <= 5 and json.loads(h.processor.open.value[0])[0][0] == dates[-1] and h.timers == {16_000}
    h.calls = 0
    # Closed days are opened again with the totals they had; the open one adds to its own.
    assert h.at(12_000, day_end_ms(dates[-2]), *[(d, "data", "text", 100, 0) for d in dates]) == []
    assert h.calls <= 5 and h.timers == {13_000, 16_000}
    assert h.at(13_000, day_end_ms(dates[-2])) == [("summary", d, 100 + i) for i, d in enumerate(dates)]
    # The earlier timer finds that nothing is due; the last day is looked at when it is due, and closed.
    assert h.at(16_000, day_end_ms(dates[-1])) == [] and h.timers == {18_000}
    assert h.at(18_000, day_end_ms(dates[-1])) == [] and h.timers == set() and h.processor.open.value is None
    assert len(json.loads(h.processor.closed.value[0])) == 30


def test_each_closed_day_expires_by_itself():
    h = Handle(IdleFlush(1000, 1000, 10_000, at_once=True))
    ended = day_end_ms("2024-01-01") + DAY_MS
    assert h.at(0, 0, ("2024-01-01", "data", "text", 1, 0)) == [("summary", "2024-01-01", 1)]
    assert h.at(1000, ended) == []                                      # closed until 11,000
    assert h.at(5000, ended, ("2024-01-01", "voice", "voice", 2, 1), ("2024-01-02", "data", "text", 2, 0)) == [
        ("summary", "2024-01-01", 1), ("summary", "2024-01-02", 2)]
    assert h.at(6000, ended, ("2024-01-01", "data", "text", 4, 0)) == [("summary", "2024-01-01", 5)]
    assert h.at(7000, ended) == [] and h.processor.open.value is None    # closed until 17,000
    assert h.at(16_999, ended, ("2024-01-01", "data", "text", 8, 0)) == [("summary", "2024-01-01", 13)]
    assert h.at(18_000, ended) == []                                    # closed until 28,000
    assert h.at(28_000, ended, ("2024-01-01", "data", "text", 16, 0)) == [("late", "2024-01-01", 16)]


class Running:
    """A stream whose micro-batch 0 runs for ``ticks`` looks at it."""
    id, exception = "q", staticmethod(lambda: None)

    def __init__(self, ticks, idle=False, ends=False):
        self.ticks, self.looks, self.idle, self.ends = ticks, 0, idle, ends

    @property
    def status(self):
        return {"isTriggerActive": not self.idle}

    @property
    def lastProgress(self):
        return {"batchId": self.looks} if self.ends else None

    def far(self):
        self.looks += 1
        return 100 if self.looks > self.ticks else 0


def test_wait_outlasts_a_long_micro_batch_but_no_stream_that_stands_still(monkeypatch):
    clock = [0.0]
    monkeypatch.setattr(catalog.time, "time", lambda: clock[0])
    monkeypatch.setattr(catalog.time, "sleep", lambda s: clock.__setitem__(0, clock[0] + s))
    q = Running(4 * catalog.FLUSH_TIMEOUT_S)
    catalog._until(q, q.far, lambda got: got >= 100)
    assert clock[0] >= 4 * catalog.FLUSH_TIMEOUT_S
    for q in (Running(10 ** 9, idle=True), Running(10 ** 9, ends=True)):
        with pytest.raises(TimeoutError):
            catalog._until(q, q.far, lambda got: got >= 100)


class Busy:
    """A stream that ends a micro-batch every 100 s and publishes all at 250 s; a look shows what was there when it
    began, and the second one waits 400 s for the stream's tasks."""
    id, exception, status = "q", staticmethod(lambda: None), {"isTriggerActive": True}

    def __init__(self, clock):
        self.clock, self.looks = clock, 0

    @property
    def lastProgress(self):
        return {"batchId": int(self.clock[0] // 100)}

    def far(self):
        self.looks += 1
        got = 100 if self.clock[0] >= 250 else 0
        self.clock[0] += 400 if self.looks == 2 else 1
        return got


def test_a_look_that_waits_for_the_stream_is_no_proof_that_it_stands_still(monkeypatch):
    clock = [0.0]
    monkeypatch.setattr(catalog.time, "time", lambda: clock[0])
    monkeypatch.setattr(catalog.time, "sleep", lambda s: clock.__setitem__(0, clock[0] + s))
    q = Busy(clock)
    catalog._until(q, q.far, lambda got: got >= 100)
    assert q.looks == 3


def test_usage_of_expired_days_is_in_the_result_of_the_idle_flush(spark, tmp_dir, monkeypatch):
    # A day a subscriber, all of them ended long before the newest; some come in the last part, after the watermark.
    monkeypatch.setattr(catalog, "FLUSH_TIMEOUT_S", 60)
    rows = [(i, datetime(2024, 1, 1, 0, i), i, "view" if i % 2 else "purchase", 1.0, "") for i in range(40)]
    rows += [(i, datetime(2024, 4, 1), i, "view" if i % 2 else "purchase", 1.0, "") for i in (40, 41)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
                          ).write.parquet(f"{tmp_dir}/sf/events.parquet")
    cut, late = [], flush.late_usage
    monkeypatch.setattr(flush, "late_usage", lambda *a: cut.append(late(*a).count()) or late(*a))
    got = catalog.JOBS["stream_idle_flush"](spark, f"{tmp_dir}/sf").collect()
    assert cut[-1] > 0
    d, v = (load(spark, f"{tmp_dir}/sf", n) for n in ("cdr_data", "cdr_voice"))
    want = serving.daily_summary(usage.daily_type_usage(d, v)).select("msisdn", "date", F.size("data_usage"), F.size("voice_usage"), "costs.*").collect()
    assert len(got) == 42 and sorted(map(tuple, got)) == sorted(map(tuple, want))
