import random
from datetime import datetime, timedelta

from hypothesis import given, settings, strategies as st

from meterflow.operators import sessions
from helpers import cdr_data, cdr_voice, empty_voice

M = "27000000001"


def _data(spark, path):
    """path: list of (tower, time)"""
    return cdr_data(spark, [(M, t, 1, 1, "text", x) for t, x in path])


def test_tower_path_AABAA(spark):
    path = [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:05:00"), (2, "2024-01-01 10:10:00"),
            (1, "2024-01-01 10:20:00"), (1, "2024-01-01 12:30:00")]
    r = sessions.tower_sessions(_data(spark, path), empty_voice(spark)).orderBy("session_start").collect()
    assert [(x.tower_id, str(x.session_start), str(x.session_end)) for x in r] == [
        (1, "2024-01-01 10:00:00", "2024-01-01 10:05:00"), (1, "2024-01-01 10:20:00", "2024-01-01 12:30:00")]
    assert abs(r[1].duration_hours - (2 + 1 / 6)) < 1e-12


def test_equal_timestamps_ordered_by_tower(spark):
    # The tie is broken by tower id, so the result is deterministic.
    path = [(2, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:30:00")]
    n = sessions.tower_interactions(_data(spark, path), empty_voice(spark)).orderBy("event_datetime", "tower_id").collect()
    assert [(x.tower_id, x.prev_tower, x.next_tower) for x in n] == [(1, None, 2), (2, 1, 1), (1, 2, None)]


def test_union_is_distinct_across_feeds(spark):
    d = _data(spark, [(1, "2024-01-01 10:00:00"), (1, "2024-01-01 10:00:00")])
    v = cdr_voice(spark, [(M, 1, "voice", 5, "2024-01-01 10:00:00"), (M, 1, "voice", 5, "2024-01-01 11:00:00")])
    assert sessions.tower_interactions(d, v).count() == 2


def _brute(path):
    rows = sorted(set(path), key=lambda r: (r[1], r[0]))
    out, i = [], 0
    while i < len(rows):
        j = i
        while j + 1 < len(rows) and rows[j + 1][0] == rows[i][0]:
            j += 1
        if rows[i][1] < rows[j][1]:
            out.append((rows[i][0], rows[i][1], rows[j][1]))
        i = j + 1
    return sorted(out)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 60 * 30)), min_size=1, max_size=60))
def test_islands_match_brute_force_across_chunks(spark, pts):
    # Minutes over 30 hours: runs cross the hourly chunks of the neighbour window.
    base = datetime(2024, 1, 1)
    path = [(t, base + timedelta(minutes=m)) for t, m in pts]
    d = cdr_data(spark, [(M, t, 1, 1, "text", x.strftime("%Y-%m-%d %H:%M:%S")) for t, x in path])
    got = sorted((r.tower_id, r.session_start, r.session_end)
                 for r in sessions.tower_sessions(d, empty_voice(spark)).collect())
    assert got == _brute(path)


def test_every_interaction_in_exactly_one_island(spark):
    rnd = random.Random(7)
    base = datetime(2024, 1, 1)
    path = [(rnd.randint(1, 2), base + timedelta(minutes=rnd.randint(0, 600))) for _ in range(200)]
    d = cdr_data(spark, [(M, t, 1, 1, "text", x.strftime("%Y-%m-%d %H:%M:%S")) for t, x in path])
    n = sessions.tower_interactions(d, empty_voice(spark)).collect()
    uniq = sorted(set(path), key=lambda r: (r[1], r[0]))
    assert len(n) == len(uniq)
    by_time = sorted(n, key=lambda r: (r.event_datetime, r.tower_id))
    for a, b in zip(by_time, by_time[1:]):
        assert a.next_tower == b.tower_id and b.prev_tower == a.tower_id


def _brute_pairs(path):
    """The source's pairing, literally: lag/lead per subscriber, candidates, all later pairs."""
    rows = sorted(set(path), key=lambda r: (r[1], r[0]))
    starts, ends = [], []
    for i, (t, x) in enumerate(rows):
        prev = rows[i - 1][0] if i else None
        nxt = rows[i + 1][0] if i + 1 < len(rows) else None
        if nxt == t or prev is None:
            starts.append((t, x))
        if prev == t or nxt is None:
            ends.append((t, x))
    out = {}
    for t, s in starts:
        later = [e for te, e in ends if te == t and e > s]
        if later:
            hours = sum((e - s).total_seconds() * 1e6 for e in later)
            out[(t, s)] = (len(later), min(later), max(later), hours)
    return out


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 60 * 30)), min_size=1, max_size=60))
def test_pair_summary_matches_all_pairs_brute_force(spark, pts):
    base = datetime(2024, 1, 1)
    path = [(t, base + timedelta(minutes=m)) for t, m in pts]
    d = cdr_data(spark, [(M, t, 1, 1, "text", x.strftime("%Y-%m-%d %H:%M:%S")) for t, x in path])
    got = {(r.tower_id, r.session_start): (r.end_count, r.first_end, r.last_end, r.total_duration_hours)
           for r in sessions.session_pair_summary(d, empty_voice(spark)).collect()}
    want = _brute_pairs(path)
    assert set(got) == set(want)
    for k, (n, f, l, us) in want.items():
        assert got[k][:3] == (n, f, l)
        assert got[k][3] == us / 3600000000


def test_neighbours_multiple_keys_and_null_times_last(spark):
    from pyspark.sql import functions as F
    from meterflow.operators.sequence import hour_chunk, neighbours
    rows = [("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-01 12:00:00"), ("a", 3, None),
            ("b", 7, "2024-01-01 11:00:00")]
    df = spark.createDataFrame(rows, "k string, v int, s string").select(
        "k", "v", F.col("s").cast("timestamp_ntz").alias("t"))
    df = df.withColumn("c", hour_chunk("t"))
    got = {(r.k, r.v): (r.prev_v, r.next_v) for r in neighbours(df, ["k"], ["t"], ["v"], "c").collect()}
    # NULL times sort last, as in SQL.
    assert got == {("a", 1): (None, 2), ("a", 2): (1, 3), ("a", 3): (2, None), ("b", 7): (None, None)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(1, 3), st.integers(0, 60 * 30)), min_size=1, max_size=80))
def test_sessions_and_pairs_per_subscriber(spark, pts):
    """Several subscribers interleaved in time: each one's runs and pairs are its own."""
    base = datetime(2024, 1, 1)
    rows = [(f"27{s:08d}", t, 1, 1, "text", (base + timedelta(minutes=m)).strftime("%Y-%m-%d %H:%M:%S"))
            for s, t, m in pts]
    d = cdr_data(spark, rows)
    got_s = sorted((r.msisdn, r.tower_id, r.session_start, r.session_end)
                   for r in sessions.tower_sessions(d, empty_voice(spark)).collect())
    got_p = {(r.msisdn, r.tower_id, r.session_start): (r.end_count, r.first_end, r.last_end)
             for r in sessions.session_pair_summary(d, empty_voice(spark)).collect()}
    want_s, want_p = [], {}
    for s in sorted({p[0] for p in pts}):
        path = [(t, base + timedelta(minutes=m)) for s2, t, m in pts if s2 == s]
        want_s += [(f"27{s:08d}", t, a, b) for t, a, b in _brute(path)]
        want_p.update({(f"27{s:08d}", t, x): v[:3] for (t, x), v in _brute_pairs(path).items()})
    assert got_s == sorted(want_s)
    assert got_p == want_p


def test_rows_without_a_subscriber_are_cut_finer_and_stay_right(spark):
    """NULL and empty subscribers: chunks of a minute, sessions as for any other key."""
    from meterflow.operators.sequence import time_chunk
    rows = []
    for k, m in enumerate((None, "", "27123")):
        for i in range(600):
            rows.append((m, (i // 7) % 3, 1, 1, "t", f"2024-01-01 0{i * 20 // 3600}:{i * 20 // 60 % 60:02d}:{i * 20 % 60:02d}"))
    d = cdr_data(spark, rows)
    out = sessions.tower_sessions(d, empty_voice(spark)).collect()
    per = {m: sorted((r.tower_id, r.session_start, r.session_end) for r in out if r.msisdn == m) for m in (None, "", "27123")}
    assert len(per[None]) == 86 and per[None] == per[""] == per["27123"]
    chunks = d.select("msisdn", time_chunk("event_datetime", "msisdn").alias("c")).distinct().groupBy("msisdn").count().collect()
    assert {r.msisdn: r["count"] for r in chunks} == {None: 200, "": 200, "27123": 4}
