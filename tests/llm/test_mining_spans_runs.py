"""Hard negatives, personal data and periodic runs: brute force, awkward rows, defined cases."""

import hashlib
import math
import os
import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))

from check_oracle import TABLES, digest  # noqa: E402
from meterflow.llm import hard_negatives, periodic_runs, personal_data  # noqa: E402
from meterflow.llm.catalog import QUERIES  # noqa: E402
from meterflow.llm.common import table  # noqa: E402
from meterflow.llm.oracle import ORACLE  # noqa: E402

SF = "/root/testdata/sf0.001"


# --- hard negatives ---------------------------------------------------------------------------------------------

def brute_mine(rows, is_anchor, n_pos, n_neg):
    """rows: {id: (label, tuple of ints)}."""
    width = max((len(v) for _, v in rows.values()), default=0)
    v = {i: list(x) + [0] * (width - len(x)) for i, (_, x) in rows.items()}
    out = []
    for a in sorted(i for i in rows if is_anchor(i)):
        score = {i: sum(p * q for p, q in zip(v[a], v[i])) for i in rows if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if rows[i][0] == rows[a][0]][:n_pos]:
            fit = [i for i in order if rows[i][0] != rows[a][0] and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit[:n_neg])]
    return sorted(out)


def mined(df, **kw):
    out = hard_negatives.mine(df, F.col("label"), F.col("id") % 5 == 0, **kw)
    return sorted(tuple(r) for r in out.collect())


def test_hard_negatives_are_brute_force(spark, monkeypatch):
    for name, size in (("TILE_ROWS", 64), ("LEAF_ROWS", 8), ("NODE_LEAVES", 3)):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(400):
        # A third of the rows hold one vector; the others lie on a coarse grid, so scores tie.
        x = [0.5, 0.5, -0.25, 0.0, 1.0, 0.0] if i % 3 == 0 else (rng.integers(-3, 6, 6) / 4).tolist()
        rows.append((i, x, int(rng.integers(0, 3))))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    want = brute_mine({i: (y, tuple(math.floor(256 * c) for c in x)) for i, x, y in rows}, lambda i: i % 5 == 0, 5, 10)
    assert want and mined(df) == want
    assert mined(df, block=20) == want


def test_hard_negatives_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 1.0], 1), (0, [1.0, 0.5], 2), (1, [1.0, 0.75], 1), (2, [0.5, 0.5, 0.25], 2), (3, [0.5], 2), (4, [], 2),
            (5, None, 1), (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (8, [None, 1.0], 2), (9, [1.0, 1.0], None), (None, [1.0, 1.0], 1),
            (10, [1.0, 1.0], 1), (11, [1e30, 1.0], 2), (12, [0.5, 0.5], 2), (12, [0.5, 0.5], 2)]
    schema = "vec_id long, embedding array<float>, label int"
    df = spark.createDataFrame(rows, schema)
    clash = df.withColumn("id", F.lit(1)).withColumn("v", F.lit("x")).withColumn("score", F.lit(1)).withColumn("a.b", F.lit(2))
    part = {0: (1, (256, 256)), 1: (1, (256, 192)), 2: (2, (128, 128, 64)), 3: (2, (128,)), 4: (2, ()), 10: (1, (256, 256)), 12: (2, (128, 128))}
    want = brute_mine(part, lambda i: i % 5 == 0, 5, 10)
    assert want and mined(df) == mined(clash) == want
    empty = spark.createDataFrame([], schema)
    assert mined(empty) == [] and mined(df.filter("vec_id in (1, 2)")) == [] and mined(df.filter("vec_id = 4")) == []
    assert mined(df.filter("vec_id = 0")) == []


# --- personal data ----------------------------------------------------------------------------------------------

def passes_luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base_spans(text):
    out = []
    for k in personal_data.KINDS:
        for m in re.finditer(k.base, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if k.name == "ip" else False,
                  "card": 13 <= len(digits) <= 19 and passes_luhn(digits), "phone": 9 <= len(digits) <= 15}[k.name]
            if ok:
                out.append((k.name, m.start(), m.end()))
    return out


TEXTS = [None, "", "no data", "mail a.b@c-d.example.com, c@d.e", "a@b.c.@x.y.z _@-.- a@@b.c", "x" * 30000 + "@y.z", "1" * 50000, "1 " * 20000, "a@b" + ".c" * 20000,
         "1.2.3.4 256.1.1.1 001.002.003.004 1.2.3.4.5.6.7.8 0000000255.1.1.1", "é ☃ 𝒳 4539 1488 0343 6467 𝒳 +1 (509) 555-6973!",
         "4539148803436467 4539148803436468", "+12 345 678 901 234 567", "+1((((((555-5555)))) 22", "tel 12 4539-1488-0343-6467"]


@pytest.fixture(scope="module")
def people(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "y"), (None, TEXTS[9], "z"), (None, TEXTS[3], "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, kind string").repartition(3), rows


def test_personal_data_base_is_brute_force(people):
    df, rows = people
    extra = df.select("*", F.lit(1).alias("row"), F.lit(2).alias("start"), F.lit("h").alias("hit"), F.lit(3).alias("a.b"))
    for docs in (df, extra):
        out = personal_data.report(personal_data.scan(docs, rounds=2)).collect()
        want = []
        for i, t, _ in rows:
            b = base_spans(t)
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in b)
            want.append((str(i), *[sum(x[0] == k.name for x in b) for k in personal_data.KINDS], hashlib.sha256(joined.encode()).hexdigest()))
        assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in out) == sorted(want)
        for r in out:
            names = [k.name for k in personal_data.KINDS]
            spans = [(names.index(k), int(s), int(e)) for k, s, e in (x.split(":") for x in r["spans"].split(",") if x)]
            assert spans == sorted(spans)
    assert personal_data.scan(df.filter("doc_id < 0")).count() == 0


def test_personal_data_adds_what_the_base_misses(spark):
    def card(n):
        body = f"4{n:014d}"
        return next(body + c for c in "0123456789" if passes_luhn(body + c))

    clean = ["plain words and numbers 12 and 345 only", "order 4539148803436468 was sent", "version 1.2.3.456 of 2020"]
    plain = [f"please use my card {card(7919 * i)} today" for i in range(40)] + [f"the token {i}a{card(104729 * i)}b was left" for i in range(40)]
    plain += [f"order 4{i:015d} came" for i in range(40) if not passes_luhn(f"4{i:015d}")]
    plain += [f"write to user{i}@mail{i % 9}.example.com now" for i in range(40)] + [f"call +1 (5{i % 10}9) 555-6{i:03d} today" for i in range(40)]
    added = {"my card 12 " + card(99) + " and": ("card", card(99)), f"{card(5)} {card(6)}": ("card", card(5)),
             "write to john.doe [at] example [dot] com please": ("email", "john.doe [at] example [dot] com"),
             "please call (509) 555-6973 today": ("phone", "(509) 555-6973")}
    texts = [*clean, *plain, *added]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r for r in personal_data.report(personal_data.scan(df)).collect()}
    assert all(out[i]["spans"] == "" for i in range(len(clean)))
    for i, t in enumerate(texts):
        got = [(k, t[int(s):int(e)]) for k, s, e in (x.split(":") for x in out[i]["spans"].split(",") if x)]
        assert [x for x in base_spans(t) if f"{x[0]}:{x[1]}:{x[2]}" not in out[i]["spans"]] == []
        if t in added:
            assert added[t] in got, (t, got)
        elif "token" in t:
            assert out[i]["n_added"] == 0


def test_personal_data_spans_hold_no_added_overlap(spark):
    found = personal_data.scan(table(spark, SF, "documents")).collect()
    for r in found:
        every = [(x["start"], x["end"], x["base"]) for x in r["findings"]]
        assert not any(a[0] < b[1] and b[0] < a[1] for i, a in enumerate(every) for b in every[:i] if not (a[2] and b[2]))


# --- periodic runs ----------------------------------------------------------------------------------------------

def brute_runs(w, least=6):
    out = {}
    for q in range(1, len(w)):
        i = q
        while i < len(w):
            if w[i] != w[i - q]:
                i += 1
                continue
            s = i - q
            while i < len(w) and w[i] == w[i - q]:
                i += 1
            if i - s >= max(least, 4 * q):
                out.setdefault((s, i), (s, i - s, q))
    return sorted(out.values(), key=lambda r: (r[0], r[2]))


blocks = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 8))


@settings(max_examples=300, deadline=None)
@given(st.lists(blocks, max_size=5), st.sampled_from([5, 16, 1 << 16]))
def test_runs_are_brute_force(parts, block):
    w = [x for body, times, more in parts for x in (body * (times + 1))[:len(body) * times + more]]
    old, periodic_runs.BLOCK = periodic_runs.BLOCK, block
    try:
        assert periodic_runs.find_runs(np.array(w, np.int64)) == brute_runs(w)
    finally:
        periodic_runs.BLOCK = old


def test_runs_of_hot_words():
    same = periodic_runs.find_runs(np.zeros(300_000, np.int64))
    assert same == [(0, 300_000, 1)]
    w = np.tile(np.r_[np.zeros(7, np.int64), 1], 3000)
    runs = periodic_runs.find_runs(w)
    assert (0, 24000, 8) in runs and len(runs) == 3001


def test_word_numbers_across_slices(monkeypatch):
    text = ("αβγ wörd\t\x0b\x0c\r\n" * 50 + "x" * 500 + "\xa0y").encode()
    monkeypatch.setattr(periodic_runs, "SLICE", 7)
    w, names = periodic_runs.word_numbers(text)
    assert [names[i] for i in w] == text.split() == re.findall(rb"[^\x20\x09-\x0D]+", text)


def test_periodic_runs_rows(spark):
    def words(text):
        return re.findall(r"[^\x20\x09-\x0D]+", text or "")
    long = " ".join(f"w{i % 997}" for i in range(200_000)) + " a b" * 500
    texts = [None, "", " \t\n", "a a a a a a", "a b " * 7 + "c", "x " * 3, "é ☃ " * 9, long, "lone " * 4 + "lone"]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(3, texts[3], 1), (None, texts[4], 1), (None, texts[3], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(2)
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    df = df.unionByName(spark.createDataFrame([(i, " ".join(f"v{k}" for k in range(5 + 7 * i)), 1) for i in ids], df.schema))
    rows += [(i, " ".join(f"v{k}" for k in range(5 + 7 * i)), 1) for i in ids]
    out = periodic_runs.report(df, order=periodic_runs.stutter).collect()
    want = []
    for i, t, _ in rows:
        w = words(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        runs = brute_runs(w) if len(w) < 5000 else [(0, 200_000, 997), (200_000, 1000, 2)]
        gone = {k for s, n, q in runs for k in range(s + q, s + n)}
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
        want.append((str(i), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
                     hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in gone).encode()).hexdigest()))
    assert sorted(map(str, [(str(r[0]), *r[1:]) for r in out])) == sorted(map(str, want))
    assert periodic_runs.report(df.filter("doc_id < 0")).count() == 0
    got = {(r["doc_id"], r["start"], r["length"], r["period"]) for r in periodic_runs.spans(df).filter("doc_id = 4").collect()}
    assert got == {(4, 0, 14, 2)}


@pytest.mark.parametrize("key", [k for k in sorted(ORACLE) if k.startswith(("op11", "op12", "op13"))])
def test_query_columns(spark, key):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[key](spark, SF)
    cur = con.execute(ORACLE[key])
    columns = [d[0] for d in cur.description]
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(cur.fetchall(), columns)


# --- stages pass any columns through ---------------------------------------------------------------------------

CLASHES = ["score", "lang_pred", "_text", "spans", "items", "overlap", "contaminated", "mix_id", "mix_turn", "mix_tokens", "mix_turn2", "_row", "id", "a.b", "a`b"]


def test_stages_carry_clashing_names(spark):
    from meterflow.llm import decontaminate, lang_id, mixing
    body = "the quick brown fox jumps over the lazy dog and runs far away from the old house on the hill"
    item = "Which river runs through the old town of Farbridge? The long green river runs through it every day."
    rows = [(1, body, "en", "a"), (2, f"Before. {item} After.", "en", "a"), (3, None, None, None), (None, body, "en", "b"), (None, body, "en", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(f"own {c}"))
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    for out, ids in ((lang_id.keep_known(docs, docs.select("doc_id", "text", "lang")), [None, None, 1, 2]),
                     (decontaminate.drop_contaminated(docs, bench), [None, None, 1, 3]), (mixing.mix(docs), [None, None, 1, 2, 3])):
        got = out.collect()
        assert sorted((r["doc_id"] for r in got), key=lambda x: (x is not None, x)) == ids
        assert all(r[c] == f"own {c}" for r in got for c in CLASHES) and set(docs.columns) <= set(out.columns)
    assert mixing.mix(docs.filter("doc_id < 0")).count() == 0 and set(mixing.ADDED) <= set(mixing.mix(docs).columns)
