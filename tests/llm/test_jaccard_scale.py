"""Operator 6 with a table of frequencies that is full, as a large corpus fills it."""
import os
import random

import numpy as np
from pyspark.sql import functions as F

from meterflow.llm import jaccard_join
from meterflow.session import work_dir


def texts(alone: int = 120, words: int = 400):
    """Unrelated texts, then groups of near copies, texts that share a third with one of these, and copies."""
    draw = random.Random(3)
    rows = [[f"{draw.getrandbits(40):x}" for _ in range(words)] for _ in range(alone)]
    for base in rows[:3]:
        for k in range(4):
            rows.append([*base[:words - 10], *(f"n{k}{draw.getrandbits(40):x}" for _ in range(10))])
        rows.append([*base[:words // 3], *(f"{draw.getrandbits(40):x}" for _ in range(words - words // 3))])
    return [(i, " ".join(r)) for i, r in enumerate([*rows, *rows[5:9]])]


def by_force(rows):
    sets = {i: {tuple(t.split()[k:k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                low, high = sorted((root[i], root[j]))
                root = {k: low if v == high else v for k, v in root.items()}
    return {(i, len(sets[i]), root[i]) for i in sets}


def stored(folder: str) -> int:
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, names in os.walk(folder) for f in names)


def test_a_full_table_of_frequencies_stores_no_hashes_of_whole_sets(spark):
    rows = texts()
    folder = os.path.dirname(work_dir(spark, "llm"))
    before = stored(folder)
    got = jaccard_join.components(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), slot_bits=6).collect()
    # Small files of a few hundred bytes aside, what a text leaves is far less than the hashes of its shingles.
    assert stored(folder) - before < 4 * sum(len(t.split()) for _, t in rows)
    assert {tuple(r) for r in got} == by_force(rows)


def test_shingles_that_one_set_has_are_not_indexed(spark, monkeypatch):
    rows, seen, explode = texts(), {}, jaccard_join.link_classes

    def linked(sets, *more):
        seen.update({r["key"]: len(r["tokens"]) for r in sets.collect()})
        return explode(sets, *more)
    monkeypatch.setattr(jaccard_join, "link_classes", linked)
    jaccard_join.components(spark.createDataFrame(rows, "doc_id long, text string"), slot_bits=6)
    # 15 sets share shingles with another one, and 3 bases; a few of the other 117 are left by chance, by a shingle or so.
    assert len([k for k, n in seen.items() if n > 3]) <= 18 and sum(seen.values()) < 18 * 100


def test_parts_of_the_shingles_make_each_pair_once(spark):
    tokens = np.arange(100, dtype=np.int64).tolist()
    sets = spark.createDataFrame([(bytes([i]), bytes([i]), 400, 400, 16, tokens[i:i + 96], list(range(96))) for i in range(5)],
                                 "key binary, label binary, n int, matched long, asked int, tokens array<long>, places array<int>")
    pairs = [r for k in range(3) for r in jaccard_join._across_labels(sets, k, 3).collect()]
    assert sorted(map(tuple, pairs)) == sorted(map(tuple, jaccard_join._across_labels(sets).collect())) and len(pairs) == 10
    assert jaccard_join._slices(sets, 0) == 1 and jaccard_join._slices(sets.withColumn("tokens", F.array_repeat(F.lit(1), 2000)), 0) > 1


def test_marks_hold_every_hash_met_often_enough(spark):
    some = np.random.default_rng(1).integers(-2 ** 63, 2 ** 63, 4000)
    lists = [(some[:2000].tolist(),), (some[1000:].tolist(),), (None,)]
    met = jaccard_join.marks(spark.createDataFrame(lists, "tokens array<long>"), 2)
    found = met.of(some.view(np.uint64))
    assert found[1000:2000].all() and found.mean() < 0.35
    met = jaccard_join.marks(spark.createDataFrame([(x,) for x in some[:50].tolist()] + [(None,)], "digest long"), 1)
    assert met.of(some.view(np.uint64))[:50].all() and met.of(some.view(np.uint64)).mean() < 0.1
    assert not jaccard_join.marks(spark.createDataFrame([], "digest long"), 1).of(some.view(np.uint64)).any()
