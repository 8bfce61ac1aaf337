"""Benchmark decontamination by BM25 retrieval and overlap.

The test items, a set of a size that does not follow the corpus, make an
inverted index that every task gets: postings of (item, impact) in item order,
cut into blocks with the largest impact of each. Every passage of a text, a
window of twice the longest item's words at steps of that length, is a query. All items
whose BM25 score reaches the item's threshold are retrieved with block-max
WAND, then verified: at least ``least`` of the item's 5-word shingles stand in
the passage, and at least half of those of its question and of its answer
(the last sentence, if it has several).

An item's threshold is the lowest score that a passage with ``least`` of its
shingles can have: its own score less the most that the words lose which the missing
shingles leave uncovered. So retrieval loses nothing that would verify.
Impacts are divided by it, which makes 1 everybody's threshold. Before WAND, a
passage's bound is summed for a few groups of items at once, over all passages
of a text; most passages end there.

Words are runs of letters and digits in lower case. Defined cases: a null or
empty text has no passage and is clean; null or wordless items are never
found; an item of fewer than five words is one shingle; repeated items and
rows are separate ones; with no item every text is clean; other columns are
ignored, and kept by ``drop_contaminated``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_row

WORDS = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"(?<=[.!?])\s+")
K1, B, BLOCK, GROUPS = 1.2, 0.75, 16, 32


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def shingles(words: list[str], n: int = 5) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def most_lost(impacts: list[float], missing: int, n: int = 5) -> float:
    """The largest sum of impacts (one per word of the item) over words that no shingle covers when ``missing``
    are gone: u such words in a row cost u shingles at either end of the item, u + n - 1 elsewhere."""
    if not missing:
        return 0.0
    if len(impacts) * missing > 40_000:   # long items: any words, the coarser bound
        return sum(sorted(impacts, reverse=True)[:missing])
    x = np.full((3, missing + 1), -np.inf)   # by shingles gone: last word covered, in a row, in the row up to the end
    x[0, 0] = 0.0
    for i, impact in enumerate(impacts):
        covered, row, last = np.maximum(x[0], x[1]), np.full(missing + 1, -np.inf), np.full(missing + 1, -np.inf)
        row[1:] = x[1, :-1]
        last[1:] = np.maximum(x[0, :-1], x[2, :-1])
        if i == 0:
            row[1] = 0.0
        elif missing >= n:
            row[n:] = np.maximum(row[n:], x[0, :-n])
        x = np.array([covered, row + impact, last + impact])
    return float(x.max())


class Index:
    """The items' postings, thresholds and shingles."""

    def __init__(self, items: list[tuple[int, str]], least: float = 0.8):
        items = [(i, t, words_of(t)) for i, t in items]
        items = [x for x in items if x[0] is not None and x[2]]
        df: dict[str, int] = {}
        for _, _, w in items:
            for t in set(w):
                df[t] = df.get(t, 0) + 1
        # Items whose commonest words agree, as those of one language, stand together in blocks and groups.
        items.sort(key=lambda x: (sorted(set(x[2]), key=lambda t: (-df[t], t))[:3], x[0]))
        self.ids, self.least = [x[0] for x in items], least
        texts = [x[2] for x in items]
        self.longest = max(map(len, texts), default=0)
        self.whole = [shingles(w) for w in texts]
        parts = [SENTENCE.split((t or "").strip()) for _, t, _ in items]
        self.question = [shingles(words_of(" ".join(p[:-1] or p))) for p in parts]
        self.answer = [shingles(words_of(p[-1])) for p in parts]
        mean = sum(map(len, texts)) / max(1, len(texts))
        self.terms = {t: i for i, t in enumerate(sorted(df))}
        post: list[list[tuple[int, float]]] = [[] for _ in df]
        for n, w in enumerate(texts):
            impact = {}
            for t in set(w):
                tf = w.count(t)
                idf = math.log(1 + (len(texts) - df[t] + 0.5) / (df[t] + 0.5))
                impact[t] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(w) / mean))
            may_miss = len(self.whole[n]) - math.ceil(least * len(self.whole[n]) - 1e-9)
            distinct = len(self.whole[n]) == max(1, len(w) - 4)   # else a missing shingle is missing in several places
            lost = most_lost([impact[t] for t in w], may_miss) if distinct else math.inf
            limit = max((sum(impact.values()) - lost) * (1 - 1e-9), 1e-9)
            for t, x in impact.items():
                post[self.terms[t]].append((n, x / limit))
        self.docs = [[n for n, _ in p] for p in post]
        self.impacts = [[x for _, x in p] for p in post]
        self.most = np.array([max(x) for x in self.impacts] + [0.0])   # the last: no term
        self.group_most = np.zeros((len(post) + 1, max(1, min(GROUPS, len(texts)))), np.float32)
        for t, p in enumerate(post):
            for n, x in p:
                g = n * self.group_most.shape[1] // len(texts)
                self.group_most[t, g] = max(self.group_most[t, g], np.float32(x) * np.float32(1 + 1e-6))
        self.block_most = [[max(x[i:i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.impacts]

    def retrieve(self, terms: list[int]) -> list[tuple[int, float]]:
        """All (item, score) of a score of 1 or more for the distinct terms, by block-max WAND."""
        lists = [[self.docs[t][0], t, 0] for t in terms]   # next item, term, place
        out = []
        while lists:
            lists.sort()
            bound, pivot = 0.0, -1
            for i, (_, t, _) in enumerate(lists):
                bound += self.most[t]
                if bound >= 1:
                    pivot = i
                    break
            if pivot < 0:
                return out
            item = lists[pivot][0]
            while pivot + 1 < len(lists) and lists[pivot + 1][0] == item:
                pivot += 1
            near, until = 0.0, float("inf")   # the blocks that would hold the pivot item
            for _, t, at in lists[:pivot + 1]:
                docs, block = self.docs[t], at // BLOCK
                while (block + 1) * BLOCK < len(docs) and docs[(block + 1) * BLOCK - 1] < item:
                    block += 1
                near += self.block_most[t][block]
                until = min(until, docs[min((block + 1) * BLOCK, len(docs)) - 1])
            if near < 1:   # no item up to the end of the first of these blocks, or the next list's item, can reach it
                after = lists[pivot + 1][0] if pivot + 1 < len(lists) else float("inf")
                target = max(item + 1, min(until + 1, after))
            elif lists[0][0] == item:
                score = sum(self.impacts[t][at] for d, t, at in lists if d == item)
                if score >= 1:
                    out.append((item, score))
                target = item + 1
            else:
                target = item
            for x in lists[:pivot + 1]:
                docs = self.docs[x[1]]
                while x[2] < len(docs) and docs[x[2]] < target:
                    x[2] += 1
                x[0] = docs[x[2]] if x[2] < len(docs) else -1
            lists = [x for x in lists if x[0] >= 0]
        return out

    def verify(self, item: int, have: set) -> float:
        """The share of the item's shingles in the passage if it is one of the item, else 0."""
        share = len(self.whole[item] & have) / len(self.whole[item])
        parts = (self.question[item], self.answer[item])
        ok = share >= self.least - 1e-9 and all(2 * len(p & have) >= len(p) for p in parts)
        return share if ok else 0.0

    def find(self, text: str | None) -> dict[int, float]:
        """Item -> the largest verified share over the passages of a text."""
        words = words_of(text)
        if not words or not self.ids:
            return {}
        none, terms = len(self.terms), self.terms
        ids = np.array([terms.get(w, none) for w in words])
        # A passage's bounds by group, words that repeat counted again; then, for those that are left, without repeats.
        upto = np.vstack([np.zeros(self.group_most.shape[1]), np.cumsum(self.group_most[ids], axis=0, dtype=float)])
        starts = np.arange(0, max(1, len(words) - self.longest), self.longest)
        ends = np.minimum(starts + 2 * self.longest, len(words))
        near = (upto[ends] - upto[starts]).max(axis=1) >= 1 - 1e-6
        found: dict[int, float] = {}
        for a, b in zip(starts[near].tolist(), ends[near].tolist()):
            own = np.unique(ids[a:b])
            own = own[own < none]
            if not len(own) or self.group_most[own].sum(axis=0, dtype=float).max() < 1 - 1e-6:
                continue
            hits = self.retrieve(own.tolist())
            if hits:
                have = shingles(words[a:b])
                for item, _ in hits:
                    short = {tuple(s) for p in (self.whole, self.question, self.answer) for s in p[item] if len(s) < 5}
                    near = have | {s for s in short if any(words[i:i + len(s)] == list(s) for i in range(a, b - len(s) + 1))}
                    share = self.verify(item, near)
                    if share:
                        found[item] = max(share, found.get(item, 0.0))
        return {self.ids[i]: s for i, s in found.items()}


def find_items(docs: DataFrame, benchmark: DataFrame, extra: list[Column], least: float = 0.8, most_items: int = 200_000) -> DataFrame:
    """The ``extra`` columns with contaminated, items (identifiers in order, comma-joined) and overlap (the largest share).

    The items are read to the driver and given to every task; a set of over ``most_items`` is refused."""
    rows = benchmark.select("item_id", "text").limit(most_items + 1).collect()
    if len(rows) > most_items:
        raise ValueError("more test items than most_items: split the set")
    shared = docs.sparkSession.sparkContext.broadcast(vars(Index([tuple(r) for r in rows], least)))
    rows = docs.select(*extra, F.col("text").alias("_text"))
    shape = rows.drop("_text").schema.add("contaminated", "boolean").add("items", "string").add("overlap", "double")

    def run(batches):
        index = Index([])
        vars(index).update(shared.value)
        for batch in batches:
            found = [index.find(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            made = [pa.array([bool(x) for x in found]), pa.array([",".join(map(str, sorted(x))) for x in found], pa.string()),
                    pa.array([max(x.values(), default=0.0) for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "contaminated", "items", "overlap"])

    return rows.mapInArrow(run, shape)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = 0.8) -> DataFrame:
    """``docs`` without the texts that hold a test item."""
    return find_items(docs, benchmark, [whole_row(docs)], least).filter(~F.col("contaminated")).select("_row.*")
