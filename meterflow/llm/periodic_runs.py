"""Periodic runs of words by an online, sparse diagonal pass.

Words are read from left to right. The pairs (word, earlier occurrence of it at distance q) of one lag q lie on a
diagonal, and a stretch of words with period q is a match of length (stretch - q) on it. Diagonals are kept sparse: a
lag is opened only at a word whose position is a multiple of it and which also stands at one, two and three lags
before, as every match of three lags holds such a word. From there the match length is counted back to its beginning
and on to the word that ends it, where a sufficient one emits its run. A lag whose opening word lies, with the
lag before it, in a run of a period that divides the lag would find that run again and stays closed. The openings
number at most n times the logarithm of n, however often a word repeats.

A run is a stretch of words with smallest period q and length of at least max(``least``, 4 q) that no neighbouring word
extends. Its words after the first q are copies; ``collapsed`` is the text without any run's copies.

Defined cases: a null or empty text, or one of separators alone, has no words and no runs; a null identifier leaves a
text as it is under ``stutter``; repeated rows give repeated results; ties for the strongest run go to the smallest
start, then period; an empty table gives no row; input columns other than the identifier and the text are ignored,
whatever their names. A text is held in memory once, with eight bytes a word and its distinct words; positions are
opened in blocks of ``BLOCK``.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

BLOCK = 1 << 16
SLICE = 1 << 20
SEPARATOR = re.compile(rb"[ \t-\r]")
NUMBERS, DIGESTS = ["n_runs", "start", "length", "period", "exponent_milli"], ["runs_sha256", "collapsed_sha256"]
RESULT = [*[StructField(n, LongType()) for n in NUMBERS], *[StructField(n, StringType()) for n in DIGESTS]]
Run = tuple[int, int, int]
#: Which word stands at each position, from (identifier, number of words); None leaves the text as it is.
Order = Callable[[int | None, int], "np.ndarray | None"]


def word_numbers(text: bytes) -> tuple[np.ndarray, list[bytes]]:
    """The text's words as numbers, and the word of each number; bytes.split() takes space and tab to carriage return."""
    known: dict[bytes, int] = {}
    parts, at = [], 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        end = m.start() if (m := SEPARATOR.search(text, end)) else len(text)
        parts.append(np.array([known.setdefault(w, len(known)) for w in text[at:end].split()], dtype=np.int64))
        at = end
    return (np.concatenate(parts) if parts else np.zeros(0, np.int64)), list(known)


def closed(i: np.ndarray, q: np.ndarray, run: Run) -> np.ndarray:
    """Whether ``run`` holds the word at i and the one a lag before, and the lag is a multiple of its period."""
    start, length, period = run
    return (i < start + length) & (i - q >= start) & (q % period == 0)


def openings(w: np.ndarray, begin: int, end: int, live: list[Run]) -> tuple[np.ndarray, np.ndarray]:
    """Positions in [begin, end) and lags to open there, by position, then lag."""
    most = min(len(w) // 4, (end - 1) // 3)
    lags = np.arange(1, most + 1)
    first = -(-np.maximum(begin, 3 * lags) // lags) * lags
    count = np.maximum((end - 1 - first) // lags + 1, 0)
    q = np.repeat(lags, count)
    i = np.repeat(first - (np.cumsum(count) - count) * lags, count) + np.arange(len(q)) * q
    for r in live:
        open_ = ~closed(i, q, r)
        i, q = i[open_], q[open_]
    for back in (1, 2, 3):
        same = w[i - (back - 1) * q] == w[i - back * q]
        i, q = i[same], q[same]
    # The match reaches at least two lags back from here: words between must agree as well.
    back = 1
    while len(i) and back <= 2 * int(q.max()):
        same = (back > 2 * q) | (w[i - back] == w[i - np.minimum(back, 2 * q) - q])
        i, q, back = i[same], q[same], 2 * back + 1
    order = np.lexsort((q, i))
    return i[order], q[order]


def agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, looked at in growing pieces."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        end = min(at + step, n)
        differ = np.flatnonzero(a[at:end] != b[at:end])
        if len(differ):
            return at + int(differ[0])
        at, step = end, 2 * step
    return n


def find_runs(w: np.ndarray, least: int = 6) -> list[Run]:
    """(start, length, period) of every run, by start, then period."""
    found: list[Run] = []
    live: list[Run] = []            # runs that the pass has not left yet
    ended: dict[int, int] = {}      # lag: where its last match ended
    for begin in range(0, len(w), BLOCK):
        live = [r for r in live if begin < r[0] + r[1]]
        at, lags = openings(w, begin, min(begin + BLOCK, len(w)), live)
        k = 0
        while k < len(at):
            i, q = int(at[k]), int(lags[k])
            k += 1
            if i < ended.get(q, 0):
                continue
            live = [r for r in live if i < r[0] + r[1]]
            if any(q % p == 0 and i - q >= s for s, _, p in live):
                continue
            start = i + 1 - agreeing(w[i::-1], w[i - q::-1]) - q
            end = i + agreeing(w[i:], w[i - q:])
            ended[q] = end
            if end - start >= max(least, 4 * q):
                run = (start, end - start, q)
                found.append(run)
                live.append(run)
                if end - i > 256:    # many openings may lie in it
                    open_ = ~closed(at[k:], lags[k:], run)
                    at, lags, k = at[k:][open_], lags[k:][open_], 0
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest length / period, compared exactly; ties: smallest start, then period."""
    best = None
    for r in runs:
        if best is None or (gain := r[1] * best[2] - best[1] * r[2]) > 0 or gain == 0 and (r[0], r[2]) < (best[0], best[2]):
            best = r
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Positions that no run drops."""
    change = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return np.flatnonzero(np.cumsum(change[:n]) == 0)


def collapsed(w: np.ndarray, names: list[bytes], runs: list[Run]):
    """The kept words joined by one space, in pieces."""
    kept = w[kept_words(len(w), runs)]
    for at in range(0, len(kept), BLOCK):
        yield (b" " if at else b"") + b" ".join([names[x] for x in kept[at:at + BLOCK].tolist()])


def stutter(doc_id: int | None, n: int) -> np.ndarray | None:
    """The query's repeated texts: with h the crc32 of the identifier and g = h // 10, where h is divisible by 10 the
    words from a = g % n on repeat the first p = 1 + (n - a) // (3 + g % 8) of them."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def judge(doc_id: int | None, text: bytes | None, order: Order | None, least: int) -> tuple:
    w, names = word_numbers(text or b"")
    if order is not None and (at := order(doc_id, len(w))) is not None:
        w = w[at]
    runs = find_runs(w, least)
    best = strongest(runs)
    digest, lines = hashlib.sha256(), hashlib.sha256()
    for piece in collapsed(w, names, runs):
        digest.update(piece)
    for r in runs:
        lines.update(b"%d,%d,%d\n" % r)
    top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *top, lines.hexdigest(), digest.hexdigest()


def report(docs: DataFrame, id_col: str = "doc_id", order: Order | None = None, least: int = 6) -> DataFrame:
    """Per row: the identifier, n_runs, the strongest run's start, length, period and exponent_milli (nulls: none),
    the SHA-256 of all runs' lines (start,length,period) and of the collapsed text."""
    rows = docs.select(F.col(id_col), F.col("text"))
    kinds = [*[(n, pa.int64()) for n in NUMBERS], *[(n, pa.string()) for n in DIGESTS]]

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for at in range(0, batch.num_rows, 256):
                part = ids[at:at + 256]
                out = [judge(i.as_py() if order else None, t.as_py(), order, least) for i, t in zip(part, texts[at:at + 256])]
                cols = [pa.array([x[k] for x in out], kind) for k, (_, kind) in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part, *cols], [batch.schema.names[0], *[n for n, _ in kinds]])

    return rows.mapInArrow(run, StructType([rows.schema[0], *RESULT]))


def spans(docs: DataFrame, id_col: str = "doc_id", least: int = 6) -> DataFrame:
    """(identifier, start, length, period) of every run of every text, in words."""
    rows = docs.select(F.col(id_col), F.col("text"))
    names = ["start", "length", "period"]

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for k, text in enumerate(batch.column(1).cast(pa.binary())):
                runs = find_runs(word_numbers(text.as_py() or b"")[0], least)
                if runs:
                    cols = [pa.array([r[c] for r in runs], pa.int64()) for c in range(3)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array([k] * len(runs))), *cols], [batch.schema.names[0], *names])

    return rows.mapInArrow(run, StructType([rows.schema[0], *[StructField(n, LongType()) for n in names]]))
