"""Language ID for mixed text.

The model is counts of character grams (1 to 3 characters of a word with its
edges) hashed into a fixed number of buckets, per learnt language, and the
scripts each language was seen in. The script of a word narrows its candidate
languages; a candidate's score is the word's mean gram log-likelihood times its
letters, held within a bound of the best; Viterbi over a text's words, with a
penalty for every switch, labels spans. Letters count for a label where a learnt language has the
word's script. A text's language is the one that labels the most such letters, its score their share
of all letters: near 0 for a text in a script that no learnt language uses.

The model is fitted on a bounded sample of the labelled rows: about
``sample_docs`` whole documents of each language, chosen by hash. It is a table
of ``BUCKETS`` rows per language, whatever the input.

Defined cases: null text, or text without a letter: ``und`` with score 0; with
no labelled row at all every text is ``und``; null languages teach nothing;
equal letters: the first language in order; repeated rows are judged alike; an
empty table gives no row; other columns are ignored, and kept by ``keep_known``.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import whole_row

LETTERS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 16
# First code points of script ranges, in order, and the scripts from there on.
SCRIPT_STARTS = [0x0, 0x370, 0x400, 0x530, 0x590, 0x600, 0x700, 0x900, 0x980, 0xB80, 0xC00, 0xE00, 0xE80, 0x10A0, 0x1100,
                 0x1200, 0x1E00, 0x1F00, 0x2000, 0x3040, 0x30A0, 0x3100, 0x3400, 0xAC00, 0xD7B0, 0xF900, 0xFB00, 0x20000]
SCRIPTS = ["latin", "greek", "cyrillic", "armenian", "hebrew", "arabic", "other", "devanagari", "indic", "tamil", "indic", "thai",
           "other", "georgian", "hangul", "other", "latin", "greek", "other", "kana", "kana", "other", "han", "hangul", "other",
           "han", "other", "han"]
_STARTS = np.array(SCRIPT_STARTS)


def script_of(word: str) -> str:
    return SCRIPTS[int(np.searchsorted(_STARTS, ord(word[0]), side="right")) - 1]


def grams_of(words: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Where each word starts among the characters of all words with their edges, and, for grams of 1 to 3
    characters, their buckets by first character and which of them lie within one word."""
    sizes = np.array([len(w) + 2 for w in words])
    chars = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    owner, grams = np.repeat(np.arange(len(words)), sizes), []
    code, n = np.zeros_like(chars), len(chars)
    for k in range(3):
        code[:n - k] = code[:n - k] * np.uint64(0x110000 + 1) + chars[k:] + np.uint64(1)
        inside = np.zeros(n, bool)
        inside[:n - k] = owner[:n - k] == owner[k:]
        mixed = (code + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15)
        grams.append(((mixed >> np.uint64(40)).astype(np.int64) % BUCKETS, inside))
    return np.concatenate([[0], np.cumsum(sizes)[:-1]]), grams


def _is_word(w: str) -> bool:
    return any(c.isalpha() for c in w)


def _count(batches):
    """(lang, text) -> (lang, feature, n): bucket counts, and scripts as features below 0."""
    names = sorted(set(SCRIPTS))
    for batch in batches:
        per: dict[str, dict[str, int]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = per.setdefault(lang, {})
            for w in LETTERS.findall((text or "").lower()):
                seen[w] = seen.get(w, 0) + 1
        for lang, seen in per.items():
            words = [w for w in seen if _is_word(w)]
            if not words:
                continue
            starts, grams = grams_of(words)
            times = np.repeat([seen[w] for w in words], np.diff(starts, append=len(grams[0][0])))
            table = sum(np.bincount(g[ok], weights=times[ok], minlength=BUCKETS) for g, ok in grams)
            counts = {int(f): int(table[f]) for f in np.flatnonzero(table)}
            for w in words:
                f = -1 - names.index(script_of(w))
                counts[f] = counts.get(f, 0) + seen[w]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts), pa.string()), pa.array(list(counts), pa.int32()),
                                              pa.array(list(counts.values()), pa.int64())], ["lang", "feature", "n"])


class Model:
    """Languages in order, log-likelihoods by bucket (BUCKETS x languages), languages of each script."""

    def __init__(self, langs: list[str], loglik: np.ndarray, scripts: dict[str, list[bool]]):
        self.langs, self.loglik, self.scripts = langs, loglik, scripts

    def has_candidate(self, words: list[str]) -> np.ndarray:
        """Whether any language has the word's script."""
        return np.array([any(self.scripts.get(script_of(w)) or ()) for w in words], bool)

    def word_scores(self, words: list[str], bound: float) -> np.ndarray:
        """Scores of the languages per word: the best candidate 0, none below ``-bound``; all 0 where no
        language has the word's script."""
        fits = np.array([self.scripts.get(script_of(w)) or [False] * len(self.langs) for w in words], bool)
        starts, grams = grams_of(words)
        sums = sum(np.add.reduceat(np.where(ok[:, None], self.loglik[g], 0.0), starts, axis=0) for g, ok in grams)
        sizes = np.array([len(w) for w in words])
        s = sums / (3 * sizes + 3)[:, None] * np.minimum(sizes, 12)[:, None]
        s = np.where(fits, s, -np.inf)
        with np.errstate(invalid="ignore"):
            s = np.clip(s - s.max(axis=1, keepdims=True), -bound, 0.0)
        return np.where(fits.any(axis=1, keepdims=True), s, 0.0)


def fit(labelled: DataFrame, sample_docs: int = 2000, id_col: str = "doc_id") -> Model:
    """``labelled``: identifier, text, lang. One count per language and bucket reaches the driver."""
    labelled = labelled.filter("lang is not null and text is not null")
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((BUCKETS, 0)), {})
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, sample_docs / n))) for k, n in sizes.items()])
    unit = F.pmod(F.xxhash64(F.col(id_col), "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = labelled.filter(unit < share).select("lang", "text")
    counts = sample.mapInArrow(_count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    got = counts.toPandas()
    names, table = sorted(set(SCRIPTS)), np.zeros((BUCKETS, len(langs)))
    by_script = np.zeros((len(names), len(langs)))
    place = got["lang"].map({k: i for i, k in enumerate(langs)}).to_numpy(int)
    feature, n = got["feature"].to_numpy(int), got["n"].to_numpy(float)
    gram = feature >= 0
    table[feature[gram], place[gram]] = n[gram]
    by_script[-1 - feature[~gram], place[~gram]] = n[~gram]
    loglik = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * BUCKETS)
    used = by_script / np.maximum(by_script.sum(axis=0), 1) >= 0.01
    return Model(langs, loglik, {s: list(map(bool, used[i])) for i, s in enumerate(names)})


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best path over (words x languages) with a penalty for every switch."""
    total = scores.sum(axis=0)
    best = int(total.argmax())
    # One language throughout is best if no stretch gains another one more than a single switch costs.
    gain = np.vstack([np.zeros(scores.shape[1]), np.cumsum(scores - scores[:, [best]], axis=0)])
    if (gain - np.minimum.accumulate(gain, axis=0)).max() <= penalty:
        return np.full(len(scores), best)
    state, came = scores[0].tolist(), []
    for row in scores[1:].tolist():
        top = max(range(len(state)), key=state.__getitem__)
        floor = state[top] - penalty
        came.append([i if s >= floor else top for i, s in enumerate(state)])
        state = [max(s, floor) + x for s, x in zip(state, row)]
    at = max(range(len(state)), key=state.__getitem__)
    path = [at]
    for back in reversed(came):
        at = back[at]
        path.append(at)
    return np.array(path[::-1])


def label(letters: np.ndarray, counted: np.ndarray, rows: np.ndarray, model: Model, penalty: float) -> tuple[str, float, str]:
    """Language, score and spans (lang:first word:last word, comma-joined) of a text's words by their letters,
    those of them that count for a label, and scores."""
    path = viterbi(rows, penalty)
    total = np.bincount(path, weights=counted, minlength=len(model.langs))
    best = int(total.argmax())
    cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
    spans = ",".join(f"{model.langs[path[a]]}:{a}:{b - 1}" for a, b in zip(cuts, cuts[1:]))
    return model.langs[best], float(total[best] / letters.sum()), spans


class WordTable:
    """Scores and letters of the words met so far, emptied when full, which doesn't change results."""

    def __init__(self, model: Model, bound: float, most: int):
        self.model, self.bound, self.most = model, bound, most
        self.place, self.scores, self.letters, self.counted = {}, np.zeros((0, len(model.langs))), np.zeros(0), np.zeros(0)

    def add(self, texts: list[list[str]]) -> None:
        new = list(set().union(*texts).difference(self.place))
        if len(self.place) + len(new) > self.most:
            self.__init__(self.model, self.bound, self.most)
            new = list(set().union(*texts))
        if new:
            self.place.update(zip(new, range(len(self.place), len(self.place) + len(new))))
            # What \w knows as a letter but isn't one, such as a superscript, has no letters and no say.
            letters = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in new], float)
            scores = np.where(letters[:, None] > 0, self.model.word_scores(new, self.bound), 0.0)
            self.scores, self.letters = np.concatenate([self.scores, scores]), np.concatenate([self.letters, letters])
            self.counted = np.concatenate([self.counted, np.where(self.model.has_candidate(new), letters, 0.0)])

    def judge(self, words: list[str], penalty: float) -> tuple[str, float, str]:
        ids = np.array([self.place[w] for w in words], int)
        letters = self.letters[ids]
        return label(letters, self.counted[ids], self.scores[ids], self.model, penalty) if letters.any() else ("und", 0.0, "")


def predict(docs: DataFrame, model: Model, extra: list[Column], penalty: float = 18.0, bound: float = 6.0,
            cached_words: int = 500_000) -> DataFrame:
    """The ``extra`` columns with lang_pred, score and spans. A text's words are its runs of letters, in lower case."""
    rows = docs.select(*extra, F.col("text").alias("_text"))
    shape = rows.drop("_text").schema.add("lang_pred", "string").add("score", "double").add("spans", "string")
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.loglik, model.scripts))

    def run(batches):
        known = WordTable(Model(*shared.value), bound, cached_words)
        for batch in batches:
            out = []
            for at in range(0, batch.num_rows, 256):
                texts = batch.column(batch.num_columns - 1)[at:at + 256].to_pylist()
                words = [LETTERS.findall(t.lower()) if t and known.model.langs else [] for t in texts]
                known.add(words)
                out += [known.judge(w, penalty) for w in words]
            made = [pa.array([x[k] for x in out], kind) for k, kind in enumerate((pa.string(), pa.float64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], "lang_pred", "score", "spans"])

    return rows.mapInArrow(run, shape)


def keep_known(docs: DataFrame, learnt: DataFrame, least: float = 0.4, **kw) -> DataFrame:
    """``docs`` without the texts of no language or without a language for ``least`` of their letters."""
    out = predict(docs, fit(learnt, **kw), [whole_row(docs)])
    return out.filter((F.col("lang_pred") != "und") & (F.col("score") >= least)).select("_row.*")
