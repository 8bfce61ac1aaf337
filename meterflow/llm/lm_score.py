"""LM scores by a subword lattice.

The vocabulary is that of an existing subword model; its order gives the first
unigram scores (Zipf's law over the rank), which rounds of expectation and
maximisation fit to the distinct training words. The lattice gives each word its
marginal probability over all segmentations into pieces. A word met in training
is one more piece, a whole one: its discounted share of the training words, and
what the discounts free goes to the lattice. The training texts fall into
classes (their languages); a class has shares of its own, and a text's
probability is summed over the classes: scoring looks at the text alone.

What is gathered from the corpus, the counts of all training words, is a Spark
table: words are counted per scan partition and summed by a shuffle, the lattice
runs over the distinct words of that table, and its values go back to the texts
in two ways: the most frequent ``head`` words, a bounded table, to every task; any
other word by a join of (text, word) rows. Both are exact.

The base score is an add-one word unigram over the same words. A word is a run
of anything but space and tab to carriage return, in ASCII lower case; each text
ends with one end token, which counts.

Defined cases: null text is empty and has the end token only; a null identifier
hashes as the empty text; rows that repeat are scored, and counted, each; with
no training text N and V are 0 and the vocabulary's first scores stand; null
classes, and those beyond the ``most_classes`` largest, are one class; words of
any length are scored whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import save
from .lattice import Lattice

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
END = "\n"            # stands for the end token: no word has one
END_WORD = END.encode()
LN10 = math.log(10)
FLUSH = 500_000


def read_vocabulary(path: str = VOCABULARY) -> list[str]:
    """Pieces by falling score; single bytes and control pieces left out."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    return [sp.id_to_piece(i) for i in sorted(ids, key=lambda i: (-sp.get_score(i), i))]


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8: on bytes, lower knows A-Z only, and split cuts at space and tab to carriage return."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def count_words(docs: DataFrame, kind: Column, kinds: int) -> DataFrame:
    """(word, seen, n0, n1, ...): occurrences of every word of the table, the end token among them, in all rows
    and in the training rows of each class; ``kind`` is a row's class, -1 if it isn't for training."""
    names = ["seen", *(f"n{k}" for k in range(kinds))]

    def run(batches):
        seen: dict[bytes, list[int]] = {}

        def flushed():
            columns = np.array(list(seen.values()), np.int64).reshape(-1, kinds + 1).T
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *map(pa.array, columns)], ["word", *names])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for text, k in zip(batch.column(0)[at:at + 256].to_pylist(), batch.column(1)[at:at + 256].to_pylist()):
                    for w, n in Counter([*words_of(text), END_WORD]).items():
                        x = seen.get(w)
                        if x is None:
                            x = seen[w] = [0] * (kinds + 1)
                        x[0] += n
                        if k >= 0:
                            x[k + 1] += n
                if len(seen) > FLUSH:
                    yield flushed()
                    seen.clear()
        yield flushed()
    counted = docs.select("text", kind.alias("kind")).mapInArrow(run, ", ".join(["word string", *(f"{n} long" for n in names)]))
    return counted.groupBy("word").agg(*[F.sum(n).alias(n) for n in names])


def fit_pieces(counts: DataFrame, pieces: list[str], rounds: int = 2, prior: float = 0.1) -> tuple[Lattice, float]:
    """The lattice with scores fitted to the words of ``counts`` (word), and the log chance to end. Per round, one
    number per piece reaches the driver."""
    spark = counts.sparkSession
    scores = -np.log(np.arange(len(pieces)) + 2.0)
    scores -= np.log(np.exp(scores).sum() * 1.01)
    lattice, end = Lattice(pieces, scores, np.full(256, math.log(0.005 / 256))), math.log(0.005)
    texts = counts.filter(F.col("word") == END).count()   # one distinct end token, if any
    for _ in range(rounds if texts else 0):
        shared = spark.sparkContext.broadcast(vars(lattice))

        def expect(batches):
            own = Lattice([], np.zeros(0), np.zeros(256))
            vars(own).update(shared.value)
            total = np.zeros(len(own.scores) + 256)
            for batch in batches:
                for at in range(0, batch.num_rows, 20_000):
                    words = batch.column(0)[at:at + 20_000].to_pylist()
                    _, uses, byte_uses = own.run(words, np.ones(len(words)))
                    total += np.concatenate([uses, byte_uses])
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.float64())], ["piece", "uses"])

        got = counts.filter(F.col("word") != END).mapInArrow(expect, "piece int, uses double")
        got = got.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()
        uses = np.full(len(lattice.scores) + 256, prior)
        np.add.at(uses, got["piece"].to_numpy(int), got["uses"].to_numpy(float))
        logs = np.log(uses) - math.log(uses.sum() + texts)
        lattice = Lattice(lattice.pieces, logs[:-256], logs[-256:])
        end = math.log(texts) - math.log(uses.sum() + texts)
        shared.unpersist()
    return lattice, end


def score(docs: DataFrame, extra: list[Column], learn: Column, class_col: str | None = "lang", vocabulary: str = VOCABULARY,
          head: int = 300_000, rounds: int = 2, discount: float = 0.7, most_classes: int = 16) -> DataFrame:
    """The ``extra`` columns with n_tokens, n_known, train_tokens, base_score and score (log10)."""
    spark = docs.sparkSession
    label = F.col(class_col) if class_col else F.lit(None).cast("string")
    sizes = docs.filter(learn).groupBy(label.alias("label")).count().orderBy(F.desc("count"), "label").limit(most_classes).collect()
    names = [r["label"] for r in sizes if r["label"] is not None]
    ks = range(len(names) + 1)   # the last class: all other rows
    kind = F.when(learn, F.coalesce(*[F.when(label == n, k) for k, n in enumerate(names)], F.lit(len(names)))).otherwise(-1)
    counts = save(count_words(docs, kind, len(ks)), "lm-counts")
    n_all = sum((F.col(f"n{k}") for k in ks), F.lit(0))
    got = counts.agg(F.sum((n_all > 0).cast("long")), *[F.sum(f"n{k}") for k in ks], *[F.sum((F.col(f"n{k}") > 0).cast("long")) for k in ks],
                     *[F.sum(F.when(F.col("word") == END, F.col(f"n{k}"))) for k in ks]).first()
    got = [x or 0 for x in got]
    kinds, tokens, types, texts = got[0], got[1:1 + len(ks)], got[1 + len(ks):1 + 2 * len(ks)], got[1 + 2 * len(ks):]
    total = sum(tokens)
    lattice, end = fit_pieces(counts.filter(n_all > 0).select("word"), read_vocabulary(vocabulary), rounds)
    shared = spark.sparkContext.broadcast(vars(lattice))
    columns = ["word", "seen", "n", *(f"s{k}" for k in ks)]

    def marginal(batches):
        own = Lattice([], np.zeros(0), np.zeros(256))
        vars(own).update(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 20_000):
                part = batch.slice(at, 20_000)
                words = part.column(0).to_pylist()
                logs = np.where([w == END for w in words], end, own.run([w if w != END else "" for w in words])[0])
                seen = [part.column(2 + k).to_numpy() for k in ks]
                with np.errstate(divide="ignore"):
                    made = [np.logaddexp(np.log(np.maximum(x - discount, 0) / max(1, n)), np.log(discount * v / n if n else 1.0) + logs) / LN10
                            for x, n, v in zip(seen, tokens, types)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sum(seen)), *map(pa.array, made)], columns)

    words = save(counts.mapInArrow(marginal, "word string, seen long, n long, " + ", ".join(f"s{k} double" for k in ks)), "lm-words")
    # The least count of the head: classes of counts, a few hundred at most, from the largest down.
    step = F.floor(F.log2("seen") * 8)
    sizes = words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("kinds"), F.min("seen").alias("least")).orderBy(F.desc("step")).collect()
    least, room = None, head
    for r in sizes:
        room -= r["kinds"]
        if room < 0:
            break
        least = r["least"]
    frequent = words.filter(F.col("seen") >= least).drop("seen").toPandas() if least is not None else None
    table = spark.sparkContext.broadcast(None if frequent is None else (
        frequent["word"].tolist(), frequent[["n", *columns[3:]]].to_numpy(float)))
    base = math.log10(total + kinds + 1)
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), *extra, F.col("text").alias("_text"))
    sums = ["_base", "_known", *(f"_s{k}" for k in ks)]
    shape = rows.drop("_text").schema.add("n_tokens", "long")
    for c in sums:
        shape = shape.add(c, "double")
    shape = shape.add("_rest", T.ArrayType(T.StringType()))

    def first(batches):
        frequent, values = table.value or ([], np.zeros((0, 1 + len(ks))))
        place = {w.encode(): i for i, w in enumerate(frequent)}
        values = np.column_stack([np.log10(values[:, 0] + 1) - base, values[:, 0] > 0, values[:, 1:]])
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, out, rest = batch.slice(at, 256), [], []
                for text in part.column(part.num_columns - 1).to_pylist():
                    words = [*words_of(text), END_WORD]
                    ids = [place.get(w, -1) for w in words]
                    hits = [i for i in ids if i >= 0]
                    rest.append([w for w, i in zip(words, ids) if i < 0] if len(hits) < len(words) else [])
                    out.append([len(words), *values[hits].sum(axis=0)])
                made = list(np.array(out).T)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(made[0].astype(np.int64)), *map(pa.array, made[1:]),
                                                  pa.array(rest, pa.list_(pa.string()))], shape.fieldNames())

    parts = save(rows.mapInArrow(first, shape), "lm-parts")
    rest = parts.select("_row", F.explode("_rest").alias("word")).groupBy("_row", "word").agg(F.count(F.lit(1)).alias("times"))
    each = [F.log10(F.col("n") + 1) - F.lit(base), (F.col("n") > 0).cast("double"), *(F.col(f"s{k}") for k in ks)]
    rest = rest.join(words.drop("seen"), "word").groupBy("_row").agg(*[F.sum(F.col("times") * x).alias(f"rest{c}") for x, c in zip(each, sums)])
    whole = {c: F.col(c) + F.coalesce(F.col(f"rest{c}"), F.lit(0.0)) for c in sums}
    n_texts = sum(texts)
    of_class = [whole[f"_s{k}"] + math.log10(texts[k] / n_texts if n_texts else 1 / len(ks)) for k in ks if texts[k] or not n_texts]
    best = F.greatest(*of_class) if len(of_class) > 1 else of_class[0]
    score = best + F.log10(sum((F.pow(F.lit(10.0), x - best) for x in of_class), F.lit(0.0)))
    return parts.drop("_rest").join(rest, "_row", "left").select(
        *[c for c in rows.columns if not c.startswith("_")], "n_tokens", whole["_known"].cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), whole["_base"].alias("base_score"), score.alias("score"))
