"""Personal data by weak supervision: labelers vote, their reliabilities are estimated, a span classifier decides.

Every kind has a base pattern, whose matches are spans if they pass its check, and a second pattern for forms that the
base misses (a number beside other digits, a national phone number, an address written with "(at)", IPv6). The matches
of both, failing ones too, are candidates. Five labelers vote for, against or not at all on each: the form of the match
(regex), its check (Luhn, ranges, number of digits), lists of known prefixes and endings (gazetteer), the words before
it (context) and the characters beside it (edge). Per kind, expectation-maximisation over the counts of vote patterns
(at most 3^5 each) estimates how often each labeler votes which way on true and on other spans, and with that every
candidate's probability. These probabilities train a naive Bayes classifier of votes and shape features with a bounded
number of values. A match of the second pattern that passes its check becomes a span if the classifier favours it
and no base span, nor one found before it, overlaps it. Base spans stay whatever it says.

Positions are code points, ends exclusive. Java's forms of the patterns are possessive and start where a run of their
characters starts, or where the last match ended, which matches the same in linear time and without deep recursion.

Defined cases: a null text counts as empty; a text without matches has no spans and an empty list; rows are numbered,
so repeated rows and rows that share an identifier, null or not, each keep their own spans; an empty table gives
no row; other columns of the input are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import ascii_lower, save


@dataclass(frozen=True)
class Labeler:
    """Votes -1 where ``against`` is found in the subject, else 1 where ``favour`` is, else 0."""
    name: str
    subject: str
    favour: str
    against: str


@dataclass(frozen=True)
class Kind:
    name: str
    base: str           # as contracted
    base_java: str
    extra: str
    extra_java: str
    labelers: tuple[Labeler, ...]


# Patterns, cue words, prefixes and endings. Labelers' patterns mean the same in Java, RE2 and Python.
_CHECK = Labeler("check", "valid", "true", "false")
_EDGE = Labeler("edge", "edge", r"""^[ \n\t"'(<,;:|\[]?~[ \n\t"')>,;:.!?|\]]?$""", r"^[A-Za-z0-9_/=.@-]~|~[A-Za-z0-9_/=@-]")


def _context(cues: str, others: str) -> Labeler:
    return Labeler("context", "before", rf"(^|[^a-z])({cues})[^a-z0-9]*([a-z]+[^a-z0-9]+){{0,3}}$", rf"(^|[^a-z])({others})[^a-z0-9]*$")


KINDS = (
    Kind("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
         r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
         r"[A-Za-z0-9._%+-]+ ?[\[(]at[\])] ?[A-Za-z0-9-]+( ?(\.|[\[(]dot[\])]) ?[A-Za-z0-9-]+)+",
         r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++",
         (Labeler("form", "plain", r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9.-]{1,253}\.[A-Za-z]{2,24}$", r"\.\.|^[._%+-]|@-|-\.|@[0-9.]+$"),
          _CHECK,
          Labeler("gazetteer", "plain", r"\.(com|org|net|edu|gov|int|info|biz|io|at|au|be|br|ca|ch|cn|de|es|eu|fr|in|it|jp|mx|nl|uk|us)$",
                  r"\.(gif|html|invalid|jpg|js|local|png|py|test|txt)$"),
          _context("address|adresse|contact|correo|courriel|e-?mail|kontakt|mail|reach|write", "commit|git|package|ssh|version"), _EDGE)),
    Kind("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
         r"[0-9A-Fa-f]{1,4}(:[0-9A-Fa-f]{1,4}){7}", r"[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}",
         (Labeler("form", "plain", r"^(0|[1-9][0-9]{0,2})(\.(0|[1-9][0-9]{0,2})){3}$|:", r"(^|\.)0[0-9]|[0-9]{4}\.|\.[0-9]{4}"), _CHECK,
          Labeler("gazetteer", "plain", r"^([1-9]|[1-9][0-9]|1[0-9][0-9]|2[01][0-9]|22[0-3])\.|^(2|3|fc|fd|fe80)[0-9A-Fa-f]*:", r"^(0|127|22[4-9]|2[3-5][0-9])\."),
          _context("address|adresse|client|from|gateway|host|ip|login|peer|server|servidor", "build|chapter|firmware|release|section|v|version"), _EDGE)),
    Kind("card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?[0-9])++",
         r"[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|3[47][0-9]{2} [0-9]{6} [0-9]{5}|[0-9]{13,19}",
         r"[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}|3[47][0-9]{2} [0-9]{6} [0-9]{5}|[0-9]{13,19}",
         (Labeler("form", "plain", r"^([0-9]{13,19}|[0-9]{4}( [0-9]{4}){3}|[0-9]{4}(-[0-9]{4}){3}|3[47][0-9]{2} [0-9]{6} [0-9]{5})$", r" .*-|-.* |[0-9]{20}"), _CHECK,
          Labeler("gazetteer", "digits", r"^(2[2-7]|30[0-5]|3[4-8]|4|5[1-5]|6011|62|64[4-9]|65)", r"^[01789]"),
          _context("amex|card|carte|credit|debit|karte|mastercard|payment|tarjeta|visa", "account|iban|id|invoice|isbn|order|serial|token|tracking"), _EDGE)),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]",
         r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|00[1-9][0-9 ().-]{7,18}[0-9]", r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}|00[1-9][0-9 ().-]{7,18}[0-9]",
         (Labeler("form", "plain", r"^(\+|00)[1-9][0-9]{0,2}[ .-]?\(?[0-9]{1,4}\)?([ .-]?[0-9]{2,4}){1,4}$|^\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}$",
                  r"[ .()-]{3}|\([^)]*$|^[^(]*\)"), _CHECK,
          Labeler("gazetteer", "plain", r"^(\+|00)(1|20|27|3[0-4]|36|39|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])", r"^(\+|00)(0|888|999)"),
          _context("call|cell|contact|fax|mobile|phone|sms|tel|telefon|telefono|whatsapp", "id|invoice|isbn|order|ref|token|version"), _EDGE)))
VOTES = len(KINDS[0].labelers)
#: What each vote weighs before reliabilities are known: the check most.
FIRST_WEIGHTS = (1.0, 4.0, 1.0, 1.5, 2.0)
#: Characters before and after a match that labelers see, no further than the next match of the same pattern.
BEFORE, AFTER = 40, 1
#: Numbers this short are no candidates of a card.
LEAST_DIGITS = 11
#: Shape features as SQL that Spark and DuckDB read alike; each has a bounded number of values.
ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
SHAPES = {"length": "CAST(least(length(plain), 40) AS STRING)", "n_digits": "CAST(least(length(digits), 24) AS STRING)",
          "marks": f"substr(translate(plain, '{ALNUM}', ''), 1, 2)", "head": "substr(digits, 1, 2)"}


def luhn(digits: Column) -> Column:
    """Whether a text of digits passes Luhn's check."""
    reverse = F.transform(F.split(F.reverse(digits), ""), lambda d: d.cast("int"))
    doubled = F.transform(reverse, lambda d, i: F.when(i % 2 == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0))) % 10 == 0


def _valid(kind: Column, hit: Column, digits: Column, extra: Column, edge: Column) -> Column:
    n = F.length(digits)
    ip = F.forall(F.split(hit, r"\."), lambda x: x.rlike("^0*([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    ok = (F.when(kind == "ip", extra | ip).when(kind == "card", F.when(n.between(13, 19), luhn(digits)).otherwise(False))
          .when(kind == "phone", n.between(9, 15)).otherwise(True))
    return ok & ~(extra & edge.rlike("[0-9]"))


def matches(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, row, kind, extra, start, end, hit, before, after) of every match of all patterns, and a row of
    (id, row) for every row of ``docs``."""
    empty = F.array().cast("array<struct<p:int,i:int,gap:int,hit:string,before:string,after:string>>")

    def found(p: int, pattern: str) -> Column:
        text = F.col("text")
        both = F.array(F.struct(F.split(text, pattern, -1).alias("g"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("h")))
        pieces = F.flatten(F.transform(both, lambda s: F.arrays_zip(
            s["g"].alias("g"), s["h"].alias("h"), F.slice(s["g"], F.lit(2), F.size(s["g"])).alias("n"))))
        made = F.transform(pieces, lambda x, i: F.struct(
            F.lit(p).alias("p"), i.alias("i"), F.length(x["g"]).alias("gap"), x["h"].alias("hit"),
            F.right(x["g"], F.lit(BEFORE)).alias("before"), F.left(x["n"], F.lit(AFTER)).alias("after")))
        return F.when(text.rlike(pattern), F.filter(made, lambda x: x["hit"].isNotNull())).otherwise(empty)

    patterns = [x for k in KINDS for x in (k.base_java, k.extra_java)]
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    mark = F.struct(F.lit(-1).alias("p"), F.lit(0).alias("i"), F.lit(0).alias("gap"), F.lit("").alias("hit"), F.lit("").alias("before"), F.lit("").alias("after"))
    pieces = rows.select("id", "row", F.explode(F.concat(F.array(mark), *[found(p, x) for p, x in enumerate(patterns)])).alias("x"))
    pieces = pieces.select("id", "row", "x.*")
    upto = Window.partitionBy("row", "p").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.length("hit")).over(upto)
    kind = F.get(F.array(*[F.lit(k.name) for k in KINDS]), F.floor(F.col("p") / 2).cast("int"))
    return pieces.select("id", "row", F.when(F.col("p") >= 0, kind).alias("kind"), (F.col("p") % 2 == 1).alias("extra"),
                         (end - F.length("hit")).alias("start"), end.alias("end"), "hit", "before", "after")


def candidates(found: DataFrame) -> DataFrame:
    """Matches with valid (bool), their votes v0.. and shape features f_..; rows without a kind stay as they are."""
    plain = F.regexp_replace(F.regexp_replace("hit", r" ?[\[(]at[\])] ?", "@"), r" ?([\[(]dot[\])]|\.) ?", ".")
    df = found.select("*", F.regexp_replace("hit", "[^0-9]", "").alias("digits"),
                      F.when(F.col("kind") == "email", plain).otherwise(F.col("hit")).alias("plain"),
                      F.concat(F.right("before", F.lit(1)), F.lit("~"), "after").alias("edge"))
    df = df.withColumn("ok", _valid(F.col("kind"), F.col("hit"), F.col("digits"), F.col("extra"), F.col("edge")))
    df = df.filter("kind is null or kind <> 'card' or ok or extra or length(digits) >= %d" % LEAST_DIGITS)
    subject = {"valid": F.col("ok").cast("string"), "before": ascii_lower(F.col("before")), **{c: F.col(c) for c in ("plain", "digits", "edge")}}

    def vote(j: int) -> Column:
        out = F.lit(0)
        for k in KINDS:
            x = k.labelers[j]
            s = subject[x.subject]
            out = F.when(F.col("kind") == k.name, F.when(s.rlike(x.against), -1).when(s.rlike(x.favour), 1).otherwise(0)).otherwise(out)
        return out.alias(f"v{j}")

    return df.select("id", "row", "kind", "extra", F.col("ok").alias("valid"), "start", "end", *[vote(j) for j in range(VOTES)],
                     *[F.expr(e).alias(f"f_{n}") for n, e in SHAPES.items()])


def _lookup(table: dict[str, float], key: Column) -> Column:
    """The value of a key, 0 if it has none."""
    if not table:
        return F.lit(0.0)
    return F.coalesce(F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])[key], F.lit(0.0))


def _log_odds(model: dict[str, float], parts: dict[str, Column]) -> Column:
    """Prior and evidence of a kind's features; ``parts`` names each feature's value."""
    return sum((_lookup({k[len(n) + 1:]: w for k, w in model.items() if k.startswith(f"{n}|")}, F.concat_ws("|", "kind", v))
                for n, v in parts.items()), _lookup({k[6:]: w for k, w in model.items() if k.startswith("prior|")}, F.col("kind")))


def _model(weights: list) -> dict[str, float]:
    """Log odds of each kind and of each of its features' values, from (kind, name, value, yes, no). Either share is
    smoothed towards that of the value among all, so that a rare value tells little."""
    model: dict[str, float] = {}
    groups: dict[tuple, list] = {}
    for kind, name, value, yes, no in weights:
        groups.setdefault((kind, name), []).append((value, yes, no))
    for (kind, name), rows in groups.items():
        all_yes, all_no, n = sum(r[1] for r in rows), sum(r[2] for r in rows), len(rows)
        model[f"prior|{kind}"] = math.log((all_yes + 1) / (all_no + 1))
        for value, yes, no in rows:
            some = n * (yes + no) / (all_yes + all_no)
            model[f"{name}|{kind}|{value}"] = math.log((yes + some) / (all_yes + n)) - math.log((no + some) / (all_no + n))
    return model


def _weigh(df: DataFrame, parts: dict[str, Column], weight: Column, odds: Column) -> dict[str, float]:
    """Fit a model to the rows' probabilities; the rows sent to the driver are the features' values."""
    p = (F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))).alias("p")
    each = df.select("kind", weight.alias("n"), p, F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), v.cast("string").alias("value")) for n, v in parts.items()])).alias("x"))
    return _model([tuple(r) for r in each.groupBy("kind", "x.name", "x.value").agg(
        F.sum(F.col("n") * F.col("p")), F.sum(F.col("n") * (F.lit(1.0) - F.col("p")))).collect()])


def reliabilities(cands: DataFrame, rounds: int = 8) -> dict[str, float]:
    """Log odds of every labeler's votes per kind, by expectation-maximisation over the counts of vote patterns."""
    votes = {f"v{j}": F.col(f"v{j}") for j in range(VOTES)}
    patterns = save(cands.groupBy("kind", *votes).count(), "vote-patterns")
    odds = sum((F.col(f"v{j}") * FIRST_WEIGHTS[j] for j in range(VOTES)), F.lit(0.0))
    model: dict[str, float] = {}
    for _ in range(rounds):
        model = _weigh(patterns, votes, F.col("count"), odds)
        odds = _log_odds(model, votes)
    return model


def scan(docs: DataFrame, id_col: str = "doc_id", rounds: int = 8) -> DataFrame:
    """Per row: the identifier, row number and findings (array of k, start, end, kind, base), by kind, then start."""
    table = save(candidates(matches(docs, id_col)), "pii-candidates")
    cands = table.filter("kind is not null")
    votes = {f"v{j}": F.col(f"v{j}") for j in range(VOTES)}
    parts = {**votes, **{f"f_{n}": F.col(f"f_{n}") for n in SHAPES}}
    final = _weigh(cands, parts, F.lit(1), _log_odds(reliabilities(cands, rounds), votes))
    table = table.withColumn("base", F.col("valid") & ~F.col("extra"))
    spans = table.filter(F.col("kind").isNull() | F.col("base") | (F.col("extra") & F.col("valid") & (_log_odds(final, parts) > 0)))
    order = Window.partitionBy("row").orderBy("start", F.desc("base"), F.desc("end"), "kind")
    real = F.col("kind").isNotNull()
    before = F.max(F.when(real, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(real & F.col("base"), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    free = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    spans = spans.withColumn("free", free)
    k = F.array_position(F.array(*[F.lit(x.name) for x in KINDS]), F.col("kind")).cast("int")
    span = F.when(real & (F.col("base") | F.col("free")), F.struct(k.alias("k"), "start", "end", "kind", "base"))
    return spans.groupBy("row", F.col("id").alias(id_col)).agg(F.array_sort(F.collect_list(span)).alias("findings"))


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest columns of the findings: counts and digest of the base spans, all spans, how many were added."""
    base = F.filter("findings", lambda x: x["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k.name) for k in KINDS]
    return found.select(id_col, *counts, F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.col("findings")).alias("spans"), F.size(F.filter("findings", lambda x: ~x["base"])).cast("long").alias("n_added"))
