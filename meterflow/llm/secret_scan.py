"""Secret scan over an incremental ledger of content-addressed blobs.

Every version of a text is addressed by its SHA-256. The ledger, a table in a
shared folder, holds for each blob the rule versions it was scanned with and
what they found. A run reads the ledger, scans only the blobs (one copy of
each) that lack a rule version, appends the outcome and joins the findings of
the current rule versions back to all paths. Positions are code points: the pieces between the matches and the
matches themselves, in order, add up to them.

Defined cases: a null text is the empty text; repeated rows, and paths that
share a text, each get that text's findings; two rules may report one place;
an empty table gives no row; other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import save, shared_dir


@dataclass(frozen=True)
class Rule:
    """``group`` of ``pattern`` is the secret; matches whose secret is shorter than ``least`` are dropped."""
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1

    @property
    def tag(self) -> str:
        return f"{self.kind}@{self.version}"


# Fixed values. A run of 24+ hex digits is what [0-9a-f]+ matches and the length
# keeps, and likewise for AKIA: the bounds are in the patterns there.
RULES = [
    Rule("assign", 1, r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", 1, r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", 1, r"xox[abprs]-[A-Za-z0-9-]{10,}"),
]
BASE = 3   # the first rules of the list are the base ones
SPAN = "start:bigint,rule:int,kind:string,end:bigint,version:int"


def _hits(rule: Rule, number: int, text: Column, missing: Column) -> Column:
    """Gap lengths, match lengths and secret lengths of a rule over a text; null
    if the rule was run on that blob before or finds nothing."""
    p = F.lit(rule.pattern)
    pieces = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), F.regexp_extract_all(text, p, F.lit(0)).alias("hit"),
                          F.regexp_extract_all(text, p, F.lit(rule.group)).alias("secret"))
    sizes = F.transform(pieces, lambda x: F.struct(F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("hit"),
                                                   F.length(x["secret"]).alias("secret")))
    return F.when(F.array_contains(missing, rule.tag) & text.rlike(rule.pattern), F.struct(
        F.lit(number).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"),
        F.lit(rule.least).alias("least"), sizes.alias("sizes")))


def scan_blobs(blobs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(blob, findings) of the blobs (blob, text, missing) with any; findings in order of start, then rule."""
    found = blobs.select("blob", F.explode(F.array_compact(F.array(*[
        _hits(r, i, F.col("text"), F.col("missing")) for i, r in enumerate(rules)]))).alias("x"))
    piece = found.select("blob", "x.rule", "x.kind", "x.version", "x.least", F.posexplode("x.sizes").alias("i", "size"))
    # A text that stands in two rows under one identifier was read twice.
    piece = piece.filter("size.hit is not null").dropDuplicates(["blob", "rule", "i"])
    before = Window.partitionBy("blob", "rule").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("size.gap").cast("long") + F.col("size.hit")).over(before)
    spans = piece.select("blob", "rule", "kind", "version", "least", (end - F.col("size.hit")).alias("start"), end.alias("end"),
                         F.col("size.secret").alias("secret")).filter("secret >= least")
    return spans.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rule", "kind", "end", "version"))).alias("findings"))


def scan(versions: DataFrame, id_col: str = "doc_id", ledger: str | None = None, rules: list[Rule] = RULES) -> DataFrame:
    """Per row of ``versions``: the identifier, blob and findings (array of start, rule, kind, end, version),
    of the rule versions given, whatever others the ledger knows.

    ``ledger`` is a folder kept between runs; a fresh one if not given."""
    spark = versions.sparkSession
    ledger = ledger or shared_dir(spark, "ledger")
    blob = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    paths = save(versions.select(F.col(id_col).alias("id"), blob.alias("blob")), "blob-paths")
    schema = f"blob string, rules array<string>, findings array<struct<{SPAN}>>"
    # The folder exists from here on, with the batches of earlier runs if any.
    spark.createDataFrame([], schema).write.mode("append").parquet(ledger)
    seen = spark.read.schema(schema).parquet(ledger).groupBy("blob").agg(
        F.array_distinct(F.flatten(F.collect_list("rules"))).alias("rules"))
    wanted = F.array(*[F.lit(r.tag) for r in rules])
    todo = (paths.groupBy("blob").agg(F.max("id").alias("id")).join(seen, "blob", "left")
            .select("blob", "id", F.array_except(wanted, F.coalesce("rules", F.array().cast("array<string>"))).alias("missing"))
            .filter("size(missing) > 0"))
    todo = save(todo, "blob-todo")
    text = versions.select(F.col(id_col).alias("read_id"), F.coalesce("text", F.lit("")).alias("text"))
    text = text.withColumn("read_blob", F.sha2(F.col("text").cast("binary"), 256))
    read = text.join(todo, F.col("read_id").eqNullSafe(F.col("id")) & (F.col("read_blob") == F.col("blob")))
    found = scan_blobs(read.select("blob", "text", "missing"), rules)
    batch = todo.join(found, "blob", "left").select(
        "blob", F.col("missing").alias("rules"), F.coalesce("findings", F.array().cast(f"array<struct<{SPAN}>>")).alias("findings"))
    batch.write.mode("append").parquet(ledger)

    def current(x: Column) -> Column:
        """The finding under its rule's number now, null if its rule version is not among ``rules``."""
        # A finding of an older ledger has no version: it is that of its batch.
        prefix = F.concat(x["kind"], F.lit("@"))
        tag = F.coalesce(F.concat(prefix, x["version"]), F.get(F.filter("rules", lambda t: t.startswith(prefix)), F.lit(0)))
        return F.struct(x["start"].alias("start"), (F.nullif(F.array_position(wanted, tag), F.lit(0)) - 1).cast("int").alias("rule"),
                        x["kind"].alias("kind"), x["end"].alias("end"), x["version"].alias("version"))

    known = (spark.read.schema(schema).parquet(ledger).filter("size(findings) > 0")
             .select("blob", F.filter(F.transform("findings", current), lambda x: x["rule"].isNotNull()).alias("findings"))
             .groupBy("blob").agg(F.array_sort(F.flatten(F.collect_list("findings"))).alias("findings")))
    return paths.join(known, "blob", "left").select(
        F.col("id").alias(id_col), "blob", F.coalesce("findings", F.array().cast(f"array<struct<{SPAN}>>")).alias("findings"))


def spans_text(findings: Column) -> Column:
    return F.array_join(F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def report(found: DataFrame, id_col: str = "doc_id", rules: list[Rule] = RULES, base: int = BASE) -> DataFrame:
    """The digest columns of the findings: counts of the base kinds, their digest, all spans."""
    def of(kind: str) -> Column:
        return F.filter("findings", lambda x: x["kind"] == kind)
    counts = [F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in rules[:base]]
    first = F.filter("findings", lambda x: x["rule"] < base)
    return found.select(id_col, *counts, F.sha2(spans_text(first).cast("binary"), 256).alias("base_sha256"),
                        spans_text(F.col("findings")).alias("spans"))
