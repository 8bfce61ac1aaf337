"""License scan by canonical digests.

A text is reduced to a canonical form (ASCII lower case, copyright lines gone,
equivalent spellings made one, everything but letters and digits a single
space), and the SHA-256 of the whole form is joined to the digests of the known
licences in the same form. Two units are looked up: the whole text, and each of
its lines as a text of its own, which finds licence notices inside longer
documents. Whole texts never leave the scan: only (id, row number, digest) rows are joined.

Defined cases: null text counts as empty; an empty canonical form matches
nothing; a known text given twice counts once under its smallest name; repeated
rows give repeated results; an empty table gives no row; input columns other
than the identifier and the text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import ascii_lower
from .license_texts import EQUIVALENT, KNOWN

# Patterns valid alike in Java and RE2.
COPYRIGHT_LINE = r"(^|\n)[^\pL\pN\n]*(copyright|\(c\)|©)[^\n]*"
OTHER = r"[^\pL\pN]+"


def canonical(text: Column) -> Column:
    """The canonical form of a text."""
    c = F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), COPYRIGHT_LINE, " ")
    # Two spaces between words: each has its own on either side for the patterns.
    c = F.concat(F.lit(" "), F.regexp_replace(c, OTHER, "  "), F.lit(" "))
    for pattern, word in EQUIVALENT:
        c = F.regexp_replace(c, pattern, word)
    return F.trim(F.regexp_replace(c, " +", " "))


def known_digests(spark: SparkSession, known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """(known_digest, license_id): the parameter's texts in canonical form."""
    texts = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("license_id"), F.lit(t).alias("licence_text")) for n, t in known])))
    form = texts.select("license_id", canonical(F.col("licence_text")).alias("form")).filter("form <> ''")
    return form.groupBy(F.sha2(F.col("form"), 256).alias("known_digest")).agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, id_col: str = "doc_id", known: list[tuple[str, str]] = KNOWN) -> DataFrame:
    """Per row: the identifier, canonical_sha256, license_id of the whole text (null: none),
    n_license_lines and line_licenses (sorted names, comma-joined) of its lines."""
    table = known_digests(docs.sparkSession, known)
    # Every row is numbered once, then read as its whole text and its lines; the number brings them together again.
    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), "text")
    units = rows.select("id", "row", F.explode(F.concat(
        F.array(F.struct(F.lit(True).alias("whole"), F.col("text").alias("text"))),
        F.coalesce(F.transform(F.split("text", "\n"), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text"))),
                   F.array().cast("array<struct<whole:boolean,text:string>>")))).alias("unit"))
    units = units.select("id", "row", "unit.whole", F.sha2(canonical(F.col("unit.text")), 256).alias("known_digest"))
    units = units.join(table, "known_digest", "left").filter("whole or license_id is not null")
    line = F.when(~F.col("whole"), F.col("license_id"))
    found = units.groupBy("row", "id").agg(
        F.max(F.when(F.col("whole"), F.col("known_digest"))).alias("canonical_sha256"),
        F.max(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
        F.count(line).alias("n_license_lines"),
        F.array_join(F.array_sort(F.collect_set(line)), ",").alias("line_licenses"))
    return found.select(F.col("id").alias(id_col), "canonical_sha256", "license_id", "n_license_lines", "line_licenses")
