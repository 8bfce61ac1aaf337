"""URL filter: character language models of accepted and rejected URLs.

Host rules decide what they cover; the URLs they accept and reject teach two
variable-order Markov models over characters, and the difference of a URL's
log-likelihoods per character, against a calibrated threshold, decides the
rest. A model's prediction blends the orders from 0 up to ``ORDER``: each
context gives its weight to the order below in proportion to the number of
different characters seen after it (Witten-Bell), an unseen context all of it.
The threshold is the one with the least balanced error on a fifth of the
covered URLs that the models did not learn from.

Gram counts stay in Spark tables keyed by the gram; a URL is scored by a join
of its grams, not by a model on the driver.

Defined cases: a null URL, or one without ://, has an empty host and path and
is judged by its whole text (null: empty); a URL without characters, and every
URL while one model has learnt nothing, has difference 0 and is allowed;
repeated URLs are scored once and judged alike; an empty table gives no row;
other input columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import ascii_lower, save

ORDER = 3
ALPHABET = 256   # characters that the order below 0 takes to be equally likely
PAD = "\u0002"


@dataclass(frozen=True)
class HostRule:
    verdict: str
    rule: str    # host/path prefix

    @property
    def host(self) -> str:
        return self.rule.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.rule.partition("/")[2]


# Fixed values.
RULES = [HostRule("allow", "org/"), HostRule("block", "example.org/es/"), HostRule("block", "example.org/en/1"),
         HostRule("allow", "com/fr/"), HostRule("block", "com/de/")]


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[HostRule]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does."""
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("verdict")))
            for r in sorted(rules, key=lambda r: (-len(r.rule), r.rule))]
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def _grams(urls: DataFrame, order: int) -> DataFrame:
    """(body, label, gram) of every character with the ``order`` ones before it."""
    padded = F.concat(F.lit(PAD * order), F.col("body"))
    return urls.select("*", F.explode(F.sequence(F.lit(1), F.length("body"))).alias("i")).select(
        "body", "label", F.substring(padded, F.col("i"), F.lit(order + 1)).alias("gram"))


def gram_ratios(learn: DataFrame, wanted: DataFrame, order: int = ORDER) -> DataFrame:
    """``learn``: gram, n_allow, n_block. ``wanted``: distinct grams. Per wanted gram, its log
    probability among the accepted less that among the rejected."""
    out = wanted.withColumns({"p_allow": F.lit(1.0 / ALPHABET), "p_block": F.lit(1.0 / ALPHABET)})
    for k in range(order + 1):
        of_order = learn.groupBy(F.substring("gram", order - k + 1, k + 1).alias("tail")).agg(
            *[F.sum(f"n_{c}").alias(f"n_{c}") for c in ("allow", "block")])
        contexts = of_order.groupBy(F.substring("tail", 1, k).alias("context")).agg(*[x for c in ("allow", "block") for x in (
            F.sum(f"n_{c}").alias(f"all_{c}"), F.sum((F.col(f"n_{c}") > 0).cast("long")).alias(f"kinds_{c}"))])
        out = out.withColumns({"tail": F.substring("gram", order - k + 1, k + 1), "context": F.substring("gram", order - k + 1, k)})
        out = out.join(of_order, "tail", "left").join(contexts, "context", "left").drop("tail", "context")
        for c in ("allow", "block"):
            n, total, kinds = (F.coalesce(F.col(f"{x}_{c}"), F.lit(0)) for x in ("n", "all", "kinds"))
            out = out.withColumn(f"p_{c}", F.when(total > 0, (n + kinds * F.col(f"p_{c}")) / (total + kinds)).otherwise(F.col(f"p_{c}")))
        out = out.select("gram", "p_allow", "p_block")
    return out.select("gram", (F.log("p_allow") - F.log("p_block")).alias("ratio"))


def threshold(scored: DataFrame, step: float = 0.01, bound: float = 8.0) -> float:
    """``scored``: label (allow, block) and ratio. The cut, of those ``step`` apart within ``bound``, with the
    least sum of the two error rates; of equal cuts the smallest; 0 if a label is missing."""
    cell = F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), F.col("ratio"))) / step).cast("long")
    cells = scored.groupBy(cell.alias("cell")).agg(*[F.sum((F.col("label") == c).cast("long")).alias(c) for c in ("allow", "block")])
    cells = [tuple(r) for r in cells.orderBy("cell").collect()]   # 2 * bound / step + 1 rows at most
    n_allow, n_block = sum(r[1] for r in cells), sum(r[2] for r in cells)
    if not n_allow or not n_block:
        return 0.0
    best, cut, lost, caught = 1.0, cells[0][0], 0, 0
    for c, allow, block in cells:
        lost, caught = lost + allow, caught + block
        error = lost / n_allow + 1 - caught / n_block
        if error < best:
            best, cut = error, c + 1
    return cut * step


def judge(pages: DataFrame, id_col: str = "page_id", rules: list[HostRule] = RULES, order: int = ORDER) -> DataFrame:
    """Per row: the identifier, host, path, rule (null: none), verdict, and ratio, the difference per character."""
    url = F.coalesce("url", F.lit(""))
    body = ascii_lower(F.when(url.contains("://"), F.regexp_extract(url, r"(?s)://(.*)", 1)).otherwise(url))
    rows = pages.select(F.col(id_col).alias("id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                        body.alias("body"))
    rows = save(rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules)), "url-rows")
    # A URL in lower case may be covered in one writing and not in another: any cover teaches.
    urls = save(rows.groupBy("body").agg(F.max("hit.verdict").alias("label")), "urls")
    urls = urls.withColumn("fold", F.conv(F.substring(F.md5(F.col("body").cast("binary")), 1, 4), 16, 10).cast("long") % 5)
    counts = _grams(urls.filter("label is not null and fold > 0"), order).groupBy("gram").agg(
        *[F.sum((F.col("label") == c).cast("long")).alias(f"n_{c}") for c in ("allow", "block")])
    counts = save(counts, "url-counts")
    learnt = counts.agg(F.sum("n_allow"), F.sum("n_block")).first()
    if learnt[0] and learnt[1]:
        grams = _grams(urls, order).groupBy("body", "gram").agg(F.count(F.lit(1)).alias("n"))
        ratios = save(gram_ratios(counts, grams.select("gram").distinct(), order), "url-ratios")
        sums = grams.join(ratios, "gram").groupBy("body").agg((F.sum(F.col("n") * F.col("ratio")) / F.sum("n")).alias("ratio"))
        scores = save(urls.join(sums, "body", "left").select("body", "label", "fold", F.coalesce("ratio", F.lit(0.0)).alias("ratio")), "url-scores")
        cut = threshold(scores.filter("label is not null and fold = 0"))
    else:
        scores, cut = urls.select("body", F.lit(0.0).alias("ratio")), 0.0
    by_model = F.when((F.col("ratio") < cut) & (F.length("body") > 0), "block").otherwise("allow")
    return rows.join(scores.select("body", "ratio"), "body").select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.verdict", by_model).alias("verdict"), "ratio")
