"""Operator 9: URL filter by rules and a character language-model ratio (DataFrame functions only).

Longest-rule-wins decides the URLs it covers.  Those decisions train two
smoothed variable-order Markov models, of accepted and of rejected URLs; any
other URL is judged by the length-normalised log-likelihood difference against
a threshold calibrated on held-out URLs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import spill

#: Longest gram: five characters of context.  Characters are those of the URL.
ORDERS = 6
#: Stands before a URL, as the context of its first characters.
START = "\u0002"


@dataclass(frozen=True)
class UrlRule:
    """Fits its host and all subdomains when the path starts with the rule's path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        return (((F.col("host") == self.host) | F.col("host").endswith("." + self.host))
                & F.col("path").startswith(self.path))


#: The production rules.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; null or without `://`: both empty."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def apply_rules(df: DataFrame, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest rule that fits, else null.

    Equal lengths: the rule that comes first.
    """
    ordered = sorted(rules, key=lambda r: -len(r.name))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(ordered):
        rule = F.when(r.fits(), r.name).otherwise(rule)
        verdict = F.when(r.fits(), r.verdict).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("rule_verdict", verdict)


def symbols(url: Column) -> Column:
    """The URL's characters, with the start marks of the longest context."""
    return F.concat(F.lit(START * (ORDERS - 1)), F.coalesce(url, F.lit("")))


def _grams(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per character, with the longest gram ending there."""
    df = df.where(F.length("s") >= ORDERS).withColumn("_at", F.explode(F.sequence(F.lit(1), F.length("s") - ORDERS + 1)))
    return df.select(*keys, F.substring("s", F.col("_at"), ORDERS).alias("g"))


def _dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that deals out both, whatever size is estimated.

    Spark takes a table's size from its compressed files, and counts rows per
    character as rows per URL: a broadcast would bring a table that grows with
    the corpus, many times the session's limit, to the driver.
    """
    return df.hint("merge")


def train(urls: DataFrame, discount: float = 0.75) -> DataFrame:
    """(g, ratio): the log-ratio of each longest gram in ``urls(s, accepted, times)``.

    URLs with null ``accepted`` teach nothing and only name grams to rate.
    Counts cover every other URL, as often as ``times`` says, and combine
    map-side; the tables grow with the distinct grams and stay tables, joined
    by gram.  Each order is smoothed by absolute discounting into the order
    below it, down to a uniform alphabet.  A gram seen in neither class has
    the ratio of its tail, and 0 below the last.
    """
    taught = lambda v: F.sum(F.when(F.col("accepted") == v, F.col("times")).otherwise(0))
    counted = _grams(urls, ["accepted", "times"]).groupBy("g").agg(taught(True).alias("na"), taught(False).alias("nr"))
    orders = [spill(counted, f"url-grams{ORDERS}")]
    for k in range(ORDERS - 1, 0, -1):
        shorter = orders[0].groupBy(F.substring("g", 2, k).alias("g")).agg(F.sum("na").alias("na"), F.sum("nr").alias("nr"))
        orders.insert(0, spill(shorter, f"url-grams{k}"))
    below = None
    for k, c in enumerate(orders, 1):
        c = c.withColumn("context", F.substring("g", 1, k - 1)).withColumn("tail", F.substring("g", 2, k - 1))
        totals = [x for a in ("a", "r") for x in (F.sum(f"n{a}").alias(f"t{a}"), F.sum((F.col(f"n{a}") > 0).cast("int")).alias(f"d{a}"))]
        if below is None:
            uniform = 1 / (F.col("seen") + 1)
            totals = c.agg(*totals, F.count_if((F.col("na") > 0) | (F.col("nr") > 0)).alias("seen"))
            c = c.crossJoin(F.broadcast(totals))  # one row
            c = c.withColumn("pa0", uniform).withColumn("pr0", uniform).withColumn("r0", F.lit(0.0))
        else:
            c = c.join(_dealt(c.groupBy("context").agg(*totals)), "context").join(_dealt(below), "tail")
        for a in ("a", "r"):
            n, t, d = F.col(f"n{a}"), F.col(f"t{a}"), F.col(f"d{a}")
            smoothed = (F.greatest(n - discount, F.lit(0.0)) + discount * d * F.col(f"p{a}0")) / F.greatest(t, F.lit(1))
            c = c.withColumn(f"p{a}", F.when(t > 0, smoothed).otherwise(F.col(f"p{a}0")))
        ratio = F.when((F.col("na") > 0) | (F.col("nr") > 0), F.log(F.col("pa") / F.col("pr"))).otherwise(F.col("r0"))
        c = spill(c.select("g", "pa", "pr", ratio.alias("ratio")), f"url-order{k}")
        below = c.select(F.col("g").alias("tail"), F.col("pa").alias("pa0"), F.col("pr").alias("pr0"), F.col("ratio").alias("r0"))
    return c.select("g", "ratio")


def score(urls: DataFrame, ratios: DataFrame, key: str) -> DataFrame:
    """Mean log-ratio per character of each ``key`` of ``urls(key, s)``; none for URLs without characters.

    ``ratios`` grows with the corpus, so characters are joined to it by gram.
    """
    grams = _grams(urls, [key]).join(_dealt(ratios), "g")
    # whole numbers add up alike in any order, so reruns agree
    return grams.groupBy(key).agg((F.sum(F.round(F.col("ratio") * 1e9).cast("long")) / F.count(F.lit(1)) / 1e9).alias("score"))


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: host, path, rule, score, verdict.

    Of the URLs that a rule decides, those whose CRC-32 is divisible by 4 are
    held out for calibration.  With m and s the held-out mean and deviation of
    each class, the threshold is the point equally many deviations from both
    means.  Without URLs of both classes the threshold is 0; null URLs and
    those without characters score 0 and are judged by it as well (allowed at
    the threshold).  Repeated rows come back each; no pages, no rows.
    """
    df = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))
    host, path = split_url(F.col("url"))
    df = apply_rules(df.withColumn("host", host).withColumn("path", path), rules)
    df = spill(df, "urls")
    held = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(4)) == 0
    each = df.where("url is not null").groupBy("url", "rule_verdict").agg(F.count(F.lit(1)).alias("times"))
    each = spill(each.withColumn("_u", F.monotonically_increasing_id()), "url-each")
    rows = each.select("_u", "times", symbols(F.col("url")).alias("s"), F.when(~held, F.col("rule_verdict") == "allow").alias("accepted"))
    scores = each.select("_u", "url").join(_dealt(score(rows, train(rows), "_u")), "_u").select("url", "score")
    scored = spill(df.join(_dealt(scores), "url", "left").withColumn("score", F.coalesce("score", F.lit(0.0))), "url-scores")
    held_out = scored.where("rule_verdict is not null and url is not null").where(held)
    v = F.col("score")
    stats = {r["rule_verdict"]: r for r in held_out.groupBy("rule_verdict").agg(
        F.avg(v).alias("m"), F.coalesce(F.stddev_pop(v), F.lit(0.0)).alias("s")).collect()}
    cut = 0.0
    if len(stats) == 2:
        a, r = stats["allow"], stats["block"]
        cut = (a["m"] * r["s"] + r["m"] * a["s"]) / (a["s"] + r["s"]) if a["s"] + r["s"] > 0 else (a["m"] + r["m"]) / 2
        cut = round(cut, 6)
    verdict = F.coalesce("rule_verdict", F.when(v >= cut, "allow").otherwise("block"))
    return scored.select(F.col("page_id").alias(id_col), "url", "host", "path", "rule", "score", F.lit(cut).alias("threshold"), verdict.alias("verdict"))

