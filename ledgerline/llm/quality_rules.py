"""Operator 1: quality rules as weak supervision (DataFrame functions only).

Each rule votes good (1), bad (-1) or abstains (0) on a document.  An
expectation-maximisation over the votes estimates, without labels, how
accurate each rule is; the posterior probability of good quality then replaces
an all-must-pass filter.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import spill

#: Space characters of the word pattern `[^\x20\x09-\x0D]+`.
SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    """Bad below ``low`` or above ``high``; good inside [``good_low``, ``good_high``]; else it abstains."""

    name: str
    value: str
    good_low: float = -math.inf
    good_high: float = math.inf
    low: float = -math.inf
    high: float = math.inf

    def vote(self) -> Column:
        v = F.expr(self.value)
        bad = F.lit(False)
        if self.low > -math.inf:
            bad = bad | (v < self.low)
        if self.high < math.inf:
            bad = bad | (v > self.high)
        good = F.lit(True)
        if self.good_low > -math.inf:
            good = good & (v >= self.good_low)
        if self.good_high < math.inf:
            good = good & (v <= self.good_high)
        vote = F.when(bad, -1).when(good, 1).otherwise(0)
        return F.coalesce(vote, F.lit(0)).cast("int").alias(self.name)


#: The rules in use; each value is a SQL expression over the columns of `features`.
RULES = (
    Rule("repeated_words", "n_repeat_words / nullif(n_words, 0)", good_high=0.05, high=0.2),
    Rule("repeated_lines", "n_dup_lines / nullif(n_lines, 0)", good_high=0.05, high=0.34),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", good_high=0.05, high=0.2),
    Rule("letters", "n_letters / nullif(word_chars, 0)", good_low=0.94, low=0.89),
    Rule("word_length", "word_chars / nullif(n_words, 0)", good_low=2.5, good_high=9.0, low=2.0, high=14.0),
    Rule("variety", "n_distinct_words / sqrt(nullif(n_words, 0))", good_low=2.5, low=1.5),
    Rule("upper_case", "n_upper / nullif(word_chars, 0)", good_high=0.2, high=0.5),
    Rule("exclamation", "n_exclaim / nullif(n_words, 0)", good_high=0.05, high=0.3),
    Rule("sentences", "n_stops / nullif(n_words, 0)", good_low=0.01, good_high=0.6),
)


def features(text: Column | None = None, source: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Measures of every whole text; null texts have none of anything.

    n_repeat_words counts the words in windows of five words that occur twice
    or more in the text.  Words and windows are compared by 64-bit hashes; only
    texts with a repeated hash pay for locating them.
    """
    text = F.coalesce(text, F.lit(""))
    df = source.select(*(keep or []), text.alias("_text"))
    df = df.select("*", F.filter(F.split("_text", SPACES), lambda w: w != "").alias("_words"),
                   F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    n = F.size("_words")
    df = df.select("*", n.cast("long").alias("n_words"), F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashed"))
    window = F.transform("_hashed", lambda h, i: F.xxhash64(h, *[F.get("_hashed", i + k) for k in range(1, 5)]))
    df = df.select("*", F.when(n >= 5, F.slice(window, F.lit(1), n - 4)).alias("_windows"))
    distinct = F.size(F.array_distinct("_windows"))
    # (hash, position) in order: equal neighbours are repeated windows
    marked = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select("*", F.when((n >= 5) & (distinct < n - 4), marked).alias("_marked"))
    same = lambda x, y: x["h"] == y["h"]
    hit = F.filter("_marked", lambda x, k: F.coalesce(same(x, F.get("_marked", k - 1)), F.lit(False))
                   | F.coalesce(same(x, F.get("_marked", k + 1)), F.lit(False)))
    df = df.select("*", F.array_sort(F.transform(hit, lambda x: x["i"])).alias("_hits"))
    covered = F.aggregate(
        "_hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("p")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["p"])).alias("n"), p.alias("p")), lambda a: a["n"])
    joined = F.array_join("_words", "")
    return df.select(
        *(keep or []), "n_words",
        F.length(joined).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"[\p{L}\p{M}\p{N}]+", ""))).cast("long").alias("n_letters"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("_text", F.lit("!")).cast("long").alias("n_exclaim"),
        F.regexp_count("_text", F.lit(r"[.?](\s|$)")).cast("long").alias("n_stops"))


def base_failed() -> Column:
    """The hard base rules, over columns of `features`."""
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class LabelModel:
    """Prior of good quality; per rule P(votes good | good, votes) and P(votes bad | bad, votes)."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def gains(self) -> list[tuple[float, float]]:
        """Log-odds that a good and a bad vote of each rule add."""
        return [(math.log(g / (1 - b)), math.log((1 - g) / b)) for g, b in zip(self.on_good, self.on_bad, strict=True)]

    def base(self) -> float:
        return math.log(self.prior / (1 - self.prior))

    def posterior(self, votes: list[str]) -> Column:
        """P(good | votes); abstentions say nothing."""
        score = F.lit(self.base())
        for v, (up, down) in zip(votes, self.gains(), strict=True):
            score = score + F.when(F.col(v) == 1, up).when(F.col(v) == -1, down).otherwise(0.0)
        return 1 / (1 + F.exp(-score))


def fit_label_model(votes: DataFrame, names: list[str], max_rounds: int = 50, tolerance: float = 1e-6,
                    prior: float = 0.8, on_good: float = 0.95, on_bad: float = 0.3, pseudo: float = 5.0) -> LabelModel:
    """EM over all documents' votes.

    Documents with equal votes are counted by one aggregation over all of them,
    so what reaches the driver has at most 3^rules rows (19,683 for nine rules)
    whatever the corpus; the rounds are arithmetic on those counts.  The start
    takes rules for precise (``on_good``) but blind to most kinds of junk
    (``on_bad``); rates are smoothed by ``pseudo`` votes at the start values.
    A rule must never speak for junk more than for good text, which keeps the
    two classes from swapping.  No documents: the initial model.
    """
    counted = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()
    counted = sorted((tuple(r[v] for v in names), r["n"]) for r in counted)
    model = LabelModel(prior, (on_good,) * len(names), (on_bad,) * len(names))
    total = sum(n for _, n in counted)
    if not total:
        return model
    for _ in range(max_rounds):
        gains, base = model.gains(), model.base()
        good = 0.0
        said = [[0.0] * 4 for _ in names]  # good docs: good votes, votes; bad docs: bad votes, votes
        for vote, n in counted:
            p = 1 / (1 + math.exp(-base - sum(up if v > 0 else down for v, (up, down) in zip(vote, gains, strict=True) if v)))
            good += n * p
            for v, s in zip(vote, said, strict=True):
                if v:
                    s[0] += n * p * (v > 0)
                    s[1] += n * p
                    s[2] += n * (1 - p) * (v < 0)
                    s[3] += n * (1 - p)
        g = tuple(min(0.9999, max(0.6, (s[0] + pseudo * on_good) / (s[1] + pseudo))) for s in said)
        b = tuple(min(0.9999, max(1.05 - x, (s[2] + pseudo * on_bad) / (s[3] + pseudo))) for s, x in zip(said, g, strict=True))
        new = LabelModel(min(0.99, max(0.01, good / total)), g, b)
        moved = max(abs(x - y) for x, y in zip((model.prior, *model.on_good, *model.on_bad), (new.prior, *g, *b), strict=True))
        model = new
        if moved < tolerance:
            break
    return model


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5,
                  keep: list[str] | None = None) -> DataFrame:
    """One row per document: measures, votes, ``posterior``, ``base_failed`` and ``kept``.

    Kept are documents that pass the base rules and whose posterior reaches
    ``threshold``.  Null and empty texts fail the base rules.  Repeated rows
    are judged each; an empty table gives no rows.  Columns in ``keep`` go
    along under their names; other columns are not looked at.
    """
    cols = [F.col(id_col).alias("_id"), *[F.col(c).alias(f"_keep_{c}") for c in keep or []]]
    held = ["_id", *[f"_keep_{c}" for c in keep or []]]
    measured = features(F.col("_t"), docs.select(*cols, F.col(text_col).alias("_t")), held)
    names = [r.name for r in RULES]
    voted = spill(measured.select("*", *[r.vote() for r in RULES]).withColumn("base_failed", base_failed()), "quality")
    model = fit_label_model(voted, names)
    judged = voted.withColumn("posterior", model.posterior(names))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    return judged.select(F.col("_id").alias(id_col), *[F.col(f"_keep_{c}").alias(c) for c in keep or []],
                         *[c for c in judged.columns if c not in held])
