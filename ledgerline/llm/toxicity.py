"""Operator 2: toxicity by a weighted lexicon matched with Aho-Corasick.

Texts and lexicon are folded alike: case, accents, homoglyphs of other scripts,
full-width forms and digit substitutions collapse to one skeleton alphabet.
Terms are word beginnings, learned with their weights from labelled documents;
exception phrases take back the hits inside them.  The summed weight,
normalised by length, goes through a logistic calibrated on labelled documents
that took no part in learning the terms.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import spill
from ledgerline.llm.textscan import pieces

# Letters of other scripts and signs that pass for Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ɡ": "g", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v",
    "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ł": "l", "ø": "o", "đ": "d",
}
# Digits and signs in the place of letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "i"}
#: Invisible characters that split a word for a machine only.
INVISIBLE = "­​‌‍⁠﻿"


def _fold_table() -> dict[int, str | None]:
    table: dict[int, str | None] = {}
    for c in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:  # accented Latin letters
        base = unicodedata.normalize("NFKD", chr(c).lower())[0]
        if base.isascii():
            table[c] = base
    for c in range(0x300, 0x370):  # combining marks
        table[c] = None
    for c in range(0xFF01, 0xFF5F):  # full-width forms
        table[c] = chr(c - 0xFEE0).lower()
    table |= {ord(a): b for a, b in HOMOGLYPHS.items()} | dict.fromkeys(map(ord, INVISIBLE))
    for c in range(0x80):
        if not chr(c).isalnum():
            table[c] = " "
    for a, b in list(table.items()):
        table[a] = SUBSTITUTES.get(b, b) if b else b
    table |= {ord(a): b for a, b in SUBSTITUTES.items()} | {ord("l"): "i"}
    return {a: "i" if b == "l" else b for a, b in table.items()}


_FOLD = _fold_table()


def fold(text: str) -> str:
    """Skeleton of a text: words of folded letters, separated by spaces (l, i, 1, ! and | are one letter)."""
    return text.lower().translate(_FOLD)


@dataclass
class ToxicModel:
    """Terms (word beginnings; a final space asks for the whole word) with weights, exception phrases, calibration."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    bias: float = -20.0
    slopes: tuple[float, float] = (0.0, 0.0)

    def automaton(self):
        """Aho-Corasick automaton over terms (weight) and exception phrases (weight None), or None if empty."""
        import ahocorasick

        machine = ahocorasick.Automaton()
        for t, w in self.terms.items():
            machine.add_word(" " + t, (len(t) + 1, w))
        for e in self.exceptions:
            machine.add_word(f" {e} ", (len(e) + 2, None))
        if not len(machine):
            return None
        machine.make_automaton()
        return machine

    def measure(self, machine, text: str) -> tuple[float, float]:
        """(log of the weight found, log of the weight per hundred words)."""
        if machine is None or not text:
            return 0.0, 0.0
        folded = " " + fold(text) + " "
        hits, shields = [], []
        for end, (size, weight) in machine.iter(folded):
            (shields if weight is None else hits).append((end - size + 1, end, weight))
        total = sum(w for a, z, w in hits if not any(s <= a and z <= e for s, e, _ in shields))
        if not total:
            return 0.0, 0.0
        return math.log1p(total), math.log1p(100 * total / max(1, len(folded.split())))

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + features @ np.array(self.slopes), -30, 30)))


def _terms_of(text: str, shortest: int, longest: int) -> set[str]:
    out = set()
    for w in set(fold(text).split()):
        if len(w) < shortest:
            if len(w) == shortest - 1:
                out.add(w + " ")
            continue
        out.update(w[:n] for n in range(shortest, min(len(w), longest) + 1))
    return out


def _count_terms(shortest: int, longest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys = list(found)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int32()),
                                               pa.array([found[k] for k in keys], pa.int64())], ["term", "toxic", "n"])

        for b in pieces(batches, limit=1 << 20):
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                found.update((t, toxic) for t in _terms_of(text or "", shortest, longest))
            if len(found) > 300_000:
                yield rows()
                found.clear()
        yield rows()

    return run


def _choose(counts: list[tuple[str, int, int]], toxic: int, clean: int) -> dict[str, float]:
    """Prefix-free terms: of a chain with the same support the longest, below a kept term nothing."""
    kept = {t: (a, b) for t, a, b in counts}
    chains: dict[str, int] = {}
    for t, (a, _) in kept.items():
        for n in range(1, len(t)):
            if t[:n] in kept:
                chains[t[:n]] = max(chains.get(t[:n], 0), a)
    terms = [t for t, (a, _) in kept.items() if chains.get(t, 0) < 0.95 * a]
    have = set(terms)
    terms = [t for t in terms if not any(t[:n] in have for n in range(1, len(t)))]
    weight = lambda a, b: math.log((a + 0.5) / (toxic + 1)) - math.log((b + 0.5) / (clean + 1))
    return {t: round(weight(*kept[t]), 6) for t in sorted(terms)}


def _calibrate(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> tuple[float, tuple[float, float]]:
    """Logistic regression by Newton steps (three parameters)."""
    a = np.column_stack([np.ones(len(x)), x])
    theta = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ theta, -30, 30)))
        gradient = a.T @ (y - p) - ridge * theta
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(3), gradient)
        theta = theta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(theta[0]), (float(theta[1]), float(theta[2]))


FEATURE_SCHEMA = "toxic int, x double, y double, hits array<string>, rates array<double>"


def _features(shared, rates=None):
    """Measures of each text, and with ``rates`` (clean share of each term's documents) the phrases around its hits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        machine = model.automaton()
        for b in pieces(batches):
            rows = []
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                phrases: dict[str, float] = {}
                if rates is not None and text:
                    words = fold(text).split()
                    for i, w in enumerate(words):
                        rate = max((rates.value[w[:n]] for n in range(3, len(w) + 1) if w[:n] in rates.value), default=None)
                        if rate is not None:
                            for phrase in [" ".join(words[i - 1 : i + 1])] * (i > 0) + [" ".join(words[i : i + 2])] * (i + 1 < len(words)):
                                phrases[phrase] = max(rate, phrases.get(phrase, 0.0))
                rows.append((toxic, *model.measure(machine, text or ""), list(phrases), list(phrases.values())))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([r[2] for r in rows], pa.float64()), pa.array([r[3] for r in rows], pa.list_(pa.string())),
                 pa.array([r[4] for r in rows], pa.list_(pa.float64()))], ["toxic", "x", "y", "hits", "rates"])

    return run


def fit(labelled: DataFrame, max_docs: int = 24_000, evidence: float = 12.0,
        shortest: int = 4, longest: int = 14, exceptions: tuple[str, ...] = ()) -> ToxicModel:
    """Learn a model from ``labelled(id, text, toxic)``.

    At most about ``max_docs`` documents, an even sample by hash of their id,
    are read; two thirds teach terms, the rest calibrates.  A term needs
    ``evidence`` nats against the base rate of toxic documents (its surprise as
    a binomial) and at most one clean document in ten.  All terms and phrases
    with that evidence are kept: the sample alone bounds the model and what
    reaches the driver.  Phrases of a term and
    a neighbour become exceptions, beside the given ones, if three or more clean
    documents hold them, at most one toxic document in ten does, and they have
    the same ``evidence`` against the clean share of the term's documents.
    Without toxic documents every score is the base rate.
    """
    labelled = labelled.where("toxic is not null").withColumn("_h", F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")))
    total = labelled.count()
    if not total:
        return ToxicModel(exceptions=exceptions)
    step = -(-total // max_docs)
    sample = spill(labelled.where(F.pmod(F.floor(F.col("_h") / 64), F.lit(step)) == 0).select("text", F.col("toxic").cast("int").alias("toxic"), "_h"), "toxic-sample")
    teach = sample.where(F.pmod(F.floor(F.col("_h") / 7), F.lit(3)) != 0)
    sizes = {r["toxic"]: r["n"] for r in teach.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    terms: dict[str, float] = {}
    rates: dict[str, float] = {}
    if toxic and clean:
        base = toxic / (toxic + clean)
        n, t = F.col("a") + F.col("b"), F.col("a")
        p = t / n
        surprise = t * F.log(p / base) + F.when(F.col("b") > 0, F.col("b") * F.log((1 - p) / (1 - base))).otherwise(0.0)
        counted = (teach.select("text", "toxic").mapInArrow(_count_terms(shortest, longest), "term string, toxic int, n long")
                   .groupBy("term").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("toxic") == 1, 0).otherwise(F.col("n"))).alias("b"))
                   .where((t > 0) & (p > base) & (p >= 0.9)).withColumn("s", surprise).where(F.col("s") >= evidence))
        chosen = [(r["term"], r["a"], r["b"]) for r in sorted(counted.collect(), key=lambda r: (-r["s"], r["term"].encode()))]
        terms = _choose(chosen, toxic, clean)
        rates = {t: (b + 0.5) / (a + b + 1) for t, a, b in chosen if t in terms}
    model = ToxicModel(terms, tuple(fold(e).strip() for e in exceptions))
    check = sample.where(F.pmod(F.floor(F.col("_h") / 7), F.lit(3)) == 0).select("text", "toxic")
    sc = sample.sparkSession.sparkContext
    shared, shared_rates = sc.broadcast(model), sc.broadcast(rates)  # the terms of at most max_docs documents
    seen = teach.select("text", "toxic").mapInArrow(_features(shared, shared_rates), FEATURE_SCHEMA).select("toxic", F.explode(F.arrays_zip("hits", "rates")).alias("_p"))
    phrases = seen.groupBy(F.col("_p.hits").alias("phrase")).agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"), F.max("_p.rates").alias("rate"))
    a, n = F.col("a"), F.col("a") + F.col("b")
    proof = F.col("b") * F.log(F.col("b") / n / F.col("rate")) + F.when(a > 0, a * F.log(a / n / (1 - F.col("rate")))).otherwise(0.0)
    phrases = phrases.where((F.col("b") >= 3) & (F.col("b") >= 0.9 * n)).withColumn("s", proof).where(F.col("s") >= evidence)
    learned = sorted(r["phrase"] for r in phrases.select("phrase").collect())
    model.exceptions = tuple(dict.fromkeys([*model.exceptions, *learned]))
    shared = sc.broadcast(model)
    # equal measures are counted, so no value gathers in one task; at most a third of max_docs rows
    counts = check.mapInArrow(_features(shared), FEATURE_SCHEMA).groupBy("toxic", "x", "y").agg(F.count(F.lit(1)).alias("n")).collect()
    rows = [r for r in sorted(counts, key=lambda r: (r["toxic"], r["x"], r["y"])) for _ in range(r["n"])]
    if not rows:
        return model
    model.bias, model.slopes = _calibrate(np.array([(r["x"], r["y"]) for r in rows]), np.array([float(r["toxic"]) for r in rows]))
    return model


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        machine = model.automaton()
        for b in pieces(batches):
            x = np.array([model.measure(machine, t or "") for t in b.column(1).to_pylist()]).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(model.score(x), pa.float64())], ["doc_id", "score"])

    return run


def score_toxicity(docs: DataFrame, model: ToxicModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1) of every whole text, in one pass without a shuffle.

    Null and empty texts have the score of a text without hits; repeated rows
    come back each; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_score(shared), "doc_id long, score double")
