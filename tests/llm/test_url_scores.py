"""Operator 9's model against plain Python: one probability at a time, no tables."""
import math
import random
import statistics
import zlib
from collections import Counter, defaultdict

from ledgerline.llm import url_model
from tests.llm.test_scores import brute_url

DISCOUNT = 0.75


class BruteModel:
    """Absolute discounting into the shorter context, per class."""

    def __init__(self, taught):
        self.counts = {True: defaultdict(Counter), False: defaultdict(Counter)}
        for url, accepted in taught:
            s = url_model.START * (url_model.ORDERS - 1) + url
            for at in range(url_model.ORDERS - 1, len(s)):
                for k in range(url_model.ORDERS):
                    self.counts[accepted][s[at - k:at]][s[at]] += 1
        self.alphabet = len(set(self.counts[True][""]) | set(self.counts[False][""])) + 1

    def probability(self, accepted, context, c):
        shorter = self.probability(accepted, context[1:], c) if context else 1 / self.alphabet
        after = self.counts[accepted].get(context)
        if not after:
            return shorter
        return (max(after[c] - DISCOUNT, 0) + DISCOUNT * len(after) * shorter) / sum(after.values())

    def ratio(self, context, c):
        """Of the longest context in which either class has the character."""
        for k in range(len(context) + 1):
            if any(c in self.counts[v].get(context[k:], ()) for v in (True, False)):
                return math.log(self.probability(True, context[k:], c) / self.probability(False, context[k:], c))
        return 0.0

    def score(self, url):
        s, n = url_model.START * (url_model.ORDERS - 1) + (url or ""), url_model.ORDERS - 1
        return statistics.fmean(self.ratio(s[at - n:at], s[at]) for at in range(n, len(s))) if url else 0.0


def brute_verdicts(urls):
    """(score, verdict or None where only the threshold decides) of each URL, and the threshold."""
    ruled = [brute_url(u)[2] for u in urls]
    held = [u is not None and zlib.crc32(u.encode()) % 4 == 0 for u in urls]
    model = BruteModel([(u, r.verdict == "allow") for u, r, h in zip(urls, ruled, held, strict=True) if r and not h])
    scores = [model.score(u) for u in urls]
    known = {v: [s for s, r, h in zip(scores, ruled, held, strict=True) if h and r and r.verdict == v] for v in ("allow", "block")}
    cut = 0.0
    if all(known.values()):
        (a, x), (b, y) = ((statistics.fmean(k), statistics.pstdev(k)) for k in (known["allow"], known["block"]))
        cut = (a * y + b * x) / (x + y) if x + y > 0 else (a + b) / 2
    return scores, [r.verdict if r else None for r in ruled], cut


def check(spark, urls):
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    got = {r.page_id: r for r in url_model.judge_urls(df).collect()}
    scores, verdicts, cut = brute_verdicts(urls)
    assert sorted(got) == list(range(len(urls)))
    for i, (s, v) in enumerate(zip(scores, verdicts, strict=True)):
        assert math.isclose(got[i].score, s, abs_tol=1e-7), (urls[i], got[i].score, s)
        assert math.isclose(got[i].threshold, cut, abs_tol=2e-6)
        if v or abs(s - cut) > 1e-5:
            assert got[i].verdict == (v or ("allow" if s >= cut else "block")), urls[i]
    return scores, cut


def test_scores_and_threshold_equal_brute_force(spark):
    rnd = random.Random(21)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 9)))
    urls = [f"http://{word('abcdé')}.org/fr/{word('abcd1')}" for _ in range(60)] + [f"http://{word('wxyzЖ')}.net/{word('wxyz2')}" for _ in range(60)]
    urls += [f"https://{word('abwx')}.info/{word('cdyz12')}?q={word('😀#')}" for _ in range(40)]
    urls += [None, "", "x", "://", "unseen ÄÖÜ", "http://" + "ab" * 2000 + ".org/fr/", *urls[:7], *urls[60:75], urls[130], None]
    scores, cut = check(spark, urls)
    assert cut and len({round(s, 6) for s in scores}) > 100


def test_scores_with_one_class_or_none(spark):
    check(spark, [f"http://h{i}.org/fr/{i}" for i in range(12)] + ["http://a.info/1"])
    check(spark, ["http://a.info/1", "b", "", None])


def test_no_table_that_grows_is_broadcast(spark, monkeypatch):
    """Only the one row of totals goes through the driver, however small the files look: characters are many times the URLs' rows."""
    plans, real = {}, url_model.spill

    def spill(df, label, *more):
        plans[label] = df._jdf.queryExecution().executedPlan().toString()
        return real(df, label, *more)

    monkeypatch.setattr(url_model, "spill", spill)
    urls = [f"http://h{i % 7}.org/fr/{i}" for i in range(150)] + [f"http://g{i % 5}.net/{i}" for i in range(150)] + [None, "", "http://a.info/1"]
    check(spark, urls)
    assert "SortMergeJoin" in plans["url-scores"]
    assert [label for label, plan in plans.items() if "BroadcastHashJoin" in plan] == []
