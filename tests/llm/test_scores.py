"""Operators 1, 2, 7 and 9, and the pipeline: brute force, invariants, held-out accuracy."""
import math
import random
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from ledgerline.llm import mixing, quality_rules, queries, toxicity, url_model
from ledgerline.llm.tables import spill

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_base(text):
    text = text or ""
    w = WORD.findall(text)
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    counts = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if counts[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed)


def test_quality_measures_equal_brute_force(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(["a", "b ", "c\n", "é😀 ", "# ", "|", "\t", "  ", "d e f g h i "]) for _ in range(rnd.randint(0, 80))) for _ in range(150)]
    texts += [None, "", " ", "\n\n", "a b c d e a b c d e", "x " * 300, "a b c d e f " * 2, "same\nsame\nother"]
    rows = [(i, t, "clash", 1) for i, t in enumerate(texts)] + [(0, texts[0], "clash", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words string, kept int")
    got = quality_rules.judge_quality(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    assert sorted((r.doc_id, tuple(r)[1:7]) for r in got) == sorted((r[0], brute_base(r[1])) for r in rows)
    assert not any(r.kept and r.base_failed for r in got)
    assert quality_rules.judge_quality(df.where("false")).collect() == []


def brute_model(votes, rounds=50):
    """Plain EM, one document at a time."""
    k = len(votes[0])
    prior, good, bad = 0.8, [0.95] * k, [0.3] * k
    for _ in range(rounds):
        posts = []
        for v in votes:
            s = math.log(prior / (1 - prior))
            for x, g, b in zip(v, good, bad, strict=True):
                s += math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) if x == -1 else 0
            posts.append(1 / (1 + math.exp(-s)))
        prior = min(0.99, max(0.01, sum(posts) / len(posts)))
        for i in range(k):
            cast = [(v[i], p) for v, p in zip(votes, posts, strict=True) if v[i]]
            good[i] = min(0.9999, max(0.6, (sum(p for x, p in cast if x > 0) + 4.75) / (sum(p for _, p in cast) + 5)))
            bad[i] = min(0.9999, max(1.05 - good[i], (sum(1 - p for x, p in cast if x < 0) + 1.5) / (sum(1 - p for _, p in cast) + 5)))
    return prior, good, bad


def test_label_model_equals_plain_em(spark):
    rnd = random.Random(2)
    votes = [[rnd.choice([1, 1, 1, 0, -1]) if rnd.random() < 0.2 else 1 for _ in range(4)] for _ in range(300)]
    votes += [[rnd.choice([-1, -1, 1, 0]) for _ in range(4)] for _ in range(60)]
    df = spark.createDataFrame(votes, "a int, b int, c int, d int")
    m = quality_rules.fit_label_model(df, ["a", "b", "c", "d"], tolerance=0.0)
    prior, good, bad = brute_model(votes)
    assert math.isclose(m.prior, prior, abs_tol=1e-9)
    assert all(math.isclose(x, y, abs_tol=1e-9) for x, y in zip((*m.on_good, *m.on_bad), (*good, *bad), strict=True))


def test_quality_agrees_with_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    judged = queries.op1_quality_rules(spark, "/root/testdata/sf0.01").where("not base_failed").join(labels, "doc_id")
    n = {(r.quality, r.kept): r["count"] for r in judged.groupBy("quality", "kept").count().collect()}
    assert n.get((0, True), 0) <= 0.05 * (n.get((0, True), 0) + n.get((0, False), 0))
    assert n.get((1, False), 0) <= 0.02 * (n.get((1, True), 0) + n.get((1, False), 0))


def test_fold_and_exceptions():
    assert toxicity.fold("ІDІ0T") == toxicity.fold("idiot") == toxicity.fold("1d!öt") == toxicity.fold("ｉｄｉｏｔ") == toxicity.fold("id​iot")
    model = toxicity.ToxicModel({toxicity.fold("clown"): 5.0}, (toxicity.fold("clown fish"),), -3.0, (2.0, 1.0))
    machine = model.automaton()
    assert model.measure(machine, "a CL0WN here")[0] > 0 and model.measure(machine, "clowns!")[0] > 0
    assert model.measure(machine, "the clown fish swims") == model.measure(machine, "a cyclown") == model.measure(machine, "") == (0.0, 0.0)
    assert model.measure(machine, "clown " + "word " * 500)[1] < model.measure(machine, "clown word")[1]


def test_toxicity_on_held_out_rows(spark):
    rnd = random.Random(6)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    rows = []
    for i in range(600):
        words, toxic = [word() for _ in range(rnd.randint(5, 80))], i % 6 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(["m0ron", "scum", "MORON", "scumbag"])
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame([(*r, 1.0, "en") for r in rows], "id long, text string, toxic int, score double, x string")
    model = toxicity.fit(df.where("id % 4 != 2"))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(df, model, "id").collect()}
    assert all((got[i] >= 0.3) == bool(t) for i, _, t in rows if i % 4 == 2)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "")], "doc_id long, text string")
    assert [0 <= r.score < 0.3 for r in toxicity.score_toxicity(odd, model).collect()] == [True] * 3
    nothing = toxicity.fit(df.where("false"))
    assert 0 <= toxicity.score_toxicity(df.limit(1), nothing, "id").first().score < 0.3


def test_exceptions_need_clean_evidence(spark):
    """Mislabelled clean rows make no exception of a toxic phrase; a phrase of clean rows alone is one."""
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    rows = []
    for i in range(3000):
        words, toxic = [word() for _ in range(rnd.randint(5, 40))], i % 4 == 0
        at = rnd.randrange(len(words))
        if toxic:
            words[at:at] = ["you", "zorkum"]
        elif i % 100 == 1:
            words[at:at] = ["zorkum", "museum"]
        rows.append((i, " ".join(words), int(toxic and i % 100 != 0)))  # every 25th toxic row is labelled clean
    df = spark.createDataFrame(rows, "id long, text string, toxic int")
    model = toxicity.fit(df)
    assert any(toxicity.fold("zorkum").startswith(t) for t in model.terms)
    assert toxicity.fold("you zorkum") not in model.exceptions and toxicity.fold("zorkum museum") in model.exceptions
    new = spark.createDataFrame([(1, "well you zorkum go on"), (2, "the zorkum museum is open"), (3, "nothing at all")], "doc_id long, text string")
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(new, model).collect()}
    assert got[1] >= 0.3 > got[2] == got[3]


def test_mixing_targets_and_limits(spark):
    rnd = random.Random(5)
    rows = [(i, "w " * rnd.randint(0, 30), rnd.choice(["a", "b", "B", None, "é", "tiny"][: 5 if i else 6])) for i in range(400)]
    rows += [(900, None, "a"), (901, "", "empty"), (None, "x y", "a"), (5, "x y z", "a"), (5, "x y z", "a"), (902, "one two", "tiny")]
    df = spark.createDataFrame([(*r, 1, "c") for r in rows], "doc_id long, text string, source string, size int, target string")
    runs = [sorted(map(str, mixing.mix_sources(df.repartition(n)).collect())) for n in (1, 6)]
    assert runs[0] == runs[1]
    got = mixing.mix_sources(df).collect()
    assert len(got) == len(rows)
    sizes, weights, target, taken = {}, {}, {}, Counter()
    for r in got:
        sizes[r.source], weights[r.source], target[r.source] = r.source_size, r.weight, r.target
        taken[r.source] += r.taken
        assert r.taken == r.copies * r.size <= 3 * r.size and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    assert [weights[s] for s in names] == [1 + i % 3 for i in range(len(names))]
    left, open_sources = float(sum(sizes.values())), list(names)
    while True:  # share, stop the full ones, share the rest again
        level = left / sum(weights[s] for s in open_sources)
        full = [s for s in open_sources if level * weights[s] > 3 * sizes[s]]
        if not full:
            break
        left -= sum(3 * sizes[s] for s in full)
        open_sources = [s for s in open_sources if s not in full]
    for s in names:
        assert math.isclose(target[s], level * weights[s] if s in open_sources else 3 * sizes[s], rel_tol=1e-12, abs_tol=1e-9)
        assert abs(taken[s] - target[s]) <= 30
    assert mixing.mix_sources(df.where("false")).collect() == []
    order = [r.position for r in mixing.training_order(mixing.mix_sources(df)).collect()]
    assert order == sorted(order) and len(order) == sum(r.copies for r in got)


def test_schedule_inverse(spark):
    for early in (0.5, 1.0, 1.5):
        t = [x / 20 for x in range(21)]
        df = spark.createDataFrame([(early * x + (1 - early) * x * x,) for x in t], "s double")
        got = [r[0] for r in df.select(mixing.position_of(F.col("s"), F.lit(early))).collect()]
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(got, t, strict=True))


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in url_model.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_url_rules_equal_brute_force(spark):
    urls = [None, "", "x", "://", "http://NET", "http://net/", "http://a.NET/x", "http://xnet/", "https://example.net/en/a?b#c", "https://m.example.net/en",
            "http://Example.com/de/", "http://example.com/dex", "http://a.org/fr/1", "http://org/fr/", "http://a.org/en/", "ftp://u@h:80/p://q", "a://b?c/d", "a://É.org/fr/#x"]
    rows = [(i, u, "h", "clash") for i, u in enumerate(urls)] + [(3, urls[3], "h", "clash"), (None, "http://q.org/en/2", "h", "c")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, s string")
    got = url_model.judge_urls(df).collect()
    key = lambda r: str(r)
    want = []
    for i, u, *_ in rows:
        host, path, rule = brute_url(u)
        want.append((i, host, path, rule.name if rule else None))
    assert sorted(((r.page_id, r.host, r.path, r.rule) for r in got), key=key) == sorted(want, key=key)
    named = {r.name: r.verdict for r in url_model.RULES}
    assert all(r.verdict == named[r.rule] if r.rule else r.verdict in ("allow", "block") for r in got)
    assert url_model.judge_urls(df.where("false")).collect() == []


def test_url_model_separates_what_rules_teach(spark):
    rnd = random.Random(8)
    name = lambda letters: "".join(rnd.choice(letters) for _ in range(8))
    good = [f"http://{name('abcd')}.org/fr/{name('abcd')}" for _ in range(80)]
    bad = [f"http://{name('wxyz')}.net/{name('wxyz')}" for _ in range(80)]
    new = [(f"http://{name('abcd')}.info/{name('abcd')}", "allow") for _ in range(20)] + [(f"http://{name('wxyz')}.info/{name('wxyz')}", "block") for _ in range(20)]
    df = spark.createDataFrame([(i, u) for i, u in enumerate([*good, *bad, *[u for u, _ in new]])], "page_id long, url string")
    got = {r.url: r.verdict for r in url_model.judge_urls(df).collect()}
    assert sum(got[u] == v for u, v in new) >= 38


def test_url_model_tells_scripts_digits_and_long_contexts(spark):
    """What one symbol for foreign letters and for digit runs, and two characters of context, cannot tell."""
    rnd = random.Random(10)
    pick = lambda letters, n=8: "".join(rnd.choice(letters) for _ in range(n))
    # both orders of the parts have the same trigrams inside, as every part ends and begins alike
    parts = {"good": ("xyaxy", "xybxy"), "bad": ("xybxy", "xyaxy")}
    kinds = [(lambda good: pick("αβγδ" if good else "жзик")), (lambda good: pick("1357" if good else "2468")),
             (lambda good: "xy".join(parts["good" if good else "bad"] * 3) + "a" * rnd.randint(0, 1))]
    for kind in kinds:
        taught = [f"http://h{i}.org/fr/{kind(True)}" for i in range(80)] + [f"http://h{i}.net/fr/{kind(False)}" for i in range(80)]
        new = [(f"http://h{i}.info/fr/{kind(i % 2 == 0)}", "allow" if i % 2 == 0 else "block") for i in range(40)]
        df = spark.createDataFrame(list(enumerate([*taught, *[u for u, _ in new]])), "page_id long, url string")
        got = {r.url: r.verdict for r in url_model.judge_urls(df).collect()}
        assert sum(got[u] == v for u, v in new) >= 36


def test_pipeline_stages(spark):
    """Each stage on its own input, against plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    kept = {r.doc_id for r in queries.op1_quality_rules(spark, SF).where("kept").collect()}
    one = corpus_pipeline.quality(spark, docs, SF)
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == kept
    rows = [(i, " ".join(f"w{i % 7}x{j}" for j in range(40)), "en", f"s{i % 3}", 1) for i in range(30)] + [(None, "lone text of no id", "en", None, 1)]
    small = spark.createDataFrame(rows, docs.schema)
    two = corpus_pipeline.near_duplicates(spark, small, SF)
    assert two.columns == docs.columns and sorted(str(r.doc_id) for r in two.collect()) == sorted([*map(str, range(7)), "None"])
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    leaky = small.limit(5).unionByName(spark.createDataFrame([(77, "before " + item + " after", "en", "s", 1)], docs.schema))
    three = corpus_pipeline.decontaminate(spark, leaky, SF)
    assert three.columns == docs.columns and 77 not in {r.doc_id for r in three.collect()} and three.count() == 5
    four = corpus_pipeline.mix(spark, small, SF)
    copies = {r.doc_id: r.copies for r in mixing.mix_sources(small).collect()}
    assert four.columns == docs.columns and Counter(r.doc_id for r in four.collect()) == Counter({k: v for k, v in copies.items() if v})
    assert corpus_pipeline.tokens(spark, four, SF).count() == sum(copies.values())


def test_pipeline_near_copies_of_scattered_words_and_shared_ids(spark):
    """Five words and 80 percent: copies that three words and 90 percent keep; an id's other texts stay."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    words = lambda i, n=100: [f"d{i}w{j}" for j in range(n)]
    texts, rnd = [], random.Random(4)
    for i in range(12):
        scattered = words(i)
        scattered[20 + i], scattered[60 + i] = "new", "other"  # similarity 86 / 106 of five words, 92 / 104 of three
        texts += [(i, words(i)), (100 + i, scattered), (200 + i, words(i) + [f"more{i}x{j}" for j in range(15)])]  # 96 / 111
        three = words(i)
        three[10], three[40], three[70] = "a", "b", "c"  # 81 / 111: under the threshold
        texts.append((300 + i, three))
    texts += [(500, words(0)), (500, words(50)), (500, words(51)), (500, words(51)), (501, words(50))]
    rnd.shuffle(texts)
    docs = spark.createDataFrame([(i, " ".join(t), "en", "s", 1) for i, t in texts], schema)
    sets = [(i, frozenset(zip(*(t[k:] for k in range(5)), strict=False)), " ".join(t)) for i, t in sorted(texts)]
    group = {x: x for x in sets}
    for _ in sets:  # spread the smallest name along links
        for a in sets:
            group[a] = min((group[b] for b in sets if 100 * len(a[1] & b[1]) >= 80 * len(a[1] | b[1])), key=lambda x: (x[0], x[2]))
    got = sorted((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    assert [i for i, _ in got] == sorted({(g[0], g[2]): g[0] for g in group.values()}.values())
    assert [t for i, t in got if i == 500] in ([" ".join(words(50)), " ".join(words(51))], [" ".join(words(51)), " ".join(words(50))])
    assert {i for i, _ in got} == {*range(12), *range(300, 312), 500}


def test_mix_is_written_in_training_order(spark):
    """The token files hold the copies by training position, from written files and from a frame."""
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rnd = random.Random(9)
    docs = spark.createDataFrame([(i, f"text{i} " * rnd.randint(1, 20), "en", rnd.choice("abc"), 1) for i in range(120)], schema).repartition(5)
    want = [i for _, i in sorted((p, r.doc_id) for r in mixing.mix_sources(docs).collect() for p in r.positions)]
    assert want != sorted(want)
    four = corpus_pipeline.mix(spark, docs, SF)
    assert [r.doc_id for r in four.collect()] == want
    path = spill(four.repartitionByRange(7, F.monotonically_increasing_id()), "several")
    for frame in (four, path):
        got = sorted((r.start, r.doc_id) for r in corpus_pipeline.tokens(spark, frame, SF).collect())
        assert [i for _, i in got] == want


def test_op7_takes_first_positions_from_the_sorted_copies(spark, monkeypatch):
    used, real = [], mixing.training_order
    monkeypatch.setattr(mixing, "training_order", lambda m: used.append(m) or real(m))
    got = Counter(map(tuple, queries.op7_mixing(spark, SF).collect()))
    rows = mixing.mix_sources(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert used and got == Counter((r.doc_id, r.size, r.source_size, r.target, r.taken, min(r.positions, default=None)) for r in rows)
