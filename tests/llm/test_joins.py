"""Operators 6 and 10 against brute force, with awkward rows."""
import random
import re

from ledgerline.llm import decontamination, jaccard_join
from ledgerline.llm.components import connected_components

LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text, k=3):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def brute_components(rows, percent=90):
    """rows: (doc_id, text); rows that share an id are one document."""
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return sorted((i, len(shingle_set(t)), find(i) if shingle_set(t) else i) for i, t in rows if i is not None)


def variants(seed, n):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(60)]
    bases = [[rnd.choice(vocabulary) for _ in range(rnd.randint(1, 70))] for _ in range(n // 6)]
    out = []
    for i in range(n):
        words = list(rnd.choice(bases))
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(len(words))] = rnd.choice(vocabulary)
        out.append((i, rnd.choice([" ", "\n", "  "]).join(words).replace("w1", rnd.choice(["w1", "W1"]))))
    return out


def test_jaccard_equals_brute_force(spark):
    rows = variants(5, 240) + [(900, None), (901, ""), (902, " \n"), (903, "a"), (904, "A"), (905, "a b"), (906, "a b"), (907, "b a")]
    rows += [(3, rows[3][1])]  # a repeated row
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, id string, n int, token string")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs).collect())
    assert got == brute_components(rows)


def test_jaccard_levels_and_final_windows(spark):
    """Many far members in one region: every level and the pairwise rest are used."""
    shared = " ".join(f"s{i}" for i in range(40))
    rows = [(i, shared + " " + " ".join(f"v{(i * 7 + j) % 23}" for j in range(i % 5))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for levels in (0, 1, 3):
        _, classes, links = jaccard_join.jaccard_links(docs, levels=levels)
        found = {r.id: r.component for r in connected_components(links).collect()}
        names = {(r.s1, r.s2): found.get(r.id, r.id) for r in classes.collect()}
        got = sorted(set(names.values()))
        assert got == sorted({c for _, _, c in brute_components(rows)})


def test_jaccard_null_ids_and_no_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (None, None), (7, "a b c d")], "doc_id long, text string")
    got = sorted(map(tuple, jaccard_join.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 2, 7), (None, 0, None), (7, 2, 7)], key=str)
    assert jaccard_join.jaccard_components(docs.where("false")).collect() == []


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (60, 50), (None, 3), (9, 9)], "a long, b long")
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50}


def brute_leaks(docs, items, size=10):
    windows = {}
    for i, t in items:
        w = ALNUM.findall((t or "").translate(LOWER))
        k = min(size, len(w))
        for j in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[j:j + k]), set()).add(i)
    sizes = {len(w) for w in windows}
    out = []
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(LOWER))
        hit, ids = set(), set()
        for k in sizes:
            for j in range(len(w) - k + 1):
                if found := windows.get(tuple(w[j:j + k])):
                    hit.update(range(j, j + k))
                    ids |= found
        out.append((d, len(w), len(hit), sorted(str(i) for i in ids if i is not None), bool(hit)))
    return sorted(out, key=str)


def leak_rows(found):
    return sorted(((r.doc_id, r.n_words, r.n_hit, list(r["items"]), r.contaminated) for r in found.collect()), key=str)


def test_decontamination_equals_brute_force(spark):
    rnd = random.Random(2)
    words = [*"abcdefg", "Über", "x1", "ñ"]
    text = lambda n: "".join(rnd.choice(words) + rnd.choice([" ", ", ", "-", "\n"]) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 4, 5, 9, 10, 11, 25]))) for i in range(25)] + [(90, None), (91, " .. "), (None, "g g g g g g g"), (3, text(12))]
    items += [items[4], (92, items[4][1])]
    docs = [(i, text(rnd.randint(0, 60)) + (rnd.choice(items)[1] or "") + text(5)) for i in range(60)] + [(800, None), (801, ""), (802, "!"), (1, "a b")]
    docs += [docs[7], (None, items[0][1])]
    d = spark.createDataFrame([(i, t, 1, "w") for i, t in docs], "doc_id long, text string, token int, words string")
    b = spark.createDataFrame([(i, t, 2) for i, t in items], "item_id long, text string, size int")
    for size in (10, 3):
        found = decontamination.find_contamination(d, b, size)
        assert leak_rows(found) == brute_leaks(docs, items, size)
        for r in found.collect():
            assert sum(s.end - s.start for s in r.spans) == r.n_hit


def test_decontamination_without_rows(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert leak_rows(decontamination.find_contamination(d, b.where("false"))) == [(1, 3, 0, [], False)]
    assert leak_rows(decontamination.find_contamination(d.where("false"), b)) == []


def test_components_of_stars_take_no_round(spark, monkeypatch):
    from ledgerline.llm import components
    written = []
    real = components.spill
    monkeypatch.setattr(components, "spill", lambda df, label: written.append(label) or real(df, label))
    links = spark.createDataFrame([(1, i) for i in range(2, 30)] + [(40, 41)], "a long, b long")
    got = {r.id: r.component for r in components.connected_components(links).collect()}
    assert got == {**dict.fromkeys(range(1, 30), 1), 40: 40, 41: 40} and written == ["links"]


def test_bit_filter_is_one_job(spark):
    from ledgerline.llm import sketch
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("bit-filter", "bit filter")
    try:
        held = sketch.bit_filter(spark.range(0, 5000, 5, 4), "id", 20)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    import numpy as np
    assert held(np.arange(0, 5000, 5)).all() and held(np.arange(1, 5000, 5)).mean() < 0.1
    assert len(tracker.getJobIdsForGroup("bit-filter")) <= 2  # the shuffle's and the result's, however many partitions


def test_jaccard_rest_has_a_document_once_a_token(spark, monkeypatch):
    """Copies with scattered edits of one text share many regions; the last comparison does not repeat them by region."""
    rnd = random.Random(11)
    base = [f"b{i}" for i in range(80)]
    rows = []
    for i in range(90):
        words = list(base)
        for p in rnd.sample(range(80), i % 9):
            words[p] = f"x{i}_{p}"
        rows.append((i, " ".join(words)))
    heads = []
    real = jaccard_join.spill

    def spill(df, label, *rest):
        table = real(df, label, *rest)
        if label == "jaccard-heads":
            heads.append((table.count(), table.select("id", "token").distinct().count()))
        return table
    monkeypatch.setattr(jaccard_join, "spill", spill)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for percent in (80, 70):
        got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs, percent=percent).collect())
        assert got == brute_components(rows, percent)
    assert heads and all(n == distinct > 0 for n, distinct in heads)


def near_group(seed, n):
    """Copies of one 150-word text with 0 to 12 words replaced, some cut short."""
    rnd = random.Random(seed)
    base = [f"b{i}" for i in range(150)]
    out = []
    for i in range(n):
        words = list(base)
        for _ in range(12 - i % 13):  # the smallest ids are far out
            words[rnd.randrange(150)] = f"own{i}x{rnd.randrange(10**6)}" if i % 3 else f"word{rnd.randrange(40)}"
        out.append((i, " ".join(words[: 150 - rnd.choice([0, 0, 0, 12, 40])])))
    return out


def brute_group(rows, percent, k):
    sets = {i: shingle_set(t, k) for i, t in rows}
    component = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in sets:
        before = dict(component)
        for a, b in links:
            component[a] = component[b] = min(component[a], component[b])
        if component == before:
            break
    return [(i, len(sets[i]), component[i]) for i in sorted(sets)]


def test_jaccard_members_of_a_large_group_meet_few_others(spark, monkeypatch):
    """Open pairs stay near the group's size, although its smallest ids, the first pivots, are far out."""
    pairs, real = [], jaccard_join.spill

    def spill(df, label, *more):
        table = real(df, label, *more)
        if label == "jaccard-pairs":
            pairs.append(table.count())
        return table

    monkeypatch.setattr(jaccard_join, "spill", spill)
    rows = near_group(3, 260)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs, percent=80, k=5).collect())
    assert got == brute_group(rows, 80, 5)
    assert pairs and max(pairs) < 3 * len(rows)  # 1021 pairs before


def test_jaccard_plans_few_joins_and_holds_no_sketch_on_the_driver(spark, monkeypatch):
    """What several branches read is a table, not a plan in each; the sketch of common shingles leaves the driver at once."""
    import sys

    import numpy as np
    joins, held, real = [], [], jaccard_join.spill

    def spill(df, label, *more):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        if label not in ("jaccard-prefixes", "links"):
            held.append(sum(x.nbytes for x in sys._getframe(1).f_locals.values() if isinstance(x, np.ndarray)))
        return real(df, label, *more)

    monkeypatch.setattr(jaccard_join, "spill", spill)
    rows = near_group(3, 260)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs, percent=80, k=5).collect())
    assert got == brute_group(rows, 80, 5)
    assert sum(joins) <= 90  # 163 before
    assert max(held) == 0  # 67108864 before, to the end of the join


def test_jaccard_levels_read_the_sets_of_open_documents_only(spark, monkeypatch):
    """Sets of documents whose regions are decided leave the disk before the levels."""
    import os
    sets, gone, real = {}, [], jaccard_join.spill

    def spill(df, label, *more):
        table = real(df, label, *more)
        if label in ("jaccard-sets", "jaccard-open-sets"):
            sets[label] = {r.id for r in table.select("id").collect()}, table.spilled_to
        if label == "jaccard-typical":
            gone.append(not os.path.exists(sets["jaccard-sets"][1].removeprefix("file:")))
        return table

    monkeypatch.setattr(jaccard_join, "spill", spill)
    rows = near_group(3, 120)
    for family in range(20):  # one word differs: linked at once
        words = [f"f{family}w{i}" for i in range(60)]
        rows += [(1000 + 2 * family, " ".join(words)), (1001 + 2 * family, " ".join([*words, "more"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jaccard_join.jaccard_components(docs, percent=80, k=5).collect())
    assert got == brute_group(rows, 80, 5)
    assert max(sets["jaccard-sets"][0]) >= 1000 > max(sets["jaccard-open-sets"][0])  # all sets to the end of the join before
    assert gone == [True]


def test_profiles_bound_what_sets_share():
    import numpy as np
    import pyarrow as pa
    rnd = np.random.default_rng(3)
    a, b, exact = [], [], []
    for n in (1, 2, 9, 60, 61, 130, 700, 5000, 40_000):
        for m in (n, max(1, n * 9 // 10), n // 3 + 1, 7):
            for share in (0, min(n, m) // 2, min(n, m)):
                h = rnd.integers(0, 2**64, n + m - share, dtype=np.uint64)
                a.append(np.unique(h[:n]))
                b.append(np.unique(h[n - share:]))
                exact.append(len(np.intersect1d(a[-1], b[-1])))
    profiles = [pa.array([jaccard_join._profile(s) for s in x], pa.binary()) for x in (a, b)]
    most = jaccard_join._most_shared(*profiles, np.full(len(a), -1))
    assert (most >= exact).all() and (most <= [min(len(x), len(y)) for x, y in zip(a, b, strict=True)]).all()
    assert max(len(jaccard_join._profile(s)) / len(s) for s in a if len(s) > 60) <= 0.25
    # a range of over 255 shingles has no byte: nothing is known
    dense = jaccard_join._profile(np.arange(300, dtype=np.uint64))
    assert dense == b"" and list(jaccard_join._most_shared(pa.array([dense], pa.binary()), profiles[0][:1], np.array([99]))) == [99]


def test_jaccard_unrelated_documents_that_share_a_shingle_have_no_sets(spark, monkeypatch):
    """Chance meetings over a rare shingle are decided by profiles: no set is written for them, in small regions."""
    rnd = random.Random(8)
    vocabulary = [f"v{i}" for i in range(24)]
    rows = [(i, " ".join(rnd.choice(vocabulary) for _ in range(70))) for i in range(200)]
    near = {}
    for i in range(0, 200, 10):
        words = rows[i][1].split()
        words[rnd.choice([0, 69])] = "other"
        near[1000 + i] = " ".join(words)
    near[1005] = " ".join([*rows[0][1].split()[:-2], "two", "others"])
    rows += sorted(near.items()) + [(1000, near[1010]), (None, rows[3][1]), rows[20]]  # an id with two texts, a copy without an id, a repeated row
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted({r for r in brute_components(rows)})
    real, seen = jaccard_join.spill, {}

    def spill(df, label, *more):
        table = real(df, label, *more)
        if label in ("jaccard-sets", "jaccard-sized"):
            seen[label] = table.count()
        return table

    monkeypatch.setattr(jaccard_join, "spill", spill)
    for most, small in ((128, True), (3, False)):
        monkeypatch.setattr(jaccard_join, "SMALL_REGION", most)
        seen.clear()
        got = jaccard_join.jaccard_components(docs).collect()
        assert sorted({tuple(r) for r in got if r.doc_id is not None}) == want and len(got) == len(rows)
        assert not small or seen["jaccard-sets"] < 70  # 98 before, of documents that meet others by chance
