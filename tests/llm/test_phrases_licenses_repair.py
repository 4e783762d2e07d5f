"""Operators 11 to 13 against brute force, and their awkward rows."""
import hashlib
import heapq
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import license_rules, licenses, phrases, repair
from ledgerline.llm.tables import ship

DOCS = "doc_id long, text string, lang string, label string"
TURNS = "conv_id long, turn long, role string, text string, label string"


@pytest.fixture(autouse=True)
def _ship(spark):
    ship(spark)


# -- phrases ---------------------------------------------------------------------
def _phrases(rows, support, longest, top):
    counts, total = {}, Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, c in counts.items():
        found = []
        for p, a in c.items():
            if len(p) < 2 or a < support:
                continue
            inside = any(len(q) > len(p) and n >= support and 100 * n >= 50 * a
                         and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, n in c.items())
            score, cut = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            if not inside:
                found.append((-score, -a, " ".join(p).encode(), p, cut))
        for rank, (score, a, _, p, cut) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, " ".join(p), -a, c[p[:cut]], c[p[cut:]], total[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest", [2, 3, 4])
def test_phrases_equal_brute_force(spark, longest):
    random.seed(longest)
    words = ["Alpha", "beta", "gamma", "délta", "a.b", "x"]
    rows = [(i, " ".join(random.choice(words) for _ in range(random.randint(0, 40))) + random.choice([".", "\n", ""]), random.choice(["en", "de", None]), "x")
            for i in range(60)]
    rows += [(None, None, "en", "x"), (7, "", None, "x"), (7, "\t alpha  beta\talpha beta", "fr", "x")] + [(100, "alpha beta gamma x", "en", "x")] * 12
    got = phrases.mine_collocations(spark.createDataFrame(rows, DOCS), support=4, longest=longest, top=9)
    columns = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == _phrases(rows, 4, longest, 9)


def test_phrases_of_nothing_and_of_one_long_text(spark):
    assert phrases.mine_collocations(spark.createDataFrame([], DOCS)).count() == 0
    text = "alpha beta " * 150_000  # one text of 1.6 MB, longer than a scan
    got = phrases.mine_collocations(spark.createDataFrame([(1, text, "en", "x")], DOCS), longest=2).collect()
    assert {(r["phrase"], r["a"], r["n"]) for r in got} == {("alpha beta", 150_000, 300_000), ("beta alpha", 149_999, 300_000)}


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    big = 3_000_000_019
    rows = [("en", "a b", 2, big), ("en", "a", 1, big + 7), ("en", "b", 1, big + 13)]
    got = phrases.score_collocations(spark.createDataFrame(rows, "lang string, phrase string, k int, n long")).first()
    assert got["score"] == 1000000 * big * big // ((big + 7) * (big + 13))


# -- licenses ------------------------------------------------------------------------
def _scan(text, rules):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    padded = "".join(f" {w} " for w in words)
    hits = []
    for n, r in enumerate(rules):
        for m in re.finditer(r.regex, padded):
            first = padded[: m.start()].count(" ") // 2
            hits.append((first, first + m[1].count("  "), r.tier, n))
    kept = [h for h in hits if not any(
        o != h and o[0] <= h[0] and o[1] >= h[1] and (o[2] < h[2] or o[2] == h[2] and (o[1] - o[0] > h[1] - h[0] or o[3] < h[3])) for o in hits)]
    base = [h for h in hits if rules[h[3]].base]
    labels = {rules[h[3]].label for h in kept + base}
    return (len(words), len(base), min((h[0] for h in base), default=None), max((h[0] for h in base), default=None),
            ",".join(sorted({rules[h[3]].label for h in base})), ",".join(sorted(labels)),
            max((license_rules.CONFIDENCE[h[2]] for h in kept), default=0.0),
            [(rules[h[3]].label, h[0], h[1], " ".join(words[h[0] : h[1] + 1])) for h in sorted(kept, key=lambda h: (h[0], -h[1], h[2], h[3]))])


TEXTS = [
    None, "", "   ...", "no such thing", "Released under the MIT License.", "under the MIT license, under the MIT licenses",
    "Licensed under the Apache License, Version 2.0 (the License)", "CC BY-NC 4.0 cc by nc CC-BY-NC", "mit mit ich gehe mit",
    "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: MIT",
    "under the terms of the GNU General Public License as published by the FSF, either version 3 of the License, or (at your option) any later version",
    "GNU Lesser General Public License v2.1 and LGPLv2.1 and gplv3", "Creative Commons Attribution-ShareAlike 4.0 International License",
    "Dies ist mit ÄÖ licence ouverte", "Mozilla Public License 2.0 and the BSD 3-Clause license and new BSD license", "All rights reserved.",
    "the unlicense apache license apache license version 2 apache software license 1.1",
]


def test_licenses_equal_brute_force(spark):
    rules = license_rules.signatures()
    assert len(rules) > 300 and all(re.compile(r.regex) for r in rules)
    random.seed(3)
    mixed = [" ".join(random.choice(TEXTS[4:]) for _ in range(6)) for _ in range(20)]
    rows = [(i, t, "en", "x") for i, t in enumerate(TEXTS + mixed + [TEXTS[4]])] + [(None, "x " * 30_000 + "cc by nc " * 700, None, "x")]
    got = licenses.scan_licenses(spark.createDataFrame(rows, DOCS).withColumn("labels", F.lit("clash"))).collect()
    assert len(got) == len(rows)
    wanted = {r[0]: _scan(r[1], rules) for r in rows if r[0] is not None}
    for r in got:
        if r["doc_id"] is None:
            assert (r["n_base"], r["first_word"], r["last_word"]) == (700, 30_000, 30_000 + 3 * 699) and len(r["detections"]) == 700
            continue
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"],
                [(d["label"], d["first_word"], d["last_word"], d["words"]) for d in r["detections"]]) == wanted[r["doc_id"]], r["doc_id"]
    assert licenses.scan_licenses(spark.createDataFrame([], DOCS)).count() == 0


def test_every_match_holds_its_keyword():
    for r in license_rules.signatures():
        words = [re.sub(r"\(\?:(.*)\)", r"\1", t) for t in r.words.split(" ") if not t.startswith(("~", ".."))]
        assert any(re.fullmatch(t, k) for t in re.split(r" |\|", " ".join(words)) for k in r.keyword.split("|")), r


# -- repair ----------------------------------------------------------------------------
def _cheapest(symbols):
    heap, done = [(0, "", 0, 0)], set()
    while heap:
        cost, audit, i, state = heapq.heappop(heap)
        if i == len(symbols) and state in (0, 3):
            return cost, audit
        if (i, state) in done:
            continue
        done.add((i, state))
        heapq.heappush(heap, (cost + 3, audit + "I", i, {0: 2, 1: 2, 2: 3, 3: 2}[state]))
        if i < len(symbols):
            role, fault = symbols[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                take = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}.get((state, role))
                if take:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, take))
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, {0: 2, 1: 2, 2: 3, 3: 2}[state]))


def _repair(rows):
    """The result of one conversation, row by row."""
    rows = sorted(((t is not None, t or 0, " " if r is None else r, " " if x is None else x) for t, r, x in rows))
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = _cheapest([(r[2][:1], f) for r, f in zip(rows, faults, strict=True)])
    out, state, left = [], 0, iter(rows)
    for letter in audit:
        role, to = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}[state]
        row = None if letter == "I" else next(left)
        if letter == "D":
            continue
        if letter == "K":
            role, to = row[2], {"s": 1, "u": 2, "a": 3}[row[2][:1]]
        out.append(f"{role}:{row[3] if row else ''}")
        state = to
    turns = [r[1] for r in rows if r[0]]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def _results(df):
    return {r["conv_id"]: tuple(r[c] for c in (*repair.COUNTS, "audit", "repaired_sha256")) for r in df.collect()}


@pytest.mark.parametrize("chunk", [repair.CHUNK_TURNS, 5])
def test_repair_equals_brute_force(spark, chunk):
    random.seed(11)
    rows = []
    for conv in [None, *range(40)]:
        for t in range(random.choice([1, 3, 8, 30])):
            role = random.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = random.choice(["Ja.", "Nein!", "half", "", " \t", None, "Was? ", f"t{t}.", "Grüße 😀."])
            rows += [(conv, random.choice([t, t, t, None]), role, text, "x")] * random.choice([1, 1, 1, 2])
    wanted = {c: _repair([r[1:4] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    turns = spark.createDataFrame(rows, TURNS).repartition(3)
    assert _results(repair.repair_conversations(turns, chunk_turns=chunk)) == wanted


def test_a_long_conversation_is_cut_and_joined_again(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"turn {t}.", "x") for t in range(3 * repair.CHUNK_TURNS)]
    got = _results(repair.repair_conversations(spark.createDataFrame(rows, TURNS)))
    assert got == {1: _repair([r[1:4] for r in rows])}


def test_runs_use_powers_of_their_transition():
    for symbol in ("u.", "at", "sx", "-."):
        for n in (1, 2, 5, 64, 100):
            letters, state = repair.edits([symbol] * n)
            assert letters + repair.tail(state) == _cheapest([(symbol[0], {".": "", "t": "truncated", "x": "blank"}[symbol[1]])] * n)[1]


def test_damage_and_conversations_without_turns(spark):
    rows = [(c, t, "assistant", "A. b! c?", "x") for c in range(20) for t in range(4)] + [(None, None, None, None, "x")]
    df = spark.createDataFrame(rows, TURNS)
    wanted = []
    for c, t, role, text, _ in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        wanted += [(c, t, "user" if k == 4 else role, text)] * {0: 0, 3: 2}.get(k, 1)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    assert sorted((tuple(r) for r in repair.damage(df).collect()), key=key) == sorted(wanted, key=key)
    gone = repair.repair_all(df.limit(0), df).collect()
    assert len(gone) == 21 and {tuple(r)[1:] for r in gone} == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest(), 0)}
    assert repair.repair_conversations(df.limit(0)).count() == 0


def test_mined_rows_of_longer_phrases_are_numbers():
    """Language and shard are one number there; both still keep their counts apart."""
    import pyarrow as pa

    from ledgerline.llm import phrases
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["en", "de", "en", "en"]), pa.array([0, 0, 1, 0], pa.int32()), pa.array(["a b a b", "a b", "a b", "A B. c"])], ["lang", "shard", "text"])
    words = pa.Table.from_batches(phrases._mine(1, None)([batch]))
    assert words.column_names == ["lang", "shard", "part", "key", "n"]
    named = {r["part"]: (r["lang"], r["shard"]) for r in words.to_pylist()}
    assert sorted(named.values()) == [("de", 0), ("en", 0), ("en", 1)]
    pairs = pa.Table.from_batches(phrases._mine(2, None)([batch]))
    assert pairs.schema.types == [pa.int64()] * 3
    counts = {}
    for r in pairs.to_pylist():
        counts.setdefault(named[r["part"]], []).append(r["n"])
    assert {k: sorted(v) for k, v in counts.items()} == {("en", 0): [1, 3], ("de", 0): [1], ("en", 1): [1]}
