"""The whole pipeline against plain Python: every stage by brute force, chained."""
import hashlib
import math
import random
import struct
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import regex
from tokenizers import Tokenizer

from ledgerline.llm import queries
from ledgerline.session import fresh_dir
from tests.llm.test_joins import LOWER, WORD, brute_leaks
from tests.llm.test_scores import brute_base, brute_model

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def vote(value, good=(-math.inf, math.inf), bad=(-math.inf, math.inf)):
    if value is None:
        return 0
    return -1 if not bad[0] <= value <= bad[1] else 1 if good[0] <= value <= good[1] else 0


def brute_votes(text):
    """The nine rules on one text."""
    text = text or ""
    n, chars, symbols, dup_lines, repeated, _ = brute_base(text)
    words = WORD.findall(text)
    lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
    count = lambda pattern: len(regex.findall(pattern, text))
    over = lambda x, y: x / y if y else None
    top = math.inf
    return (vote(over(repeated, n), (-top, 0.05), (-top, 0.2)), vote(over(dup_lines, lines), (-top, 0.05), (-top, 0.34)),
            vote(over(symbols, n), (-top, 0.05), (-top, 0.2)), vote(over(count(r"[\p{L}\p{M}\p{N}]"), chars), (0.94, top), (0.89, top)),
            vote(over(chars, n), (2.5, 9.0), (2.0, 14.0)), vote(over(len(set(words)), math.sqrt(n)), (2.5, top), (1.5, top)),
            vote(over(count(r"\p{Lu}"), chars), (-top, 0.2), (-top, 0.5)), vote(over(count("!"), n), (-top, 0.05), (-top, 0.3)),
            vote(over(count(r"[.?](?:\s|$)"), n), (0.01, 0.6)))


def brute_quality(docs):
    votes = [brute_votes(d[1]) for d in docs]
    prior, good, bad = brute_model(votes)
    kept = []
    for d, v in zip(docs, votes, strict=True):
        odds = math.log(prior / (1 - prior))
        odds += sum(math.log(g / (1 - b)) if x == 1 else math.log((1 - g) / b) for x, g, b in zip(v, good, bad, strict=True) if x)
        if odds >= 0 and not brute_base(d[1])[-1]:
            kept.append(d)
    return kept


def brute_near(docs):
    """Five words, 80 percent; of a group the smallest id, rows without an id all."""
    nodes = sorted({(d[0], d[1]) for d in docs if d[0] is not None})
    words = {x: WORD.findall((x[1] or "").translate(LOWER)) for x in nodes}
    sets = {x: {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for x, w in words.items()}
    group = {x: x for x in nodes}
    links = [(a, b) for a in nodes for b in nodes if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while any(group[a] != group[b] for a, b in links):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    rows = {(d[0], d[1]): d for d in docs}
    return [rows[x] for x in sorted(set(group.values()))] + [d for d in docs if d[0] is None], len(links)


def brute_mix(docs):
    """Targets raised source by source, copies placed by the schedule's inverse; copies in training order."""
    size = lambda d: len(WORD.findall(d[1] or ""))
    sources = sorted({d[3] for d in docs}, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(sources)}
    held = {s: sum(size(d) for d in docs if d[3] == s) for s in sources}
    full = set()
    while True:
        rest = sum(held.values()) - sum(3 * held[s] for s in full)
        level = {s: rest * weight[s] / sum(weight[t] for t in sources if t not in full) for s in sources if s not in full}
        more = {s for s in level if level[s] > 3 * held[s]}
        if not more:
            break
        full |= more
    target = {s: float(3 * held[s]) if s in full else level[s] for s in sources}
    digest = lambda x: hashlib.md5(x.encode()).hexdigest()
    placed = []
    for s in sources:
        before, early = 0, (1.5, 1.0, 0.5)[weight[s] - 1]
        order = lambda d: (digest("" if d[0] is None else str(d[0])), d[0] or 0, digest(d[1] or ""))
        for d in sorted((d for d in docs if d[3] == s), key=order):
            whole = math.floor(target[s] / held[s])
            for k in range(min(3, whole + (before + size(d) / 2 <= target[s] - whole * held[s]))):
                share = (k * held[s] + before) / target[s]
                at = min(1.0, 2 * share / (early + math.sqrt(early * early + 4 * (1 - early) * share))) if share > 0 else 0.0
                placed.append((at, d[0] is not None, d[0] or 0, d))
            before += size(d)
    return [p[-1] for p in sorted(placed, key=lambda p: p[:3])]


def brute_tokens(docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(queries.TOKENIZER))
    start, out = 0, []
    for d in docs:
        ids = [*tokenizer.encode(d[1] or "", add_special_tokens=False).ids, 0]
        out.append((d[0], start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def corpus():
    rnd = random.Random(11)
    vocabulary = sorted({"".join(rnd.choice("abdeghiklmnoprstué") for _ in range(rnd.randint(3, 8))) for _ in range(400)})

    def words(n):
        return [rnd.choice(vocabulary) + rnd.choice([""] * 8 + [".", ","]) for _ in range(n)]

    def text(w):
        return "".join(x + rnd.choice([" "] * 9 + ["\n"]) for x in w) + "end."

    items = [(i, " ".join(words(rnd.choice([4, 12, 30])))) for i in range(8)] + [(None, " ".join(words(15))), (90, None), (91, " .. ")]
    docs = []
    for i in range(40):
        base = words(rnd.randint(60, 110))
        docs.append((i, text(base)))
        for k in range(rnd.choice([0, 1, 2])):  # near copies, of them some below the threshold
            near = list(base)
            for _ in range(rnd.choice([1, 1, 2, 8])):
                near[rnd.randrange(len(near))] = rnd.choice(vocabulary)
            docs.append((100 + 10 * i + k, text(near)))
    for i in range(8):
        docs.append((600 + i, text(words(30)) + " " + items[i][1] + " " + text(words(5))))
    junk = ["#", "*", "$$", "|", "!!!", "AAAA", "a", "<>"]
    docs += [(700 + i, " ".join(rnd.choice(junk) for _ in range(30))) for i in range(12)]
    docs += [(720 + i, " ".join(words(6) * 5)) for i in range(4)] + [(730, "few words."), (731, ""), (732, None), (733, "\n\n"), (None, None)]
    docs += [docs[0], docs[5], (3, text(words(60))), (None, text(words(50))), (None, text(words(45)))]
    # rows of one id and equal texts are one document to the pipeline, so they have one source
    source = {d: rnd.choice(["a", "a", "a", "b", "Ü", None]) for d in docs}
    return [(i, t, "en", source[i, t], len(t or "")) for i, t in docs], items


def test_pipeline_equals_plain_python(spark):
    rows, items = corpus()
    root = fresh_dir(spark, "pipeline-fixture")
    spark.createDataFrame(rows, DOCUMENTS).repartition(3).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    one = brute_quality(rows)
    two, links = brute_near(one)
    leaky = {(d, n, tuple(i)) for d, n, _, i, found in brute_leaks([(k, d[1]) for k, d in enumerate(two)], items) if found}
    three = [d for k, d in enumerate(two) if k not in {k for k, _, _ in leaky}]
    four = brute_mix(three)
    assert len(rows) > len(one) > len(two) > len(three) > 30 and links > 15 and max(Counter(four).values()) > 1
    got = [tuple(r) for r in corpus_pipeline.run(spark, root).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got, key=lambda r: r[1]) == brute_tokens(four)


def test_pipeline_without_documents(spark):
    root = fresh_dir(spark, "pipeline-empty")
    spark.createDataFrame([], DOCUMENTS).write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame([(1, "some words of an item")], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    assert corpus_pipeline.run(spark, root).collect() == []
