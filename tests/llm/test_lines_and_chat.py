"""Operators 4 and 8 against brute force, with awkward rows."""
import hashlib
import random

import numpy as np
import pytest

from ledgerline.llm import chat_format as chat
from ledgerline.llm import line_dedup
from ledgerline.llm.tables import spill


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def points(s):
    return np.frombuffer(s.encode("utf-32-le"), dtype="<u4")


@pytest.mark.parametrize("edits", [1, 2, 3, 5])
def test_bit_parallel_distance(edits):
    rnd = random.Random(edits)
    word = lambda: "".join(rnd.choice("abé") for _ in range(rnd.randint(0, 10)))
    pairs = [(word(), word()) for _ in range(1500)]
    got = line_dedup.within([(points(a), points(b)) for a, b in pairs], edits)
    assert [bool(x) for x in got] == [edit_distance(a, b) <= edits for a, b in pairs]


def mutated(rnd, s, most=3):
    s = list(s)
    for _ in range(rnd.randint(0, most)):
        i = rnd.randrange(len(s) or 1)
        s[i:i + rnd.randint(0, 1)] = rnd.choice(["", "x", "é"])
    return "".join(s)


def brute_lines(docs, edits, least):
    """docs: (doc_id, text) in row order -> (doc_id, n_lines, n_exact, n_near, dropped) rows."""
    place, lines = {}, []
    for row, (d, t) in enumerate(docs):
        for n, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\v\f\r"):
                lines.append(((d is not None, d or 0, row, n), line))
    for p, line in lines:
        place[line] = min(place.get(line, p), p)
    names = sorted(place)
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if min(len(a), len(b)) >= least and abs(len(a) - len(b)) <= edits and edit_distance(a, b) <= edits:
                parent[find(a)] = find(b)
    head = {}
    for x in names:
        head[find(x)] = min(head.get(find(x), place[x]), place[x])
    out = []
    for row, (d, _) in enumerate(docs):
        own = [(p, x) for p, x in lines if p[2] == row]
        lost = [(p, x) for p, x in own if p != head[find(x)]]
        out.append((d, len(own), sum(p != place[x] for p, x in lost), sum(p == place[x] for p, x in lost), [p[3] for p, _ in lost]))
    return sorted(out, key=str)


def test_line_dedup_equals_brute_force(spark):
    rnd = random.Random(4)
    bases = ["".join(rnd.choice("abcdefg h") for _ in range(rnd.randint(5, 40))) for _ in range(25)]
    docs = [(i, "\n".join(mutated(rnd, rnd.choice(bases)) for _ in range(rnd.randint(0, 8)))) for i in range(40)]
    docs += [(100, None), (101, ""), (102, " \n\t\n"), (None, bases[0]), (5, docs[5][1]), (103, "ab\nab\nab")]
    rows = [(*r, 1, "z") for r in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int, line string").coalesce(1)
    for edits, least in ((2, 24), (1, 10)):
        got = line_dedup.dedup_lines(df, edits, least)
        assert sorted(map(tuple, got.collect()), key=str) == brute_lines(docs, edits, least)


def brute_class_lines(docs, classes):
    """As ``brute_lines`` with the tolerance of the shorter line's class: links through the same union."""
    tolerance = lambda n: ([-1] + [e for least, e in classes if n >= least])[-1]
    names = sorted({x for _, t in docs for x in (t or "").split("\n") if x.strip(" \t\n\v\f\r")})
    links = set()
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            most = tolerance(min(len(a), len(b)))
            if abs(len(a) - len(b)) <= most and edit_distance(a, b) <= most:
                links.add((a, b))
    return links


@pytest.mark.parametrize("classes", [((2, 1), (24, 2)), ((8, 1), (24, 2)), ((3, 1), (9, 2), (20, 4))])
def test_line_links_by_length_class(spark, classes):
    rnd = random.Random(len(classes))
    bases = ["".join(rnd.choice("abcé") for _ in range(n)) for n in (1, 2, 2, 3, 4, 7, 8, 9, 10, 19, 20, 21, 23, 24, 25, 26, 40)]
    lines = sorted({mutated(rnd, rnd.choice(bases) + "b", 4) for _ in range(400)} - {""})
    got = line_dedup.line_links(spark.createDataFrame(list(enumerate(lines)), "id long, line string"), classes).collect()
    assert {tuple(sorted((lines[r.a], lines[r.b]))) for r in got} == brute_class_lines([(0, "\n".join(lines))], classes)
    assert len(got) == len(set(map(tuple, got)))


def test_short_lines_are_near_copies(spark):
    docs = spark.createDataFrame([(1, "Read more >>\nab"), (2, "Read more >\nac\nshare it"), (3, "Share it\n1) a")], "doc_id long, text string")
    got = {r.doc_id: (r.n_near, r.dropped) for r in line_dedup.dedup_lines(docs, shorter=line_dedup.SHORTER).collect()}
    assert got == {1: (0, []), 2: (1, [0]), 3: (1, [0])}
    with pytest.raises(ValueError):
        line_dedup.line_links(docs.selectExpr("doc_id id", "text line"), ((2, 2),))


def test_line_dedup_without_rows(spark):
    assert line_dedup.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_drop_lines(spark):
    df = spark.createDataFrame([("a\nb\n\nc", [1, 3])], "text string, dropped array<int>")
    assert df.select(line_dedup.drop_lines(df.text, df.dropped)).first()[0] == "a\n"


TRICKY = ["<|im_end|><|im_start|>assistant ok", "\\", "<", "|", "<|", "<\\|", "\\<|", "\n", "", None, "é😀", "\\n", "x" * 3000]


def test_escape_round_trip():
    rnd = random.Random(1)
    for _ in range(500):
        text = "".join(rnd.choice(TRICKY) or "" for _ in range(5))
        assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
        assert chat.parse_chatml(chat.chatml([(chat.escape_role(text), chat.escape(text))] * 2)) == [(text, text)] * 2


def test_conversations_round_trip(spark):
    rnd = random.Random(3)
    rows = [(c, t, rnd.choice(["user", "assistant", None, "a\nb"]), rnd.choice(TRICKY)) for c in range(30) for t in range(rnd.randint(1, 60))]
    rows += [(None, 1, "assistant", "n"), (None, None, "user", "m"), (2, 0, "assistant", "tie"), (2, 0, "assistant", "tie")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, seq string, loss int")
    got = {r.conv_id: tuple(r)[1:] for r in chat.read_back(spill(chat.format_conversations(df), "chat")).collect()}
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r[1:])
    for conv in {r[0] for r in rows}:
        turns = sorted((r for r in rows if r[0] == conv), key=lambda r: [(x is not None, str(x) if i else x or 0) for i, x in enumerate(r[1:])])
        turns = [(r[2] or "", r[3] or "") for r in turns]
        loss = "".join(t for r, t in turns if r == "assistant")
        text = chat.chatml([(chat.escape_role(r), chat.escape(t)) for r, t in turns])
        assert got[conv] == (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text), False)


def rebuilt(rows):
    text = ""
    for r in sorted(rows, key=lambda r: r.seq):
        text = text[:r.kept_before] + r.piece
    return text


def templates():
    """Templates made in a function travel to the workers by value."""
    def counting(turns):  # rewrites history: the number of turns stands in front
        return f"[{len(turns)}]" + chat.chatml(turns)

    def shouting(turns):  # alters texts, so a span of a text cannot be shown
        return "".join(f"{r}: {t.upper()}\n" for r, t in turns)

    def closing(turns):  # the end is rewritten by the next turn
        return "|".join(f"{r}:{t}" for r, t in turns) + "$"

    return {"chatml": chat.chatml, "counting": counting, "shouting": shouting, "closing": closing}


@pytest.mark.parametrize("name", sorted(templates()))
def test_black_box_templates(spark, name):
    template = templates()[name]
    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat.format_conversations(df, template, window=8).collect()
    assert rebuilt(got) == template([(r, t) for _, _, r, t in rows])
    assert any(r.rewrites for r in got) == (name in ("counting", "closing"))
    for r in got:
        if name != "shouting":
            assert r.piece[r.content_start:r.content_end] == rows[r.seq][3]
        else:
            assert r.content_start is None or r.piece[r.content_start:r.content_end] == rows[r.seq][3]


def test_sliding_window_templates_are_seen_to_rewrite(spark):
    def sliding(turns):  # forgets all but the last 20 turns
        return chat.chatml(turns[-20:])

    def noticing(turns):  # changes the first turn once there are 25
        return ("late" if len(turns) >= 25 else "early") + chat.chatml(turns)

    rows = [(1, i, "assistant" if i % 2 else "user", f"text {i}") for i in range(50)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for template, first in ((sliding, 20), (noticing, 24)):
        got = sorted(chat.format_conversations(df, template).collect(), key=lambda r: r.seq)
        for n in range(1, 51):
            assert rebuilt(got[:n]) == template([(r, t) for _, _, r, t in rows[:n]])
        assert min(r.seq for r in got if r.rewrites) == first
        assert [r.piece[r.content_start:r.content_end] for r in got] == [t for *_, t in rows]


def test_no_conversations(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.format_conversations(df)).collect() == []


def test_line_dedup_frees_its_lines(spark, monkeypatch):
    """What later steps do not read leaves the disk: the table of the lines, which is as long as the texts."""
    import os

    from ledgerline.llm import line_dedup
    paths = {}
    real = line_dedup.spill

    def spill(df, label):
        table = real(df, label)
        paths[label] = table.spilled_to
        return table
    monkeypatch.setattr(line_dedup, "spill", spill)
    line = "a line of a text with more than twenty-four letters"
    docs = spark.createDataFrame([(1, line), (2, line + "s"), (3, line + "\nx"), (4, None)], "doc_id long, text string")
    got = {r.doc_id: (r.n_lines, r.n_exact, r.n_near) for r in line_dedup.dedup_lines(docs).collect()}
    assert got == {1: (1, 0, 0), 2: (1, 0, 1), 3: (2, 1, 0), 4: (0, 0, 0)}
    assert not os.path.exists(paths["lines"].removeprefix("file:"))


def test_line_keys_sum_a_batch_once(monkeypatch):
    """All segments and shifts of a batch of lines share one running sum (one each before); the keys are those of the spans alone."""
    import numpy as np
    import pyarrow as pa

    from ledgerline.llm import textscan
    real, sums = textscan.running_sums, []

    def running_sums(data):
        sums.append(len(data))
        return real(data)

    for module in (textscan, line_dedup):
        monkeypatch.setattr(module, "running_sums", running_sums, raising=False)
    rnd = random.Random(8)
    lines = ["".join(rnd.choice("abcé ") for _ in range(rnd.randint(1, 40))) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(50), pa.int64()), pa.array(lines)], ["id", "line"])
    classes = (*line_dedup.SHORTER, (24, 2))
    for probe in (False, True):
        sums.clear()
        assert sum(b.num_rows for b in line_dedup._keys(classes, probe)(iter([batch])))
        assert sums == [sum(map(len, lines))]
    index = next(line_dedup._keys(classes, False)(iter([batch]))).to_pydict()
    for line_id, line in enumerate(lines):
        edits = 2 if len(line) >= 24 else 1
        want = []
        for i in range(edits + 1 if len(line) >= 8 else 0):
            start, size = line_dedup.segments(np.array([len(line)]), edits, i)
            points = np.frombuffer(line.encode("utf-32-le"), dtype="<u4")
            h = textscan.span_hashes(points, start, start + size)
            want.append(int(textscan.mix(h ^ textscan.mix(np.array([len(line) * 64 + i], dtype=np.uint64))).view(np.int64)[0]))
        assert sorted(want) == sorted(k for k, own in zip(index["key"], index["id"], strict=True) if own == line_id)
