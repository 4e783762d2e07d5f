"""Operator 6: exact n-gram Jaccard join in the metric space of shingle sets.

Jaccard distance is a metric.  Every rare shingle in a document's necessary
prefix elects a pivot document; documents that share the pivot form its region
(all pairs within the threshold meet in at least one).  Distances to the pivot
then decide by the triangle inequality: documents within the threshold link at
once, pairs whose pivot distances differ by more than the threshold cannot
link, and what is left open (far documents, and the boundary documents near
enough to them) joins again around a new pivot of the region, the document with
the commonest shingles first, level by level; after the last level, the open
pairs that share a token of their prefixes, now in order of exact counts among
the open documents, and lie within the windows of all regions they share are
compared.  Documents around one pivot meet there only over shingles that the
pivot lacks, or where what they share with it is enough for a link: members of
a large group differ by few such shingles, and each meets few others.  Nothing
is estimated: links are decided by exact set intersections.

The larger the corpus, the more unrelated documents share a rare shingle by
chance.  Each document therefore has a profile, how many of its shingles fall
into each of some buckets, a sixtieth of its set.  What two profiles have in
common bounds from above what the sets share: only documents that may be within
the threshold of another one of a region stay members, and only the sets of
pairs that may link move.

Why not plain nearest-pivot cells: unrelated texts lie at distance 1 from every
pivot, so windows around globally chosen pivots would copy each document into
each cell.  Electing pivots per rare shingle keeps the regions to documents
that have something in common.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm import sketch
from ledgerline.llm.components import connected_components
from ledgerline.llm.tables import drop, settle, spill
from ledgerline.llm.textscan import NOT_SPACE, Words, list_column, mix, pieces, shingles, utf8

#: Shingles whose hash ends in this many zero bits are counted exactly.
COUNTED_BITS = 2
#: Buckets (one byte each, 16 MB) that tell how common a counted shingle is.
LEVEL_BITS = 24
#: Shingles of a set for each byte of its profile at most; half of it at least.
PROFILE_SHINGLES = 8
#: Regions of so many documents at most have all their pairs of profiles compared; the levels open larger ones.
SMALL_REGION = 128


def _sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (fewer than k words: all of them as one)."""
    data, offsets = utf8(column, lower=True)
    words = Words(data, offsets, NOT_SPACE)
    h = words.hashes()
    grams, at = shingles(h, words.first, k)
    cut = np.searchsorted(at, words.first)
    out = []
    for i, n in enumerate(words.count):
        if n >= k:
            out.append(np.unique(grams[cut[i] : cut[i + 1]]))
        elif n:
            whole = np.uint64(n)
            for x in h[words.first[i] : words.first[i + 1]]:
                whole = mix(np.array([whole], dtype=np.uint64))[0] ^ x
            out.append(mix(np.array([whole], dtype=np.uint64)))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def _signature(values: np.ndarray) -> tuple[int, int]:
    d = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


def _counted(grams: np.ndarray) -> np.ndarray:
    return (grams & np.uint64((1 << COUNTED_BITS) - 1)) == 0


def _emit_counted(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            data, offsets = utf8(b.column(0), lower=True)
            words = Words(data, offsets, NOT_SPACE)
            grams, _ = shingles(words.hashes(), words.first, k)
            yield pa.RecordBatch.from_arrays([pa.array(grams[_counted(grams)].view(np.int64))], ["token"])

    return run


def _levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Logarithmic count of the shared tokens of a task, by bucket."""
    levels = np.zeros(1 << LEVEL_BITS, dtype=np.uint8)
    for b in batches:
        tokens = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        level = np.minimum(255, 4 * np.log2(b.column(1).to_numpy(zero_copy_only=False))).astype(np.uint8)
        np.maximum.at(levels, sketch.bucket(tokens, LEVEL_BITS), level)
    yield from sketch.to_rows(levels)


def _profile(s: np.ndarray) -> bytes:
    """How many shingles of the set fall into each of 2^b equal ranges of the hashes; empty if a byte cannot hold one."""
    bits = max(3, int(np.ceil(np.log2(max(len(s), 1) / PROFILE_SHINGLES))))
    counts = np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits)
    return counts.astype(np.uint8).tobytes() if counts.max() <= 255 else b""


def _most_shared(a: pa.Array, b: pa.Array, unknown: np.ndarray) -> np.ndarray:
    """The most shingles that the sets behind each pair of profiles can share; ``unknown`` where a profile is empty."""
    sides = []
    for c in (a, b):
        c = c.cast(pa.large_binary())
        at = np.frombuffer(c.buffers()[1], dtype=np.int64)[c.offset : c.offset + len(c) + 1]
        sides.append((np.frombuffer(c.buffers()[2] or b"", dtype=np.uint8), at[:-1], np.diff(at)))
    (data_a, at_a, long_a), (data_b, at_b, long_b) = sides
    out = unknown.copy()
    for x, y in {(int(x), int(y)) for x, y in zip(long_a, long_b, strict=True) if x and y}:
        rows = np.flatnonzero((long_a == x) & (long_b == y))
        m, step = min(x, y), max(1, (1 << 20) // max(x, y))
        for r in (rows[i : i + step] for i in range(0, len(rows), step)):
            # the longer one's ranges are joined to those of the shorter one
            one = data_a[at_a[r][:, None] + np.arange(x)].reshape(len(r), m, x // m).sum(axis=2, dtype=np.int64)
            two = data_b[at_b[r][:, None] + np.arange(y)].reshape(len(r), m, y // m).sum(axis=2, dtype=np.int64)
            out[r] = np.minimum(one, two).sum(axis=1)
    return out


def _judge(percent: int):
    """Rows of (..., n, m, profile, other's profile) with ``may`` for the profiles: whether the sets can be within the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n, m = (b.column(c).to_numpy(zero_copy_only=False) for c in ("n", "m"))
            both = np.minimum(_most_shared(b.column("_pa"), b.column("_pb"), np.minimum(n, m)), np.minimum(n, m))
            keep = [c for c in b.schema.names if c not in ("_pa", "_pb")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), pa.array(100 * both >= percent * (n + m - both))], [*keep, "may"])

    return run


def _judged(pairs: DataFrame, percent: int) -> DataFrame:
    schema = ", ".join(f"{c} long" for c in pairs.columns if c not in ("_pa", "_pb"))
    return pairs.mapInArrow(_judge(percent), f"{schema}, may boolean")


PREFIX_SCHEMA = "doc_id long, n long, s1 long, s2 long, prefix array<long>, profile binary"


def _only(wanted, at: int):
    """Rows whose column ``at`` passes the filter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.filter(pa.array(wanted(b.column(at).to_numpy(zero_copy_only=False))))

    return run


def _prefixes(shared, k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        for b in pieces(batches):
            sets = _sets(b.column(1), k)
            signs = [_signature(s) for s in sets]
            heads = []
            for s in sets:
                need = len(s) + (-percent * len(s) // 100) + 1 if len(s) else 0  # n - ceil(percent * n / 100) + 1
                # counted shingles first, of these the rare ones first: one order for all documents
                rank = np.where(_counted(s), common[sketch.bucket(s, LEVEL_BITS)].astype(np.int64), 256)
                heads.append(s[np.lexsort((s, rank))[:need]])
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in heads])])
            flat = np.concatenate(heads) if heads else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in signs], pa.int64()),
                 pa.array([y for _, y in signs], pa.int64()), list_column(flat.view(np.int64), bounds, pa.int64()),
                 pa.array([_profile(s) for s in sets], pa.binary())],
                ["doc_id", "n", "s1", "s2", "prefix", "profile"])

    return run


SET_SCHEMA = "id long, n long, s1 long, s2 long, grams array<long>"


def _full_sets(wanted, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            b = b.filter(pa.array(wanted(b.column(0).fill_null(0).cast(pa.int64()).to_numpy(zero_copy_only=False))))
            if not b.num_rows:
                continue
            sets = _sets(b.column(1), k)
            signs = [_signature(s) for s in sets]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([x for x, _ in signs], pa.int64()),
                 pa.array([y for _, y in signs], pa.int64()), list_column(np.concatenate(sets).view(np.int64), bounds, pa.int64())],
                ["id", "n", "s1", "s2", "grams"])

    return run


def _measure(pairs: DataFrame, sets: DataFrame, profiles: DataFrame, keep: list[str], percent: int, finish: Callable[[DataFrame], DataFrame],
             label: str) -> DataFrame:
    """Add the exact overlap of ``id`` and ``other`` and both sizes; null where the profiles rule a link out.

    Only the sets of pairs still in question move: once to their pair, and the
    others' to the result.  ``finish`` of these rows is spilled as ``label``.
    Four branches read the sized pairs: as a table, not as a plan in each of
    them, they leave the driver half the joins to plan, compile and hold.
    """
    sized = pairs.join(profiles.select("id", "n", F.col("profile").alias("_pa")), "id")
    sized = sized.join(profiles.select(F.col("id").alias("other"), F.col("n").alias("m"), F.col("profile").alias("_pb")), "other")
    sized = spill(_judged(sized.select("id", "n", "other", "m", *keep, "_pa", "_pb"), percent), "jaccard-sized")
    asked = sized.where("may").select("id", "n", "other", "m", *keep)
    # by the columns of the joins below: the sets are dealt out once for both sides
    held = lambda *c: sets.join(asked.select(F.col(c[0]).alias("id"), F.col(c[1]).alias("n")).distinct(), ["id", "n"], "left_semi")
    a = held("id", "n").select("id", "n", F.col("grams").alias("_ga"))
    b = held("other", "m").select(F.col("id").alias("other"), F.col("n").alias("m"), F.col("grams").alias("_gb"))
    told = asked.join(a, ["id", "n"]).join(b, ["other", "m"])
    both = F.size(F.array_intersect("_ga", "_gb")).cast("long").alias("both")
    told = told.select("id", "other", *keep, "n", "m", both).unionByName(
        sized.where("not may").select("id", "other", *keep, "n", "m", F.lit(None).cast("long").alias("both")))
    told = spill(finish(told), label)
    drop(sized)
    return told


def _near_members(members: DataFrame, profiles: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Of ``members(region, id)`` those that may be within the threshold of another document of the region, and (id) all that these may be near to.

    Any link between two documents of a region keeps both.  Members of regions
    of over SMALL_REGION documents all stay: their pairs are not listed here.
    """
    everyone = members.union(members.select("region", F.col("region").alias("id")).distinct())
    sizes = spill(members.groupBy("region").agg(F.count(F.lit(1)).alias("k")).select("region", (F.col("k") < SMALL_REGION).alias("small")), "jaccard-sizes")
    placed = everyone.join(sizes.where("small"), "region", "left_semi").join(profiles, "id")
    placed = spill(placed.select("region", "id", "n", "profile"), "jaccard-placed")
    a = placed.select("region", "id", "n", F.col("profile").alias("_pa"))
    b = placed.select("region", F.col("id").alias("other"), F.col("n").alias("m"), F.col("profile").alias("_pb"))
    pairs = a.join(b, "region").where((F.col("id") < F.col("other")) & (100 * F.least("n", "m") >= percent * F.greatest("n", "m")))
    may = _judged(pairs.select("region", "id", "n", "other", "m", "_pa", "_pb"), percent).where("may")
    # either end of a pair
    ends = may.select("region", F.explode(F.array("id", "other")).alias("id")).distinct()
    large = members.join(sizes.where("not small"), "region", "left_semi")
    whole = large.union(large.select("region", F.col("region").alias("id")).distinct())
    kept = spill(ends.select("region", "id").union(whole), "jaccard-near")
    drop(placed, sizes)
    return kept.where("region != id"), kept.select("id").distinct()


def _linked(percent: int):
    return F.coalesce(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both")), F.lit(False))


def _distance():
    return 1 - F.col("both") / (F.col("n") + F.col("m") - F.col("both"))


def _typical(sets: DataFrame) -> DataFrame:
    """(id, typical): how many of the sets have a shingle of this document, on average; highest in the middle of a group."""
    tokens = sets.select("id", F.explode("grams").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k"))
    return tokens.join(shared, "token").groupBy("id").agg(F.avg("k").alias("typical"))


def _homes(seen: list[DataFrame], single: DataFrame) -> DataFrame:
    """(id, home, o): the pivot that shares most with all documents measured against it, half of the own set if any does.

    ``seen`` (id, pivot, both) are the measured overlaps; documents with several sets have no home and are none.
    """
    asked = seen[0]
    for t in seen[1:]:
        asked = asked.unionByName(t)
    asked = asked.where("both is not null and id != pivot").join(single.select("id", "n"), "id").join(single.select(F.col("id").alias("pivot")), "pivot")
    asked = asked.select("id", "pivot", "n", "both").distinct()
    known = asked.groupBy("pivot").agg(F.sum("both").alias("shared"))
    best = F.max(F.struct(F.col("both") * 2 >= F.col("n"), "shared", "pivot", "both")).alias("m")
    return asked.join(known, "pivot").groupBy("id").agg(best).select("id", F.col("m.pivot").alias("home"), F.col("m.both").alias("o"))


def _rare_first(held: DataFrame, homes: DataFrame, sets: DataFrame) -> DataFrame:
    """(id, n, home, o, u, ranked): the shingles of each set of ``held`` documents by exact counts among them and their homes.

    Shingles that no other such set has come first; there are ``u`` of them and
    they match nothing, so only the rest is listed, as (k, token, inside): how
    many sets have it, and whether the home is one.
    """
    ids = held.select("id").distinct()
    middles = homes.join(ids, "id", "left_semi").select(F.col("home").alias("id")).distinct()
    # id and grams are all that any branch reads: the sets are dealt out once for all of them
    counted_sets = sets.select("id", "grams").join(ids.union(middles).distinct(), "id", "left_semi")
    counted_sets = counted_sets.select("*", F.xxhash64("id", "grams").alias("set"), F.size("grams").cast("long").alias("n"))
    tokens = counted_sets.select("id", "set", "n", F.explode("grams").alias("token"))
    shared = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    inside = tokens.join(middles, "id", "left_semi").select(F.col("id").alias("home"), "token", F.lit(True).alias("_in"))
    ranked = (tokens.join(ids, "id", "left_semi").join(homes, "id", "left").join(shared, "token").join(inside, ["home", "token"], "left")
              .groupBy("id", "set", "n", "home", "o")
              .agg(F.array_sort(F.collect_list(F.struct("k", "token", F.coalesce("_in", F.lit(False)).alias("inside")))).alias("ranked")))
    return ranked.withColumn("u", (F.col("n") - F.size("ranked")).cast("int"))


def _open_pairs(ranked: DataFrame, about: DataFrame, percent: int) -> DataFrame:
    """(id, other): the pairs of two components, one document far from a pivot at least, that may be within the threshold.

    Such a pair shares a token of both necessary prefixes.  If both have one
    home and share no shingle outside it, they share at most the lesser of
    their overlaps with it; if they share one, then also one of the first of
    those outside, as many of them as the overlaps leave missing.
    """
    ranked = ranked.join(about, "id")
    need = F.expr(f"cast(n - ceil({percent} * n / 100) + 1 as int)")
    heads = ranked.where(need > F.col("u")).select("id", "n", "c", "far", "home", "o", "u", F.posexplode(F.slice("ranked", F.lit(1), need - F.col("u"))).alias("i", "head"))
    heads = spill(heads.select("id", "n", "c", "far", "home", "o", F.col("head.token").alias("token"), "head.inside", (F.col("u") + F.col("i")).alias("pos")), "jaccard-heads")
    outer = ranked.where("home is not null").withColumn("outer", F.filter("ranked", lambda x: ~x["inside"])).withColumn("m", F.size("outer"))
    few = F.expr(f"cast(least(m, m - (ceil({percent} * n / 100) - o) + 1) as int)")
    outer = outer.where(few > 0).select("id", "n", "c", "far", "home", "o", "m", F.posexplode(F.slice("outer", F.lit(1), few)).alias("at", "head"))
    outer = spill(outer.select("id", "n", "c", "far", "home", "o", F.col("head.token").alias("token"), (F.col("m") - F.col("at")).alias("left")), "jaccard-outer")
    settle(ranked.sparkSession)
    side = lambda x, *more: [F.col(c).alias(c + x) for c in ("id", "n", "c", "far", "o", *more)]
    apart = (F.col("c_a") != F.col("c_b")) & (F.col("id_a") < F.col("id_b")) & (F.col("far_a") | F.col("far_b"))
    enough = lambda both: (100 + percent) * both >= percent * (F.col("n_a") + F.col("n_b"))
    # what the two can share at most: neither's own shingles, and nothing before their first shared token
    most = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    middle = F.least("o_a", "o_b")
    same = F.coalesce(F.col("home_a") == F.col("home_b"), F.lit(False))
    first = heads.select("token", *side("_a", "pos", "home", "inside")).join(heads.select("token", *side("_b", "pos", "home")), "token")
    first = first.where(apart & enough(most) & (~same | (F.col("inside_a") & enough(middle))))
    second = outer.select("token", "home", *side("_a", "left")).join(outer.select("token", "home", *side("_b", "left")), ["home", "token"])
    second = second.where(apart & enough(middle + F.least("left_a", "left_b")))
    pair = [F.col("id_a").alias("id"), F.col("id_b").alias("other")]
    return first.select(*pair).union(second.select(*pair)).distinct()


def _extend(links: DataFrame, found: DataFrame, fresh: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Add ``fresh`` links; the components found so far stand for the links before."""
    if fresh.isEmpty():
        return links, found
    stars = found.select(F.col("id").alias("a"), F.col("component").alias("b"))
    return links.union(fresh), spill(connected_components(stars.union(fresh)), "jaccard-found")


def _join(docs: DataFrame, percent: int, k: int, levels: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """`jaccard_links`, and the components (id, component) of its links."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    tokens = docs.select("text").mapInArrow(_emit_counted(k), "token long")
    shared_tokens = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # 2^LEVEL_BITS bytes, whatever the corpus; the driver holds them no longer than the prefixes need them
    shared = spark.sparkContext.broadcast(sketch.collect_sketch(shared_tokens.mapInArrow(_levels, sketch.SCHEMA), LEVEL_BITS, "max", np.uint8))
    headed = spill(docs.mapInArrow(_prefixes(shared, k, percent), PREFIX_SCHEMA), "jaccard-prefixes")
    shared.destroy()
    signed = spill(headed.drop("prefix", "profile"), "jaccard-documents")
    classes = spill(signed.where("n > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("id")).where("id is not null"), "jaccard-classes")
    settle(spark)
    # each set of an id once
    heads = headed.where("n > 0").join(classes.withColumnRenamed("id", "doc_id"), ["s1", "s2", "doc_id"], "left_semi").dropDuplicates(["s1", "s2", "doc_id"])
    heads = spill(heads.select(F.col("doc_id").alias("id"), "n", "prefix", "profile"), "jaccard-prefixes")
    drop(headed)
    settle(spark)
    tokens = heads.select("id", F.explode("prefix").alias("token"))
    elected = spill(tokens.groupBy("token").agg(F.min("id").alias("region"), F.max("id").alias("last"))
                    .where("last > region").drop("last"), "jaccard-pivots")
    settle(spark)
    # most tokens are one document's own: they stay behind before the second shuffle
    shared_token = sketch.bit_filter(elected, "token", 26)
    tokens = tokens.mapInArrow(_only(shared_token, 1), "id long, token long")
    members = spill(tokens.join(elected, "token").where("id != region").select("region", "id").distinct(), "jaccard-regions")
    profiles = spill(heads.select("id", "n", "profile"), "jaccard-profiles")
    drop(heads, elected)
    settle(spark)
    everyone, (members, nodes) = members, _near_members(members, profiles, percent)
    drop(everyone)
    settle(spark)
    sets = docs.mapInArrow(_full_sets(sketch.bit_filter(nodes, "id", 26), k), SET_SCHEMA)
    sets = spill(sets.join(classes, ["s1", "s2", "id"], "left_semi"), "jaccard-sets")
    several = sets.groupBy("id", "s1", "s2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not several.isEmpty():  # repeated rows: each set once
        once = spill(sets.dropDuplicates(["id", "s1", "s2"]), "jaccard-sets")
        drop(sets)
        sets = once
    whole, sets = sets, sets.select("id", "n", "grams")
    single = spill(sets.groupBy("id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("several")).where("several = 1").drop("several"), "jaccard-single")
    settle(spark)

    wide = (100 - percent) / 100 + 1e-9
    state = _measure(members.withColumnRenamed("region", "other"), sets, profiles, [], percent, lambda told: told.select(
        F.col("other").alias("region"), "id", "n", "both", _linked(percent).alias("near"), F.array(_distance()).alias("d")), "jaccard-level")
    seen = [state.select("id", F.col("region").alias("pivot"), "both")]
    state = state.drop("both")
    links = state.where("near").select(F.col("region").alias("a"), F.col("id").alias("b"))
    found = spill(connected_components(links), "jaccard-found")
    settle(spark)
    done = typical = None
    for level in range(levels + 1):
        held = state.join(found.withColumnRenamed("component", "_c"), "id", "left").withColumn("c", F.coalesce("_c", "id")).drop("_c")
        if done is not None:
            held = held.join(done, ["region", "id"], "left_anti")
        # regions that still hold far documents and two components are open
        open_regions = held.groupBy("region").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("near").alias("all_near"))
        open_regions = spill(open_regions.where("lo < hi and not all_near").select("region"), "jaccard-open")
        if open_regions.isEmpty():
            break
        held = spill(held.join(open_regions, "region"), "jaccard-held")
        if level:  # the first is in ``seen``
            drop(state)
        if typical is None:
            # the levels read the sets of open documents and of pivots that these were measured against: the others stay behind before any shuffle
            is_open = sketch.bit_filter(held.select("id").distinct(), "id", 25)
            is_pivot = sketch.bit_filter(state.join(held.select("id").distinct(), "id", "left_semi").select("region").distinct(), "region", 25)
            sets = spill(sets.mapInArrow(_only(lambda v: is_open(v) | is_pivot(v), 0), "id long, n long, grams array<long>"), "jaccard-open-sets")
            drop(whole)
            whole = sets
            settle(spark)
            typical = spill(_typical(sets.mapInArrow(_only(is_open, 0), "id long, n long, grams array<long>")), "jaccard-typical")
        if level < levels:
            middle = F.when(~F.col("near") | F.lit(level == 0), F.struct("typical", F.xxhash64("id")))
            pivots = spill(held.join(typical, "id").groupBy("region").agg(F.max_by("id", middle).alias("pivot")).where("pivot is not null"), "jaccard-middles")
            asked = held.join(pivots, "region").where("id != pivot").select("region", "id", F.col("pivot").alias("other"))
            told = _measure(asked, sets, profiles, ["region"], percent, lambda told: told.select(
                "region", "id", F.col("other").alias("pivot"), "both", _linked(percent).alias("hit"), _distance().alias("x")), "jaccard-level")
            seen.append(told.select("id", "pivot", "both"))
            links, found = _extend(links, found, told.where("hit").select(F.col("pivot").alias("a"), F.col("id").alias("b")))
            gone = pivots.select("region", F.col("pivot").alias("id"))
            done = gone if done is None else done.union(gone)
            state = spill(held.join(told.select("region", "id", "x"), ["region", "id"])
                          .select("region", "id", "n", "near", F.concat("d", F.array("x")).alias("d")), "jaccard-level")
            drop(held)
            settle(spark)
            continue
        # a document meets another once a shared token, however many regions hold both; the regions' windows then judge the pair
        about = held.groupBy("id").agg(F.max("c").alias("c"), F.max(~F.col("near")).alias("far"))
        homes = spill(_homes(seen, single), "jaccard-homes")
        ranked = spill(_rare_first(held, homes, sets), "jaccard-ranked")
        places = spill(held.groupBy("id").agg(F.collect_list(F.struct("region", "d")).alias("places")), "jaccard-places")
        settle(spark)
        pairs = spill(_open_pairs(ranked, about, percent), "jaccard-pairs")
        drop(ranked, held)
        of = lambda c, x: places.select(F.col("id").alias(c), F.col("places").alias(x))
        at_b = F.map_from_entries("pb")
        both = F.filter("pa", lambda p: F.map_contains_key(at_b, p["region"]))
        in_window = F.forall(F.transform(both, lambda p: F.zip_with(p["d"], F.try_element_at(at_b, p["region"]), lambda x, y: F.abs(x - y))),
                             lambda gaps: F.forall(gaps, lambda x: F.coalesce(x <= wide, F.lit(True))))
        pairs = pairs.join(of("id", "pa"), "id").join(of("other", "pb"), "other").where((F.size(both) > 0) & in_window).select("id", "other")
        pairs = spill(pairs, "jaccard-pairs")
        settle(spark)
        fresh = _measure(pairs, sets, profiles, [], percent, lambda told: told.where(_linked(percent)).select(F.col("id").alias("a"), F.col("other").alias("b")).distinct(), "jaccard-links")
        links, found = _extend(links, found, fresh)
    drop(whole, profiles)
    settle(spark)
    return signed, classes, links, found


def jaccard_links(docs: DataFrame, percent: int = 90, k: int = 3, levels: int = 2,
                  id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, classes, links) of the join at Jaccard similarity ``percent`` / 100 or more.

    documents: doc_id, n (set size), s1, s2 (set signature), one row per input
    row.  classes: s1, s2, id; documents with equal sets are one class under
    its smallest id, so copies never meet pairwise.  links: (a, b) between
    class ids, enough of them that reachability equals that of all links.

    Rows that share an id are one document.  Null ids take part in no link;
    null, empty and word-less texts have the empty set, which links with
    nothing.  Other columns are ignored.
    """
    return _join(docs, percent, k, levels, id_col, text_col)[:3]


def jaccard_components(docs: DataFrame, percent: int = 90, k: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable by links) of every row.

    A document without a set is its own component.  A null id has the
    component of its class, or null if no row of the class has an id.
    """
    documents, classes, _, found = _join(docs, percent, k, 2, id_col, text_col)
    named = spill(classes.join(found, "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component")), "jaccard-names")
    return (documents.join(named, ["s1", "s2"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id")))
