"""N-gram Jaccard join: documents linked by the similarity of their shingle sets, and their groups.

Method: prefix index with set-relation skipping. Shingles are ordered rare
first, so that two sets of the wanted similarity share one of their first
few shingles; those are the index. Two kinds of skipping follow:

* index level: a list of the index is cut into blocks by position and set
  size; pairs of blocks whose sizes or positions rule out the similarity,
  or whose sets are all known to be connected, are skipped unread;
* answer level: each list's leader (the set in which the list's shingle
  comes earliest) is compared with the others first. A set's answers are
  then derived from its leader's computed answers: sets connected through a
  leader are not compared with each other again, and by the triangle
  inequality of the Jaccard distance only sets whose distances to a common
  leader differ by at most the allowed distance are;
* pair level: parity bits of either set bound their difference from below,
  which settles most pairs of different sets before any set is shipped.

Equal sets are one class from the start and enter the index once. Groups
are connected components of the links, found by Spark joins alone.

Shingles are 64-bit hashes. "Rare" is read from a count sketch of fixed
size; any order is right, a better one is faster.

Defined cases: a text without words (or null) has an empty set and links
with nothing; one of fewer words than a shingle is one shingle; rows that
share a ``doc_id`` are one node with several sets; a null ``doc_id`` has no
component (null) and links with nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import join_counted, unpack, whole_row, written

#: Counters of the sketch, and how many one row of it holds.
COUNTERS, CHUNK = 1 << 20, 1 << 14
#: Rows of one part of the sketch that are summed at once.
FAN_IN = 64
#: Partners of one set that are verified in one join group.
PARTNERS = 1000
#: Ids (8 bytes each) that are broadcast to pick documents from a scan; beyond, the documents are shuffled instead.
BROADCAST_IDS = 2_000_000
#: Positions that share a block of an index list.
BLOCK = 8
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def shingles(text: bytes | None, words: int) -> np.ndarray:
    """The distinct shingles of a text as sorted hashes. ``bytes.lower`` and ``bytes.split`` know ASCII only,
    as the definition of a word asks."""
    parts = text.lower().split() if text else []
    if not parts:
        return np.zeros(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, parts), dtype=np.uint64, count=len(parts))
    n = max(1, len(h) - words + 1)
    out = np.full(n, min(len(h), words), dtype=np.uint64)
    for k in range(min(words, len(h))):
        out = (out ^ (out >> np.uint64(29))) * _M1 + (h[k : k + n] ^ _M3) * _M2
    out ^= out >> np.uint64(32)
    out *= _M3
    out ^= out >> np.uint64(29)
    return np.unique(out)


def prefix_length(n, percent: int):
    """How many of a set's n shingles, in the common order, a similar set must share one of."""
    return n - (percent * n + 99) // 100 + 1


def parity_bits(s: np.ndarray) -> bytes:
    """One bit per hash slot: whether an odd number of the set's shingles falls on it. As many slots as the next
    power of two above the set's size (64 at least), so that the bits stay far smaller than the set."""
    slots = 1 << max(6, int(len(s) - 1).bit_length())
    odd = np.bincount((s % np.uint64(slots)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def differing(one: bytes, two: bytes) -> int:
    """Slots whose parity differs: each needs a shingle that only one of the sets has. The longer bits are folded."""
    x, y = np.frombuffer(one, dtype=np.uint8), np.frombuffer(two, dtype=np.uint8)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))


def sketch(docs: DataFrame, words: int) -> np.ndarray:
    """How often shingles fall on each counter, over all documents. Fixed size; summed in rounds of bounded groups."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for b in batches:
            some, size = [], 0
            for v in b.column(0):
                some.append(shingles(v.as_py(), words))
                size += len(some[-1])
                if size > COUNTERS:
                    total += np.bincount((np.concatenate(some) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
                    some, size = [], 0
            if some:
                total += np.bincount((np.concatenate(some) % np.uint64(COUNTERS)).astype(np.int64), minlength=COUNTERS)
        chunks = np.minimum(total, 2**32 - 1).astype(np.uint32).reshape(-1, CHUNK)
        task = TaskContext.get().partitionId()
        some = [k for k in range(len(chunks)) if chunks[k].any()]
        yield pa.record_batch(
            [pa.array(some, pa.int32()), pa.array([task] * len(some), pa.int32()), pa.array([chunks[k].tobytes() for k in some], pa.binary())],
            names=["part", "task", "counts"],
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(CHUNK, dtype=np.int64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, dtype=np.uint32)
        return pd.DataFrame({"part": pdf["part"][:1], "task": pdf["task"][:1] // FAN_IN, "counts": [np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()]})

    texts = _texts(docs).select("text")
    rows = texts.mapInArrow(count, "part int, task int, counts binary")
    tasks = texts.rdd.getNumPartitions()
    while tasks > 1:
        rows = rows.groupBy("part", F.floor(F.col("task") / FAN_IN)).applyInPandas(add, "part int, task int, counts binary")
        tasks = -(-tasks // FAN_IN)
    out = np.zeros((COUNTERS // CHUNK, CHUNK), dtype=np.uint32)
    for r in rows.collect():  # COUNTERS / CHUNK rows
        out[r["part"]] = np.frombuffer(r["counts"], dtype=np.uint32)
    return out.ravel()


def prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``id, n, digest, bits, prefix`` of each document: size, digest and parity bits of its set, and its rarest
    shingles in order."""
    shared = docs.sparkSession.sparkContext.broadcast(sketch(docs, words))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for b in batches:
            sizes, digests, bits, firsts = [], [], [], []
            for v in b.column(1):
                s = shingles(v.as_py(), words)
                sizes.append(len(s))
                digests.append(hashlib.md5(s.tobytes()).digest())
                bits.append(parity_bits(s))
                if len(s):
                    k = prefix_length(len(s), percent)
                    c = counts[(s % np.uint64(COUNTERS)).astype(np.int64)]
                    near = np.flatnonzero(c <= np.partition(c, k - 1)[k - 1])  # s is sorted: ties go by hash
                    s = s[near[np.argsort(c[near], kind="stable")[:k]]]
                firsts.append(s)
            ends = np.cumsum([0] + [len(f) for f in firsts])
            flat = np.concatenate(firsts).view(np.int64) if firsts else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.record_batch([b.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(bits, pa.binary()), lists], names=["id", "n", "digest", "bits", "prefix"])

    return _texts(docs).mapInArrow(run, "id long, n long, digest binary, bits binary, prefix array<long>")


def picked(rows: DataFrame, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose ``id`` is in ``ids`` (``left_anti``: is not); a shuffle of the rows only where the ids are too
    many to broadcast."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", how)


def sets_of(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, s``: the whole shingle sets of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            some = [shingles(v.as_py(), words) for v in b.column(1)]
            ends = np.cumsum([0] + [len(f) for f in some])
            flat = np.concatenate(some).view(np.int64) if some else np.zeros(0, np.int64)
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=["id", "s"])

    return picked(_texts(docs), ids).mapInArrow(run, "id long, s array<long>")


def with_side(pairs: DataFrame, counted: DataFrame, side: str, values: DataFrame) -> DataFrame:
    """``pairs`` with the columns of ``values`` (``id`` and others, renamed to end in ``_a`` or ``_b``) of one side.

    A set with very many partners is repeated, so that no join group holds
    more than about ``PARTNERS`` pairs. Such sets, each with at least a
    thousandth of all pairs, are at most a thousand (two numbers each).
    ``counted``: the written table of the pairs ``a, b``.
    """
    other = "b" if side == "a" else "a"
    most = max(PARTNERS, counted.count() // 1000)
    many = F.broadcast(counted.groupBy(side).count().filter(F.col("count") > most).select(side, F.ceil(F.col("count") / PARTNERS).alias("_k")))
    copies = F.coalesce(F.col("_k"), F.lit(1)).cast("long")
    left = pairs.join(many, side, "left").select(*pairs.columns, F.pmod(F.xxhash64(other), copies).alias("_c"))
    right = values.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in values.columns if c != "id"])
    right = right.join(many, side, "left").withColumn("_c", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1))).drop("_k")
    return left.join(right, [side, "_c"]).drop("_c")


def bounds(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """``a, b, total, least`` of each pair: the size of both sets together, and a lower bound of the number of
    shingles that only one of them has, from their parity bits. ``bits``: ``id, n, bits``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            least = [differing(x.as_py(), y.as_py()) for x, y in zip(b.column("bits_a"), b.column("bits_b"), strict=True)]
            total = np.asarray(b.column("n_a")) + np.asarray(b.column("n_b"))
            yield pa.record_batch([b.column("a"), b.column("b"), pa.array(total, pa.int64()), pa.array(least, pa.int64())], names=["a", "b", "total", "least"])

    both = with_side(with_side(pairs, pairs, "a", bits), pairs, "b", bits)
    return both.select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(run, "a long, b long, total long, least long")


def verify(pairs: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """``a, b, inter, total`` of each pair: size of the intersection, and of both sets together.

    Only the sets that some pair names are made, and each side ships only its own.
    """
    side = lambda c: written(pairs.select(F.col(c).alias("id")).distinct(), "pair-ids")
    first, second = side("a"), side("b")
    sets = written(sets_of(docs, first.unionByName(second).distinct(), words), "sets")
    both = with_side(with_side(pairs, pairs, "a", picked(sets, first)), pairs, "b", picked(sets, second))
    return both.select("a", "b", F.size(F.array_intersect("s_a", "s_b")).cast("long").alias("inter"), (F.size("s_a") + F.size("s_b")).cast("long").alias("total"))


def compare(pairs: DataFrame, bits: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``a, b, similar, lo, hi`` of each pair: whether it is a link, and bounds of its Jaccard distance.

    Parity bits settle most pairs that are not similar without their sets;
    all others are verified on whole sets, and their bounds are the distance.
    """
    bounded = written(bounds(pairs, bits), "bounds")
    possible = (F.col("total") - F.col("least")) * (100 + percent) >= F.lit(2 * percent) * F.col("total")
    open_ = written(bounded.filter(possible).select("a", "b").distinct(), "possible")
    inter, total = F.col("inter"), F.col("total")
    exact = verify(open_, docs, words).select("a", "b", (inter * (100 + percent) >= total * percent).alias("similar"), ((total - 2 * inter) / (total - inter)).alias("lo"))
    apart = bounded.filter(~possible).select("a", "b", F.lit(False).alias("similar"), (2 * F.col("least") / (total + F.col("least"))).alias("lo"), F.lit(1.0).alias("hi"))
    return exact.withColumn("hi", F.col("lo")).select(*apart.columns).unionByName(apart)


def components(edges: DataFrame) -> DataFrame:
    """``id, comp``: the smallest id that each node of ``edges`` (``u, v``) reaches.

    Alternating large and small stars: every node is hooked to the least of
    its neighbours, until all edges lead to a component's least node. Each
    round is written, so that no lineage grows and a lost executor costs
    one round at most.
    """

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    def tidy(e: DataFrame) -> DataFrame:
        return e.filter(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = written(tidy(edges), "edges")
    seen = mark(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = least(both).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(tidy(large), "edges")
        low = least(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.withColumnRenamed("m", "v"))
        edges = written(tidy(small), "edges")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp")).unionByName(edges.select(F.col("v").alias("id"), F.col("v").alias("comp")).distinct())


def _fits(n1, p1, n2, p2, percent: int):
    """Sizes and positions allow the similarity (positions of the first common shingle)."""
    need = F.ceil(F.lit(percent) * (n1 + n2) / (100 + percent))
    return (F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent) & (F.least(n1 - p1, n2 - p2) >= need)


def links(docs: DataFrame, index: DataFrame, words: int, percent: int) -> DataFrame:
    """Verified pairs ``u, v`` of similar sets that connect all sets which similarity connects.

    ``index``: ``id, n, bits, prefix``, one row for each different set.
    """
    entries = index.select("id", "n", F.posexplode("prefix").alias("pos", "tok"))
    live = written(entries.groupBy("tok").agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1"), "live-tokens")
    lists = written(join_counted(entries, live, ["tok"], "cnt", int(index.agg(F.sum(F.size("prefix"))).first()[0] or 0)), "lists")

    # answers of the leaders
    leader = lists.groupBy("tok", "cnt").agg(F.min(F.struct("pos", "n", "id")).alias("l"))
    total = lists.count()
    stars = (
        join_counted(lists.drop("cnt"), leader, ["tok"], "cnt", total)
        .filter((F.col("id") != F.col("l.id")) & _fits(F.col("n"), F.col("pos"), F.col("l.n"), F.col("l.pos"), percent))
        .select(F.col("l.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    bits = index.select("id", "n", "bits")
    answers = written(compare(written(stars, "stars"), bits, docs, words, percent), "answers")
    found = answers.filter("similar").select(F.col("a").alias("u"), F.col("b").alias("v"))
    comp = components(found)

    # what is left: lists that still hold sets of several components
    near = lambda lo, hi: F.struct(hi.alias("hi"), lo.alias("lo"), F.col("a").alias("l")).alias("h")
    zero, no = F.lit(0.0), F.lit(0)
    home = answers.select(F.col("b").alias("id"), near(F.col("lo"), F.col("hi")), no.alias("sets"))
    home = home.unionByName(answers.select(F.col("a").alias("id"), near(zero, zero), no.alias("sets")))
    home = home.unionByName(index.select("id", F.lit(None).cast(home.schema["h"].dataType).alias("h"), F.lit(1).alias("sets")))
    # an id with several sets has no one distance to a leader
    home = home.groupBy("id").agg(F.min("h").alias("h"), F.sum("sets").alias("sets")).filter("sets = 1 AND h IS NOT NULL").drop("sets")
    open_ = lists.join(comp, "id", "left").join(home, "id", "left")
    open_ = written(open_.select("tok", "cnt", "id", "n", "pos", F.coalesce("comp", "id").alias("comp"), F.col("h.l").alias("home"), F.col("h.lo").alias("lo"), F.col("h.hi").alias("hi")), "open")
    mixed = open_.groupBy("tok", "cnt").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").drop("c0", "c1")
    rows = join_counted(open_.drop("cnt"), mixed, ["tok"], "cnt", total)
    size_class = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent)))
    rows = written(rows.drop("cnt").withColumn("sc", size_class).withColumn("pb", F.floor(F.col("pos") / BLOCK)), "blocks")
    head = rows.groupBy("tok", "sc", "pb").agg(F.max("n").alias("n1"), F.min("n").alias("n0"), F.min("pos").alias("p0"), F.min("comp").alias("c0"), F.max("comp").alias("c1"))
    one, two = (head.select("tok", *[F.col(c).alias(f"{c}_{k}") for c in head.columns[1:]]) for k in "xy")
    # a block pair can hold a similar pair: sizes overlap, the least position leaves enough room, components differ
    room = F.least(F.col("n1_x") - F.col("p0_x"), F.col("n1_y") - F.col("p0_y")) >= F.ceil(F.lit(percent) * (F.col("n0_x") + F.col("n0_y")) / (100 + percent))
    sized = (F.col("n1_x") * 100 >= F.col("n0_y") * percent) & (F.col("n1_y") * 100 >= F.col("n0_x") * percent)
    apart = ~((F.col("c0_x") == F.col("c1_x")) & (F.col("c0_y") == F.col("c1_y")) & (F.col("c0_x") == F.col("c0_y")))
    ordered = (F.col("sc_x") < F.col("sc_y")) | ((F.col("sc_x") == F.col("sc_y")) & (F.col("pb_x") <= F.col("pb_y")))
    blocks = one.join(two, "tok").filter(ordered & sized & room & apart).select("tok", "sc_x", "pb_x", "sc_y", "pb_y")
    x, y = (rows.select("tok", *[F.col(c).alias(f"{c}_{k}") for c in rows.columns if c != "tok"]) for k in "xy")
    allowed = 1 - percent / 100 + 1e-9
    far = F.greatest(F.col("lo_x") - F.col("hi_y"), F.col("lo_y") - F.col("hi_x")) > allowed
    far = F.coalesce((F.col("home_x") == F.col("home_y")) & far, F.lit(False))
    once = (F.col("sc_x") < F.col("sc_y")) | (F.col("pb_x") < F.col("pb_y")) | (F.col("id_x") < F.col("id_y"))
    rest = (
        blocks.join(x, ["tok", "sc_x", "pb_x"])
        .join(y, ["tok", "sc_y", "pb_y"])
        .filter(once & (F.col("comp_x") != F.col("comp_y")) & ~far & _fits(F.col("n_x"), F.col("pos_x"), F.col("n_y"), F.col("pos_y"), percent))
        .select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))
        .distinct()
    )
    rest = written(rest.join(answers.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "rest")
    more = compare(rest, bits, docs, words, percent).filter("similar").select(F.col("a").alias("u"), F.col("b").alias("v"))
    return found.unionByName(more)


def jaccard_groups(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each input row."""
    sets = written(prefixes(docs, words, percent), "prefixes")
    real = sets.filter("n > 0 AND id IS NOT NULL")
    classes = written(real.groupBy("digest").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("cnt")), "classes")
    index = real.join(classes, (real["id"] == classes["rep"]) & (real["digest"] == classes["digest"])).select("id", "n", "bits", "prefix", real["digest"]).dropDuplicates(["id", "digest"]).drop("digest")
    edges = links(docs, written(index, "index"), words, percent)
    # ids with several texts tie those texts' classes together
    several = real.select("id", "digest").distinct().groupBy("id").count().filter("count > 1").select("id")
    tied = real.join(several, "id", "left_semi").select("id", "digest").distinct().join(classes, "digest").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    comp = components(edges.unionByName(tied))
    grouped = classes.join(comp, F.col("rep") == F.col("id"), "left").select("digest", "cnt", F.coalesce("comp", "rep").alias("component_id"))
    linked = join_counted(real.select("id", "n", "digest"), grouped, ["digest"], "cnt", sets.count())
    alone = sets.filter("n = 0 OR id IS NULL").select("id", "n", F.col("id").alias("component_id"))
    return linked.select("id", "n", "component_id").unionByName(alone).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")


def one_per_group(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The document of the smallest id of each group; of rows that share it, the one whose text sorts first.

    Near duplicates here are sets of five-word shingles with a similarity of 0.8 or more.
    """
    groups = written(jaccard_groups(docs, words, percent).select("doc_id", "component_id"), "groups")
    gone = written(groups.filter("doc_id != component_id").select(F.col("doc_id").alias("id")).distinct(), "gone")
    again = written(groups.filter("doc_id = component_id").groupBy(F.col("doc_id").alias("id")).count().filter("count > 1").select("id"), "again")
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), whole_row(docs).alias("_row"))
    single = picked(rows, gone.unionByName(again), "left_anti")
    # ids are unique but for a fault in the input, so the side of repeated ids is as good as empty
    text = F.col("_row.text")
    repeated = picked(rows, again).groupBy("id").agg(F.min_by("_row", F.struct(text.isNull(), text)).alias("_row"))
    return unpack(single.select("_row")).unionByName(unpack(repeated.select("_row")))
