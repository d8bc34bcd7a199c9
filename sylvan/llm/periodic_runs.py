"""Periodic runs of words: stretches that repeat with some period, such as generation loops.

Method: block convolution. The period range is cut into dyadic scales. At
the scale of block length B every aligned block of B words is held against
the window of positions that follow it by the scale's distances: the sums
of squared differences come from an exact integer convolution (number-
theoretic transforms modulo primes whose product exceeds any such sum), and
a sum of zero is an occurrence. A run of period q holds an aligned block of
its scale whose copy q words on is part of the run too, so the distances of
all occurrences seed all runs. Occurrences of neighbouring blocks at one
distance form a chain, which is extended word by word at both ends.

A block can only occur again if each of its words stands again within the
scale's reach; other blocks have no occurrence and are not transformed.
That leaves nothing out, and in plain prose it settles nearly all blocks.

A task works on a few hundred thousand words at a time: the texts are laid
end to end with a word of their own between them, so no run crosses two
texts. A text is never cut; memory is in proportion to the longest one.

Defined cases: a null or empty text has no words, no runs, and collapses to
the empty text; rows that share an id are each on their own, a null id
stays null; other columns are not read, so their names cannot clash; of one
stretch only the smallest period counts, and runs of different periods may
overlap; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import WORD, col

#: Primes of the form c * 2**k + 1 with k >= 25, and a generator of each one's units.
PRIMES = ((2013265921, 31), (469762049, 3), (167772161, 3))
#: Numbers that one transform step holds in memory.
STEP_CELLS = 1 << 18
#: Words that are searched together (a longer text is on its own).
BATCH_WORDS = 300_000


class Transform:
    """Number-theoretic transforms of length ``n`` (a power of two) modulo one prime, row by row."""

    def __init__(self, n: int, prime: int, generator: int):
        self.n, self.p = n, prime
        self.ahead, self.back, half = {}, {}, n // 2
        while half:
            root = pow(generator, (prime - 1) // (2 * half), prime)
            self.ahead[half], self.back[half] = self._powers(root, half), self._powers(pow(root, -1, prime), half)
            half //= 2
        self.scale = pow(n, -1, prime)

    def _powers(self, root: int, count: int) -> np.ndarray:
        out = np.ones(1, dtype=np.int64)
        while len(out) < count:
            out = np.concatenate([out, out * pow(root, len(out), self.p) % self.p])
        return out

    def forward(self, rows: np.ndarray) -> np.ndarray:
        """In bit-reversed order, which pointwise products do not mind."""
        a, half = rows % self.p, self.n // 2
        while half:
            x = a.reshape(len(a), -1, 2, half)
            left, right = x[:, :, 0], x[:, :, 1]
            x[:, :, 0], x[:, :, 1] = (left + right) % self.p, (left - right) * self.ahead[half] % self.p
            half //= 2
        return a

    def inverse(self, a: np.ndarray) -> np.ndarray:
        half = 1
        while half < self.n:
            x = a.reshape(len(a), -1, 2, half)
            left, right = x[:, :, 0], x[:, :, 1] * self.back[half] % self.p
            x[:, :, 0], x[:, :, 1] = (left + right) % self.p, (left - right) % self.p
            half *= 2
        return a * self.scale % self.p


def occurrences(words: np.ndarray, starts: np.ndarray, size: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (start, distance) where the block of ``size`` words at a start occurs again, least <= distance <= most.

    ``words`` are numbers >= 0 and end with at least ``most + size`` words that no block holds.
    """
    n, lags, span = 4 * size, most - least + 1, most - least + size
    bound, primes, product = size * int(words.max(initial=0)) ** 2, [], 1
    for p in PRIMES:
        primes.append(Transform(n, *p))
        product *= p[0]
        if product > bound:
            break
    else:
        raise ValueError("too many different words for one text")
    found_at, found_by = [], []
    per_step = max(1, STEP_CELLS // n)
    for k in range(0, len(starts), per_step):
        at = starts[k : k + per_step]
        window = words[at[:, None] + least + np.arange(span)]
        block = words[at[:, None] + np.arange(size)]
        zero = np.ones((len(at), lags), dtype=bool)
        for t in primes:
            flipped, padded = np.zeros((2, len(at), n), dtype=np.int64)
            flipped[:, 0], flipped[:, n - size + 1 :] = block[:, 0], block[:, :0:-1]
            padded[:, :span] = window
            cross = t.inverse(t.forward(flipped) * t.forward(padded) % t.p)[:, :lags]
            w = window % t.p
            squares = np.zeros((len(at), span + 1), dtype=np.int64)
            np.cumsum(w * w % t.p, axis=1, out=squares[:, 1:])
            own = (block % t.p) ** 2 % t.p
            zero &= (own.sum(axis=1)[:, None] + squares[:, size:] - squares[:, :lags] - 2 * cross) % t.p == 0
        row, lag = np.nonzero(zero)
        found_at.append(at[row])
        found_by.append(least + lag)
    none = np.zeros(0, dtype=np.int64)
    return np.concatenate([none, *found_at]), np.concatenate([none, *found_by])


def matches(words: np.ndarray, last: int, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on (``step`` 1) or backwards (-1) equal the one ``distance`` after them.

    ``words[last]`` and ``words[-1]`` equal no other word.
    """
    count, live, width = np.zeros(len(at), dtype=np.int64), np.arange(len(at)), 8
    while len(live):
        goes_on = []
        per_step = max(1, STEP_CELLS // width)
        for k in range(0, len(live), per_step):
            some = live[k : k + per_step]
            i = at[some][:, None] + step * (count[some][:, None] + np.arange(width))
            j = i + distance[some][:, None]
            same = words[np.clip(i, -1, last)] == words[np.clip(j, -1, last)]
            whole = same.all(axis=1)
            count[some] += np.where(whole, width, same.argmin(axis=1))
            goes_on.append(some[whole])
        live, width = np.concatenate(goes_on), min(2 * width, 4096)
    return count


def scales(longest: int) -> Iterator[tuple[int, int, int]]:
    """(block length, least and most distance) for all periods of a text of ``longest`` words.

    A run has at least ``max(q, 12 - q)`` words whose copy q words on belongs
    to it, and 2B - 1 words in a row hold an aligned block of B.
    """
    size, least = 2, 1
    while least <= longest // 2:
        yield size, least, 4 * size - 2
        size, least = 2 * size, 4 * size - 1


def runs_of(words: np.ndarray, text: np.ndarray, shortest: int = 12) -> np.ndarray:
    """All runs (start, end, period) of texts laid end to end, by start and period.

    ``words`` are word numbers, ``text`` the text each belongs to; between
    two texts stands a word of its own.
    """
    total = len(words)
    if not total:
        return np.zeros((0, 3), dtype=np.int64)
    longest = int(np.bincount(text).max())
    order = np.lexsort((np.arange(total), words, text))
    again = (words[order][1:] == words[order][:-1]) & (text[order][1:] == text[order][:-1])
    gap = np.full(total, np.iinfo(np.int64).max)
    gap[order[:-1][again]] = np.diff(order)[again]
    steps = list(scales(longest))
    reach = max((most + size for size, _, most in steps), default=0)
    stop = int(words.max()) + 1
    padded = np.concatenate([words, np.full(reach, stop), [stop + 1]])
    known = np.zeros((0, 3), dtype=np.int64)
    for size, least, most in steps:
        blocks = total // size
        at = np.flatnonzero((gap[: blocks * size] <= most).reshape(blocks, size).all(axis=1)) * size
        if not len(at):
            continue
        at, by = occurrences(padded[:-1], at, size, least, most)
        if not len(at):
            continue
        order = np.lexsort((at, by))
        at, by = at[order], by[order]
        first = np.ones(len(at), dtype=bool)
        first[1:] = (by[1:] != by[:-1]) | (at[1:] != at[:-1] + size)
        begin = np.flatnonzero(first)
        a, z, d = at[begin], at[np.append(begin[1:], len(at)) - 1] + size, by[begin]
        if len(known):  # inside a run of period q, a distance that q divides gives that run again
            furthest = np.maximum.accumulate(known[:, 1])
            which = np.maximum.accumulate(np.where(known[:, 1] == furthest, np.arange(len(known)), 0))
            prior = np.searchsorted(known[:, 0], a, "right") - 1
            run = known[which[np.maximum(prior, 0)]]
            fresh = ~((prior >= 0) & (run[:, 1] >= z + d) & (d % run[:, 2] == 0))
            a, z, d = a[fresh], z[fresh], d[fresh]
        start = a - matches(padded, total, a - 1, d, -1)
        end = z + matches(padded, total, z, d, 1) + d
        long = end - start >= np.maximum(shortest, 2 * d)
        known = np.concatenate([known, np.stack([start, end, d], axis=1)[long]])
        # of one stretch, the smallest period; the larger ones are its multiples
        known = known[np.lexsort((known[:, 2], known[:, 1], known[:, 0]))]
        again = np.zeros(len(known), dtype=bool)
        again[1:] = (known[1:, :2] == known[:-1, :2]).all(axis=1)
        known = known[~again]
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def collapsed_runs(texts: list[list[bytes]], shortest: int = 12) -> Iterator[tuple[np.ndarray, bytes]]:
    """For the words of each text: its runs (start, length, period), and its words without the repeats, joined by a space."""
    number = defaultdict(count().__next__)  # a new word takes the next number
    parts, owner = [], []
    for k, words in enumerate(texts):
        parts += [np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)), np.array([-1 - k])]
        owner.append(np.full(len(words) + 1, k))
    flat, owner = np.concatenate(parts), np.concatenate(owner)
    flat = np.where(flat < 0, len(number) - 1 - flat, flat)  # a word of its own after each text
    offset = np.searchsorted(owner, np.arange(len(texts) + 1))
    runs = runs_of(flat, owner, shortest)
    change = np.zeros(len(flat) + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    cuts = np.searchsorted(runs[:, 0], offset)
    for k, words in enumerate(texts):
        own = runs[cuts[k] : cuts[k + 1]]
        if len(own):
            words = [words[i] for i in np.flatnonzero(kept[offset[k] : offset[k] + len(words)]).tolist()]
        yield np.stack([own[:, 0] - offset[k], own[:, 1] - own[:, 0], own[:, 2]], axis=1), b" ".join(words)


RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


def find_runs(docs: DataFrame, shortest: int = 12, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, runs, collapsed_text``: each text's runs by start and period, and its words without their repeats.

    A run is a stretch of words with smallest period ``period``, at least
    ``max(shortest, 2 * period)`` long, that no neighbouring word extends;
    ``shortest`` is at least 12. Its words after the first period are left
    out of ``collapsed_text``.
    """
    if shortest < 12:
        raise ValueError("shortest is at least 12")
    source = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).cast("binary").alias("text"))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def some(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[list[bytes]]]]:
        """A few hundred thousand words at a time."""
        texts, first, size = [], 0, 0
        for i, value in enumerate(batch.column(1)):
            texts.append(value.as_py().split())  # of bytes: at the six white-space characters of ASCII only
            size += len(texts[-1])
            if size >= BATCH_WORDS:
                yield first, i + 1, texts
                texts, first, size = [], i + 1, 0
        if texts:
            yield first, len(batch), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in some(batch):
                runs, rest = zip(*collapsed_runs(texts, shortest))
                ends = np.cumsum([0, *map(len, runs)]).astype(np.int32)
                flat = np.concatenate(runs)
                spans = pa.StructArray.from_arrays([pa.array(flat[:, c]) for c in range(3)], fields=list(kind))
                columns = [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(ends), spans), pa.array(rest, pa.string())]
                yield pa.record_batch(columns, names=["doc_id", "runs", "collapsed_text"])

    schema = f"doc_id {source.schema['doc_id'].dataType.simpleString()}, runs {RUNS}, collapsed_text string"
    return source.mapInArrow(run, schema)


def with_loops(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` where every tenth text by hash ends in a loop, as the contract of the query states.

    With h the CRC-32 of the decimal id and g = h // 10: where h is a
    multiple of 10 and the text has n > 0 words, the words from a = g % n on
    repeat the first 1 + (n - a) // (3 + g % 8) of them. A null id leaves
    the text as it is.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    looped = docs.select("doc_id", "text", h.alias("h")).select(
        "doc_id", "text", F.expr("h div 10").alias("g"), F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0))).alias("w")
    )
    looped = looped.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    looped = looped.withColumn("p", F.expr("cast(1 + (n - a) div (3 + g % 8) as int)"))
    loop: Column = F.slice("w", F.col("a") + 1, F.col("p"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    tail = F.slice(F.flatten(F.array_repeat(loop, times)), F.lit(1), F.col("n") - F.col("a"))
    whole = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), tail)
    return looped.select("doc_id", F.when(F.col("n") > 0, whole).otherwise(F.col("text")).alias("text"))


def run_report(found: DataFrame) -> DataFrame:
    """The longest run of each text (ties: smallest start, then period) and digests of all runs and of the collapsed text."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )
