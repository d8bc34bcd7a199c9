"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Method: best-fit decreasing with a segment tree over remaining capacities.
Pieces of equal length are interchangeable, so the tree works on runs: the
histogram of piece lengths (at most ``capacity`` rows) goes to the driver,
which places whole runs, tightest open capacity first, exactly as best-fit
decreasing would place the pieces one by one. What comes back is a table of
segments (length, first rank, bins, offsets) whose size depends on the
capacity alone; each piece finds its segment by its rank among the pieces
of its length, in parallel.

Defined cases: a null text is empty and gives the end token alone; rows
that share a ``doc_id`` are packed each on its own; ties in length are
broken by a row id in a written table, so a recomputed task agrees; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sylvan.llm.common import written

#: Words kept in a worker's cache of token ids before it is emptied.
CACHE_WORDS = 300_000
#: Pieces of one length that one window task ranks, on average.
RANK_ROWS = 100_000


class MergeTable:
    """Byte-pair merges of many plain words at once.

    Rows of a matrix are words, their symbols in turn; each round merges
    every word's best-ranked leftmost pair, until none is left. The results
    are the tokenizer's own (held against it in the tests).
    """

    NONE = np.int32(1 << 30)

    def __init__(self, spec: dict):
        vocab, suffix = spec["vocab"], spec["end_of_word_suffix"]
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
        names = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
        self.inner = np.array([vocab[names[b]] for b in range(256)], dtype=np.int64)
        self.last = np.array([vocab[names[b] + suffix] for b in range(256)], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["merges"]]
        code = np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(code, kind="stable")
        self.code, self.rank = code[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)  # by rank

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left << 20 | right
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.code[at] == code), self.rank[at], self.NONE)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, and how many each has. Words of one length share a matrix."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        counts, parts = np.zeros(len(words), dtype=np.int64), []
        for n in np.unique(sizes):
            rows = np.flatnonzero(sizes == n)
            raw = np.frombuffer(b"".join([words[r] for r in rows]), dtype=np.uint8).reshape(len(rows), n)
            sym = np.concatenate([self.inner[raw[:, :-1]], self.last[raw[:, -1:]]], axis=1)
            live, final = np.arange(len(rows)), np.full(sym.shape, -1, dtype=np.int64)
            rank = self.ranks(sym[:, :-1], sym[:, 1:])
            while n > 1 and len(live):
                j = rank.argmin(axis=1)
                best = rank[np.arange(len(live)), j]
                done = best == self.NONE
                final[live[done], : sym.shape[1]] = sym[done]
                live, sym, rank, j, best = live[~done], sym[~done], rank[~done], j[~done], best[~done]
                if not len(live) or sym.shape[1] == 1:
                    break
                i, cols = np.arange(len(live)), np.arange(sym.shape[1] - 1)
                sym[i, j] = self.made[best]
                sym = np.take_along_axis(sym, cols + (cols > j[:, None]), axis=1)
                cols = cols[:-1]
                rank = np.take_along_axis(rank, cols + (cols >= j[:, None]), axis=1)
                if sym.shape[1] == 1:
                    break
                for at in (j - 1, j):
                    ok = (at >= 0) & (at < rank.shape[1])
                    rank[i[ok], at[ok]] = self.ranks(sym[i[ok], at[ok]], sym[i[ok], at[ok] + 1])
            final[live, : sym.shape[1]] = sym
            counts[rows] = (final >= 0).sum(axis=1)
            parts.append((rows, final))
        ends = np.cumsum(counts)
        flat = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
        for rows, final in parts:
            keep = final >= 0
            flat[((ends - counts)[rows][:, None] + np.cumsum(keep, axis=1) - 1)[keep]] = final[keep]
        return flat, counts


#: A plain word: composed letters that lower-case one to one, then perhaps one run of punctuation (one unit for the
#: tokenizer). No apostrophe: 's and the like are units. Longer words go to the tokenizer itself.
PLAIN = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]{1,24})([.,;:!?#*&%$]*)")
#: A comma or full stop that belongs to a longer run of punctuation, so that it is no unit of its own. The white space
#: named is the tokenizer's: it takes U+001C to U+001F for punctuation, unlike Python's ``\s``.
RUN = re.compile(r"(?:[^\w\x20\t-\r\x85\xa0]|_)[.,] ")


class _Index(dict):
    """Word to number; a new word takes the next number and is noted as pending."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.pending.append(word)
        return n


class WordTokens:
    """Token ids of texts, by way of a cache over words.

    The tokenizer splits at white space before anything else, so the ids of
    a text are those of its space-separated words in turn, and texts become
    array look-ups. A new word of plain letters and final punctuation is
    merged in bulk (:class:`MergeTable`); any other goes to the tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.merges = MergeTable(json.load(f)["model"])
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.flat = np.zeros(1 << 20, dtype=np.uint32)
        self.start, self.size = np.zeros((2, 1 << 18), dtype=np.int64)  # of each word in flat
        self.used = 0

    def _set(self, numbers: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        total = self.used + len(ids)
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self.index) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : total] = ids
        self.start[numbers] = self.used + np.cumsum(counts) - counts
        self.size[numbers] = counts
        self.used = total

    def _look_up(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self.size[at]
        where = np.repeat(self.start[at] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return self.flat[where], size

    def _learn(self) -> None:
        index, plain, odd, joined = self.index, [], [], []
        k = 0
        while k < len(index.pending):  # the parts of a joined word may be new as well, and come later
            w = index.pending[k]
            k += 1
            m = PLAIN.fullmatch(w)
            if m is None:
                odd.append(w)
            elif m[2]:
                joined.append((index[w], index[m[1]], index[m[2]]))
            else:
                plain.append(w)
        index.pending = []
        if plain:
            self._set(np.array([index[w] for w in plain]), *self.merges.encode([w.encode() for w in plain]))
        if odd:
            new = [e.ids for e in self.tok.encode_batch_fast(odd, add_special_tokens=False)]
            counts = np.array([len(ids) for ids in new])
            self._set(np.array([index[w] for w in odd]), np.array([x for ids in new for x in ids], dtype=np.uint32), counts)
        if joined:
            table = np.array(joined)
            ids, sizes = self._look_up(table[:, 1:].ravel())
            self._set(table[:, 0], ids, sizes[::2] + sizes[1::2])

    @staticmethod
    def _words(text: str) -> list[str]:
        """Pieces of the text whose ids follow one another; Latin-1 texts are lower-cased, as the tokenizer does."""
        text = text.replace("\n", " ")
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return text.split(" ")
        if "<|" in text:  # perhaps a special token, whose case matters
            return text.split(" ")
        text = text.lower()
        if RUN.search(text) is None:
            text = text.replace(", ", " , ").replace(". ", " . ")
        return text.split(" ")

    def encode_many(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.index) > CACHE_WORDS:
            self.clear()
        number = self.index.__getitem__
        at = [np.array(list(map(number, self._words(t))), dtype=np.int64) for t in texts]
        if self.index.pending:
            self._learn()
        return [self._look_up(a)[0] for a in at]


_TOKENS: dict[str, WordTokens] = {}


def tokens_for(path: str) -> WordTokens:
    """One tokenizer and cache per Python worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    if path not in _TOKENS:
        _TOKENS[path] = WordTokens(path)
    return _TOKENS[path]


def encoded(tok: WordTokens, texts: pa.Array, chars: int = 2_000_000) -> Iterator[np.ndarray]:
    """Ids of each text (null: none), a few million characters at a time."""
    some, size = [], 0
    for text in texts:
        some.append(text.as_py() or "")
        size += len(some[-1])
        if size >= chars:
            yield from tok.encode_many(some)
            some, size = [], 0
    yield from tok.encode_many(some)


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """The pieces of each document: its ids and the end token, cut at ``capacity`` only where longer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokens_for(tokenizer)
        names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * with_ids
        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()] + [pa.list_(pa.int32())] * with_ids
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc, ids in zip(batch.column(0).to_pylist(), encoded(tok, batch.column(1))):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at : at + capacity]
                    for out, v in zip(rows, (doc, k, at, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))):
                        out.append(v)
            yield pa.record_batch([pa.array(r, t) for r, t in zip(rows, types)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECES + ", ids array<int>" * with_ids)


class CapacityTree:
    """Segment tree over capacities 0..n: how many open bins have each; finds the least capacity >= x that has one."""

    def __init__(self, n: int):
        self.size = 1 << n.bit_length()
        self.sum = np.zeros(2 * self.size, dtype=np.int64)

    def add(self, capacity: int, bins: int) -> None:
        i = capacity + self.size
        while i:
            self.sum[i] += bins
            i >>= 1

    def least(self, x: int) -> int | None:
        if x >= self.size:
            return None
        i = x + self.size
        if self.sum[i]:
            return x
        while i > 1:  # up to the first ancestor whose right sibling holds bins, then down its left edge
            if not i & 1 and self.sum[i + 1]:
                i += 1
                while i < self.size:
                    i = 2 * i if self.sum[2 * i] else 2 * i + 1
                return i - self.size
            i >>= 1
        return None


def plan_runs(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over runs of equal lengths.

    Returns segments (length, first rank, first bin, pieces per bin, offset
    in the bin), sorted by length and rank. Equal bins are kept as ranges of
    bin numbers; a length splits at most one range, and a bin takes at most
    90 different lengths, so the table is bounded by the capacity.
    """
    tree, open_bins, bins, out = CapacityTree(capacity), {}, 0, []

    def put(room: int, first: int, n: int) -> None:
        if room and n:
            open_bins.setdefault(room, []).append((first, n))
            tree.add(room, n)

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            room = tree.least(length)
            if room is None:  # new bins, as many as the rest of this run needs
                room = capacity
                first, n = bins, -(-left // (capacity // length))
                bins += n
            else:
                first, n = open_bins[room].pop()
                tree.add(room, -n)
            per = room // length
            full = min(n, left // per)
            if full:
                out.append((length, rank, first, per, capacity - room))
                put(room - per * length, first, full)
                rank, left = rank + full * per, left - full * per
            if full < n:
                if left:
                    out.append((length, rank, first + full, left, capacity - room))
                    put(room - left * length, first + full, 1)
                    full, left = full + 1, 0
                put(room, first + full, n - full)
    return np.array(sorted(out), dtype=np.int64).reshape(-1, 5)


def place(pieces: DataFrame, capacity: int) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (which carry ``uid``, ``length``)."""
    spark = pieces.sparkSession
    histogram = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most ``capacity`` rows
    segments = plan_runs(histogram, capacity)
    shared = spark.sparkContext.broadcast(segments)
    buckets = max(1, -(-max(histogram.values(), default=0) // RANK_ROWS))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    by_length = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = dealt.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(by_length), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_bucket").orderBy("uid")
    ranked = dealt.withColumn("_in", F.row_number().over(inside) - 1)
    if buckets > 1:
        ranked = ranked.join(before, ["length", "_bucket"]).withColumn("_in", F.col("_in") + F.col("_before"))
    names = [c for c in pieces.columns if c != "uid"]
    kinds = {f.name: f.dataType.simpleString() for f in pieces.schema}

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = shared.value
        keys = seg[:, 0] << 48 | seg[:, 1]
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_rank"))
            s = seg[np.searchsorted(keys, length << 48 | rank, "right") - 1]
            nth = rank - s[:, 1]
            where = [pa.array(s[:, 2] + nth // s[:, 3]), pa.array(s[:, 4] + nth % s[:, 3] * length)]
            yield pa.record_batch([*[b.column(c) for c in names], *where], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long"
    return ranked.select(*names, F.col("_in").cast("long").alias("_rank")).mapInArrow(find, schema)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece.

    Texts are tokenised once; what is written and shuffled is a short row
    per piece.
    """
    pieces = cut(docs, tokenizer, capacity, end_id).withColumn("uid", F.monotonically_increasing_id())
    return place(written(pieces, "pieces"), capacity)


def sequences(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, ids``. A group holds at most ``capacity`` tokens."""
    pieces = written(cut(docs, tokenizer, capacity, end_id, with_ids=True).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    placed = place(pieces, capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
