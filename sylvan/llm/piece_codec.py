"""SentencePiece encoding and decoding by a table of distinct chunks.

Method: in a vocabulary whose pieces never hold a white-space marker after
another character, no piece and no merge crosses from a word into the
marker that follows it, and none crosses a line end where no piece holds
one. So a marked text falls into chunks (a run of markers with the word
after it, or a line end with the word after it) that are segmented
independently. Each distinct chunk is segmented once by the sentencepiece
library, into a table of ids and surfaces; a text's ids, and its decoded
text, are the table's entries joined by position.

The table lives in a Python worker and goes on from batch to batch; at
``TABLE_CHARS`` characters it is emptied between two batches, so memory is
bounded whatever the vocabulary of the corpus. Nothing is shuffled.

Whether the model allows this is read from its pieces and its normaliser
(:func:`separable`); for a model that does not, the whole text is the chunk.

Defined cases: a null text counts as empty, and an empty text has no ids
and decodes to the empty text; U+2581 in a text is the marker itself, as in
the library, and decodes to a space; rows that share an id are each on
their own, a null id stays null; other columns are not read, so their names
cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sylvan.llm.common import col

#: What the library writes for a space.
MARKER = "▁"
#: A text that a normaliser would change, but for the marker.
PROBE = "a  b\tc \n 　ﬁ①ÅÅＡ \x00\x7f​­ "
#: Characters of distinct chunks that a worker keeps.
TABLE_CHARS = 8_000_000
#: Characters that are looked up together.
STEP_CHARS = 2_000_000

CHUNK = re.compile(r" +[^ \n]*|\n[^ \n]*")


def separable(sp: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece crosses into a marker or holds a line end, and texts are marked but not changed otherwise."""
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    apart = all(MARKER not in p.lstrip(MARKER) and "\n" not in p and " " not in p for p in pieces)
    alone = sp.encode("\n", out_type=str)[:1] == [MARKER]  # the marker before a line end is a piece of its own
    return apart and alone and sp.normalize(PROBE) == MARKER + PROBE.replace(" ", MARKER)


class ChunkTable:
    """Distinct chunks with their ids and surfaces."""

    def __init__(self, path: str):
        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.split = separable(self.sp)
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.surface: list[str] = []
        self.chars = 0
        self.flat, self.used = np.zeros(1 << 16, dtype=np.int32), 0
        self.start, self.size = np.zeros((2, 1 << 14), dtype=np.int64)

    def chunks(self, text: str) -> list[str]:
        """The marked text in parts; each begins with its markers (written as spaces) or a line end."""
        if not text:
            return []
        return CHUNK.findall(" " + text.replace(MARKER, " ")) if self.split else [" " + text]

    def learn(self, new: list[str]) -> None:
        """Segments new chunks. The library marks the start of a text itself, but for an empty one, so one marker is left to it."""
        ids = self.sp.encode([c if c[0] == "\n" else c[1:] or "\n" for c in new], num_threads=1)
        ids = [x[1:] if c[0] == "\n" else x[:1] if c == " " else x for c, x in zip(new, ids)]
        shown = self.sp.decode(ids)
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        first, total = len(self.surface), self.used + int(sizes.sum())
        while total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while first + len(new) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.flat[self.used : total] = np.fromiter((i for x in ids for i in x), dtype=np.int32, count=total - self.used)
        self.size[first : first + len(new)] = sizes
        self.start[first : first + len(new)] = self.used + np.cumsum(sizes) - sizes
        self.used = total
        self.surface += [s if c[0] == "\n" else " " + s for c, s in zip(new, shown)]
        self.chars += sum(map(len, new))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids of all texts in turn, how many each has, and the decoded texts."""
        if self.chars > TABLE_CHARS:
            self.clear()
        parts = [self.chunks(t) for t in texts]
        number, new = self.number, []
        for chunk in {c for p in parts for c in p}:
            if chunk not in number:
                number[chunk] = len(number)
                new.append(chunk)
        if new:
            self.learn(new)
        at = [np.fromiter(map(number.__getitem__, p), dtype=np.int64, count=len(p)) for p in parts]
        every = np.concatenate([np.zeros(0, dtype=np.int64), *at])
        size = self.size[every]
        ends = np.cumsum(size)
        ids = self.flat[np.repeat(self.start[every] - (ends - size), size) + np.arange(int(size.sum()))]
        counts = np.array([int(self.size[a].sum()) for a in at], dtype=np.int64)
        decoded = ["".join(map(self.surface.__getitem__, a.tolist()))[1:] for a in at]  # but for the mark of the start
        return ids, counts, decoded


_TABLES: dict[str, ChunkTable] = {}


def table_for(path: str) -> ChunkTable:
    """One table per Python worker and model."""
    if path not in _TABLES:
        _TABLES[path] = ChunkTable(path)
    return _TABLES[path]


def encode_texts(docs: DataFrame, model: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each text without begin or end ids, and what they decode to."""
    source = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text), F.lit("")).alias("text"))

    def some(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
        texts, first, size = [], 0, 0
        for i, value in enumerate(batch.column(1)):
            texts.append(value.as_py())
            size += len(texts[-1])
            if size >= STEP_CHARS:
                yield first, i + 1, texts
                texts, first, size = [], i + 1, 0
        if texts:
            yield first, len(batch), texts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = table_for(model)
        for batch in batches:
            for first, last, texts in some(batch):
                ids, counts, decoded = chunks.encode(texts)
                ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                columns = [batch.column(0).slice(first, last - first), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), pa.array(decoded, pa.string())]
                yield pa.record_batch(columns, names=["doc_id", "ids", "decoded"])

    return source.mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, ids array<int>, decoded string")
