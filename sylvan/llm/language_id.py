"""Language identification by cross-parsing entropy.

Method: a suffix automaton of labelled text per language yields longest
matches. A text is parsed greedily into the longest phrases that occur in
the language's text; the language that needs the fewest phrases,
normalised by log2 of the length of its text, wins. A phrase costs at least
log2 of the number of symbols, so little training text makes none cheaper
than naming a letter; a letter that the training text lacks is a phrase of
its own.

Every letter of the training text is a symbol of its own, whatever the size
of the alphabet. The automaton's edges are laid into one sparse table by
displacement (a state's edges at its base plus the symbol, each marked with
its state), about 40 bytes a character of training text. A failed match
restarts at the root and is counted; thousands of stretches of text are
parsed at once, one symbol each per step. A text is cut every
``LANE`` symbols from its own start; a parse restarts there without counting
a phrase, for all languages alike. So a text's result depends on the text
alone, not on its neighbours in a batch.

Training: ``chars_per_language`` characters of each language, or all it has:
the labelled documents, long ones included, are cut into pieces of
``piece`` characters, and those with the smallest hash are taken.

Defined cases: a null text or one without letters is ``und`` with score 0;
equal phrase counts go to the language that sorts first; without training
rows every text is ``und``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from random import Random

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import unpack, whole_row

UNKNOWN = "und"
#: Symbols of a text that are parsed without a break.
LANE = 1024
#: Symbols: 0 begins a text, 1 is anything but a letter, letters follow; the last is for all letters that training lacks.
FIRST_LETTER = 2


@dataclass
class Automaton:
    """Edges of a suffix automaton; the edge of state s by symbol c is at ``base[s] + c`` if ``owner`` there is s."""

    root: np.ndarray  # by symbol: the state after a phrase's first symbol
    base: np.ndarray  # by state
    owner: np.ndarray
    target: np.ndarray

    def next(self, state: int, symbol: int) -> int | None:
        at = self.base[state] + symbol
        return int(self.target[at]) if self.owner[at] == state else None


@dataclass
class Model:
    languages: list[str]
    letters: dict[str, int]
    automata: list[Automaton]
    logs: list[float]


def displaced(nexts: list[dict[int, int]], width: int, seed: int = 3, tries: int = 200) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``base, owner, target``: states with most edges first, each at a drawn base where its places are free, or at the end."""
    room = 2 * sum(map(len, nexts)) + 1
    owner, target = [-1] * (room + width), [0] * (room + width)
    base = np.zeros(len(nexts), dtype=np.int32)
    draw = Random(seed)
    for s in sorted(range(len(nexts)), key=lambda s: -len(nexts[s])):
        out = nexts[s]
        for _ in range(tries):
            at = draw.randrange(room)
            if all(owner[at + c] < 0 for c in out):
                break
        else:
            at = room = len(owner)
            owner += [-1] * width
            target += [0] * width
        base[s] = at
        for c, t in out.items():
            owner[at + c], target[at + c] = s, t
    return base, np.array(owner, dtype=np.int32), np.array(target, dtype=np.int32)


def automaton(symbols: list[int], width: int) -> Automaton:
    """The suffix automaton of ``symbols``, all below ``width``."""
    nexts, link, length, last = [{}], [-1], [0], 0
    for c in symbols:
        cur = len(nexts)
        nexts.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nexts)
                nexts.append(dict(nexts[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    nexts.append({})  # the state after a symbol that the text lacks: whatever follows begins a phrase
    root = np.full(width, len(nexts) - 1, dtype=np.int32)
    for c, t in nexts[0].items():
        root[c] = t
    root[0] = 0  # before a text's first symbol
    nexts[0] = {}  # the root's edges are those of ``root``
    return Automaton(root, *displaced(nexts, width))


def letter_symbols(letters: dict[str, int]) -> np.ndarray:
    """Symbol of every code point."""
    absent = FIRST_LETTER + len(letters)
    out = np.ones(0x110000, dtype=np.uint16 if absent < 1 << 16 else np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            out[cp] = letters.get(ch.lower(), absent)
    return out


def symbols_of(texts: list[str], symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols in turn, a reset before each, runs of other than letters as one; where each text begins."""
    joined = "\0" + "\0".join(texts)
    s = symbol[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)]
    begin = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]]) if texts else np.zeros(0, dtype=np.int64)
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != 1) | (s[:-1] != 1)
    s[begin] = 0
    keep[begin] = True
    at = np.cumsum(keep) - 1
    return s[keep], at[begin]


def phrases(stream: np.ndarray, begin: np.ndarray, automaton: Automaton) -> np.ndarray:
    """Failed matches within each text: its phrases, but for the first."""
    length = np.diff(np.append(begin, len(stream)))
    pieces = -(-length // LANE)
    text = np.repeat(np.arange(len(begin)), pieces)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    size = np.minimum(length[text] - nth * LANE, LANE)
    order = np.argsort(-size, kind="stable")  # the longest first: those still parsed at step t are the first ones
    text, size, place = text[order], size[order], (begin[text] + nth * LANE)[order]
    root, base, owner, target = automaton.root, automaton.base, automaton.owner, automaton.target
    lanes = len(text)
    running = np.searchsorted(-size, -np.arange(size[0] if lanes else 0), side="left")
    state, at, held, fresh = (np.zeros(lanes, dtype=np.int32) for _ in range(4))
    failed = np.zeros(lanes, dtype=np.int32)
    miss = np.empty(lanes, dtype=bool)
    symbol = np.empty(lanes, dtype=stream.dtype)
    for t, n in enumerate(running.tolist()):
        s, c = state[:n], symbol[:n]
        np.take(stream, place[:n], out=c, mode="clip")
        place[:n] += 1
        if t == 0:  # the mark that begins a text, or the first symbol of a later piece
            np.take(root, c, out=s, mode="clip")
            continue
        a, h, f, m = at[:n], held[:n], fresh[:n], miss[:n]
        np.take(base, s, out=a, mode="clip")
        np.add(a, c, out=a, casting="unsafe")
        np.take(owner, a, out=h, mode="clip")
        np.not_equal(h, s, out=m)
        np.take(root, c, out=f, mode="clip")
        failed[:n] += m if t > 1 else m & (s != 0)  # a text's first symbol fails nothing
        np.take(target, a, out=s, mode="clip")
        np.copyto(s, f, where=m)
    return np.bincount(text, weights=failed, minlength=len(begin)).astype(np.int64)


def sample(rows: DataFrame, chars: int, piece: int) -> DataFrame:
    """``lang, text``, with ``doc_id`` and the number ``at`` of the piece: of each language, pieces by hash until they have ``chars`` characters.

    A hash fraction of about twice the need passes on, so the window sees a
    bounded set and only pieces that pass are cut out.
    """
    rows = rows.withColumn("_n", F.char_length("text")).filter(F.col("_n") > 0)
    share = rows.groupBy(F.col("lang").alias("_l")).agg(F.sum("_n").alias("_all")).select("_l", (F.lit(2.0 * chars + 20 * piece) / F.col("_all")).alias("_p"))
    own = F.xxhash64("doc_id", "text", F.lit("sample"))
    rows = rows.join(F.broadcast(share), F.col("lang") == F.col("_l")).withColumn("_own", own)  # as large as the set of languages
    hashed = F.transform(F.sequence(F.lit(0).cast("long"), F.ceil(F.col("_n") / piece) - 1), lambda i: F.struct(F.xxhash64(F.col("_own"), i).alias("h"), i.alias("at")))
    few = F.filter(hashed, lambda x: F.shiftrightunsigned(x["h"], 11) / F.lit(float(1 << 53)) < F.col("_p"))
    cut = rows.select("doc_id", "lang", "text", F.explode(few).alias("_x")).select(
        "doc_id", "lang", "_x.h", "_x.at", F.expr(f"substring(text, cast(_x.at * {piece} + 1 as int), {piece})").alias("text"))
    before = F.sum(F.char_length("text")).over(Window.partitionBy("lang").orderBy("h", "doc_id", "at", "text").rowsBetween(Window.unboundedPreceding, -1))
    return cut.withColumn("_before", F.coalesce(before, F.lit(0))).filter(F.col("_before") < chars).drop("_before")


def train(docs: DataFrame, usable: Column, chars_per_language: int = 30_000, piece: int = 750) -> Model:
    """Learn from ``text`` and non-null ``lang`` of the documents that ``usable`` admits."""
    rows = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    taken = sample(rows, chars_per_language, piece).collect()
    texts: dict[str, list[str]] = {}
    for r in sorted(taken, key=lambda r: (r["lang"], r["h"], r["doc_id"] is None, r["doc_id"] or 0, r["at"], r["text"])):
        texts.setdefault(r["lang"], []).append(r["text"])
    common = {ch for ts in texts.values() for t in ts for ch in t.lower() if ch.isalpha()}
    letters = {ch: FIRST_LETTER + i for i, ch in enumerate(sorted(common))}
    symbol = letter_symbols(letters)
    model = Model([], letters, [], [])
    width = FIRST_LETTER + len(letters) + 1
    for lang in sorted(texts):
        stream = symbols_of(texts[lang], symbol)[0][:chars_per_language]
        if (stream > 1).any():
            model.languages.append(lang)
            model.automata.append(automaton([int(c) for c in stream], width))
            model.logs.append(float(np.log2(max(len(stream) + 1, width - 1))))
    return model


def parse(texts: list[str], model: Model, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits a letter of each text under each language (texts x languages), and the texts' letters."""
    stream, begin = symbols_of(texts, symbol)
    letters = np.add.reduceat((stream > 1).astype(np.int8), begin, dtype=np.int64)
    counts = np.stack([phrases(stream, begin, t) for t in model.automata], axis=1) + 1
    return counts * np.array(model.logs) / np.maximum(letters, 1)[:, None], letters


_SYMBOLS: dict[tuple, np.ndarray] = {}


def predict(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None, chars: int = 2_000_000) -> DataFrame:
    """``_row`` (the input columns, or those of ``keep``), ``lang_pred``, ``score`` for each input row.

    The score is the share of the winner when each language weighs
    exp(-bits a letter): near 1 where the others need many more phrases.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def some(texts: list[str]) -> tuple[list[str], list[float]]:
        m = shared.value
        key = tuple(m.letters.items())
        if key not in _SYMBOLS:
            _SYMBOLS[key] = letter_symbols(m.letters)
        if not m.languages or not texts:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits, letters = parse(texts, m, _SYMBOLS[key])
        best = bits.argmin(axis=1)
        weight = np.exp(4 * (bits.min(axis=1, keepdims=True) - bits))
        score = np.where(letters > 0, 1 / weight.sum(axis=1), 0.0)
        return [m.languages[b] if n else UNKNOWN for b, n in zip(best, letters)], score.tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, texts, size = [], [], [], 0
            for v in batch.column(0).field("text") if carried else batch.column(1):
                texts.append(v.as_py() or "")
                size += len(texts[-1])
                if size >= chars:
                    for out, x in zip((langs, scores), some(texts)):
                        out += x
                    texts, size = [], 0
            for out, x in zip((langs, scores), some(texts)):
                out += x
            yield pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=["_row", "lang_pred", "score"])

    kept = docs.select(*keep) if keep else docs
    carried = "text" in kept.columns  # the row brings the text along
    row = docs.select(whole_row(kept).alias("_row"), *[F.col("text").alias("_text")] * (not carried))
    schema = T.StructType([row.schema["_row"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return row.mapInArrow(run, schema)


def labelled_part(doc_id: str = "doc_id") -> Column:
    """True for documents kept out of training: crc32 of the id as text leaves 1 on division by 3."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def known_language(docs: DataFrame, languages: tuple[str, ...] | None = None, least_score: float = 0.3) -> DataFrame:
    """The documents whose language is told: it is one of ``languages`` (default: all that are learned) and its score,
    its share among all learned ones, is at least ``least_score``.

    Documents of ``und`` (no letter in them) go, and so do those in which
    no language needs clearly fewer phrases than the others.
    """
    out = predict(docs, train(docs, ~labelled_part()))
    told = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score)
    return unpack(out.filter(told & F.col("lang_pred").isin(*languages) if languages is not None else told))
