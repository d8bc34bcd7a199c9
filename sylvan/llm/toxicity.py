"""Toxicity: a convolutional text classifier trained in numpy.

Method: hashed word embeddings, filters of several widths, max pooling over
the text, a logistic output; thresholds calibrated by language. Words are
runs of bytes other than ASCII white space, digits and punctuation, A-Z
lower-cased. A word that at least ``MIN_DOCS`` training texts hold has its
own embedding, found by its hash; all others share ``SHARED`` rows by hash.

Calibration: on the part of the training rows kept from the fit, a
threshold per language is found; a text's score is shifted so that its
language's threshold reads 0.5. The language of a text is itself read from
its words (naive Bayes over the hashed words, learned from the training
rows), never from a column.

Training: at most ``rows_per_class`` labelled documents per class, those
with the smallest hash of their id. A document of more than
``chars_per_row`` characters trains on pieces of it, those with the smallest
hash from anywhere in the text, of that many characters together; so what
the driver gathers is bounded by rows x characters. Every text that is
scored is scored whole.

Defined cases: an empty or null text, or one without words, is scored on
zero features like any other; without training rows of both classes every
score is the share of label 1 (0.5 where there are no labels); rows that
share a ``doc_id`` are scored each on its own; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import bounded_sample, unpack, whole_row

#: Bytes that separate words (all of ASCII but letters) become spaces; A-Z become a-z.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
MIN_DOCS = 2
SHARED = 256
DIM, WIDTHS, FILTERS = 6, (1, 2, 3), 8
#: Characters of one piece of a long training document.
PIECE = 1000
CACHE_WORDS = 500_000


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) >> 1


@dataclass
class Model:
    hashes: np.ndarray  # sorted hashes of the words with an own embedding
    embed: np.ndarray  # SHARED rows, then one per hash
    filters: list[np.ndarray]  # per width: width * DIM x FILTERS
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: float
    languages: list[str] = field(default_factory=list)
    lang_log: np.ndarray | None = None  # embedding rows x languages
    shift: np.ndarray | None = None  # logit of the threshold per language
    constant: float | None = None


class Rows:
    """Embedding row of each word, by way of a cache."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = {int(h): SHARED + i for i, h in enumerate(hashes)}
        self.seen: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        get = self.seen.get
        got = list(map(get, words))
        if None in got:
            if len(self.seen) > CACHE_WORDS:
                self.seen.clear()
            for i, g in enumerate(got):
                if g is None:
                    h = word_hash(words[i])
                    got[i] = self.seen[words[i]] = self.hashes.get(h, h % SHARED)
        return np.array(got, dtype=np.int32)


def pooled(rows: np.ndarray, begin: np.ndarray, model: Model, keep: bool = False):
    """Max over each text's positions of every filter (texts x filters). ``rows``: all texts in turn, each
    followed by max(WIDTHS) - 1 rows of -1 (zero vectors), so that no window spans two texts."""
    x = model.embed[np.maximum(rows, 0)]
    x[rows < 0] = 0
    n, pad = len(rows), max(WIDTHS) - 1
    x = np.concatenate([x, np.zeros((pad, DIM), dtype=x.dtype)])
    outs, acts = [], []
    for w, f, b in zip(WIDTHS, model.filters, model.bias):
        a = x[:n] @ f[:DIM]
        for k in range(1, w):
            a += x[k : n + k] @ f[k * DIM : (k + 1) * DIM]
        a += b
        top = np.maximum.reduceat(a, begin, axis=0)
        outs.append(np.maximum(top, 0))
        acts.append(a)
    features = np.concatenate(outs, axis=1)
    return (features, acts, x) if keep else features


def stack(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pad = np.full(max(WIDTHS) - 1, -1, dtype=np.int32)
    flat = np.concatenate([x for p in parts for x in (p, pad)])
    begin = np.cumsum([0] + [len(p) + len(pad) for p in parts[:-1]])
    return flat, begin


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[list[bytes]], y: np.ndarray, seed: int = 7, epochs: int | None = None, batch: int = 64, rate: float = 0.02) -> Model:
    """Train on word lists and 0/1 labels: Adam on the logistic loss.

    The first coordinate of an embedding starts at the word's smoothed log
    odds between the classes, the others at small random values. A small sample gets more epochs (about 300
    steps at least).
    """
    rng = np.random.default_rng(seed)
    epochs = epochs or max(6, 300 * batch // max(1, len(texts)))
    df = [Counter(), Counter()]
    for words, label in zip(texts, y):
        df[int(label)].update(set(words))
    own = sorted(((word_hash(w), w) for w in df[0].keys() | df[1].keys() if df[0][w] + df[1][w] >= MIN_DOCS))
    hashes = np.array([h for h, _ in own], dtype=np.int64)
    n0, n1 = max(1, int((y == 0).sum())), max(1, int((y == 1).sum()))
    odds = np.array([np.log((df[1][w] + 0.5) / (n1 + 1)) - np.log((df[0][w] + 0.5) / (n0 + 1)) for _, w in own])
    seen = np.array([df[0][w] + df[1][w] for _, w in own])
    embed = np.zeros((SHARED + len(own), DIM), dtype=np.float32)
    embed[:, 1:] = rng.normal(0, 0.1, (len(embed), DIM - 1))
    if own:
        embed[SHARED:, 0] = odds * seen / (seen + 4)
    filters = [rng.normal(0, 0.2, (w * DIM, FILTERS)).astype(np.float32) for w in WIDTHS]
    for f, w in zip(filters, WIDTHS):
        for k in range(w):
            f[k * DIM] += 0.6 / w
    model = Model(hashes, embed, filters, [np.full(FILTERS, -0.3, dtype=np.float32) for _ in WIDTHS],
                  np.full(FILTERS * len(WIDTHS), 0.1, dtype=np.float32), -1.0)
    rows = Rows(hashes)
    data = [rows(t) for t in texts]
    params = [model.embed, *model.filters, *model.bias, model.out, np.array([model.out_bias], dtype=np.float32)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    weight = np.where(y == 1, min(5.0, n0 / n1) ** 0.5, 1.0)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(data))
        for at in range(0, len(order), batch):
            pick = order[at : at + batch]
            flat, begin = stack([data[i] for i in pick])
            ends = np.append(begin[1:], len(flat))
            feats, acts, x = pooled(flat, begin, model, keep=True)
            z = feats @ model.out + params[-1][0]
            g = ((sigmoid(z) - y[pick]) * weight[pick] / len(pick)).astype(np.float32)
            grads = [np.zeros_like(p) for p in params[1:]]
            grads[-1][0], grads[-2][:] = g.sum(), feats.T @ g + 1e-4 * model.out
            back = np.outer(g, model.out) * (feats > 0)
            touched = []
            for k, w in enumerate(WIDTHS):
                own_back = back[:, k * FILTERS : (k + 1) * FILTERS]
                # where the maximum was: the first position of each text that has it
                peak = np.repeat(np.maximum.reduceat(acts[k], begin, axis=0), ends - begin, axis=0)
                text_at, filt = np.nonzero(own_back)
                hit_pos, hit_f = np.nonzero(acts[k] == peak)
                owner = np.searchsorted(begin, hit_pos, "right") - 1
                _, one = np.unique(owner * FILTERS + hit_f, return_index=True)
                pos = np.zeros((len(pick), FILTERS), dtype=np.int64)
                pos[owner[one], hit_f[one]] = hit_pos[one]
                p, gg = pos[text_at, filt], own_back[text_at, filt]
                np.add.at(grads[len(WIDTHS) + k], filt, gg)
                for j in range(w):
                    part = slice(j * DIM, (j + 1) * DIM)
                    np.add.at(grads[k].T[:, part], filt, x[p + j] * gg[:, None])
                    r = flat[np.minimum(p + j, len(flat) - 1)]
                    ok = r >= 0
                    touched.append((r[ok], (gg[:, None] * model.filters[k][part].T[filt])[ok]))
            step += 1
            who = np.concatenate([t[0] for t in touched])
            uniq, inv = np.unique(who, return_inverse=True)
            ge = np.zeros((len(uniq), DIM), dtype=np.float32)
            np.add.at(ge, inv, np.concatenate([t[1] for t in touched]))
            for i, p in enumerate(params):
                gr, sel = (ge, uniq) if i == 0 else (grads[i - 1], slice(None))
                first[i][sel] = 0.9 * first[i][sel] + 0.1 * gr
                second[i][sel] = 0.99 * second[i][sel] + 0.01 * gr * gr
                p[sel] -= rate * (0.2 if i == 0 else 1) * (first[i][sel] / (1 - 0.9**min(step, 500))) / (np.sqrt(second[i][sel] / (1 - 0.99**min(step, 500))) + 1e-6)
    model.out_bias = float(params[-1][0])
    return model


def logits(parts: list[np.ndarray], model: Model) -> np.ndarray:
    flat, begin = stack(parts)
    return pooled(flat, begin, model) @ model.out + model.out_bias


def language_of(parts: list[np.ndarray], model: Model) -> np.ndarray:
    """Number of the likeliest language of each text."""
    flat, begin = stack(parts)
    weights = model.lang_log[np.maximum(flat, 0)] * (flat >= 0)[:, None]
    return np.add.reduceat(weights, begin, axis=0).argmax(axis=1)


def calibrate(model: Model, parts: list[np.ndarray], y: np.ndarray, langs: list[str], fit_parts: list[np.ndarray], fit_langs: list[str]) -> None:
    """Language tables from the fitted rows, a threshold per language (best F1, between two logits) from the others."""
    model.languages = sorted(set(fit_langs))
    counts = np.full((len(model.embed), len(model.languages)), 0.1)
    for p, lang in zip(fit_parts, fit_langs):
        np.add.at(counts[:, model.languages.index(lang)], p, 1)
    counts[:SHARED] = 1
    model.lang_log = np.log(counts / counts.sum(axis=0)).astype(np.float32)

    def threshold(z: np.ndarray, t: np.ndarray, default: float) -> float:
        if t.sum() < 10 or (t == 0).sum() < 10:
            return default
        order = np.argsort(-z, kind="stable")
        hits = np.cumsum(t[order])
        f1 = 2 * hits / (np.arange(1, len(z) + 1) + t.sum())
        k = int(f1.argmax())
        return float((z[order[k]] + z[order[min(k + 1, len(z) - 1)]]) / 2)

    z, where = logits(parts, model), language_of(parts, model)
    overall = threshold(z, y, 0.0)
    model.shift = np.array([threshold(z[where == i], y[where == i], overall) for i in range(len(model.languages))])


def scores(texts: list[str], model: Model, rows: Rows) -> np.ndarray:
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    parts = [rows(words_of(t)) for t in texts]
    return sigmoid(logits(parts, model) - model.shift[language_of(parts, model)])


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents kept out of training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_text(doc_id: str, text: str, chars: int) -> Column:
    """The text, or of a longer one ``chars`` characters: the pieces with the smallest hash, in their order."""
    pieces = F.sequence(F.lit(0), F.floor(F.char_length(text) / PIECE).cast("int"))
    hashed = F.transform(pieces, lambda i: F.struct(F.xxhash64(F.col(doc_id), F.lit("piece"), i).alias("h"), i.alias("i")))
    some = F.array_sort(F.transform(F.slice(F.array_sort(hashed), 1, max(1, chars // PIECE)), lambda x: x["i"]))
    cut = F.transform(some, lambda i: F.substring(F.col(text), i * PIECE + 1, F.lit(PIECE)))
    return F.when(F.char_length(text) <= chars, F.col(text)).otherwise(F.array_join(cut, " "))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows_per_class: int = 3000, seed: int = 7, chars_per_row: int = 20_000) -> Model:
    """Fit and calibrate on the labelled documents that are not held out."""
    marked = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("_y"))
    rows = docs.filter(~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", training_text("doc_id", "text", chars_per_row).alias("text"), F.coalesce(F.col("lang"), F.lit("")).alias("lang"))
    sample = bounded_sample(marked.filter(~held_out()), "_y", rows_per_class, "doc_id")
    sample = F.broadcast(sample)  # at most 2 * rows_per_class rows of two numbers
    got = sorted((r["doc_id"], r["text"], r["_y"], r["lang"]) for r in rows.join(sample, "doc_id").collect())
    y = np.array([g[2] for g in got], dtype=np.float64)
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(0, np.int64), np.zeros((SHARED, DIM), np.float32), [], [], np.zeros(0), 0.0, constant=float(y.mean()) if len(y) else 0.5)
    words = [words_of(g[1]) for g in got]
    # copies of a text fall on the same side, by a hash of its words
    aside = np.array([word_hash(b" ".join(w)) % 4 == 0 for w in words])
    if len(set(y[aside].tolist())) < 2 or len(set(y[~aside].tolist())) < 2:
        aside[:] = False
    use = np.flatnonzero(~aside)
    model = fit([words[i] for i in use], y[use], seed)
    rows_ = Rows(model.hashes)
    parts = [rows_(w) for w in words]
    rest = np.flatnonzero(aside) if aside.any() else use
    calibrate(model, [parts[i] for i in rest], y[rest], [got[i][3] for i in rest], [parts[i] for i in use], [got[i][3] for i in use])
    return model


_ROWS: dict[int, Rows] = {}


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] | None = None, chars: int = 2_000_000) -> DataFrame:
    """``_row`` (the input columns, or those of ``keep``), ``score``, ``predicted`` for each input row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        key = hash(m.hashes.tobytes())
        if key not in _ROWS:
            _ROWS.clear()
            _ROWS[key] = Rows(m.hashes)
        for batch in batches:
            out, some, size = [], [], 0
            for v in batch.column(1):
                some.append(v.as_py() or "")
                size += len(some[-1])
                if size >= chars:
                    out.append(scores(some, m, _ROWS[key]))
                    some, size = [], 0
            if some:
                out.append(scores(some, m, _ROWS[key]))
            s = np.concatenate(out) if out else np.zeros(0)
            yield pa.record_batch([batch.column(0), pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32), pa.int32())], names=["_row", "score", "predicted"])

    row = docs.select(whole_row(docs.select(*keep) if keep else docs).alias("_row"), F.col("text").alias("_text"))
    schema = T.StructType([row.schema["_row"], T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return row.mapInArrow(run, schema)


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic."""
    return unpack(score(docs, train(docs, labels)).filter(F.col("predicted") == 0))
