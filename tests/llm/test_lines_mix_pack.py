"""Line dedup, source mix and packing against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sylvan.llm import line_dedup, mixing, packing
from sylvan.llm.queries import QUERIES
from llm_fixtures import columns, docs, odd_rows, SF_SMALL  # noqa: F401

PATH = public_tokenizers.path("word_bpe_49k.json")
SPACES = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_lines(rows, min_chars, min_docs):
    held = defaultdict(set)
    key = lambda line: line.strip(SPACES).translate(LOWER)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars and d is not None:
                held[key(line)].add(d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= min_chars and len(held[key(x)]) >= min_docs and max(held[key(x)]) != d)]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def test_line_dedup_brute_force(docs, odd_rows):
    rng = random.Random(3)
    lines = ["Common LINE number one", " common line number one\t", "Äpfel und Birnen Äpfel", "äpfel und birnen äpfel", "short", "", " not stripped nbsp line"]
    rows = [(i, "\n".join(rng.choice(lines + [f"own line {i} {k}" for k in range(3)]) for _ in range(rng.randint(0, 9))), "en", "s") for i in range(40)]
    rows += odd_rows
    got = line_dedup.line_dedup(docs(rows), min_chars=10, min_docs=3)
    assert columns(got.select("_row.doc_id", "n_lines", "n_dropped", "kept_text"), "doc_id", "n_lines", "n_dropped", "kept_text") == brute_lines([r[:2] for r in rows], 10, 3)


def test_line_dedup_keeps_columns_and_empty_table(docs, odd_rows):
    d = docs(odd_rows)
    out = line_dedup.dedup_documents(d)
    assert out.columns == d.columns and out.count() == len(odd_rows)
    assert line_dedup.line_dedup(docs([])).count() == 0


def brute_mix(rows):
    size = [len((t or "").encode().split()) for _, t, _, _ in rows]
    per = Counter()
    for (_, _, _, s), n in zip(rows, size):
        per[s] += n
    names = sorted(per, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    capped, total = {}, sum(per.values())
    while True:  # cap and share the excess anew until none is above
        free = [s for s in names if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if level * weight[s] >= 3 * per[s]]
        if not over:
            break
        capped |= {s: 3 * per[s] for s in over}
    return size, per, {s: capped.get(s, level * weight[s] if s not in capped else 0) for s in names}


def test_mix_targets_and_taken(docs, odd_rows):
    rng = random.Random(5)
    rows = [(100 + i, " ".join(["w"] * rng.randint(0, 12)), "en", f"s{min(rng.randint(0, 9), rng.randint(0, 9))}") for i in range(600)]
    rows += odd_rows
    size, per, target = brute_mix(rows)
    got = mixing.mix(docs(rows))[0].collect()
    taken = Counter()
    for r in got:
        assert r["source_size"] == per[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert 0 <= r["repeats"] <= 3
        taken[r["source"]] += r["size"] * r["repeats"]
    assert sorted(r["size"] for r in got) == sorted(size)
    biggest = defaultdict(int)
    for (_, _, _, s), n in zip(rows, size):
        biggest[s] = max(biggest[s], n)
    for s in per:
        # two equal rows are taken alike, so that a boundary can be off by both
        assert abs(taken[s] - target[s]) <= biggest[s]
    again = mixing.mix(docs(rows).repartition(7))[0]
    assert columns(again, "doc_id", "size", "repeats") == sorted(((r["doc_id"], r["size"], r["repeats"]) for r in got), key=repr)


def test_mix_refines_over_several_levels(docs, monkeypatch):
    monkeypatch.setattr(mixing, "LEVEL_BITS", 3)
    rows = [(i, "w " * (i % 7 + 1), "en", f"s{i % 4 if i % 3 else 0}") for i in range(300)]
    fine = mixing.mix(docs(rows))[0]
    one = columns(fine, "doc_id", "repeats")
    monkeypatch.setattr(mixing, "LEVEL_BITS", 12)
    assert one == columns(mixing.mix(docs(rows))[0], "doc_id", "repeats")


def test_mix_documents_repeats_rows(docs, odd_rows):
    rows = [(i, "a b c", "en", f"s{i % 2 if i > 9 else 0}") for i in range(50)]
    d = docs(rows)
    times = {r["doc_id"]: r["repeats"] for r in mixing.mix(d)[0].collect()}
    out = mixing.mix_documents(d)
    assert out.columns == d.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({k: v for k, v in times.items() if v})
    assert mixing.mix(docs([]))[0].count() == 0
    assert mixing.mix_documents(docs([])).count() == 0
    assert mixing.mix(docs([(1, None, None, None)]))[0].first()["target"] == 0


def best_fit(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(bins) if room >= n]
        if not fits:
            bins.append(capacity)
            fits = [len(bins) - 1]
        bins[min(fits, key=lambda i: bins[i])] -= n
    return sorted(bins)


def test_runs_equal_one_by_one_best_fit():
    rng = random.Random(1)
    for _ in range(200):
        capacity = rng.choice([7, 10, 31, 100])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        segments = packing.plan_runs(dict(Counter(lengths)), capacity)
        rooms, seen = {}, Counter()
        for n in lengths:
            s = segments[[i for i, x in enumerate(segments) if x[0] == n and x[1] <= seen[n]][-1]]
            b = s[2] + (seen[n] - s[1]) // s[3]
            rooms[b] = rooms.get(b, capacity) - n
            seen[n] += 1
        assert sorted(rooms.values()) == best_fit(lengths, capacity)


def test_capacity_tree():
    tree = packing.CapacityTree(20)
    for c in (3, 9, 20):
        tree.add(c, 2)
    assert [tree.least(x) for x in (0, 3, 4, 9, 10, 20)] == [3, 3, 9, 9, 20, 20]
    tree.add(20, -2)
    assert tree.least(10) is None and tree.least(21) is None


ODD_TEXTS = [
    "", " a  b\n\n c", "<|endoftext|> x<|STARTOFTEXT|>y", "ÀÉ ΟΔΥΣΣΕΥΣ İstanbul ﬁ é ́x c\tx\x0bd\x1ce it's I'LL 're 漢字かな😀", "a ́b ẛ̣ Å", "\x85 x​y ﻿q ß µ ª ¼ _, x_. a,, b.. c.,",
    "Word, word. WORD! x.&&& y###, 3,4 5. 6.7, e.g., ². q", "aaaa" * 30, "d'être l'eau don't won't 's.", "été, Èze. ÿ×÷ å.",
]


def test_word_cache_equals_tokenizer(spark, monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 3000)
    tok, plain = packing.WordTokens(PATH), Tokenizer.from_file(PATH)
    texts = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("text").collect()] + ODD_TEXTS
    for at in range(0, len(texts), 20):
        for text, ids in zip(texts[at : at + 20], tok.encode_many(texts[at : at + 20])):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_whole(docs, odd_rows):
    rows = odd_rows + [(50 + i, t, "en", "s") for i, t in enumerate(ODD_TEXTS)]
    d, tok, capacity = docs(rows), Tokenizer.from_file(PATH), 64
    got = packing.pack(d, PATH, capacity=capacity).collect()
    want = Counter()
    for doc, text, _, _ in rows:
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            want[doc, k, at, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    rooms = []
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        rooms.append(capacity - at)
    assert sorted(rooms) == best_fit([r["length"] for r in got], capacity)
    assert packing.pack(docs([]), PATH).count() == 0


def test_packing_ranks_over_buckets(docs, monkeypatch):
    rows = [(i, "same text", "en", "s") for i in range(60)] + [(i, "x " * (i % 9), "en", "s") for i in range(60, 120)]
    monkeypatch.setattr(packing, "RANK_ROWS", 5)
    got = packing.pack(docs(rows), PATH, capacity=16).collect()
    places = [(r["sequence_id"], r["offset"]) for r in got]
    assert len(got) == 120 and len(set(places)) == 120


def test_sequences_hold_the_tokens(docs):
    rows = [(i, "alpha beta gamma " * i, "en", "s") for i in range(12)]
    got = packing.sequences(docs(rows), PATH, capacity=20).collect()
    tok = Tokenizer.from_file(PATH)
    want = Counter(x for _, t, _, _ in rows for x in [*tok.encode(t, add_special_tokens=False).ids, 1])
    assert Counter(x for r in got for x in r["ids"]) == want
    assert all(len(r["ids"]) <= 20 for r in got)


def test_line_query_on_given_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = [(d, n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute_lines(rows, 40, 5)]
    got = QUERIES["op2_line_dedup"](spark, SF_SMALL)
    assert columns(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(want, key=repr)
    assert got.filter(F.col("n_dropped") > 0).count() == sum(1 for r in want if r[2])


def test_ids_equal_tokenizer_on_seeded_fuzz():
    """100,000 strings over all of Latin-1, control characters, punctuation runs, word parts and special tokens."""
    rng = random.Random(1)
    latin = [chr(c) for c in range(256)]
    control = [chr(c) for c in range(33)] + list("\x7f\x80\x85\xa0\xad")
    punct = list(".,;:!?#*&%$_-'\"()[]<>|/\\@^~`+={}")
    words = ["hello", "World", "it's", "Ünï", "straße", "don't", "3.5", "a.b", "<|startoftext|>", "<|endoftext|>", "<|", "'s", "_x_", "__", "ABC"]
    alphabets = [latin, control + punct + list("ab \n  "), punct + [" ", "\n"], words + punct + [" "] * 10 + ["\n", ". ", ", "], latin + ["漢", "ﬁ", " ", "​", "　"]]
    tok, cache = Tokenizer.from_file(PATH), packing.WordTokens(PATH)
    for t in ["\x1d.\n&", "\x1d. a", "\x1c, b"]:
        assert cache.encode_many([t])[0].tolist() == tok.encode(t, add_special_tokens=False).ids
    for alphabet in alphabets:
        for _ in range(20):
            texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 24))) for _ in range(1000)]
            want = [e.ids for e in tok.encode_batch(texts, add_special_tokens=False)]
            assert [a.tolist() for a in cache.encode_many(texts)] == want
