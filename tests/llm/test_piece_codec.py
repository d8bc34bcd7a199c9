"""The chunk table against the sentencepiece library on whole texts."""

import hashlib
import random

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from sylvan.llm import piece_codec as pc
from sylvan.llm.queries import PIECES, QUERIES
from llm_fixtures import DOC, docs, odd_rows, SF_SMALL  # noqa: F401

PATH = public_tokenizers.path(PIECES)
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
TABLE = pc.ChunkTable(PATH)


def check(texts, table=TABLE):
    ids, counts, decoded = table.encode(texts)
    at = 0
    for t, n, shown in zip(texts, counts, decoded):
        want = SP.encode(t)
        assert ids[at : at + n].tolist() == want, repr(t)
        assert shown == SP.decode(want), repr(t)
        at += n
    assert at == len(ids)


def test_model_is_separable():
    assert TABLE.split


def test_edges():
    check(["", " ", "  ", "\n", "\n\n", " \n ", "a", " a", "a ", "a  b", "▁", "▁▁a", "a▁b c", "\x00", "a\x00 b", "\t", "\r\n", "<s>", "</s> <unk> <0x0A>", "�", "\U0001f600 \U0001f600"])
    check([" " * n + "x" + " " * n + "\n" + " " * n for n in range(40)])


def test_seeded_fuzz():
    """Over all of Latin-1, controls, markers, runs of spaces, other scripts and whole pieces of the vocabulary."""
    rng = random.Random(13)
    pieces = [SP.id_to_piece(i).replace(pc.MARKER, " ") for i in range(SP.get_piece_size())]
    alphabets = [
        [chr(c) for c in range(256)],
        list("  \n\n\t\r\x0b\x0c\x1c\x85\xa0 ▁ab.,"),
        list("abc  ") + ["漢", "字", "́", "\U0001f468", "‍", "ﬁ", "①", "­", "﻿"],
        pieces,
    ]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(0, 30))) for a in alphabets for _ in range(6000)]
    for k in range(0, len(texts), 1000):
        check(texts[k : k + 1000])


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_any_text(text):
    check([text])


def test_emptied_table_and_whole_text_chunks(monkeypatch):
    monkeypatch.setattr(pc, "TABLE_CHARS", 20)
    small = pc.ChunkTable(PATH)
    for t in ["one two three four five six", "two three seven", "", "one two"]:
        check([t, t + "\n" + t], small)
    assert small.chars < 60
    whole = pc.ChunkTable(PATH)
    whole.split = False  # as for a model whose pieces cross markers
    check(["one  two\nthree", "", " x", "\n"], whole)


def test_model_with_changed_marks_is_not_separable():
    class Crossing:
        """A vocabulary with one piece over a marker."""

        def __getattr__(self, name):
            return getattr(SP, name)

        def id_to_piece(self, i):
            return "of▁the" if i == 500 else SP.id_to_piece(i)

    assert not pc.separable(Crossing())


def brute(rows):
    out = []
    for d, t in rows:
        ids = SP.encode(t or "")
        out.append((d, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(SP.decode(ids).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_operator_on_odd_rows(docs, odd_rows):
    got = pc.encode_texts(docs(odd_rows), PATH)
    assert got.columns == ["doc_id", "ids", "decoded"]
    want = sorted(((r[0], SP.encode(r[1] or ""), SP.decode(SP.encode(r[1] or ""))) for r in odd_rows), key=repr)
    assert sorted(((r[0], list(r[1]), r[2]) for r in got.collect()), key=repr) == want
    assert pc.encode_texts(docs([]), PATH).count() == 0


def test_registered_query(spark):
    got = QUERIES["op13_piece_codec"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)
