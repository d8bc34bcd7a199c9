"""Periodic runs against brute force over all periods and positions."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sylvan.llm import periodic_runs as pr
from sylvan.llm.queries import QUERIES
from llm_fixtures import DOC, docs, odd_rows, SF_SMALL  # noqa: F401


def brute_runs(w, shortest=12):
    out, n = [], len(w)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(shortest, 2 * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def check(texts, shortest=12):
    got = pr.collapsed_runs([[x.encode() for x in t] for t in texts], shortest)
    for t, (runs, rest) in zip(texts, got):
        want = brute_runs(t, shortest)
        assert [tuple(r) for r in runs.tolist()] == want
        assert rest.decode() == brute_collapse(t, want)


def some_text(rng):
    n, letters = rng.randint(0, 90), rng.choice(["a", "ab", "abc", "abcdefgh"])
    w = [rng.choice(letters) for _ in range(n)]
    for _ in range(rng.randint(0, 3)):  # loops, also loops of loops
        if w:
            s = rng.randrange(len(w))
            unit = w[s : s + rng.randint(1, 12)]
            w[s:s] = unit * rng.randint(1, 5)
    return w


def test_runs_against_brute_force():
    rng = random.Random(11)
    for _ in range(60):
        check([some_text(rng) for _ in range(rng.randint(1, 8))])
    check([["a"] * 300, [], ["a"] * 11, ["a"] * 12, ["a", "b"] * 6, ["a", "b"] * 6 + ["a"], ["a"] * 299], 12)
    check([["a"] * 40, list("abcdefghij" * 3)], 20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=60), min_size=1, max_size=4))
def test_runs_of_two_letters(texts):
    check([list(t) for t in texts])


def test_known_families():
    fib = ["a", "ab"]
    while len(fib[-1]) < 400:  # Fibonacci words hold as many runs as words can, in nested periods
        fib.append(fib[-1] + fib[-2])
    check([list(fib[-1][:400]), list(("a" * 13 + "b") * 9)])


def test_one_prime_or_several():
    """Numbers so large that one and two primes do not bound the sums; an occurrence modulo one prime only is none."""
    words = np.concatenate([np.array([0, pr.PRIMES[0][0], 5, 0, 5]), np.full(20, 7)])
    at, by = pr.occurrences(words, np.array([0]), 1, 1, 4)
    assert at.tolist() == [0] and by.tolist() == [3]
    big = np.concatenate([np.array([3, 10**12, 4, 3, 10**12]), np.full(20, 7)])
    at, by = pr.occurrences(big, np.array([0]), 2, 1, 4)
    assert at.tolist() == [0] and by.tolist() == [3]


def test_long_text_with_a_late_loop():
    rng = random.Random(2)
    loop = [f"u{rng.randint(0, 5000)}" for _ in range(6001)]
    w = [f"v{rng.randint(0, 300)}" for _ in range(20_000)] + loop * 3 + ["end"]
    ((runs, rest),) = pr.collapsed_runs([[x.encode() for x in w]])
    assert [20_000, 18_003, 6001] in runs.tolist()
    assert rest.decode() == " ".join(w[:26_001] + ["end"])


def brute_report(rows):
    out = []
    for d, t in rows:
        w = [x.decode() for x in (t or "").encode().split()]
        n = len(w)
        h = 1 if d is None else zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(w)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        digest = hashlib.sha256("".join(f"{s},{le},{q}\n" for s, le, q in runs).encode()).hexdigest()
        row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        out.append((d, len(runs), *row, digest, hashlib.sha256(brute_collapse(w, runs).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_query_against_brute_force(docs, odd_rows):
    rng = random.Random(4)
    planted = [i for i in range(40_000) if zlib.crc32(str(i).encode()) % 10 == 0][:60]
    words = ["alpha", "beta", "gamma", "\x1cdelta", "Ωmega", "a\xa0b", "x"]
    rows = [(i, rng.choice([" ", "\n", "\t \r"]).join(rng.choice(words) for _ in range(rng.randint(0, 70))), "en", "s") for i in planted + list(range(-20, 60))]
    rows += [r for r in odd_rows if r[1] is None or len(r[1]) < 1000]
    got = pr.run_report(pr.find_runs(pr.with_loops(docs(rows))))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute_report([r[:2] for r in rows])


def test_empty_table_and_long_text(spark, docs, odd_rows):
    assert pr.find_runs(docs([])).count() == 0
    out = pr.find_runs(docs(odd_rows)).collect()
    assert len(out) == len(odd_rows)
    long = next(r for r in out if r["doc_id"] == 8)
    # the words word{i % 977} and{i % 31} repeat after 977 * 31 pairs only, beyond half the text
    assert long["runs"] == [] and long["collapsed_text"].count(" ") == 59_999


def test_registered_query(spark):
    got = QUERIES["op11_periodic_runs"](spark, SF_SMALL)
    want = spark.read.parquet(f"{SF_SMALL}/documents.parquet").filter(F.length("text") < 3000)
    rows = [(r["doc_id"], r["text"]) for r in want.collect()]
    ids = {r[0] for r in rows}
    assert sorted((tuple(r) for r in got.collect() if r["doc_id"] in ids), key=repr) == brute_report(rows)
