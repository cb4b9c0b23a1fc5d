"""Periodic runs against trying every period at every place."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from tessera.llm import periodic_runs as P, queries


def plain_runs(words):
    """All maximal stretches for every period; of equal stretches the least period."""
    n, found = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and words[e] == words[e + q]:
                e += 1
            if e + q - i >= max(24, 3 * q):
                found.setdefault((i, e + q), q)
            i = e
    return sorted((a, b, q) for (a, b), q in found.items())


def made(rng):
    """Words with runs inside runs, near runs and borders shared by runs."""
    out = []
    for _ in range(rng.randint(1, 4)):
        unit = [rng.randint(0, 2) for _ in range(rng.randint(1, 9))]
        inner = unit * rng.randint(1, 9)
        if rng.random() < 0.5:
            inner = (inner + [rng.randint(0, 3)] * rng.randint(0, 3)) * rng.randint(1, 6)
        out += inner + [rng.randint(0, 9) for _ in range(rng.randint(0, 4))]
    return out[:600]


def test_runs_equal_every_period():
    rng = random.Random(1)
    seen = 0
    for _ in range(600):
        words = made(rng)
        want = plain_runs(words)
        assert sorted(P.runs_of(np.array(words, np.int64))) == want
        seen += len(want)
    assert seen > 500


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 1), min_size=0, max_size=130))
def test_runs_of_two_letters(words):
    assert sorted(P.runs_of(np.array(words, np.int64))) == plain_runs(words)


def test_many_texts_at_once():
    rng = random.Random(2)
    texts = [[str(x).encode() for x in made(rng)] for _ in range(40)] + [[], [b"x"], [b"a"] * 23, [b"a"] * 24, [b"a"] * 24]
    got = P.runs_by_text(texts)
    assert [sorted(r) for r in got] == [plain_runs(t) for t in texts]


def test_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 100):
        values = rng.permutation(n).astype(np.int64)
        tree = P.WaveletMatrix(values)
        left = rng.integers(0, n, 200)
        right = np.array([rng.integers(a + 1, n + 1) for a in left])
        limit = rng.integers(0, n + 1, 200)
        assert tree.below(left, right, limit).tolist() == [(values[a:b] < x).sum() for a, b, x in zip(left, right, limit)]
        rank = np.array([rng.integers(0, b - a) for a, b in zip(left, right)])
        assert tree.select(left, right, rank).tolist() == [sorted(values[a:b])[k] for a, b, k in zip(left, right, rank)]


def plain_row(key, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    told = [None] * 4 if best is None else [best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]]
    lines = "".join(f"{a},{b - a},{q}\n" for a, b, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (key, len(runs), *told, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


@pytest.fixture()
def query_over(spark, tmp):
    def run(rows):
        schema = "doc_id long, text string, row int, runs string, key int, n_words string"
        spark.createDataFrame([(i, t, 1, "x", 2, "y") for i, t in rows], schema).write.parquet(f"{tmp}/documents.parquet")
        got = queries.op12_periodic_runs(spark, tmp).collect()
        return sorted((tuple(r) for r in got), key=str)

    return run


def test_query_on_odd_rows(query_over):
    rng = random.Random(5)
    rows = [(None, "a " * 50), (1, None), (2, ""), (3, " \t\n"), (4, "b " * 30 + "🙂 " * 30), (4, "b " * 30 + "🙂 " * 30), (5, "x y " * 40), (6, "\x1c \x85 " * 30)]
    rows += [(i, " ".join(f"w{x}" for x in made(rng))) for i in range(10, 120)]
    assert query_over(rows) == sorted((plain_row(*r) for r in rows), key=str)


def test_query_on_nothing(query_over):
    assert query_over([]) == []


def test_very_long_text(query_over):
    text = " ".join(f"u{i % 977}" for i in range(200_000)) + " " + " ".join(str(i) for i in range(100_000))
    key = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10)
    ((_, n, start, length, period, milli, _, _),) = query_over([(key, text)])
    assert (n, start, length, period, milli) == (1, 0, 200_000, 977, 1000 * 200_000 // 977)


def test_documents_equal_every_period(spark):
    """The whole documents table at the smallest scale."""
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in queries.op12_periodic_runs(spark, sf).collect()), key=str)
    assert got == sorted((plain_row(r.doc_id, r.text) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) >= 10
