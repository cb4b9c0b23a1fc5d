"""The n-gram join against brute force."""

import random
import re

import numpy as np
import pytest

from tessera.llm import ngram_join as J

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = {tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(rng):
    """Groups whose members lie around the threshold, with and without their base."""
    rows, vocabulary = [], [f"w{i}" for i in range(400)]
    for size, copies, with_base in ((40, 25, True), (150, 40, False), (400, 25, True), (12, 20, False)):
        base = [rng.choice(vocabulary) for _ in range(size)]
        if with_base:
            rows.append(" ".join(base))
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randrange(0, max(2, size // 20))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                own = own[: len(own) - rng.randrange(1, max(2, size // 12))]
            rows.append(" ".join(own))
    rows += ["", None, " \t\n", "one", "One", "two words", "two  WORDS", "a b c", "word " * 3000, "word " * 3001]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("words", "percent"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, words, percent):
    rows = near_copies(random.Random(words))
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, component_id int, size string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(df, words, percent).collect()}
    assert got == brute(rows, words, percent)


def test_links_are_counted_exactly(spark, monkeypatch):
    monkeypatch.setattr(J, "COUNT_PART", 7)  # components in several parts
    rows = near_copies(random.Random(11))
    sets = {}
    for i, t in rows:
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k : k + 3]) for k in range(max(1, len(w) - 2))) if w else frozenset()
    classes = {s for s in sets.values() if s}
    want = {i: sum(10 * len(s & o) >= 9 * len(s | o) for o in classes if s and o != s) for i, s in sets.items()}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.n_links for r in J.jaccard_components(df, 3, 90, count_links=True).collect()}
    assert got == want and max(want.values()) > 5
    assert "n_links" not in J.jaccard_components(df.limit(0)).columns


def test_empty_table_and_null_ids(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert J.jaccard_components(empty).count() == 0
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (5, None)], "doc_id long, text string")
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id) for r in J.jaccard_components(df).collect())
    assert got == [(-1, 2, 3), (3, 2, 3), (3, 2, 3), (5, 0, 5)]


def test_rows_without_ids_link_others(spark):
    text = lambda n: " ".join(f"w{i}" for i in range(n + 2))
    rows = [(7, text(50)), (None, text(45)), (3, text(40)), (None, text(45).replace("w", "v")), (None, text(46).replace("w", "v"))]  # 40 and 50: below 85 %
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()), key=str)
    assert got == sorted([(7, 50, 3), (None, 45, 3), (3, 40, 3), (None, 45, None), (None, 46, None)], key=str)


def test_bands_cover_every_pair_of_sizes():
    bands = J.Bands(90, 1000)
    for a in range(1, 700):
        for b in range(a, a * 100 // 90 + 1):
            if a != b and bands.most_apart(a, b) >= b - a and bands.most_apart(a, b):
                common = set(bands.of(a)) & set(bands.of(b))
                assert any(2 * bands.plan[k][0] + bands.plan[k][1] > bands.most_apart(a, b) for k in common), (a, b)


@pytest.mark.parametrize("words", range(1, 7))
def test_chunks_of_few_words(words):
    for text in ("one", "one two", "one two three", "one two three four"):
        alone, beside = J.shingle_sets([text.encode()], words), J.shingle_sets([text.encode(), b"x " * 9], words)
        assert list(alone[0]) == list(beside[0]) and len(alone[0]) == max(1, len(text.split()) - words + 1)


def test_words_that_polynomials_confuse_stay_apart(spark):
    """The Thue-Morse word and its complement have equal polynomial hashes modulo 2 ** 64 for every odd base."""
    word = "a"
    while len(word) < 2048:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{word} x y z"), (2, f"{other} x y z")]
    one, two = J.shingle_sets([t.encode() for _, t in rows], 3)
    assert len(one) == len(two) == 2 and len(set(one.tolist()) & set(two.tolist())) == 1
    got = J.jaccard_components(spark.createDataFrame([(1, word), (2, other)], "doc_id long, text string"), words=3, percent=90)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == [(1, 1), (2, 2)]


@pytest.mark.parametrize("percent", [90, 80])
def test_similar_sets_share_the_keys_they_need(percent):
    rng, bands, tight = np.random.default_rng(percent), J.Bands(percent, 1000), 0
    for _ in range(3000):
        pool = rng.integers(0, 2**63, int(rng.choice([6, 20, 60, 200, 900])) * 2, dtype=np.uint64)
        size = int(rng.integers(1, len(pool) // 2 + 1))
        apart = bands.most_apart(size, size) + 1
        one, kept = pool[:size], rng.permutation(size)[: max(1, size - int(rng.integers(0, apart + 1)))]
        two = np.concatenate([pool[kept], pool[size : size + int(rng.integers(0, apart + 1))]])
        shared = len(kept)
        if 100 * shared < percent * (len(one) + len(two) - shared) or shared == len(one) == len(two):
            continue
        (x, least_x), (y, least_y) = J.segment_keys(np.sort(one), bands), J.segment_keys(np.sort(two), bands)
        both = len(np.intersect1d(x, y))
        assert both >= max(least_x, least_y), (len(one), len(two), shared)
        tight += max(least_x, least_y) > 1
    assert tight > 300


def test_members_whose_size_differs_from_their_hub(spark):
    """Beginnings of one text: the longest are too long for the hub, and link with each other."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(420)]
    rows = []
    for n in range(200, 420, 7):
        for _ in range(6 if n < 230 else 1):
            own = base[:n]
            for _ in range(rng.randrange(0, 3)):
                own[rng.randrange(n)] = f"x{rng.randrange(9)}"
            rows.append(" ".join(own))
    rows = list(enumerate(rows))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert got == brute(rows, 3, 90)


def test_texts_are_hashed_in_parts_of_bounded_bytes(monkeypatch):
    import pyarrow as pa

    texts = [f"w{i} ".encode() * 20_000 for i in range(40)] + [b"a b c"] * 600
    seen, whole = [], J.shingle_sets(texts, 3)
    monkeypatch.setattr(J, "shingle_sets", lambda some, words, f=J.shingle_sets: seen.append([len(t) for t in some]) or f(some, words))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.binary())], ["set_key", "text"])
    got = [(k, g) for b in J._sets_of(3)(iter([batch])) for k, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]
    assert [k for k, _ in got] == list(range(len(texts))) and all(np.array_equal(np.array(g, np.int64).view(np.uint64), h) for (_, g), h in zip(got, whole, strict=True))
    assert max(sum(x) for x in seen if len(x) > 1) <= J.CHUNK_BYTES and max(map(len, seen)) <= 256


def test_rows_handed_to_python_at_once_are_bounded(spark, monkeypatch):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    found, inner = [], J._components_of
    monkeypatch.setattr(J, "_components_of", lambda *a: found.append(spark.conf.get(name)) or inner(*a))
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (3, "x")], "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in J.jaccard_components(df).collect()) == [(1, 1), (2, 1), (3, 3)]
    assert found == [str(J.ARROW_ROWS)] and spark.conf.get(name) == before
