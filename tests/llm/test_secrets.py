"""Secret scans against plain regular expressions, plain tests and the SQL."""

import base64
import hashlib
import math
import random
import re

import duckdb
import pytest

from tessera.llm import queries, secrets as S

ASSIGN = re.compile(r"(?ai:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def plain_base(text):
    text = text or ""
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def told(spans):
    return ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def plain_p(word, alphabet):
    n, k = len(word), len(alphabet)
    x = [alphabet.index(c) for c in word]
    upper = lambda z: 0.5 * math.erfc(z / math.sqrt(2))
    even = k / n * sum(word.count(c) ** 2 for c in set(word)) - n
    shape = (k - 1) * n / (2 * (n - 1))
    p1 = upper(((even / (k - 1)) ** (1 / 3) - (1 - 1 / (9 * shape))) * 3 * math.sqrt(shape))
    halves = [v >= k / 2 for v in x]
    ones, runs = sum(halves), 1 + sum(a != b for a, b in zip(halves, halves[1:]))
    mean = 1 + 2 * ones * (n - ones) / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p2 = 2 * upper(abs(runs - mean) / math.sqrt(var)) if var > 0 else 0
    bottom = n * sum(v * v for v in x) - sum(x) ** 2
    p3 = 0
    if bottom > 0:
        c = (n * sum(a * b for a, b in zip(x, x[1:] + x[:1])) - sum(x) ** 2) / bottom
        p3 = 2 * upper(abs((c + 1 / (n - 1)) / math.sqrt(n * n / ((n - 1) ** 2 * (n - 2)))))
    return 1 - (1 - min(p1, p2, p3)) ** 3


def made(rng, n=400):
    """(doc_id, text): words, long compounds, and random strings by several encodings."""
    words = "the of and vicinity handkerchief representation international-cooperation-agreements aCamelCaseIdentifierOfNote /usr/share/some/long/path".split()
    rows, planted = [], {}
    for i in range(n):
        parts = [rng.choice(words) for _ in range(rng.randint(0, 30))]
        if rng.random() < 0.5:
            secret = rng.choice([
                base64.b64encode(rng.randbytes(rng.randint(24, 60))).decode().rstrip("="), base64.b32encode(rng.randbytes(30)).decode().rstrip("="),
                rng.randbytes(24).hex().upper(), rng.randbytes(12).hex(), "AKIA" + "".join(rng.choices("ABCDEFGHIJ234567", k=rng.randint(10, 20)))])
            lead = rng.choice(["", "", "", "token=", 'Password : "', "api_key='", "secret:ab token: ", "🙂 "])
            parts.insert(rng.randint(0, len(parts)), lead + secret)
            if not lead.strip(" 🙂") and len(secret) > 30 and re.search("[A-Zg-z]", secret):
                planted[i] = secret
        rows.append((i, " ".join(parts)))
    return rows, planted


ODD = [(None, "token=abcdef"), (1001, None), (1002, ""), (1003, " \t\n"), (1004, "é🙂 passwd='x' PASSWORD=12345 password=123456"), (1004, "é🙂 passwd='x' PASSWORD=12345 password=123456"),
       (1005, "secret=token:abcdefgh token==abcdef"), (1006, "f" * 24 + " " + "f" * 23 + " AKIA" + "B" * 16 + "AKIAKIA"), (1007, "ſecret=abcdefg toKen=abcdefg")]


@pytest.fixture()
def scanned(spark, tmp):
    def run(rows):
        schema = "doc_id long, text string, tokens string, base int, assign int, row string"
        spark.createDataFrame([(i, t, "t", 1, 2, "r") for i, t in rows], schema).write.parquet(f"{tmp}/documents.parquet")
        return sorted((tuple(r) for r in queries.op13_secret_scan(spark, tmp).collect()), key=str)

    return run


def test_base_spans_equal_regular_expressions(scanned, tmp):
    rows, planted = made(random.Random(6))
    rows += ODD + [(2000, "word " * 100_000 + "token=abcdef " * 3_000)]
    got = scanned(rows)
    want = [(i, told(plain_base(t)), [sum(k == x for _, k, _ in plain_base(t)) for x in range(3)]) for i, t in rows]
    assert sorted((r[0], r[4], list(r[1:4])) for r in got if r[0] is not None) == sorted((i, hashlib.sha256(s.encode()).hexdigest(), c) for i, s, c in want if i is not None)
    by_id = dict(rows)
    found = {r[0]: r[5] for r in got}
    for i, s, _ in want:
        assert set(filter(None, s.split(","))) <= set(found[i].split(","))
    random_spans = {i: [by_id[i][int(a):int(b)] for k, a, b in (x.split(":") for x in s.split(",") if x) if k == "random"] for i, s in found.items()}
    caught = sum(any(p in w for w in random_spans[i]) for i, p in planted.items())
    assert len(planted) > 60 and caught >= 0.8 * len(planted)  # some random strings fall below their class's threshold
    wrong = [w for i, ws in random_spans.items() for w in ws if i not in planted and not re.search(r"[A-Z2-7]{23}|\d.*[A-Z].*[a-z]", w)]
    assert len(wrong) <= 0.05 * caught, wrong
    # the same rows by the SQL
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp}/documents.parquet/*.parquet')")
    assert sorted(con.execute(queries.ORACLES["op13_secret_scan"]).fetchall(), key=str) == got


def test_p_values(spark):
    rng = random.Random(7)
    alphabets = [a for _, a, _ in S.ENCODINGS]
    words = [("".join(rng.choices(alphabets[i], k=rng.randint(32, 90))), i) for i in range(len(alphabets)) for _ in range(30)] + [("ab" * 30, 2), ("a" * 40, 0), ("abcdefghijklmnopqrstuvwxyz" * 2, 2)]
    df = spark.createDataFrame([(w, [(0, len(w), w)]) for w, _ in words], "w string, tokens array<struct<start:bigint,stop:bigint,word:string>>")
    got = {r.w: r.tokens[0] for r in S._tested(df).collect()}
    for w, _ in words:
        assert got[w].p == pytest.approx(plain_p(w, alphabets[got[w].encoding - 1]), abs=1e-5)


def test_thresholds_by_class(spark):
    rng = random.Random(8)
    even = [(1, 0, rng.random()) for _ in range(2_000)]
    mixed = [(2, 0, rng.random()) for _ in range(1_000)] + [(2, 0, 0.2 * rng.random()) for _ in range(1_000)]
    df = spark.createDataFrame([([x],) for x in even + mixed + [(3, 1, 0.001)] * 50], "tokens array<struct<encoding:int,band:int,p:double>>")
    got = {(r.encoding, r.band): r.least for r in S.thresholds(df).collect()}
    assert got[1, 0] <= 0.02 and 0.1 <= got[2, 0] <= 0.25 and got[3, 1] > 0.001


def test_scan_of_nothing(scanned):
    assert scanned([]) == []


def test_a_very_long_token(scanned):
    word = "".join(random.Random(9).choices(S.ENCODINGS[8][1], k=60_000))
    ((_, a, k, h, _, spans),) = scanned([(1, word)])
    assert (a, k, h, spans) == (0, 0, 0, "random:0:60000") or spans == ""
