"""Every stage of the pipeline against a plain version, each on its own input."""

import base64
import collections
import hashlib

import corpus_pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_ngram_join import brute
from test_operators import brute_lines

from tessera.llm import quality, queries

SOURCE = "/root/testdata/sf0.001"
ODD = [(900_000, None), (900_001, ""), (900_002, " \n\t\n"), (900_003, "one two"), (900_004, "one two")]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """{stage: (rows in, rows out)} and the folder of the first stage's tables."""
    at = str(tmp_path_factory.mktemp("pipeline"))
    docs = spark.read.parquet(f"{SOURCE}/documents.parquet")
    odd = spark.createDataFrame([(i, t, None, "web", None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    docs.select("doc_id", "text", "lang", "source", "n_chars").union(odd).write.parquet(f"{at}/documents.parquet")
    spark.read.parquet(f"{SOURCE}/labels.parquet").write.parquet(f"{at}/labels.parquet")
    docs, seen = spark.read.parquet(f"{at}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(f"{at}/{k}")
        after = spark.read.parquet(f"{at}/{k}")
        assert k == len(corpus_pipeline.STAGES) - 1 or after.columns == docs.columns, name
        seen[k] = [tuple(r) for r in docs.collect()], [tuple(r) for r in after.collect()]
        docs = after
    return seen, at


def test_classifier_keeps_what_it_scores_high(spark, stages):
    (before, after), at = stages[0][0], stages[1]
    table = spark.read.parquet(f"{at}/documents.parquet")
    model = quality.fit(table, spark.read.parquet(f"{at}/labels.parquet"))
    score = {r.row.doc_id: r.score for r in quality.score(table, model).collect()}
    assert sorted(after, key=str) == sorted((r for r in before if score[r[0]] >= quality.THRESHOLD), key=str)
    marked = {r.doc_id: r.quality for r in spark.read.parquet(f"{at}/labels.parquet").collect()}
    kept = {r[0] for r in after}
    good = [r[0] for r in before if marked.get(r[0]) == 1]
    assert sum(i in kept for i in good) >= 0.9 * len(good)


def test_lines_that_go(stages):
    before, after = stages[0][1]
    want = brute_lines([(r[0], r[1]) for r in before])
    assert sorted(((r[0], r[1]) for r in after), key=str) == sorted(((r[0], want[r[0], r[1]]) for r in before), key=str)
    assert all(r[4] == (None if r[1] is None else len(r[1])) for r in after)


def test_one_of_near_copies_stays(stages):
    before, after = stages[0][2]
    group = {i: g for i, (_, g) in brute([(r[0], r[1]) for r in before], 5, 80).items()}
    assert sorted(after, key=str) == sorted((r for r in before if group[r[0]] == r[0]), key=str)


def test_mix_takes_what_sql_says(stages):
    (before, after), at = stages[0][3], stages[1]
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW documents AS SELECT * FROM '{at}/2/*.parquet'")
        db.execute(f"CREATE VIEW labels AS SELECT * FROM '{at}/labels.parquet/*.parquet'")
        words = {r[0]: (r[1], r[4]) for r in db.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({queries.ORACLES['op4_mix_sources']})").fetchall()}
    times = collections.Counter(after)
    assert set(times) <= set(before)
    for r in before:
        size, taken = words[r[0]]
        assert size * times[r] == taken and (size == 0 or times[r] <= 3)


def test_tokens_equal_the_library(stages):
    before, after = stages[0][4]
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for r in before:
        ids = plain.encode_ordinary(r[1] or "")
        sha = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (r[1] or "").encode())]
        want.append((r[0], r[3], len(ids), *sha))
    assert sorted(after, key=str) == sorted(want, key=str)
