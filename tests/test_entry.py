import duckdb
import pytest

import __spark_entry__ as E

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["c_custkey", "c_mktsegment", "segment_probe", "segment_probe_lookup"]


def test_every_query_has_a_name_and_most_have_sql():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 60
    # the training-data queries come with their optional subpackage, all or none
    assert sum(k == "pipeline" or k.startswith("op") and k[2].isdigit() for k in qs) in (0, 14)


FAST = ["lookup_column", "match_self_join", "match_flags", "row_index_dense", "cell_put", "cell_mutate_mixed",
        "cell_check_and_put", "change_tracking_history", "cell_scan_wide", "salted_row_key", "enrich_store"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def norm(v):
    return "∅" if v is None else (repr(round(v, 6)) if isinstance(v, float) else str(v))


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle_at_sf0001(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    order = sorted(ocols)
    got = sorted(tuple(norm(r[c]) for c in order) for r in df.collect())
    want = sorted(tuple(norm(row[ocols.index(c)]) for c in order) for row in res.fetchall())
    assert got == want


def test_every_oracle_runs_in_duckdb(duck):
    for name, sql in E.oracle_sql().items():
        res = duck.execute(sql)
        cols = [d[0] for d in res.description]
        assert len(cols) == len(set(cols)), name  # every output column is named once
        res.fetchall()
