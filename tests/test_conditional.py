"""Conditional mutations at row grain: batch plans, chunks and streams against a plain fold."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import cas
from tessera.operators import cells as C
from tessera.streaming import mutations as SM

from conftest import rows

REQ = f"k string, f string, q string, exp string, ts long, seq long, then {cas.THEN}"


def some_then(rnd):
    """One to three mutations of any cells of the row."""
    out = []
    for _ in range(rnd.randint(1, 3)):
        kind = rnd.choice([C.PUT, C.PUT, C.PUT, C.DELETE_CELL, C.DELETE_FAMILY, C.DELETE_ROW, C.INCREMENT])
        f, q = rnd.choice("cd"), rnd.choice("xyz")
        out.append((kind, None if kind == C.DELETE_ROW else f, q if kind in (C.PUT, C.INCREMENT, C.DELETE_CELL) else None,
                    rnd.choice(["1", "2", "\u0000"]) if kind == C.PUT else None, 1 if kind == C.INCREMENT else None))
    return out


def some_requests(rnd, n, hot=0.5, first=10):
    keys = ["hot", "k1", "k2", "k3"]
    return [(keys[0] if rnd.random() < hot else rnd.choice(keys), rnd.choice("cd"), rnd.choice("xy"), rnd.choice([None, None, "1", "2", "3", "\u0000"]),
             first + i // 2, i, some_then(rnd)) for i in range(n)]


BASE = [("hot", "c", "x", 3, 0, "put", "1", None), ("hot", "d", "y", 3, 0, "put", "\u0000", None), ("k1", "c", "x", 14, 0, "put", "2", None),
        ("k2", "c", "x", 3, 0, "put", "1", None), ("k2", "c", None, 20, 0, "delete_family", None, None), ("k3", "d", "x", 3, 0, "increment", None, 2)]


def brute(spark_rows, requests):
    """Apply request after request: resolve a row's log in plain Python, check, append."""
    from test_cells import brute_resolve

    log, accepted = list(spark_rows), []
    for k, f, q, exp, ts, seq, then in sorted(requests, key=lambda r: (r[0], r[4], r[5])):
        state = {(e[0], e[1], e[2]): e[3] for e in brute_resolve([e for e in log if e[0] == k])}
        if state.get((k, f, q)) != exp:
            continue
        # older than the last change of the checked cell: a newer put or increment, or a delete at its ts
        last = [(e[3], e[4] if e[5] in (C.PUT, C.INCREMENT) else 1 << 63) for e in log
                if e[0] == k and (e[5] == C.DELETE_ROW or (e[1] == f and (e[5] == C.DELETE_FAMILY or e[2] == q)))]
        if last and (ts, seq) <= max(last):
            continue
        accepted.append((k, ts, seq))
        log += [(k, mf, mq, ts, seq, kind, v, d) for kind, mf, mq, v, d in then]
    return sorted(set(accepted)), brute_resolve(log)


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_brute_force_on_all_paths(spark, seed):
    rnd = random.Random(seed)
    raw = some_requests(rnd, 90)
    base = spark.createDataFrame(BASE, C.CELL_SCHEMA)
    df = spark.createDataFrame(raw, REQ)
    reqs = cas.requests(df, row_key="k", family=F.col("f"), qualifier=F.col("q"), expected="exp", ts="ts", seq="seq", then=F.col("then"))
    want, state = brute(BASE, raw)
    assert len(want) > 10
    for hot, chunks in ((None, None), (0, 6 * seed)):
        got = cas.check_and_mutate(base, reqs, hot_row_requests=hot, num_chunks=chunks)
        assert sorted(set(rows(got, "row_key", "ts", "seq"))) == want
        assert rows(C.resolve(C.append(base, got)), "row_key", "family", "qualifier", "value") == state


def test_stale_requests_are_refused(spark):
    base = spark.createDataFrame([("a", "c", "x", 100, 0, "put", "x", None)], C.CELL_SCHEMA)
    df = spark.createDataFrame([("a", "x", "new", 5), ("a", "x", "new", 101)], "k string, exp string, v string, ts long")
    reqs = cas.requests(df, row_key="k", family="c", qualifier="x", expected="exp", value="v", ts="ts")
    for one_row in (False, True):
        got = cas.check_and_put(base, reqs.filter("ts = 5") if one_row else reqs, single_per_row=one_row)
        assert rows(got, "ts") == ([] if one_row else [(101,)])


def test_stored_null_character_is_not_absent(spark):
    base = spark.createDataFrame([("a", "c", "x", 1, 0, "put", "\u0000", None)], C.CELL_SCHEMA)
    reqs = cas.requests(spark.createDataFrame([("a",)], "k string"), row_key="k", family="c", qualifier="x", expected=F.lit(None), value=F.lit("v"), ts=5)
    for hot in (None, 0):
        assert cas.check_and_put(base, reqs, hot_row_requests=hot).count() == 0


def test_row_deletes_see_each_other(spark):
    base = spark.createDataFrame([("a", "c", "x", 1, 0, "put", "1", None), ("a", "c", "y", 1, 0, "put", "2", None)], C.CELL_SCHEMA)
    df = spark.createDataFrame([("a", "x", "1", 5), ("a", "y", "2", 6)], "k string, q string, exp string, ts long")
    reqs = cas.requests(df, row_key="k", family="c", qualifier=F.col("q"), expected="exp", ts="ts")
    for hot in (None, 0):
        got = cas.check_and_delete(base, reqs, scope="row", hot_row_requests=hot, num_chunks=2)
        assert rows(got, "row_key", "ts", "kind") == [("a", 5, "delete_row")]


def test_null_parts_of_requests_fail(spark):
    base = C.empty_cells(spark)
    reqs = cas.requests(spark.createDataFrame([(None,)], "k string"), row_key="k", family="c", qualifier="x", expected=F.lit(None), value=F.lit("v"), ts=5)
    with pytest.raises(Exception, match="row_key is null"):
        cas.check_and_put(base, reqs)


def _files(spark, df, path, parts):
    """The requests as files of increasing versions, oldest first."""
    import os
    import time

    raw = sorted(df.collect(), key=lambda r: (r.ts, r.seq))
    step = -(-len(raw) // parts)
    for i in range(parts):
        spark.createDataFrame(raw[i * step:(i + 1) * step], df.schema).coalesce(1).write.parquet(f"{path}/part={i}")
        for f in os.listdir(f"{path}/part={i}"):
            os.utime(f"{path}/part={i}/{f}", (time.time() - 1000 + i,) * 2)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_equals_batch_over_rows_families_and_cells(spark, tmp):
    raw = some_requests(random.Random(9), 120)
    base = spark.createDataFrame(BASE, C.CELL_SCHEMA)
    df = spark.createDataFrame(raw, REQ)

    def reqs(d):
        return cas.requests(d, row_key="k", family=F.col("f"), qualifier=F.col("q"), expected="exp", ts="ts", seq="seq", then=F.col("then"))

    live = C.resolve(base.filter("row_key <> 'k2'"))
    accepted = SM.stream_check_and_mutate(reqs(_files(spark, df, f"{tmp}/in", 3)), live)
    SM.append_to_files(accepted, f"{tmp}/out", f"{tmp}/ck")
    got = C.read_cells(spark, f"{tmp}/out")
    start = base.filter("row_key <> 'k2'")
    want = cas.check_and_mutate(start, reqs(df))
    assert rows(got) == rows(want)
    assert rows(C.resolve(C.append(start, got))) == rows(C.resolve(C.append(start, want)))


def test_stream_state_shrinks_with_deletes(spark, tmp):
    puts = [("r", "c", f"q{i}", None, i + 1, 0, [(C.PUT, "c", f"q{i}", "v", None)]) for i in range(20)]
    drop = [("r", "c", "q0", "v", 100, 0, [(C.DELETE_ROW, None, None, None, None)])]
    stream = _files(spark, spark.createDataFrame(puts + drop, REQ), f"{tmp}/in", 1)
    reqs = cas.requests(stream, row_key="k", family=F.col("f"), qualifier=F.col("q"), expected="exp", ts="ts", seq="seq", then=F.col("then"))
    SM.append_to_files(SM.stream_check_and_mutate(reqs, None), f"{tmp}/out", f"{tmp}/ck")
    assert C.read_cells(spark, f"{tmp}/out").count() == 21

    def kept(name):
        return spark.read.format("statestore").option("stateVarName", name).load(f"{tmp}/ck").count()

    assert (kept("cells"), kept("tombs")) == (0, 1)


def test_stream_state_calls_and_texts(spark, tmp):
    # a row without tombstones costs one read of its cell and a test for tombstones; what isn't changed isn't written
    class Kept(dict):
        def __init__(self, *a):
            super().__init__(*a)
            self.calls = []

        def getValue(self, key):
            self.calls.append("get")
            return self.get(key)

        def exists(self):
            self.calls.append("exists")
            return bool(self)

        def updateValue(self, key, value):
            self.calls.append("put")
            self[key] = value

        def removeKey(self, key):
            self.calls.append("remove")
            del self[key]

        def iterator(self):
            return iter([*self.items()])

    def run(cells, tombs, *reqs):
        row = SM._KeptRow(cells, tombs)
        taken = [row.request(*r) for r in reqs]
        row.save()
        return taken

    put = lambda value: [{"kind": "put", "family": "c", "qualifier": "q", "value": value, "delta": None}]
    gone = [{"kind": "delete_row", "family": None, "qualifier": None, "value": None, "delta": None}]
    cells, tombs = Kept(), Kept()
    assert run(cells, tombs, ("c", "q", None, 1, 0, put("a"))) == [True]
    assert (cells.calls, tombs.calls) == (["get", "put"], ["exists"])
    cells.calls, tombs.calls = [], []
    assert run(cells, tombs, ("c", "q", "x", 2, 0, put("b"))) == [False]
    assert (cells.calls, tombs.calls) == (["get"], [])
    # a delete of the row is kept, and hides older requests in later batches
    cells["d", "old"] = ("v", None, None)
    assert run(cells, tombs, ("c", "q", "a", 5, 0, gone)) == [True]
    assert ("c", "q") not in cells and tombs == {("row", "", ""): (5,)}
    assert run(cells, tombs, ("d", "old", "v", 9, 0, put("b"))) == [False]
    assert run(cells, tombs, ("c", "q", None, 5, 0, put("b")), ("c", "q", None, 6, 0, put("c"))) == [False, True]
    assert cells["c", "q"] == ("c", 6, 0)


def test_stream_keeps_odd_values(spark, tmp):
    odd = 'a"\n\\\t\u2028\u00e9\U0001f600'
    raw = [("r", "c", "q", None, 1, 0, [(C.PUT, "c", "q", odd, None)]), ("r", "c", "q", odd, 2, 0, [(C.PUT, "c", "n", None, None), (C.INCREMENT, "c", "i", None, 2**62)])]
    stream = _files(spark, spark.createDataFrame(raw, REQ), f"{tmp}/in", 2)
    reqs = cas.requests(stream, row_key="k", family=F.col("f"), qualifier=F.col("q"), expected="exp", ts="ts", seq="seq", then=F.col("then"))
    SM.append_to_files(SM.stream_check_and_mutate(reqs, None), f"{tmp}/out", f"{tmp}/ck")
    got = C.read_cells(spark, f"{tmp}/out").select("qualifier", "value", "delta").collect()
    assert {tuple(r) for r in got} == {("q", odd, None), ("n", None, None), ("i", None, 2**62)}


class _Value:
    """A value state, with a count of its calls."""

    def __init__(self):
        self.value, self.calls = None, []

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def clear(self):
        self.calls.append("clear")
        self.value = None


class _Map(dict):
    """A map state."""

    getValue, updateValue, removeKey = dict.get, dict.__setitem__, dict.__delitem__

    def exists(self):
        return bool(self)

    def iterator(self):
        return iter([*self.items()])


class _Handle:
    def __init__(self):
        self.states = {}

    def getValueState(self, name, schema):
        return self.states.setdefault(name, _Value())

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, _Map())


def _processor():
    handle, processor = _Handle(), SM.ConditionalRows()
    processor.init(handle)
    return processor, handle.states


def _batch(processor, *reqs):
    import json

    from pyspark.sql import Row
    names = ("ts", "seq", "family", "qualifier", "expected", "tie")
    given = [Row(row_key="r", request=json.dumps(dict(zip(names, (*r[:5], 0), strict=True))) + "\n" + json.dumps(r[5])) for r in reqs]
    return [r.ts for r in processor.handleInputRows(("r",), iter(given), None)]


def _mutation(kind, family=None, qualifier=None, value=None):
    return {"kind": kind, "family": family, "qualifier": qualifier, "value": value, "delta": None}


def test_stream_state_calls_of_a_row_with_deletes():
    # whatever a row's requests put and delete, a micro-batch reads and writes its two values once each
    processor, states = _processor()
    put = lambda v: [_mutation(C.PUT, "c", "q", v), _mutation(C.PUT, "d", "last", v)]
    gone = [_mutation(C.DELETE_ROW)]
    assert _batch(processor, (1, 0, "c", "q", None, put("a"))) == [1]
    for state in states.values():
        if isinstance(state, _Value):
            state.calls.clear()
    taken = _batch(processor, (2, 0, "c", "q", "a", gone), (2, 1, "c", "q", None, put("b")), (3, 0, "c", "q", None, put("c")), (4, 0, "c", "q", "c", gone))
    assert taken == [2, 3, 4]
    assert states["cells"].calls == ["get", "clear"] and states["tombs"].calls == ["get", "update"]
    assert not states["wide_cells"] and not states["wide_tombs"]


def test_stream_state_of_rows_that_outgrow_a_text(monkeypatch):
    # the same decisions for rows held as texts, as maps, and for those that move from one to the other
    raw = some_requests(random.Random(31), 240)
    of_row = [(ts, seq, f, q, exp, [_mutation(k, mf, mq, v) | {"delta": d} for k, mf, mq, v, d in then]) for key, f, q, exp, ts, seq, then in raw if key == raw[0][0]]
    of_row.sort(key=lambda r: (r[0], r[1]))
    assert len(of_row) > 30
    taken, wide = [], []
    for most in (16_384, 60, 0):
        monkeypatch.setattr(SM, "NARROW", most)
        processor, states = _processor()
        taken.append([_batch(processor, *of_row[i:i + 5]) for i in range(0, len(of_row), 5)])
        wide.append(states["cells"].value == ("wide",))
    assert taken[0] == taken[1] == taken[2] and any(taken[0])
    assert wide == [False, True, True]


def test_stream_starts_with_wide_and_narrow_rows(spark, tmp):
    live = spark.createDataFrame([("wide", "c", f"q{i:03}", f"v{i}", 1, 0) for i in range(3 * SM.PACK)] + [("narrow", "c", "q000", "v0", 1, 0), ("narrow", "c", "q001", None, None, None)],
                                 "row_key string, family string, qualifier string, value string, ts bigint, seq bigint")
    raw = [("wide", "c", "q000", "v0", 5, 0, [(C.PUT, "c", "q190", "new", None)]), ("wide", "c", "q190", "new", 6, 0, [(C.DELETE_ROW, None, None, None, None)]),
           ("wide", "c", "q191", "v191", 7, 0, [(C.PUT, "c", "q191", "no", None)]), ("wide", "c", "q191", None, 8, 0, [(C.PUT, "c", "q191", "yes", None)]),
           ("narrow", "c", "q000", "v0", 5, 0, [(C.PUT, "c", "q000", "x", None)]), ("narrow", "c", "q000", "v0", 6, 0, [(C.PUT, "c", "q000", "no", None)])]
    stream = _files(spark, spark.createDataFrame(raw, REQ), f"{tmp}/in", 3)
    reqs = cas.requests(stream, row_key="k", family=F.col("f"), qualifier=F.col("q"), expected="exp", ts="ts", seq="seq", then=F.col("then"))
    SM.append_to_files(SM.stream_check_and_mutate(reqs, live), f"{tmp}/out", f"{tmp}/ck")
    assert rows(C.read_cells(spark, f"{tmp}/out"), "row_key", "ts") == [("narrow", 5), ("wide", 5), ("wide", 6), ("wide", 8)]
