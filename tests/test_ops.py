import itertools

import pytest
from pyspark.sql import functions as F

from tessera.operators import cas, clean, index, match, setops
from tessera.operators import cells as C
from tessera.operators.convert import df_to_cells
from tessera.operators.lookup import lookup_column

from conftest import SF_SMALL, rows


def test_df_to_cells_rules(spark):
    df = spark.createDataFrame(
        [(1, "a", None, {"k": "v", "n": None}), (2, None, 3, None)],
        "ID int, name string, id2 int, m map<string,string>")
    got = rows(df_to_cells(df, family="c", key_col="id"), "row_key", "qualifier", "value")
    # the key column is excluded case-insensitively; nulls become ""; a null map gives no cells
    assert got == [("1", "id2", ""), ("1", "k", "v"), ("1", "n", ""), ("1", "name", "a"),
                   ("2", "id2", "3"), ("2", "name", "")]


def test_map_entry_after_column_wins(spark):
    df = spark.createDataFrame([(1, "col", {"name": "map"})], "id int, name string, m map<string,string>")
    got = rows(C.resolve(df_to_cells(df, family="c")), "qualifier", "value")
    assert got == [("name", "map")]


def test_clean_null_rows(spark):
    df = spark.createDataFrame([(1, " null "), (2, "NULL"), (3, None), (4, "x")], "id int, t string")
    assert rows(clean.clean_null_rows(df, "t"), "id") == [(2,), (4,)]


def test_clean_defaults(spark):
    df = spark.createDataFrame([(None, None, "a"), (2, 1.5, None)], "a int, b double, c string")
    out = clean.clean_defaults(df)
    assert out.columns == ["a", "b", "c"]
    assert rows(out) == [(0.0, 0.0, "a"), (2.0, 1.5, "0.0")]
    ts = spark.sql("SELECT current_timestamp() AS t")
    with pytest.raises(TypeError):
        clean.clean_defaults(ts)


def test_row_index_multi_partition(spark):
    keys = list(range(0, 3000, 3))
    df = spark.createDataFrame([(k, str(k)) for k in reversed(keys)], "k int, v string")
    out = index.row_index(df, "k", offset=5, num_partitions=7)
    got = rows(out, "row_num", "k")
    assert got == [(i + 5, k) for i, k in enumerate(keys)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_row_index_string_key_in_back(spark):
    words = [f"w{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    out = index.row_index(df, "w", in_front=False, num_partitions=3)
    assert out.columns == ["w", "row_num"]
    assert rows(out) == [(w, i + 1) for i, w in enumerate(words)]


def _brute_pairs(recs, keyfns):
    out = set()
    for a, b in itertools.product(recs, recs):
        if any(f(a) is not None and f(a) == f(b) for f in keyfns):
            out.add((a[0], b[0]))
    return out


def test_or_match_equals_brute_force(spark):
    recs = [(i, f"n{i % 4}" if i % 5 else None, f"e{i % 3}", f"p{i % 7}" if i % 2 else None) for i in range(40)]
    df = spark.createDataFrame(recs, "id int, name string, email string, phone string")
    pairs = match.or_match_pairs(df, {"name": F.col("name"), "email": F.col("email"), "phone": F.col("phone")})
    got = [(r[0], r[1]) for r in pairs.select("l.id", "r.id").collect()]
    assert len(got) == len(set(got))  # every pair once
    want = _brute_pairs(recs, [lambda r: r[1], lambda r: r[2], lambda r: r[3]])
    assert set(got) == want
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_null_keys_never_match(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "id int, k string")
    assert match.or_match_pairs(df, {"k": F.col("k")}).count() == 0


def test_lookup_column_paths(spark):
    dic = spark.createDataFrame([("2", "c", "Cuba", 0, 0, "put", "-CUBA-", None),
                                 ("2", "c", "Peru", 0, 0, "put", "", None),
                                 ("1", "c", "Cuba", 0, 0, "put", "-USA-", None)], C.CELL_SCHEMA)
    df = spark.createDataFrame([(1, "\tCuba "), (2, "Peru"), (3, "Chile"), (4, None), (5, "")], "id int, country string")
    for limit in (None, 0, 1000):
        out = lookup_column(df, "country", dic, row_key="2", family="c", broadcast_limit=limit)
        got = dict(rows(out, "id", "country_lookup"))
        assert got == {1: "-CUBA-", 2: "", 3: None, 4: None, 5: None}


def _fold(reqs, start=None):
    cur, accepted = start, []
    for r in sorted(reqs, key=lambda x: (x[3], x[4])):
        if cur == r[1]:
            cur = r[2]
            accepted.append(r)
    return cur, accepted


def test_check_and_put_general_equals_fold(spark):
    import random
    rnd = random.Random(5)
    vals = [None, "a", "b", "c"]
    reqs = [(f"k{rnd.randint(0, 3)}", rnd.choice(vals), rnd.choice(vals[1:]), i, 0) for i in range(200)]
    base_rows = [("k0", "c", "s", 0, 0, "put", "a", None)]
    base = spark.createDataFrame(base_rows, C.CELL_SCHEMA)
    df = spark.createDataFrame(reqs, "k string, exp string, val string, ts long, seq long")
    r = cas.requests(df, row_key="k", family="c", qualifier="s", expected="exp", value="val", ts="ts", seq="seq")
    accepted = cas.check_and_put(base, r)
    state = dict(rows(C.resolve(C.append(base, accepted)), "row_key", "value"))
    want = {}
    for k in sorted({x[0] for x in reqs}):
        cur, _ = _fold([x for x in reqs if x[0] == k], start="a" if k == "k0" else None)
        if cur is not None:
            want[k] = cur
    assert state == want


def test_check_and_put_chunked_equals_fold(spark):
    import random
    rnd = random.Random(11)
    vals = [None, "a", "b", "c"]
    # one very hot cell and a few cold ones, cut into several ordered chunks
    reqs = [("hot" if rnd.random() < 0.8 else f"k{rnd.randint(0, 3)}", rnd.choice(vals), rnd.choice(vals[1:]), i, 0)
            for i in range(600)]
    base = spark.createDataFrame([("hot", "c", "s", 0, 0, "put", "b", None)], C.CELL_SCHEMA)
    df = spark.createDataFrame(reqs, "k string, exp string, val string, ts long, seq long")
    r = cas.requests(df, row_key="k", family="c", qualifier="s", expected="exp", value="val", ts="ts", seq="seq")
    for action in ("put", "delete"):
        chunked = cas.check_and_mutate(base, r, action=action, hot_row_requests=0, num_chunks=7)
        plain = cas.check_and_mutate(base, r, action=action, hot_row_requests=None)
        assert rows(chunked, "row_key", "ts", "kind") == rows(plain, "row_key", "ts", "kind")
    state = dict(rows(C.resolve(C.append(base, cas.check_and_put(base, r, hot_row_requests=0, num_chunks=7))),
                      "row_key", "value"))
    want = {}
    for k in sorted({x[0] for x in reqs}):
        cur, _ = _fold([x for x in reqs if x[0] == k], start="b" if k == "hot" else None)
        if cur is not None:
            want[k] = cur
    assert state == want


def test_check_and_delete_single_path_equals_general(spark):
    base = spark.createDataFrame([("u1", "c", "t", 1, 0, "put", "error", None),
                                  ("u2", "c", "t", 1, 0, "put", "view", None)], C.CELL_SCHEMA)
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "u string")
    r = cas.requests(users, row_key="u", family="c", qualifier="t", expected=F.lit("error"), ts=F.lit(10))
    a = rows(cas.check_and_delete(base, r, scope="row", single_per_row=True), "row_key", "kind")
    b = rows(cas.check_and_delete(base, r, scope="row"), "row_key", "kind")
    assert a == b == [("u1", "delete_row")]


def test_changed_rows(spark):
    prev = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, s string")
    new = spark.createDataFrame([(1, "a"), (2, "c"), (3, None), (4, "d"), (4, "d")], "id int, s string")
    assert rows(setops.changed_rows(new, prev)) == [(2, "c"), (4, "d")]


def test_identical_records_spread_over_blocks(spark):
    """By default a hot key of identical records is shared out evenly, and all its pairs come."""
    df = spark.createDataFrame([("same",)] * 2_500, "k string")
    pairs = match.or_match_pairs(df, {"k": F.col("k")})
    assert pairs.count() == 2_500 ** 2
    members = df.select(F.lit(0).alias("_rule"), F.lit(1).alias("_h"), F.struct("k").alias("rec"), F.lit(2_500).alias("_n"))
    plan = match._grid_pairs(members, 100)._jdf.queryExecution().optimizedPlan().toString()
    assert "_i" in plan and "_j" in plan
    ids = members.withColumn("_id", F.monotonically_increasing_id()).groupBy(F.pmod("_id", F.lit(25)).alias("b")).count()
    sizes = [r["count"] for r in ids.collect()]
    assert len(sizes) == 25 and max(sizes) <= 2 * min(sizes)


def test_sf_tables_readable(spark):
    assert spark.read.parquet(f"{SF_SMALL}/customer.parquet").count() > 0


def _executed_plan(df) -> str:
    df.collect()  # AQE's final plan
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_plan_broadcasts_dictionary_only(spark):
    from tessera import bindings as B
    probe = B.lookup_probe(B.table(spark, SF_SMALL, "customer"))
    out = lookup_column(probe, "segment_probe", B.segment_dictionary(spark, SF_SMALL), row_key="2", family="c")
    plan = _executed_plan(out)
    assert "BroadcastHashJoin" in plan
    # the probe side (the customer scan) reaches the join without a shuffle
    probe_branch = plan.split("BroadcastHashJoin", 1)[1].split("BroadcastExchange", 1)[0]
    assert "Exchange hashpartitioning" not in probe_branch


def test_resolve_plan_has_no_window_or_nested_loop(spark):
    from tessera import bindings as B
    plan = _executed_plan(C.resolve(B.event_puts(spark, SF_SMALL)))
    for bad in ("Window", "NestedLoop", "Cartesian"):
        assert bad not in plan


def test_change_history_window_is_partitioned_by_key(spark):
    from tessera import bindings as B
    from tessera.plans import change_tracking as CT
    ev = B.table(spark, SF_SMALL, "events")
    obs = CT.step_observations(ev, key="user_id", status=F.col("event_type"), ts="ts",
                               step=B.day_step(F.col("ts")), tiebreak="event_id")
    plan = _executed_plan(CT.change_history(obs))
    window_lines = [l for l in plan.split("\n") if "Window [" in l]
    assert window_lines and all("windowspecdefinition(key" in l for l in window_lines)


def test_or_match_by_blocks_equals_brute_force(spark):
    # one email shared by most records: a hot key
    recs = [(i, f"n{i % 9}" if i % 4 else None, "same@x" if i % 5 else f"e{i}", f"p{i % 3}") for i in range(60)]
    df = spark.createDataFrame(recs, "id int, name string, email string, phone string")
    rules = {"name": F.col("name"), "email": F.col("email"), "phone": F.col("phone")}
    pairs = match.or_match_pairs(df, rules, block_rows=5)
    got = [(r[0], r[1]) for r in pairs.select("l.id", "r.id").collect()]
    assert len(got) == len(set(got))
    assert set(got) == _brute_pairs(recs, [lambda r: r[1], lambda r: r[2], lambda r: r[3]])


def test_applications_far_apart_match(spark, tmp):
    from tessera import bindings as B
    # which records agree is a matter of their values, however far apart their keys lie
    spark.createDataFrame([(1, "A", 3, 1250.5, "BUILDING"), (90_000, "B", 3, 1250.25, "BUILDING"), (180_000, "C", 3, 1999.0, "BUILDING")],
                          "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp}/customer.parquet")
    got = rows(match.match_applications(B.applications(spark, tmp)), "matched_name", "matched_address", "matched_phone", "matched_email")
    assert got == [(1, 1, 0, 0)] * 4 + [(1, 1, 1, 1)] * 5


def _names_apart(l, r):
    return {"apart": F.levenshtein(F.concat_ws(" ", l("first"), l("last")), F.concat_ws(" ", r("first"), r("last"))), "l_last": l("last")}


@pytest.mark.parametrize("block_rows", [1_000, 7, None])
@pytest.mark.parametrize("per_task", [2_000_000, 10])
def test_or_match_by_groups_equals_brute_force(spark, monkeypatch, block_rows, per_task):
    # few names, nulls, records that come twice, a hot email and a key that is not the first rule's
    monkeypatch.setattr(match, "PAIRS_PER_TASK", per_task)
    recs = [(i // 2, f"a{i % 3}" if i % 7 else None, f"b{i % 2}" if i % 11 else None, "hot@x" if i % 4 else f"e{i % 9}", f"p{i % 13}" if i % 5 else None)
            for i in range(90)]
    df = spark.createDataFrame(recs, "id int, first string, last string, email string, phone string")
    keys = {"email": lambda r: r[3], "name": lambda r: None if None in r[1:3] else r[1] + r[2], "phone": lambda r: r[4]}
    rules = {"email": F.col("email"), "name": F.concat("first", "last"), "phone": F.col("phone")}
    pairs = match.or_match_pairs(df, rules, block_rows=block_rows, shared=["first", "last"], shared_rules=["name"], once=_names_apart)
    assert pairs.columns == ["l", "r", "apart", "l_last"]
    plain = match.or_match_pairs(df, rules)
    want = sorted(((a, b) for a, b in itertools.product(recs, recs) if any(k(a) is not None and k(a) == k(b) for k in keys.values())), key=repr)
    got = pairs.collect()
    assert sorted(((tuple(r["l"]), tuple(r["r"])) for r in got), key=repr) == want
    assert sorted(((tuple(r["l"]), tuple(r["r"])) for r in plain.collect()), key=repr) == want
    whole = lambda r: " ".join(x for x in r[1:3] if x)
    assert all((r["apart"] == 0) == (whole(r["l"]) == whole(r["r"])) and r["l_last"] == r["l"]["last"] for r in got)


def test_or_match_by_groups_when_all_columns_are_shared(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    pairs = match.or_match_pairs(df, {"k": F.col("k")}, shared=["k"], shared_rules=["k"])
    assert rows(pairs.select("l.k", F.col("r.k").alias("k2"))) == [("a", "a")] * 4 + [("b", "b")]
    assert match.or_match_pairs(df.filter("false"), {"k": F.col("k")}, shared=["k"]).count() == 0


def _joined_rows(df) -> int:
    """Rows that the joins of the plan that ran have made."""
    def made(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return made(node.executedPlan())
        if name.endswith("QueryStage"):
            return made(node.plan())
        below = node.children()
        return (node.metrics().get("numOutputRows").get().value() if "Join" in name else 0) + sum(made(below.apply(i)) for i in range(below.size()))
    df.collect()
    return made(df._jdf.queryExecution().executedPlan())


def test_applications_join_records_with_groups_of_a_name(spark):
    # 200 records of one email and two names: the names are compared once per record and name, not once per pair
    apps = spark.createDataFrame([(i, "Ann", f"Lee{i % 2}", "same@x", f"p{i}", f"s{i}") for i in range(200)],
                                 "app_id int, first_name string, last_name string, email string, phone string, address string")
    out = match.match_applications(apps)
    # the email's two groups and the name's one, of which the email's own name falls out, and phone and address
    assert _joined_rows(out) <= 5 * 200
    assert [tuple(r) for r in out.groupBy("matched_name", "matched_email", "matched_phone", "name_distance").count()
            .orderBy("matched_name", "matched_phone").collect()] == [(0, 1, 0, 1, 20_000), (1, 1, 0, 0, 19_800), (1, 1, 1, 0, 200)]


def test_applications_of_a_crowded_key(spark):
    # more than a block's records share one email; names null on one side give no distance
    apps = spark.range(1_500).select(
        F.col("id").alias("app_id"), F.lit("Ann").alias("first_name"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("L"), F.col("id") % 3)).alias("last_name"),
        F.lit("same@x").alias("email"), F.lit(None).cast("string").alias("phone"), F.lit(None).cast("string").alias("address"))
    got = match.match_applications(apps).groupBy("name", "name2", "matched_name", "name_distance").count().collect()
    names = [None, "AnnL1", "AnnL2"]
    assert sorted(map(repr, map(tuple, got))) == sorted(
        repr((a, b, int(a is not None and a == b), None if None in (a, b) else int(a != b), 250_000)) for a in names for b in names)
