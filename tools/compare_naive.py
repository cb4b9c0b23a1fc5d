"""Time four rewritten operators against their naive forms at one scale factor.

    python tools/compare_naive.py /root/testdata/sf0.1

* match:  exploded-key equi join      vs  the OR join as written (nested loop)
* lookup: size-checked broadcast join vs  a per-row Python UDF over a dict
* index:  range + checkpoint + narrow vs  row_number() over one unpartitioned window
* resolve (puts): per-cell aggregate  vs  row_number() over (partition by cell) = 1

Prints one JSON line: {"sf_dir": ..., "pairs": {op: {"rewritten": s, "naive": s}}}.
The naive forms exist only here, for comparison.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tessera import bindings as B  # noqa: E402
from tessera.catalog import QUERIES  # noqa: E402
from tessera.functions.scalar import jvm_trim  # noqa: E402
from tessera.operators import cells as C  # noqa: E402
from tessera.session import local_session  # noqa: E402


def run(df) -> float:
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def best(make, n=3) -> float:
    return round(min(run(make()) for _ in range(n)), 3)


def main():
    d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8, 16, app="tessera-naive")
    spark.sparkContext.setLogLevel("ERROR")
    out = {}

    # D1 -------------------------------------------------------------- OR join
    def naive_match():
        apps = B.applications(spark, d)
        a, b = apps.alias("a1"), apps.alias("a2")
        name = lambda t: F.concat(F.col(f"{t}.first_name"), F.col(f"{t}.last_name"))
        cond = ((name("a1") == name("a2")) | (F.col("a1.email") == F.col("a2.email"))
                | (F.col("a1.phone") == F.col("a2.phone")) | (F.col("a1.address") == F.col("a2.address")))
        return a.join(b, cond).select("a1.app_id", "a2.app_id")
    out["match"] = {"rewritten": best(lambda: QUERIES["match_self_join"](spark, d)),
                    "naive": best(naive_match)}

    # D2 -------------------------------------------------------------- lookup
    def naive_lookup():
        dic = {r["qualifier"]: r["value"] for r in
               C.resolve(B.segment_dictionary(spark, d)).filter("row_key = '2'").collect()}
        bdic = spark.sparkContext.broadcast(dic)

        @F.udf("string")
        def get(v):
            return None if v is None or not v.strip() else bdic.value.get(v.strip())
        probe = B.lookup_probe(B.table(spark, d, "customer"))
        return probe.withColumn("segment_probe_lookup", get("segment_probe"))
    out["lookup"] = {"rewritten": best(lambda: QUERIES["lookup_column"](spark, d)),
                     "naive": best(naive_lookup)}

    # D2 at lineitem size: the dictionary maps return flags, the probe is every line item
    # the dictionary is a stored cell table, as in use
    from tessera.session import scratch_path
    dict_path = scratch_path(spark, "flag-dictionary")
    flags = B.table(spark, d, "lineitem").select("l_returnflag").distinct()
    C.write_cells(C.mutations(flags, row_key=F.lit("1"), family="c", qualifier=F.col("l_returnflag"),
                              value=F.concat(F.lit("-"), F.col("l_returnflag"), F.lit("-"))), dict_path)

    def flag_dictionary():
        return C.read_cells(spark, dict_path)

    def our_lookup_li():
        from tessera.operators.lookup import lookup_column
        li = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
        return lookup_column(li, "l_returnflag", flag_dictionary(), row_key="1", family="c")

    def naive_lookup_li():
        dic = {r["qualifier"]: r["value"] for r in C.resolve(flag_dictionary()).collect()}
        bdic = spark.sparkContext.broadcast(dic)

        @F.udf("string")
        def get(v):
            return None if v is None or not v.strip() else bdic.value.get(v.strip())
        li = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
        return li.withColumn("l_returnflag_lookup", get("l_returnflag"))
    out["lookup_lineitem"] = {"rewritten": best(our_lookup_li), "naive": best(naive_lookup_li)}

    # P3 -------------------------------------------------------------- row index
    def naive_index():
        o = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
        return o.withColumn("row_num", F.row_number().over(Window.orderBy("l_orderkey", "l_linenumber")))

    def our_index():
        from tessera.operators.index import row_index
        o = B.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
        return row_index(o, ["l_orderkey", "l_linenumber"])
    out["row_index_lineitem"] = {"rewritten": best(our_index), "naive": best(naive_index)}

    # M1 -------------------------------------------------------------- latest put
    def puts():
        li = B.table(spark, d, "lineitem")
        return C.mutations(li, row_key="l_suppkey", family="c", qualifier=F.col("l_returnflag"),
                           value="l_extendedprice", ts=F.col("l_orderkey"), seq=F.col("l_linenumber"))

    def naive_resolve():
        w = Window.partitionBy("row_key", "family", "qualifier").orderBy(F.col("ts").desc(), F.col("seq").desc())
        return puts().withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
    out["resolve_puts_lineitem"] = {"rewritten": best(lambda: C.resolve(puts())), "naive": best(naive_resolve)}

    print(json.dumps({"sf_dir": d, "pairs": out}))
    spark.stop()


if __name__ == "__main__":
    main()
