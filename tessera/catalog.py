"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query takes ``(spark, sf_dir)``, reads the tables of that folder (or
data Spark derives from them) and returns a DataFrame. The oracle is SQL over
the same tables registered as views. Sinks and streams write under the shared
checkpoint folder and return a DataFrame that reads what was written.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera import bindings as B
from tessera.functions import scalar as S
from tessera.operators import cas
from tessera.operators import cells as C
from tessera.operators import clean, index, match, partitions, setops
from tessera.operators.convert import df_to_cells, put_dataframe
from tessera.operators.lookup import lookup_column
from tessera.session import scratch_path, unique_name
from tessera.sinks import tables as K
from tessera.sources import files as SF
from tessera.sources import sql as SQ

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def T(spark: SparkSession, d: str, name: str) -> DataFrame:
    return B.table(spark, d, name)


# ------------------------------------------------------------------ SQL helpers

def duck_java_hash(expr: str) -> str:
    """DuckDB text of ``String.hashCode`` (UTF-16 units, 32-bit, signed)."""
    units = (f"flatten(list_transform(string_split({expr}, ''), lambda ch: CASE WHEN unicode(ch) > 65535 "
             f"THEN [55296 + ((unicode(ch) - 65536) // 1024), 56320 + ((unicode(ch) - 65536) % 1024)] "
             f"ELSE [unicode(ch)] END))")
    h = f"list_reduce(list_prepend(0::BIGINT, {units}), lambda a, x: (a * 31 + x) % 4294967296)"
    return f"(CASE WHEN {h} >= 2147483648 THEN {h} - 4294967296 ELSE {h} END)"


def duck_salted(expr: str, n: int) -> str:
    salt = f"CAST(abs({duck_java_hash(expr)} % {n}) AS VARCHAR)"
    return f"(CASE WHEN length({salt}) >= 4 THEN {salt} ELSE lpad({salt}, 4, '0') END || ':' || {expr})"


def customer_unpivot_sql(key: str = "CAST(c_custkey AS VARCHAR)", where: str = "") -> str:
    w = f" WHERE {where}" if where else ""
    parts = [
        f"SELECT {key} AS row_key, 'c' AS family, 'c_name' AS qualifier, c_name AS value FROM customer{w}",
        f"SELECT {key}, 'c', 'c_nationkey', CAST(c_nationkey AS VARCHAR) FROM customer{w}",
        f"SELECT {key}, 'c', 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM customer{w}",
        f"SELECT {key}, 'c', 'c_mktsegment', c_mktsegment FROM customer{w}",
    ]
    return "\nUNION ALL\n".join(parts)


CUSTOMER_CELLS_CTE = f"cc AS ({customer_unpivot_sql()})"

# ================================================================== sources

@register("scan_csv_header", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_header(spark, d):
    path = scratch_path(spark, "csv-header")
    K.write_csv(T(spark, d, "customer"), path, header=True)
    df = SF.read_csv_header(spark, path)
    return df.select(F.col("c_custkey").cast("bigint"), "c_name", F.col("c_nationkey").cast("int"),
                     F.col("c_acctbal").cast("double"), "c_mktsegment")


@register("scan_csv_schema", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey
FROM customer""")
def scan_csv_schema(spark, d):
    path = scratch_path(spark, "csv-pipe")
    K.write_csv(T(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), path, delimiter="|", header=False)
    return SF.read_csv_schema(spark, path, columns="c_custkey,c_name,c_nationkey", delimiter="|")


@register("scan_parquet", "SELECT * FROM orders")
def scan_parquet(spark, d):
    return SF.read_parquet(spark, f"{d}/orders.parquet")


@register("scan_json", "SELECT * FROM events")
def scan_json(spark, d):
    ev = T(spark, d, "events")
    path = scratch_path(spark, "json")
    K.write_json(ev, path)
    return SF.read_json(spark, path, schema=ev.schema)


@register("scan_multi_path", "SELECT * FROM orders")
def scan_multi_path(spark, d):
    orders = T(spark, d, "orders")
    root = scratch_path(spark, "multi")
    is_f = F.coalesce(F.col("o_orderstatus") == "F", F.lit(False))
    orders.filter(is_f).write.parquet(f"{root}/part_f")
    orders.filter(~is_f).write.parquet(f"{root}/part_rest")
    return SF.read_multi_path(spark, "parquet", [f"{root}/part_f", f"{root}/missing", f"{root}/part_rest"])


SOURCE_SQL = """
SELECT c.c_mktsegment, o.o_orderstatus, count(*) AS n_orders,
       CAST(sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey
GROUP BY c.c_mktsegment, o.o_orderstatus"""


def _views(spark, d, *names) -> dict[str, str]:
    out = {}
    for n in names:
        v = unique_name(n)
        T(spark, d, n).createOrReplaceTempView(v)
        out[n] = v
    return out


@register("source_sql", SOURCE_SQL.format(orders="orders", customer="customer"))
def source_sql(spark, d):
    return SQ.run_sql(spark, SOURCE_SQL.format(**_views(spark, d, "orders", "customer")))


NAMED_QUERIES = {
    "orders_since": """
SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price
FROM {orders} WHERE o_orderdate >= :start GROUP BY o_orderstatus""",
}


@register("source_named_query", """
SELECT o_orderstatus, count(*) AS n_orders, max(o_totalprice) AS max_price
FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' GROUP BY o_orderstatus""")
def source_named_query(spark, d):
    v = _views(spark, d, "orders")
    queries = {k: q.format(**v) for k, q in NAMED_QUERIES.items()}
    return SQ.named_query(spark, queries, "orders_since",
                          args={"start": datetime.date(1997, 1, 1)})  # a DATE: no time zone involved


@register("source_dispatch", """
SELECT 'sql' AS kind, c_custkey, c_name, c_nationkey FROM customer
UNION ALL SELECT 'csv', c_custkey, c_name, c_nationkey FROM customer
UNION ALL SELECT 'parquet', c_custkey, c_name, c_nationkey FROM customer""")
def source_dispatch(spark, d):
    v = _views(spark, d, "customer")
    csv_path = scratch_path(spark, "dispatch-csv")
    K.write_csv(T(spark, d, "customer"), csv_path, header=True)
    parts = [
        ("sql", SQ.load(spark, f"SELECT c_custkey, c_name, c_nationkey FROM {v['customer']}", "sql")),
        ("csv", SQ.load(spark, csv_path, "csv")),
        ("parquet", SQ.load(spark, f"{d}/customer.parquet", "parquet")),
    ]
    out = None
    for kind, df in parts:
        df = df.select(F.lit(kind).alias("kind"), F.col("c_custkey").cast("bigint"), "c_name",
                       F.col("c_nationkey").cast("int"))
        out = df if out is None else out.unionByName(df)
    return out


# ================================================================== sinks

@register("sink_csv", "SELECT * FROM supplier")
def sink_csv(spark, d):
    sup = T(spark, d, "supplier")
    path = scratch_path(spark, "sink-csv")
    K.write_csv(sup, path, delimiter="|", header=True)
    return SF.read_csv_header(spark, path, schema=sup.schema, delimiter="|")


@register("sink_file_append", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_file_append(spark, d):
    orders = T(spark, d, "orders")
    path = scratch_path(spark, "append")
    K.write_files(orders, path, mode="overwrite")
    K.write_files(orders, path, mode="append")
    return spark.read.parquet(path)


@register("sink_file_partitioned", "SELECT * FROM orders")
def sink_file_partitioned(spark, d):
    path = scratch_path(spark, "partitioned")
    K.write_files(T(spark, d, "orders"), path, partition_by="o_orderstatus")
    return spark.read.parquet(path)


@register("sink_managed_table", "SELECT * FROM orders")
def sink_managed_table(spark, d):
    name = unique_name("orders_managed")
    K.save_table(T(spark, d, "orders"), name)
    return spark.table(name)


def _empty_table_like(spark, df: DataFrame, name: str, partition_by: str | None = None) -> None:
    w = df.limit(0).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.saveAsTable(name)


@register("sink_insert_into", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def sink_insert_into(spark, d):
    orders = T(spark, d, "orders")
    name = unique_name("orders_ins")
    _empty_table_like(spark, orders, name)
    K.insert_into(spark, orders, name)
    K.insert_into(spark, orders.select(*reversed(orders.columns)), name)  # reordered: aligned by name first
    return spark.table(name)


@register("sink_insert_overwrite", "SELECT * FROM orders")
def sink_insert_overwrite(spark, d):
    orders = T(spark, d, "orders")
    name = unique_name("orders_ovw")
    _empty_table_like(spark, orders, name)
    K.insert_into(spark, orders, name)
    K.insert_into(spark, orders, name, overwrite=True)
    return spark.table(name)


@register("sink_dynamic_partition", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
       CASE WHEN o_orderstatus = 'F' THEN 'REWRITTEN' ELSE o_orderpriority END AS o_orderpriority
FROM orders""")
def sink_dynamic_partition(spark, d):
    orders = T(spark, d, "orders")
    name = unique_name("orders_dyn")
    K.save_table(orders, name, partition_by="o_orderstatus")
    rewritten = orders.filter(F.col("o_orderstatus") == "F").withColumn("o_orderpriority", F.lit("REWRITTEN"))
    K.insert_into(spark, rewritten, name, overwrite=True, partition_by="o_orderstatus")
    return spark.table(name)


@register("sink_external_table", "SELECT * FROM orders")
def sink_external_table(spark, d):
    path = scratch_path(spark, "external")
    K.write_files(T(spark, d, "orders"), path)
    name = unique_name("orders_ext")
    K.create_external_table(spark, name, path)
    return spark.table(name)


@register("temp_view", """
SELECT c_mktsegment, count(*) AS n_customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY c_mktsegment""")
def temp_view(spark, d):
    view = K.temp_view(T(spark, d, "customer"), f"db.{unique_name('cust')}")
    return spark.sql(f"""
        SELECT c_mktsegment, count(*) AS n_customers,
               CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
        FROM {view} GROUP BY c_mktsegment""")


@register("cell_put_dataframe", customer_unpivot_sql(key=duck_salted("CAST(c_custkey AS VARCHAR)", 6)))
def cell_put_dataframe(spark, d):
    cells = put_dataframe(C.empty_cells(spark), T(spark, d, "customer"), family="c", num_salts=6)
    return C.resolve(cells).select("row_key", "family", "qualifier", "value")


# ================================================================== cleaning, index

DOC_TAG_SQL = "CASE WHEN lang = 'fr' THEN ' null ' WHEN lang = 'de' THEN NULL ELSE source END"


@register("clean_null_rows", f"""
SELECT doc_id, lang, source, n_chars, tag FROM (
  SELECT doc_id, lang, source, n_chars, {DOC_TAG_SQL} AS tag FROM documents)
WHERE trim(lang) <> 'null' AND trim(tag) <> 'null'""")
def clean_null_rows(spark, d):
    docs = T(spark, d, "documents")
    tag = (F.when(F.col("lang") == "fr", F.lit(" null ")).when(F.col("lang") == "de", F.lit(None))
           .otherwise(F.col("source")))
    df = docs.select("doc_id", "lang", "source", "n_chars", tag.alias("tag"))
    return clean.clean_null_rows(df, "lang,tag")


@register("clean_defaults", """
SELECT c_custkey, c_mktsegment, COALESCE(CAST(o_orderkey AS DOUBLE), 0.0) AS o_orderkey,
       COALESCE(o_totalprice, 0.0) AS o_totalprice, COALESCE(o_orderstatus, '0.0') AS o_orderstatus
FROM customer LEFT JOIN orders ON c_custkey = o_custkey""")
def clean_defaults(spark, d):
    c, o = T(spark, d, "customer"), T(spark, d, "orders")
    df = c.join(o, c.c_custkey == o.o_custkey, "left").select(
        "c_custkey", "c_mktsegment", "o_orderkey", "o_totalprice", "o_orderstatus")
    return clean.clean_defaults(df, ["o_orderkey", "o_totalprice", "o_orderstatus"])


@register("row_index_dense", """
SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS row_num, o_orderkey, o_custkey, o_totalprice
FROM orders""")
def row_index_dense(spark, d):
    df = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return index.row_index(df, "o_orderkey")


@register("row_index_window", """
SELECT c_custkey, c_name, c_nationkey, CAST(99 + row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS row_num
FROM customer""")
def row_index_window(spark, d):
    return index.row_index_by_window(T(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey", offset=100)


# ================================================================== scalar functions

@register("salted_row_key", f"""
SELECT c_custkey, {duck_salted('c_name', 6)} AS row_key FROM customer""")
def salted_row_key(spark, d):
    return T(spark, d, "customer").select("c_custkey", S.salted_row_key("c_name", 6).alias("row_key"))


@register("fn_java_hash", f"""
SELECT c_custkey, CAST({duck_java_hash('c_name')} AS INTEGER) AS name_hash,
       CAST({duck_java_hash('c_mktsegment')} AS INTEGER) AS segment_hash FROM customer""")
def fn_java_hash(spark, d):
    return T(spark, d, "customer").select("c_custkey", S.java_string_hash("c_name").alias("name_hash"),
                                          S.java_string_hash("c_mktsegment").alias("segment_hash"))


@register("history_key", """
SELECT event_id, CAST(user_id AS VARCHAR) || ':' || strftime(ts, '%Y%m%d%H%M%S') AS id_ts FROM events""")
def history_key(spark, d):
    return T(spark, d, "events").select("event_id", S.history_key("user_id", "ts").alias("id_ts"))


@register("fn_levenshtein", """
SELECT c_custkey, CAST(levenshtein(c_mktsegment, n_name) AS INTEGER) AS distance
FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def fn_levenshtein(spark, d):
    c, n = T(spark, d, "customer"), T(spark, d, "nation")
    return c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey", S.levenshtein("c_mktsegment", "n_name").alias("distance"))


@register("fn_trim", r"""
SELECT c_custkey, regexp_replace(chr(9) || c_name || '  ' || chr(10), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g') AS trimmed,
       trim(chr(9) || c_name || '  ') AS space_trimmed
FROM customer""")
def fn_trim(spark, d):
    padded = F.concat(F.lit("\t"), F.col("c_name"), F.lit("  "), F.lit("\n"))
    return T(spark, d, "customer").select(
        "c_custkey", S.jvm_trim(padded).alias("trimmed"),
        F.trim(F.concat(F.lit("\t"), F.col("c_name"), F.lit("  "))).alias("space_trimmed"))


@register("fn_parse_date", """
SELECT o_orderkey, strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS order_day FROM orders""")
def fn_parse_date(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", S.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd"), "yyyy-MM-dd")
                    .alias("order_day"))


@register("fn_ts_to_int", """
SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS month_int FROM orders""")
def fn_ts_to_int(spark, d):
    return T(spark, d, "orders").select("o_orderkey", S.ts_to_int("o_orderdate", S.MONTH_INT_PATTERN)
                                        .alias("month_int"))


@register("fn_equals_ignore_case", """
SELECT c_custkey, COALESCE(lower(c_mktsegment) = 'building', false) AS is_building FROM customer""")
def fn_equals_ignore_case(spark, d):
    return T(spark, d, "customer").select(
        "c_custkey", S.equals_ignore_case(F.col("c_mktsegment"), F.lit("building")).alias("is_building"))


@register("project_chain", """
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment AS segment,
       CAST(floor(c_acctbal / 1000) AS BIGINT) AS balance_k FROM customer""")
def project_chain(spark, d):
    return (T(spark, d, "customer")
            .withColumn("balance_k", F.floor(F.col("c_acctbal") / 1000).cast("bigint"))
            .drop("c_name")
            .withColumnRenamed("c_mktsegment", "segment"))


@register("limit_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def limit_rows(spark, d):
    # a top-k report: the limit is the feature
    return T(spark, d, "orders").orderBy("o_orderkey").limit(10)


# ================================================================== set operations

@register("changed_rows", """
SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer
EXCEPT
SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0""")
def changed_rows(spark, d):
    c = T(spark, d, "customer")
    previous = c.filter(F.col("c_acctbal") >= 0).select("c_custkey", "c_mktsegment")
    updated = c.select("c_custkey", F.when(F.col("c_nationkey") == 3, F.lit("CHANGED"))
                       .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return setops.changed_rows(updated, previous)


@register("union_all", """
SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier""")
def union_all(spark, d):
    return setops.union_all(T(spark, d, "customer").select("c_custkey", "c_name"),
                            T(spark, d, "supplier").select("s_suppkey", "s_name"))


# ================================================================== cells

@register("df_to_cells", customer_unpivot_sql())
def df_to_cells_q(spark, d):
    return B.customer_cells(spark, d).select("row_key", "family", "qualifier", "value")


@register("df_to_cells_map", """
SELECT CAST(event_id AS VARCHAR) AS row_key, 'user_id' AS qualifier, CAST(user_id AS VARCHAR) AS value FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 'type', event_type FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), 'props', COALESCE(props, '') FROM events""")
def df_to_cells_map(spark, d):
    ev = T(spark, d, "events")
    df = ev.select("event_id", "user_id",
                   F.create_map(F.lit("type"), F.col("event_type"), F.lit("props"), F.col("props")).alias("m"))
    return df_to_cells(df, family="c").select("row_key", "qualifier", "value")


@register("cell_scan_map", f"""
WITH {CUSTOMER_CELLS_CTE}
SELECT row_key, qualifier, upper(value) AS value_upper FROM cc WHERE row_key >= '1' AND row_key < '5'""")
def cell_scan_map(spark, d):
    return C.scan_map(B.stored(B.customer_cells(spark, d), "customer-cells"),
                      [F.col("row_key"), F.col("qualifier"), F.upper("value").alias("value_upper")],
                      start_row="1", stop_row="5")


@register("cell_scan_rows", f"""
WITH {CUSTOMER_CELLS_CTE}
SELECT row_key, count(*) AS n_cells, string_agg(qualifier || '=' || value, ',' ORDER BY qualifier) AS joined
FROM cc GROUP BY row_key""")
def cell_scan_rows(spark, d):
    rows = C.scan_rows(B.stored(B.customer_cells(spark, d), "customer-cells"))
    return rows.select("row_key", F.size("cells").cast("bigint").alias("n_cells"),
                       F.array_join(F.transform("cells", lambda c: F.concat(c["qualifier"], F.lit("="), c["value"])),
                                    ",").alias("joined"))


@register("cell_scan_ranges", f"""
WITH {CUSTOMER_CELLS_CTE}
SELECT CASE WHEN row_key >= '9' THEN 3 WHEN row_key >= '6' THEN 2 WHEN row_key >= '3' THEN 1 ELSE 0 END AS range_id,
       count(*) AS n_cells, count(DISTINCT row_key) AS n_rows
FROM cc GROUP BY 1""")
def cell_scan_ranges(spark, d):
    tagged = C.scan_ranges(B.stored(B.customer_cells(spark, d), "customer-cells"), ["3", "6", "9"])
    return tagged.groupBy("range_id").agg(F.count("*").alias("n_cells"),
                                          F.countDistinct("row_key").alias("n_rows"))


CUSTOMER_WIDE_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment FROM customer"""


@register("cell_scan_wide", CUSTOMER_WIDE_SQL)
def cell_scan_wide(spark, d):
    return C.scan_wide(B.stored(B.customer_cells(spark, d), "customer-cells"), key_name="c_custkey", qualifiers=B.CUSTOMER_QUALIFIERS)


@register("cell_bulk_get", f"""
WITH {CUSTOMER_CELLS_CTE}
SELECT o_orderkey, row_key, qualifier, value FROM orders JOIN cc ON CAST(o_custkey AS VARCHAR) = row_key""")
def cell_bulk_get(spark, d):
    keys = T(spark, d, "orders").select("o_orderkey", "o_custkey")
    return C.bulk_get(B.stored(B.customer_cells(spark, d), "customer-cells"), keys, "o_custkey").select(
        "o_orderkey", "row_key", "qualifier", "value")


@register("cell_bulk_get_wide", """
SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment
FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def cell_bulk_get_wide(spark, d):
    keys = T(spark, d, "orders").select("o_custkey")
    return C.bulk_get_wide(B.stored(B.customer_cells(spark, d), "customer-cells"), keys, "o_custkey", qualifiers=B.CUSTOMER_QUALIFIERS)


@register("cell_point_get", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'c_mktsegment' ELSE ' c_name' END AS q,
       CASE WHEN o_orderstatus = 'F' THEN c_mktsegment ELSE c_name END AS value
FROM orders LEFT JOIN customer ON c_custkey = o_custkey""")
def cell_point_get(spark, d):
    qualifier = F.when(F.col("o_orderstatus") == "F", F.lit("c_mktsegment")).otherwise(F.lit(" c_name"))
    req = T(spark, d, "orders").select("o_orderkey", "o_custkey", qualifier.alias("q"))
    cells = B.stored(B.customer_cells(spark, d), "customer-cells")
    return C.point_get(cells, req, row_col="o_custkey", family="c", qualifier_col="q").select("o_orderkey", "q", "value")


@register("cell_get_columns", """
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN 'c_mktsegment' END AS qualifier, c_mktsegment AS value
FROM orders LEFT JOIN customer ON c_custkey = o_custkey + (o_orderkey % 2) * 1000000000
WHERE o_orderkey % 2 = 1 OR o_orderstatus = 'F'
UNION ALL
SELECT o_orderkey, q.qualifier, CASE q.qualifier WHEN 'c_name' THEN c_name WHEN 'c_nationkey' THEN CAST(c_nationkey AS VARCHAR)
    WHEN 'c_acctbal' THEN CAST(c_acctbal AS VARCHAR) ELSE c_mktsegment END
FROM orders JOIN customer ON c_custkey = o_custkey, (VALUES ('c_name'), ('c_nationkey'), ('c_acctbal'), ('c_mktsegment')) q(qualifier)
WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'F'""")
def cell_get_columns(spark, d):
    """Each request names the columns it wants, or none for the whole row; half of the keys are absent and keep their request."""
    one = F.array(F.struct(F.lit("c").alias("family"), F.lit("c_mktsegment").alias("qualifier")))
    wants = F.when((F.col("o_orderstatus") == "F") | (F.col("o_orderkey") % 2 == 1), one)
    key = F.col("o_custkey") + (F.col("o_orderkey") % 2) * 1_000_000_000
    req = T(spark, d, "orders").select("o_orderkey", key.alias("k"), wants.alias("wants"))
    cells = B.stored(B.customer_cells(spark, d), "customer-cells")
    return C.bulk_get(cells, req, "k", columns="wants", keep_absent=True).select("o_orderkey", "qualifier", "value")


@register("cell_latest_value", """
SELECT CAST(user_id AS VARCHAR) AS row_key, arg_max(event_type, ts) AS value FROM events GROUP BY user_id""")
def cell_latest_value(spark, d):
    puts = B.event_puts(spark, d, qualifier=F.lit("last_type"), value="event_type")
    return C.latest_value(B.stored(puts, "event-cells"), family="c", qualifier="last_type")


# ================================================================== mutations

@register("cell_put", """
SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier, CAST(arg_max(value, ts) AS VARCHAR) AS value
FROM events GROUP BY user_id, event_type""")
def cell_put(spark, d):
    ev = T(spark, d, "events")
    cells = C.put(C.empty_cells(spark), ev, row_key="user_id", family="c", qualifier=F.col("event_type"),
                  value="value", **B.event_version(ev))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_put_twice", """
SELECT CAST(o_orderkey AS VARCHAR) AS row_key, o_orderpriority AS value FROM orders""")
def cell_put_twice(spark, d):
    orders = T(spark, d, "orders")
    cell = {"row_key": "o_orderkey", "family": "c", "qualifier": "v"}
    cells = C.put(C.empty_cells(spark), orders, value="o_orderstatus", **cell)
    cells = C.put(cells, orders, value="o_orderpriority", **cell)  # wins as the later call, though less as text
    return C.resolve(cells).select("row_key", "value")


@register("cell_delete_then_put", """
SELECT CAST(o_orderkey AS VARCHAR) AS row_key, CASE WHEN o_orderstatus = 'F' THEN 'again' ELSE o_orderpriority END AS value
FROM orders WHERE o_orderstatus <> 'F' OR o_totalprice > 200000""")
def cell_delete_then_put(spark, d):
    orders = T(spark, d, "orders")
    cell = {"row_key": "o_orderkey", "family": "c", "qualifier": "v"}
    cells = C.put(C.empty_cells(spark), orders, value="o_orderpriority", **cell)
    done = orders.filter(F.col("o_orderstatus") == "F")
    cells = C.delete(cells, done, row_key="o_orderkey")
    cells = C.put(cells, done.filter(F.col("o_totalprice") > 200000), value=F.lit("again"), **cell)
    return C.resolve(cells).select("row_key", "value")


@register("cell_compaction_late", """
SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier, CAST(arg_max(value, struct_pack(t := ts, e := event_id)) AS VARCHAR) AS value
FROM events GROUP BY user_id, event_type""")
def cell_compaction_late(spark, d):
    ev = T(spark, d, "events")
    puts = C.mutations(ev, row_key="user_id", family="c", qualifier=F.col("event_type"), value="value",
                       **B.event_version(ev))
    path, base = scratch_path(spark, "late-log"), scratch_path(spark, "late-base")
    late = F.col("seq") % 2 == 0  # half of all puts, of all versions, arrive after the compaction
    C.write_cells(puts.filter(~late), path)
    covered = C.compact_to(C.read_cells(spark, path), base)
    C.write_cells(puts.filter(late), path)
    cells = C.read_compacted(spark, base, C.read_cells(spark, path), covered)
    return C.resolve(cells).select("row_key", "qualifier", "value")


def _funnel_case(col: str) -> str:
    whens = " ".join(f"WHEN {col} = '{new}' THEN {'NULL' if exp is None else repr(exp)}"
                     for new, exp in B.FUNNEL_EXPECTS)
    return f"CASE {whens} ELSE NULL END"


CHECK_AND_PUT_SQL = f"""
WITH RECURSIVE ev AS (
  SELECT user_id, event_type AS new_v, CAST({_funnel_case('event_type')} AS VARCHAR) AS exp,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
fold(user_id, rn, status) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR) FROM ev
  UNION ALL
  SELECT f.user_id, e.rn,
         CASE WHEN (f.status IS NULL AND e.exp IS NULL) OR f.status = e.exp THEN e.new_v ELSE f.status END
  FROM fold f JOIN ev e ON e.user_id = f.user_id AND e.rn = f.rn + 1),
last AS (SELECT user_id, max(rn) AS rn FROM ev GROUP BY user_id)
SELECT CAST(f.user_id AS VARCHAR) AS row_key, f.status AS value
FROM fold f JOIN last l ON f.user_id = l.user_id AND f.rn = l.rn
WHERE f.status IS NOT NULL"""


def _funnel_requests(ev: DataFrame) -> DataFrame:
    return cas.requests(ev, row_key="user_id", family="c", qualifier="status",
                        expected=B.funnel_expected(F.col("event_type")), value="event_type",
                        **B.event_version(ev))


@register("cell_check_and_put", CHECK_AND_PUT_SQL)
def cell_check_and_put(spark, d):
    ev = T(spark, d, "events")
    base = C.empty_cells(spark)
    accepted = cas.check_and_put(base, _funnel_requests(ev))
    return C.resolve(C.append(base, accepted)).select("row_key", "value")


def _seeded_sql(start: str, then: str, out: str) -> str:
    """The fold of the events of each user from a start status; ``then`` is what an accepted event leaves."""
    ok = "((f.status IS NULL AND e.exp IS NULL) OR f.status = e.exp)"
    return f"""
WITH RECURSIVE ev AS (
  SELECT user_id, event_type AS new_v, CAST({_funnel_case('event_type')} AS VARCHAR) AS exp, CAST(event_id AS VARCHAR) AS id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM events),
fold(user_id, rn, status, last_event) AS (
  SELECT DISTINCT user_id, CAST(0 AS BIGINT), CAST({start} AS VARCHAR), CAST(CASE WHEN {start} IS NOT NULL THEN 'base' END AS VARCHAR) FROM ev
  UNION ALL
  SELECT f.user_id, e.rn, CASE WHEN {ok} THEN {then.format('e.new_v')} ELSE f.status END, CASE WHEN {ok} THEN {then.format('e.id')} ELSE f.last_event END
  FROM fold f JOIN ev e ON e.user_id = f.user_id AND e.rn = f.rn + 1),
last AS (SELECT user_id, max(rn) AS rn FROM ev GROUP BY user_id),
done AS (SELECT CAST(f.user_id AS VARCHAR) AS row_key, f.status, f.last_event FROM fold f JOIN last l ON f.user_id = l.user_id AND f.rn = l.rn)
{out}"""


_START = "CASE user_id % 3 WHEN 0 THEN 'signup' WHEN 1 THEN 'view' END"
_TWO_CELLS = """SELECT row_key, 'status' AS qualifier, status AS value FROM done WHERE status IS NOT NULL
UNION ALL SELECT row_key, 'last_event', last_event FROM done WHERE last_event IS NOT NULL"""


def _seeded_users(ev: DataFrame) -> DataFrame:
    """Two cells for two thirds of the users, older than every event."""
    users = ev.select("user_id").distinct()
    status = F.when(F.col("user_id") % 3 == 0, "signup").when(F.col("user_id") % 3 == 1, "view")
    known = users.withColumn("status", status).filter("status IS NOT NULL")
    cell = lambda family, qualifier, value: C.mutations(known, row_key="user_id", family=family, qualifier=qualifier, value=value, ts=0)
    return C.append(cell("c", "status", "status"), cell("d", "last_event", F.lit("base")))


def _two_cell_requests(ev: DataFrame, deletes: bool) -> DataFrame:
    """Requests on the status that write another family's cell as well, or delete the whole row after an error."""
    puts = F.array(cas.mutation(C.PUT, family="c", qualifier="status", value=F.col("event_type")),
                   cas.mutation(C.PUT, family="d", qualifier="last_event", value=F.col("event_id")))
    gone = F.array(cas.mutation(C.DELETE_ROW))
    then = F.when(F.col("event_type") == "error", gone).otherwise(puts) if deletes else puts
    return cas.requests(ev, row_key="user_id", family="c", qualifier="status", expected=B.funnel_expected(F.col("event_type")), then=then,
                        **B.event_version(ev))


@register("cell_check_and_put_seeded", _seeded_sql(_START, "{}", "SELECT row_key, status AS value FROM done WHERE status IS NOT NULL"))
def cell_check_and_put_seeded(spark, d):
    ev = T(spark, d, "events")
    base = _seeded_users(ev)
    cells = C.append(base, cas.check_and_put(base, _funnel_requests(ev)))
    return C.scan(cells, families=["c"]).select("row_key", "value")


@register("cell_check_and_put_other", _seeded_sql(_START, "{}", _TWO_CELLS))
def cell_check_and_put_other(spark, d):
    ev = T(spark, d, "events")
    base = _seeded_users(ev)
    cells = C.append(base, cas.check_and_mutate(base, _two_cell_requests(ev, deletes=False)))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_check_and_delete_row_seq", _seeded_sql(_START, "CASE WHEN e.new_v = 'error' THEN NULL ELSE {} END", _TWO_CELLS))
def cell_check_and_delete_row_seq(spark, d):
    ev = T(spark, d, "events")
    base = _seeded_users(ev)
    cells = C.append(base, cas.check_and_mutate(base, _two_cell_requests(ev, deletes=True)))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_increment", """
SELECT CAST(user_id AS VARCHAR) AS row_key, event_type AS qualifier, CAST(count(*) AS VARCHAR) AS value
FROM events GROUP BY user_id, event_type""")
def cell_increment(spark, d):
    ev = T(spark, d, "events")
    cells = C.increment(C.empty_cells(spark), ev, row_key="user_id", family="c",
                        qualifier=F.col("event_type"), delta=1, **B.event_version(ev))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_delete_row", f"""
WITH cc AS ({customer_unpivot_sql(where="c_mktsegment <> 'AUTOMOBILE'")})
SELECT row_key, qualifier, value FROM cc""")
def cell_delete_row(spark, d):
    cust = T(spark, d, "customer")
    base = B.customer_cells(spark, d)
    gone = cust.filter(F.col("c_mktsegment") == "AUTOMOBILE")
    cells = C.delete(base, gone, scope="row", row_key="c_custkey", ts=1)
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_delete_cell", f"""
WITH cc AS ({customer_unpivot_sql()})
SELECT row_key, qualifier, value FROM cc
WHERE NOT (qualifier = 'c_acctbal' AND TRY_CAST(value AS DOUBLE) < 0)""")
def cell_delete_cell(spark, d):
    cust = T(spark, d, "customer")
    neg = cust.filter(F.col("c_acctbal") < 0)
    cells = C.delete(B.customer_cells(spark, d), neg, scope="cell", row_key="c_custkey",
                     family="c", qualifier="c_acctbal", ts=1)
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("cell_delete_family", f"""
WITH cc AS ({customer_unpivot_sql(where="c_mktsegment <> 'FURNITURE'")})
SELECT row_key, family, qualifier, value FROM cc
UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'x', 'segment', c_mktsegment FROM customer""")
def cell_delete_family(spark, d):
    cust = T(spark, d, "customer")
    extra = C.mutations(cust, row_key="c_custkey", family="x", qualifier="segment", value="c_mktsegment")
    base = C.append(B.customer_cells(spark, d), extra)
    furn = cust.filter(F.col("c_mktsegment") == "FURNITURE")
    cells = C.delete(base, furn, scope="family", row_key="c_custkey", family="c", ts=1)
    return C.resolve(cells).select("row_key", "family", "qualifier", "value")


@register("cell_check_and_delete", """
SELECT row_key, value FROM (
  SELECT CAST(user_id AS VARCHAR) AS row_key, arg_max(event_type, ts) AS value FROM events GROUP BY user_id)
WHERE value <> 'error'""")
def cell_check_and_delete(spark, d):
    ev = T(spark, d, "events")
    base = B.event_puts(spark, d, qualifier=F.lit("last_type"), value="event_type")
    users = ev.select("user_id").distinct()
    reqs = cas.requests(users, row_key="user_id", family="c", qualifier="last_type",
                        expected=F.lit("error"), ts=F.lit(2**62), seq=0)
    tombs = cas.check_and_delete(base, reqs, scope="row", single_per_row=True)
    return C.resolve(C.append(base, tombs)).select("row_key", "value")


MIXED_SQL = """
WITH last_err AS (SELECT user_id, max(ts) AS err_ts FROM events WHERE event_type = 'error' GROUP BY user_id),
puts AS (SELECT user_id, event_type AS qualifier, CAST(arg_max(value, ts) AS VARCHAR) AS value, max(ts) AS put_ts
         FROM events WHERE event_type IN ('view', 'signup', 'click') GROUP BY user_id, event_type)
SELECT CAST(p.user_id AS VARCHAR) AS row_key, p.qualifier, p.value
FROM puts p LEFT JOIN last_err e ON p.user_id = e.user_id
WHERE NOT (p.qualifier = 'click' AND e.err_ts IS NOT NULL AND e.err_ts >= p.put_ts)
UNION ALL
SELECT CAST(user_id AS VARCHAR), 'n_purchase', CAST(count(*) AS VARCHAR) FROM events
WHERE event_type = 'purchase' GROUP BY user_id"""


def mixed_mutations(ev: DataFrame) -> DataFrame:
    """puts for view/signup/click, a purchase counter, and an error clears the click cell."""
    et = F.col("event_type")
    kind = (F.when(et == "purchase", F.lit(C.INCREMENT)).when(et == "error", F.lit(C.DELETE_CELL))
            .otherwise(F.lit(C.PUT)))
    qual = (F.when(et == "purchase", F.lit("n_purchase")).when(et == "error", F.lit("click"))
            .otherwise(et))
    value = F.when(kind == C.PUT, F.col("value").cast("string"))
    delta = F.when(kind == C.INCREMENT, F.lit(1))
    return C.mutations(ev, row_key="user_id", family="c", qualifier=qual, value=value, kind=kind,
                       delta=delta, **B.event_version(ev))


@register("cell_mutate_mixed", MIXED_SQL)
def cell_mutate_mixed(spark, d):
    ev = T(spark, d, "events")
    cells = C.mutate(C.empty_cells(spark), mixed_mutations(ev))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("foreach_partition", "SELECT count(*) AS n_rows FROM customer")
def foreach_partition(spark, d):
    n = partitions.count_rows_by_partition_side_effect(T(spark, d, "customer"))
    return spark.createDataFrame([(n,)], "n_rows bigint")


def _name_features(batch, ctx):
    import pandas as pd
    return pd.DataFrame({
        "c_custkey": batch["c_custkey"],
        "name_len": batch["c_name"].str.len().astype("int64"),
        "segment_code": batch["c_mktsegment"].str.slice(0, 3).str.lower(),
    })


@register("map_partitions", """
SELECT c_custkey, CAST(length(c_name) AS BIGINT) AS name_len, lower(substr(c_mktsegment, 1, 3)) AS segment_code
FROM customer""")
def map_partitions(spark, d):
    return partitions.map_partitions(T(spark, d, "customer"), _name_features,
                                     "c_custkey bigint, name_len bigint, segment_code string",
                                     setup=lambda: {"opened": True})


@register("cell_table_create_drop", """
SELECT CAST(s_suppkey AS VARCHAR) AS row_key, 's_name' AS qualifier, s_name AS value FROM supplier
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 's_nationkey', CAST(s_nationkey AS VARCHAR) FROM supplier""")
def cell_table_create_drop(spark, d):
    name = unique_name("cells_tbl")
    supplier_cells = df_to_cells(T(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), family="c")
    C.create_table(spark, name)
    C.insert_cells(spark, name, B.customer_cells(spark, d))
    C.drop_table(spark, name)
    C.drop_table(spark, name)  # absent table tolerated
    C.create_table(spark, name)
    C.insert_cells(spark, name, supplier_cells)
    return C.resolve(C.read_table(spark, name)).select("row_key", "qualifier", "value")


# ================================================================== matching, lookup

APPS_SQL = """
SELECT c_custkey AS app_id,
       upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS first_name,
       CASE WHEN c_nationkey = 0 THEN NULL
            ELSE 'N' || CAST(c_nationkey AS VARCHAR) || '-' || CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) END AS last_name,
       lower(c_mktsegment || '.' || CAST(CAST(floor(c_acctbal / 100) AS BIGINT) AS VARCHAR) || '@example.com') AS email,
       CASE WHEN c_acctbal < 0 THEN NULL
            ELSE CAST(c_nationkey AS VARCHAR) || '-' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) END AS phone,
       CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL
            ELSE CAST(c_nationkey AS VARCHAR) || ' ' || c_mktsegment || ' St ' || CAST(CAST(floor(c_acctbal / 1000) AS BIGINT) AS VARCHAR) END AS address
FROM customer"""

MATCH_SQL = f"""
WITH applications AS ({APPS_SQL})
SELECT
 (CASE WHEN a1.first_name || a1.last_name = a2.first_name || a2.last_name THEN 1 ELSE 0 END) AS matched_name,
 (CASE WHEN a1.address = a2.address THEN 1 ELSE 0 END) AS matched_address,
 (CASE WHEN a1.phone = a2.phone THEN 1 ELSE 0 END) AS matched_phone,
 (CASE WHEN a1.email = a2.email THEN 1 ELSE 0 END) AS matched_email,
 CAST(levenshtein(a1.first_name || ' ' || a1.last_name, a2.first_name || ' ' || a2.last_name) AS INTEGER) AS name_distance,
 a1.first_name || a1.last_name AS name, a1.email AS email, a1.phone AS phone, a1.address AS address,
 a2.first_name || a2.last_name AS name2, a2.email AS email2, a2.phone AS phone2, a2.address AS address2
FROM applications a1 INNER JOIN applications a2
 ON (a1.first_name || a1.last_name = a2.first_name || a2.last_name
     OR a1.email = a2.email OR a1.phone = a2.phone OR a1.address = a2.address)"""


@register("match_self_join", MATCH_SQL)
def match_self_join(spark, d):
    return match.match_applications(B.applications(spark, d))


@register("match_flags", """
SELECT a.doc_id, b.doc_id AS doc_id2,
       CASE WHEN a.text = b.text THEN 1 ELSE 0 END AS matched_text,
       CASE WHEN a.source || '|' || a.lang || '|' || CAST(a.n_chars AS VARCHAR)
               = b.source || '|' || b.lang || '|' || CAST(b.n_chars AS VARCHAR) THEN 1 ELSE 0 END AS matched_shape
FROM documents a JOIN documents b
  ON a.text = b.text
  OR a.source || '|' || a.lang || '|' || CAST(a.n_chars AS VARCHAR) = b.source || '|' || b.lang || '|' || CAST(b.n_chars AS VARCHAR)""")
def match_flags(spark, d):
    docs = T(spark, d, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    shape = F.concat(F.col("source"), F.lit("|"), F.col("lang"), F.lit("|"), F.col("n_chars").cast("string"))
    pairs = match.or_match_pairs(docs, {"text": F.col("text"), "shape": shape})
    l_shape = F.concat(F.col("l.source"), F.lit("|"), F.col("l.lang"), F.lit("|"), F.col("l.n_chars").cast("string"))
    r_shape = F.concat(F.col("r.source"), F.lit("|"), F.col("r.lang"), F.lit("|"), F.col("r.n_chars").cast("string"))
    return pairs.select(
        F.col("l.doc_id").alias("doc_id"), F.col("r.doc_id").alias("doc_id2"),
        F.when(F.col("l.text") == F.col("r.text"), 1).otherwise(0).alias("matched_text"),
        F.when(l_shape == r_shape, 1).otherwise(0).alias("matched_shape"))


LOOKUP_SQL = """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_nationkey = 0 THEN 'UNKNOWN' WHEN c_nationkey = 1 THEN NULL
            ELSE ' ' || c_mktsegment || chr(9) END AS segment_probe,
       CASE WHEN c_nationkey IN (0, 1) THEN NULL
            ELSE '-' || upper(substr(c_mktsegment, 1, 4)) || '-' END AS segment_probe_lookup
FROM customer"""


@register("lookup_column", LOOKUP_SQL)
def lookup_column_q(spark, d):
    probe = B.lookup_probe(T(spark, d, "customer"))
    return lookup_column(probe, "segment_probe", B.segment_dictionary(spark, d), row_key="2", family="c")


# ================================================================== composite jobs

ETL_SQL = """
SELECT c_custkey, c_name, c_acctbal, c_mktsegment,
       '-' || upper(substr(c_mktsegment, 1, 4)) || '-' AS c_mktsegment_lookup
FROM customer"""


@register("etl_load_enrich_store", ETL_SQL)
def etl_load_enrich_store(spark, d):
    from tessera.plans.etl import CellSink, Lookup, load_enrich_store

    v = _views(spark, d, "customer")
    root = scratch_path(spark, "etl")
    table = unique_name("etl_customers")
    load_enrich_store(
        spark, f"SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM {v['customer']}", "sql",
        lookup=Lookup(B.segment_dictionary(spark, d), "c_mktsegment", "2", "c"),
        location=f"{root}/files", table=table, partition_by="c_mktsegment",
        cell_sink=CellSink(f"{root}/cells", "c", num_salts=6))
    return spark.table(table)


def _observations(spark, d):
    from tessera.plans.change_tracking import step_observations
    ev = T(spark, d, "events")
    return step_observations(ev, key="user_id", status=F.col("event_type"), ts="ts",
                             step=B.day_step(F.col("ts")), tiebreak="event_id")


@register("change_tracking_state", """
SELECT CAST(user_id AS VARCHAR) AS row_key, arg_max(event_type, ts) AS status FROM events GROUP BY user_id""")
def change_tracking_state(spark, d):
    from tessera.plans.change_tracking import current_state
    return current_state(_observations(spark, d)).select(
        F.col("key").cast("string").alias("row_key"), "status")


@register("change_tracking_history", """
WITH obs AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS step_ts, arg_max(event_type, ts) AS status
  FROM events GROUP BY 1, 2),
ch AS (SELECT *, lag(status) OVER (PARTITION BY user_id ORDER BY step_ts) AS prev FROM obs)
SELECT CAST(user_id AS VARCHAR) || ':' || strftime(step_ts, '%Y%m%d%H%M%S') AS id_ts, status
FROM ch WHERE prev IS NULL OR prev <> status""")
def change_tracking_history(spark, d):
    from tessera.plans.change_tracking import change_history, history_table
    return history_table(change_history(_observations(spark, d)))


@register("map_round_trip", """
SELECT CAST(c_custkey AS VARCHAR) AS rowKeyId, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, c_name AS NameKey,
       'testvalue1' AS testkey1, 'testvalue2' AS testkey2, 'testvalue3' AS testkey3
FROM customer""")
def map_round_trip(spark, d):
    from tessera.plans.enrich import map_round_trip as run
    wide = C.scan_wide(B.customer_cells(spark, d), key_name="CustID", qualifiers=B.CUSTOMER_QUALIFIERS)
    return run(wide, key_col="CustID", name_col="c_name", store_path=scratch_path(spark, "map-cells"))


@register("enrich_store", f"""
WITH base AS ({customer_unpivot_sql(key=duck_salted("CAST(c_custkey AS VARCHAR)", 6))})
SELECT row_key, qualifier, value FROM base
UNION ALL
SELECT {duck_salted("CAST(c_custkey AS VARCHAR)", 6)}, 'c_mktsegment_lookup',
       '-' || upper(substr(c_mktsegment, 1, 4)) || '-' FROM customer""")
def enrich_store(spark, d):
    from tessera.plans.enrich import enrich_and_store
    path = scratch_path(spark, "enrich-csv")
    K.write_csv(T(spark, d, "customer"), path, header=True)
    df = SF.read_csv_header(spark, path)
    cells = enrich_and_store(df, lookup_col="c_mktsegment", dictionary_cells=B.segment_dictionary(spark, d),
                             row_key="2", family="c", num_salts=6, store_path=scratch_path(spark, "enriched"))
    return C.resolve(cells).select("row_key", "qualifier", "value")


# ================================================================== streaming

ROWS_PER_SLICE_FILE = 250_000


def _event_slices(spark, d, parts: int = 4, rows_per_file: int = ROWS_PER_SLICE_FILE) -> tuple[str, object, int]:
    """``events`` copied as ``parts`` slices in time order, one write per slice, each of as many files.

    A file stream that takes that many files per trigger (the third value) replays
    the slices as micro-batches. The number of files follows the rows, so many tasks write
    and read a slice; one that has fewer is filled up with empty files.
    """
    ev = T(spark, d, "events")
    root = scratch_path(spark, "event-slices")
    lo, hi, n = ev.agg(F.min(S.epoch_micros("ts")), F.max(S.epoch_micros("ts")), F.count("*")).first()
    lo, hi = (lo or 0), (hi or 0) + 1
    step = max(1, -(-(hi - lo) // parts))
    files = max(1, -(-n // (parts * rows_per_file)))
    us = S.epoch_micros("ts")
    nothing = spark.createDataFrame([], ev.schema).coalesce(1)
    for i in range(parts):
        a, b = lo + i * step, lo + (i + 1) * step
        own = (us >= a) & (us < b)
        rows = ev.filter(own | us.isNull() if i == 0 else own)
        dealt = rows.coalesce(1) if files == 1 else rows.repartitionById(files, F.pmod(F.monotonically_increasing_id(), F.lit(files)).cast("int"))
        dealt.write.mode("append").parquet(root)
        if files > 1:
            for _ in range((i + 1) * files - len(spark.read.schema(ev.schema).parquet(root).inputFiles())):
                nothing.write.mode("append").parquet(root)
    return root, ev.schema, files


def _stream_events(spark, d):
    from tessera.streaming.mutations import file_stream
    path, schema, files = _event_slices(spark, d)
    return file_stream(spark, path, schema, max_files_per_trigger=files)


def _drain_cells(spark, stream_cells) -> DataFrame:
    from tessera.streaming.mutations import append_to_files
    root = scratch_path(spark, "stream-cells")
    append_to_files(stream_cells.select(*C.CELL_COLUMNS), f"{root}/data", f"{root}/_checkpoint", partition_by="kind")
    return C.read_cells(spark, f"{root}/data")


@register("stream_foreach_batch", """
SELECT event_type, count(*) AS n_events FROM events GROUP BY event_type""")
def stream_foreach_batch(spark, d):
    from tessera.streaming.mutations import foreach_batch, idempotent_batch_writer
    root = scratch_path(spark, "foreach-batch")
    writer = idempotent_batch_writer(
        f"{root}/out", lambda b, i: b.groupBy("event_type").agg(F.count("*").alias("n")))
    foreach_batch(_stream_events(spark, d), writer, f"{root}/_checkpoint")
    return (spark.read.parquet(f"{root}/out").groupBy("event_type")
            .agg(F.sum("n").cast("bigint").alias("n_events")))


def _value_cents(batch, ctx):
    import pandas as pd
    return pd.DataFrame({"event_id": batch["event_id"],
                         "value_cents": (batch["value"] * 100).round().astype("int64")})


@register("stream_map", "SELECT event_id, CAST(round(value * 100) AS BIGINT) AS value_cents FROM events")
def stream_map(spark, d):
    from tessera.streaming.mutations import append_to_files, stream_map as smap
    root = scratch_path(spark, "stream-map")
    mapped = smap(_stream_events(spark, d), _value_cents, "event_id bigint, value_cents bigint")
    append_to_files(mapped, f"{root}/data", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/data")


@register("stream_put", ORACLES["cell_put"])
def stream_put(spark, d):
    s = _stream_events(spark, d)
    muts = C.mutations(s, row_key="user_id", family="c", qualifier=F.col("event_type"), value="value",
                       ts=S.epoch_micros("ts"), seq=F.col("event_id"))
    return C.resolve(_drain_cells(spark, muts)).select("row_key", "qualifier", "value")


@register("stream_increment", ORACLES["cell_increment"])
def stream_increment(spark, d):
    s = _stream_events(spark, d)
    muts = C.mutations(s, row_key="user_id", family="c", qualifier=F.col("event_type"), kind=C.INCREMENT,
                       delta=F.lit(1), ts=S.epoch_micros("ts"), seq=F.col("event_id"))
    return C.resolve(_drain_cells(spark, muts)).select("row_key", "qualifier", "value")


@register("stream_delete", ORACLES["cell_delete_row"])
def stream_delete(spark, d):
    from tessera.streaming.mutations import file_stream
    cust = T(spark, d, "customer")
    gone = file_stream(spark, f"{d}/customer.parquet", cust.schema, max_files_per_trigger=None) \
        .filter(F.col("c_mktsegment") == "AUTOMOBILE")
    tombs = C.mutations(gone, row_key="c_custkey", kind=C.DELETE_ROW, ts=1)
    cells = C.append(B.customer_cells(spark, d), _drain_cells(spark, tombs))
    return C.resolve(cells).select("row_key", "qualifier", "value")


@register("stream_mutate_mixed", MIXED_SQL)
def stream_mutate_mixed(spark, d):
    muts = mixed_mutations(_stream_events(spark, d))
    return C.resolve(_drain_cells(spark, muts)).select("row_key", "qualifier", "value")


@register("stream_check_and_put", CHECK_AND_PUT_SQL)
def stream_check_and_put(spark, d):
    from tessera.streaming.mutations import stream_check_and_mutate
    accepted = stream_check_and_mutate(_funnel_requests(_stream_events(spark, d)), None, action="put")
    return C.resolve(_drain_cells(spark, accepted)).select("row_key", "value")


@register("stream_check_and_delete", ORACLES["cell_check_and_delete"])
def stream_check_and_delete(spark, d):
    from tessera.streaming.mutations import stream_check_and_mutate
    base = B.event_puts(spark, d, qualifier=F.lit("last_type"), value="event_type")
    current = C.resolve(base).select("row_key", "family", "qualifier", "value", "ts", "seq")
    reqs = cas.requests(_stream_events(spark, d), row_key="user_id", family="c", qualifier="last_type",
                        expected=F.lit("error"), ts=F.lit(2**62), seq=F.col("event_id"))
    accepted = stream_check_and_mutate(reqs, current, action="delete", delete_scope="row")
    tombs = _drain_cells(spark, accepted)
    return C.resolve(C.append(base, tombs)).select("row_key", "value")


@register("stream_check_and_mutate", ORACLES["cell_check_and_delete_row_seq"])
def stream_check_and_mutate_q(spark, d):
    from tessera.streaming.mutations import stream_check_and_mutate
    base = _seeded_users(T(spark, d, "events"))
    accepted = stream_check_and_mutate(_two_cell_requests(_stream_events(spark, d), deletes=True), C.resolve(base))
    return C.resolve(C.append(base, _drain_cells(spark, accepted))).select("row_key", "qualifier", "value")


@register("stream_enrich", """
SELECT event_id, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id = c_custkey""")
def stream_enrich(spark, d):
    from tessera.streaming.mutations import stream_gets
    store = scratch_path(spark, "customer-cells")
    C.write_cells(B.customer_cells(spark, d), store)  # the stored table the stream reads live
    root = scratch_path(spark, "stream-enrich")
    found = stream_gets(_stream_events(spark, d).select("event_id", "user_id"), store, key_col="user_id",
                        qualifiers=["c_name", "c_mktsegment"], path=root, checkpoint=f"{root}/_checkpoint")
    return found.select("event_id", "user_id", "c_name", "c_mktsegment")


STREAM_CHANGE_SQL = """
WITH b AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) + 1 AS hi FROM events),
sl AS (SELECT e.*, (epoch_us(e.ts) - b.lo) // ((b.hi - b.lo + 3) // 4) AS slice FROM events e, b),
slice_ts AS (SELECT slice, max(ts) AS step_ts FROM sl GROUP BY slice),
obs AS (SELECT user_id, slice, arg_max(event_type, (ts, event_id)) AS status FROM sl GROUP BY user_id, slice),
ch AS (SELECT o.*, lag(status) OVER (PARTITION BY user_id ORDER BY slice) AS prev FROM obs o)
SELECT CAST(ch.user_id AS VARCHAR) || ':' || strftime(t.step_ts, '%Y%m%d%H%M%S') AS id_ts, ch.status
FROM ch JOIN slice_ts t ON ch.slice = t.slice
WHERE ch.prev IS NULL OR ch.prev <> ch.status"""


@register("stream_change_tracking", STREAM_CHANGE_SQL)
def stream_change_tracking(spark, d):
    from tessera.plans.change_tracking import stream_change_tracking as run
    root = scratch_path(spark, "stream-change")
    _cells, hist = run(_stream_events(spark, d), key="user_id", status=F.col("event_type"), ts="ts",
                       tiebreak="event_id", root=root, checkpoint=f"{root}/_checkpoint")
    return spark.read.parquet(hist).select("id_ts", "status")
