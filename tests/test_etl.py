from pyspark.sql import functions as F

from tessera import bindings as B
from tessera.operators import cells as C
from tessera.plans.etl import CellSink, Lookup, load_enrich_store

from conftest import SF_SMALL, rows


def _customer_view(spark):
    B.table(spark, SF_SMALL, "customer").createOrReplaceTempView("etl_cust")
    return "SELECT c_custkey, c_name, c_mktsegment FROM etl_cust"


def test_path_wins_and_external_table(spark, tmp):
    sql = _customer_view(spark)
    lk = Lookup(B.segment_dictionary(spark, SF_SMALL), "c_mktsegment", "2", "c")
    out = load_enrich_store(spark, sql, "sql", lookup=lk, location=f"{tmp}/files", table="etl_ext",
                            partition_by="c_mktsegment", cell_sink=CellSink(f"{tmp}/cells", "c", num_salts=6))
    assert "c_mktsegment_lookup" in out.columns
    t = spark.table("etl_ext")
    assert t.count() == B.table(spark, SF_SMALL, "customer").count()
    assert t.filter(F.col("c_mktsegment_lookup").isNull()).count() == 0
    cells = C.resolve(C.read_cells(spark, f"{tmp}/cells"))
    assert cells.filter(F.col("qualifier") == "c_mktsegment_lookup").count() == t.count()
    assert cells.filter(~F.col("row_key").rlike("^[0-9]{4}:")).count() == 0


def test_lookup_skipped_when_a_name_is_missing(spark, tmp):
    sql = _customer_view(spark)
    lk = Lookup(B.segment_dictionary(spark, SF_SMALL), "c_mktsegment", "", "c")
    out = load_enrich_store(spark, sql, "sql", lookup=lk, location=f"{tmp}/f")
    assert "c_mktsegment_lookup" not in out.columns


def test_table_insert_with_staging_view_and_partitions(spark):
    sql = _customer_view(spark)
    cust = spark.sql(sql)
    cust.limit(0).write.mode("overwrite").partitionBy("c_mktsegment").saveAsTable("etl_target")
    load_enrich_store(spark, sql, "sql", table="default.etl_target", partition_by="c_mktsegment", overwrite=True)
    assert spark.catalog.tableExists("temp_etl_target")  # staging view without the database part
    assert rows(spark.table("etl_target").select(*cust.columns)) == rows(cust)
    load_enrich_store(spark, sql, "sql", table="etl_target", partition_by="c_mktsegment", overwrite=False)
    assert spark.table("etl_target").count() == 2 * cust.count()


def test_scan_time_range_keeps_tombstones(spark):
    log = spark.createDataFrame([("a", "c", "x", 1, 0, "put", "old", None),
                                 ("a", "c", "x", 5, 0, "put", "new", None),
                                 ("b", "c", "x", 1, 0, "put", "b1", None),
                                 ("b", None, None, 9, 0, "delete_row", None, None)], C.CELL_SCHEMA)
    got = rows(C.scan(log, max_ts=3), "row_key", "value")
    assert got == [("a", "old")]  # b's delete at ts 9 still applies
