import pytest
from pyspark.sql import functions as F

from tessera.sinks import tables as K
from tessera.sources import files as SF
from tessera.sources import sql as SQ

from conftest import SF_SMALL, rows


def test_multi_path_tolerates_missing(spark, tmp):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    nation.write.parquet(f"{tmp}/a")
    nation.write.parquet(f"{tmp}/b")
    df = SF.read_multi_path(spark, "parquet", [f"{tmp}/a", f"{tmp}/missing", f"{tmp}/b"])
    assert df.count() == 2 * nation.count()
    assert SF.read_multi_path(spark, "parquet", [f"{tmp}/none1", f"{tmp}/none2"]) is None


def test_csv_round_trip_keeps_whitespace(spark, tmp):
    df = spark.createDataFrame([(1, "  padded  "), (2, "x")], "id int, t string")
    K.write_csv(df, f"{tmp}/csv", delimiter="|")
    back = SF.read_csv_header(spark, f"{tmp}/csv", delimiter="|", schema="id int, t string")
    assert rows(back) == [(1, "  padded  "), (2, "x")]
    plain = SF.read_csv_schema(spark, f"{tmp}/csv", columns="a,b", delimiter="|")
    assert plain.schema.simpleString() == "struct<a:string,b:string>"


def test_json_keeps_microseconds(spark, tmp):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    K.write_json(ev, f"{tmp}/json")
    back = SF.read_json(spark, f"{tmp}/json", schema=ev.schema)
    assert rows(back) == rows(ev)


def test_load_dispatch_and_named_query(spark, tmp):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    nation.createOrReplaceTempView("nation_io_test")
    q = {"by_region": "SELECT n_regionkey, count(*) AS n FROM nation_io_test WHERE n_regionkey >= :r GROUP BY 1"}
    got = SQ.load(spark, "by_region", "sql", queries=q, args={"r": 3})
    assert sorted(r[0] for r in got.collect()) == [3, 4]
    with pytest.raises(KeyError):
        SQ.named_query(spark, q, "nope")
    K.write_csv(nation, f"{tmp}/n", header=True)
    assert SQ.load(spark, f"{tmp}/n", "csv").count() == 25
    nation.write.parquet(f"{tmp}/p")
    assert SQ.load(spark, f"{tmp}/p", "parquet").count() == 25


def test_insert_into_is_aligned_by_name(spark):
    nation = spark.read.parquet(f"{SF_SMALL}/nation.parquet")
    nation.limit(0).write.mode("overwrite").saveAsTable("io_ins")
    K.insert_into(spark, nation.select(*reversed(nation.columns)), "io_ins")
    assert rows(spark.table("io_ins")) == rows(nation)
    K.insert_into(spark, nation, "io_ins", overwrite=True)
    assert spark.table("io_ins").count() == 25


def test_dynamic_partition_overwrite_only_touches_given_partitions(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    K.save_table(orders, "io_dyn", partition_by="o_orderstatus")
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    f_rows = orders.filter(F.col("o_orderstatus") == "F").limit(3)
    K.insert_into(spark, f_rows, "io_dyn", overwrite=True, partition_by="o_orderstatus")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == before
    t = spark.table("io_dyn")
    assert t.filter(F.col("o_orderstatus") == "F").count() == 3
    assert t.filter(F.col("o_orderstatus") != "F").count() == orders.filter(F.col("o_orderstatus") != "F").count()


def test_external_table_over_partitioned_files(spark, tmp):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    K.write_files(orders, f"{tmp}/o", partition_by="o_orderstatus")
    K.create_external_table(spark, "io_ext", f"{tmp}/o", partitioned=True)
    assert spark.table("io_ext").count() == orders.count()


def test_temp_view_drops_database(spark):
    df = spark.createDataFrame([(1,)], "a int")
    assert K.temp_view(df, "db.some_view") == "some_view"
    assert spark.table("some_view").count() == 1
