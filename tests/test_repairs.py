"""Sources, sinks, cleaning and change tracking on inputs that once went wrong."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tessera.operators.clean import clean_null_rows
from tessera.plans import change_tracking as CT
from tessera.sinks import tables as K
from tessera.sources import files as SF


def test_a_column_named_null(spark, tmp):
    assert SF.string_schema("a,null,b").names == ["a", "null", "b"]
    df = spark.createDataFrame([("null", 1), ("x", 2)], "a string, b int")
    assert clean_null_rows(df, "null").count() == 2
    assert clean_null_rows(df).count() == 1
    assert clean_null_rows(df, "a,null").count() == 1


def test_paths_of_different_schema_and_a_corrupt_one(spark, tmp):
    spark.createDataFrame([(1, 2)], "a int, b int").write.parquet(f"{tmp}/one")
    spark.createDataFrame([(3, 4)], "a int, c int").write.parquet(f"{tmp}/two")
    os.makedirs(f"{tmp}/bad")
    with open(f"{tmp}/bad/part.parquet", "wb") as f:
        f.write(b"not parquet at all")
    skipped = []
    with pytest.warns(UserWarning):
        df = SF.read_multi_path(spark, "parquet", [f"{tmp}/one", f"{tmp}/bad", f"{tmp}/none", f"{tmp}/two"], skipped=skipped)
    assert rows(df.select("a", "b", "c")) == [(1, 2, None), (3, None, 4)]
    assert skipped == [f"{tmp}/bad", f"{tmp}/none"]


def test_positional_insert_and_managed_table(spark, tmp):
    spark.sql("DROP TABLE IF EXISTS repairs_t")
    spark.createDataFrame([(1, "x")], "a int, b string").write.saveAsTable("repairs_t")
    K.insert_into(spark, spark.createDataFrame([(2, "y")], "c int, d string"), "repairs_t")
    K.insert_into(spark, spark.createDataFrame([("z", 3)], "b string, a int"), "repairs_t")
    assert rows(spark.table("repairs_t")) == [(1, "x"), (2, "y"), (3, "z")]
    with pytest.raises(ValueError, match="managed"):
        K.create_external_table(spark, "repairs_t", f"{tmp}/x")
    assert spark.table("repairs_t").count() == 3
    spark.sql("DROP TABLE repairs_t")


def test_change_to_null_and_new_keys(spark):
    obs = spark.createDataFrame([("k", 1, None), ("k", 2, "a"), ("k", 3, None), ("k", 4, None)], "key string, step_ts int, status string")
    assert rows(CT.change_history(obs), "step_ts", "status") == [(1, None), (2, "a"), (3, None)]
    initial = spark.createDataFrame([("1", "0"), ("2", "0")], "id string, status string")
    update = spark.createDataFrame([("2", "1"), ("3", "1")], "id string, status string")
    state, history = CT.run_steps(spark, initial, [(1_000_000, update)], key="id", status="status")
    assert rows(state, "row_key", "value") == [("1", "0"), ("2", "1"), ("3", "1")]
    assert rows(history.select(F.col("id_ts").substr(1, 1), "status")) == [("1", "0"), ("2", "0"), ("2", "1"), ("3", "1")]
