"""File and table sinks."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tessera.functions.scalar import split_names


def write_csv(df: DataFrame, path: str, *, delimiter: str = ",", header: bool = True,
              mode: str = "overwrite") -> None:
    """CSV files; edge whitespace of text is kept so the data round-trips."""
    (df.write.mode(mode).option("header", header).option("sep", delimiter)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_json(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """JSON lines; timestamps keep microseconds (the default drops them)."""
    from tessera.sources.files import JSON_TS_FORMAT
    df.write.mode(mode).option("timestampNTZFormat", JSON_TS_FORMAT).json(path)


def write_files(df: DataFrame, path: str, *, mode: str = "overwrite", fmt: str = "parquet",
                partition_by: str | Sequence[str] | None = None) -> None:
    """Files, overwrite or append, optionally partitioned by a list of columns."""
    writer = df.write.mode(mode).format(fmt)
    cols = split_names(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.save(path)


def save_table(df: DataFrame, name: str, *, mode: str = "overwrite",
               partition_by: str | Sequence[str] | None = None) -> None:
    """A catalog table managed by Spark."""
    writer = df.write.mode(mode)
    cols = split_names(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.saveAsTable(name)


def insert_into(spark: SparkSession, df: DataFrame, table: str, *, overwrite: bool = False,
                partition_by: str | Sequence[str] | None = None) -> None:
    """``INSERT INTO|OVERWRITE`` an existing table.

    A frame with the table's column names is put in table order first (the
    partition columns are last in a partitioned table); with other names the
    insert is positional, as in ``INSERT ... SELECT *``. With partition columns
    the overwrite is dynamic: only partitions present in ``df`` are replaced.
    The session setting is restored afterwards.
    """
    cols = spark.table(table).columns
    if len(df.columns) != len(cols):
        raise ValueError(f"{table} has {len(cols)} columns, the data {len(df.columns)}")
    same = {c.lower() for c in df.columns} == {c.lower() for c in cols}
    ordered = df.select(*[f"`{c}`" for c in cols]) if same else df
    if not split_names(partition_by):
        ordered.write.insertInto(table, overwrite=overwrite)
        return
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "dynamic")
    try:
        ordered.write.insertInto(table, overwrite=overwrite)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def create_external_table(spark: SparkSession, table: str, path: str, *, fmt: str = "parquet",
                          partitioned: bool = False, replace: bool = True) -> None:
    """Register files at ``path`` as an external table; repair partitions if any.

    An external table of that name is registered anew (``replace``) or kept
    and refreshed, which is refused if it lies at another location; a managed table is never touched, since dropping it would
    delete its files.
    """
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType == "MANAGED":
            raise ValueError(f"{table} is a managed table; it is not replaced by an external one")
        if not replace:
            described = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").first()
            bare = lambda p: re.sub(r"^[a-z0-9]+:/+", "/", p.rstrip("/"))
            if described and bare(described["data_type"]) != bare(path):
                raise ValueError(f"{table} lies at {described['data_type']}, not at {path}")
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING {fmt} LOCATION '{path}'")
    if partitioned:
        spark.sql(f"MSCK REPAIR TABLE {table}")
    spark.catalog.refreshTable(table)


def temp_view(df: DataFrame, name: str) -> str:
    """Register a temp view; a database prefix in ``name`` is dropped."""
    view = name.split(".")[-1]
    df.createOrReplaceTempView(view)
    return view
