"""Batch load -> lookup column -> files / tables -> cells.

Rules kept from the original job: the lookup runs only when the dictionary
and all four lookup names are given; a file path wins over a table name; an
external table is registered only with both a path and a table name; the
staging view is ``temp_<table>`` without the database part; the cell write
is optional. The loaded frame is persisted when more than one sink reads it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tessera.functions.scalar import split_names
from tessera.operators import cells as C
from tessera.operators.convert import df_to_cells
from tessera.operators.lookup import DEFAULT_SUFFIX, lookup_column
from tessera.sinks.tables import create_external_table, insert_into, temp_view, write_files
from tessera.sources.sql import load


@dataclass
class Lookup:
    cells: DataFrame
    column: str
    row_key: str
    family: str
    suffix: str = DEFAULT_SUFFIX


@dataclass
class CellSink:
    path: str
    family: str
    num_salts: int = 0
    ts: int | None = None  # None: later loads win


def load_enrich_store(spark: SparkSession, source: str, kind: str = "sql", *,
                      queries: Mapping[str, str] | None = None, lookup: Lookup | None = None,
                      location: str | None = None, table: str | None = None,
                      partition_by: str | None = None, overwrite: bool = True,
                      persist_staging_table: bool = False, cell_sink: CellSink | None = None) -> DataFrame:
    """Run the ETL and return the enriched frame that was written; its cache is released after the last sink."""
    df = load(spark, source, kind, queries=queries)
    if lookup is not None and all([lookup.column, lookup.row_key, lookup.family]):
        df = lookup_column(df, lookup.column, lookup.cells, row_key=lookup.row_key,
                           family=lookup.family, suffix=lookup.suffix)
    sinks = int(bool(location) or bool(table)) + int(cell_sink is not None)
    if sinks > 1:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    mode = "overwrite" if overwrite else "append"
    if location:
        write_files(df, location, mode=mode, partition_by=partition_by)
        if table:
            create_external_table(spark, table, location, partitioned=bool(split_names(partition_by)),
                                  replace=overwrite)
    elif table:
        staging = f"temp_{table.split('.')[-1]}"
        if persist_staging_table:
            df.write.mode("overwrite").saveAsTable(staging)
            staged = spark.table(staging)
        else:
            temp_view(df, staging)
            staged = spark.table(staging)
        insert_into(spark, staged, table, overwrite=overwrite, partition_by=partition_by)
    if cell_sink is not None:
        C.write_cells(df_to_cells(df, family=cell_sink.family, num_salts=cell_sink.num_salts,
                                  ts=cell_sink.ts), cell_sink.path)
    return df.unpersist() if sinks > 1 else df
