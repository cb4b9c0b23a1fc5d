"""Per-partition functions with one setup per partition."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame

from tessera.session import ship_package


def foreach_partition(df: DataFrame, fn: Callable[[Iterator[Any]], None]) -> None:
    """Run a side-effecting function once per partition (an action)."""
    ship_package(df.sparkSession)
    df.foreachPartition(fn)


def count_rows_by_partition_side_effect(df: DataFrame) -> int:
    """Count rows through ``foreachPartition`` and an accumulator.

    Accumulator updates inside an action are applied once per successful task,
    so a retried task does not double count.
    """
    ship_package(df.sparkSession)
    acc = df.sparkSession.sparkContext.accumulator(0)

    def count_part(rows: Iterator[Any]) -> None:
        n = 0
        for _ in rows:
            n += 1
        acc.add(n)

    df.foreachPartition(count_part)
    return int(acc.value)


def map_partitions(df: DataFrame, fn: Callable[[pd.DataFrame, Any], pd.DataFrame], schema,
                   setup: Callable[[], Any] | None = None) -> DataFrame:
    """Map Arrow batches of each partition through ``fn(batch, context)``.

    ``setup()`` runs once per partition (the connection-per-partition pattern)
    and its result is handed to every batch of that partition.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = setup() if setup is not None else None
        for batch in batches:
            yield fn(batch, ctx)

    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)
