"""SQL text, named queries, literal rows and the source dispatcher (S6-S8, S17)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.files import read_csv_header, read_multi_path


def run_sql(spark: SparkSession, text: str, args: Mapping[str, Any] | None = None) -> DataFrame:
    """SQL text as a source; named parameter markers (``:name``) are bound, not pasted."""
    return spark.sql(text, args=dict(args)) if args else spark.sql(text)


def named_query(spark: SparkSession, queries: Mapping[str, str], name: str,
                args: Mapping[str, Any] | None = None) -> DataFrame:
    """Run the query registered under ``name`` in a name -> SQL mapping."""
    if name not in queries:
        raise KeyError(f"no query named {name!r}")
    return run_sql(spark, queries[name], args)


def from_literals(spark: SparkSession, rows: Sequence[Sequence[Any]], schema) -> DataFrame:
    """Rows given in code (seed data in tests)."""
    return spark.createDataFrame(list(rows), schema)


def load(spark: SparkSession, source: str | Sequence[str], kind: str = "sql", *,
         queries: Mapping[str, str] | None = None, args: Mapping[str, Any] | None = None) -> DataFrame:
    """Dispatch on ``kind``: ``sql`` (text, or a name when ``queries`` is given),
    ``csv`` (header, inferred types), anything else Parquet: one path or a list of them (unreadable ones tolerated).
    """
    k = (kind or "sql").lower()
    if k in ("sql", "hive"):
        if queries is not None:
            return named_query(spark, queries, source, args)
        return run_sql(spark, source, args)
    if k == "csv":
        return read_csv_header(spark, source)
    df = read_multi_path(spark, "parquet", [source] if isinstance(source, str) else list(source))
    if df is None:
        raise FileNotFoundError(f"no readable parquet at {source}")
    return df
