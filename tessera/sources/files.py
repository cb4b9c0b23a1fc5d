"""File sources.

All readers return lazy DataFrames: column pruning and filters written after
them reach the Parquet/JSON/CSV scan. Pass a schema for JSON and CSV at scale;
inference costs an extra pass over the input.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tessera.functions.scalar import split_names


def string_schema(names: str | Sequence[str]) -> T.StructType:
    """A comma list of names as an all-string, nullable schema."""
    cols = split_names(names)
    if not cols:
        raise ValueError("a column list is required when the file has no header")
    return T.StructType([T.StructField(c, T.StringType(), True) for c in cols])


def read_csv_header(spark: SparkSession, path: str | Sequence[str], *, delimiter: str = ",",
                    infer_schema: bool = True, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header line; types inferred unless a schema is given."""
    reader = spark.read.option("header", True).option("sep", delimiter)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer_schema)
    return reader.csv(path if isinstance(path, str) else list(path))


def read_csv_schema(spark: SparkSession, path: str | Sequence[str], *, columns: str | Sequence[str],
                    delimiter: str = ",") -> DataFrame:
    """Header-less CSV whose columns are named by a list; every column is text."""
    return (spark.read.schema(string_schema(columns)).option("header", False)
            .option("sep", delimiter).csv(path if isinstance(path, str) else list(path)))


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return spark.read.parquet(*([path] if isinstance(path, str) else list(path)))


# Fixed value: timestamps in JSON text keep all six fractional digits.
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def read_json(spark: SparkSession, path: str | Sequence[str], *,
              schema: T.StructType | str | None = None) -> DataFrame:
    """JSON lines; give ``schema`` to skip the inference pass."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    reader = reader.option("timestampNTZFormat", JSON_TS_FORMAT)
    return reader.json(path if isinstance(path, str) else list(path))


def _read_one(spark: SparkSession, fmt: str, paths: list[str], schema) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(paths if len(paths) > 1 else paths[0])


def read_multi_path(spark: SparkSession, fmt: str, paths: Sequence[str], *,
                    schema: T.StructType | str | None = None,
                    skipped: list[str] | None = None) -> DataFrame | None:
    """Read several paths as one DataFrame, skipping the ones that cannot be read.

    Each path is tried alone (file listings, and footers if no schema is
    given); a missing, empty or corrupt one is skipped, with a warning, and
    added to ``skipped`` if that is given. Readable paths are unioned by name:
    a column that a path lacks is null there. ``None`` when nothing is readable.
    """
    frames: list[tuple[str, DataFrame]] = []
    for p in paths:
        try:
            frames.append((p, _read_one(spark, fmt, [p], schema)))
        except Exception as e:  # noqa: BLE001 - whatever makes a path unreadable
            warnings.warn(f"skipped unreadable path {p}: {type(e).__name__}", stacklevel=2)
            if skipped is not None:
                skipped.append(p)
    if not frames:
        return None
    if all(df.schema == frames[0][1].schema for _, df in frames):
        # One scan over all readable paths keeps a single file index and split planning.
        return _read_one(spark, fmt, [p for p, _ in frames], schema)
    out = frames[0][1]
    for _, df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
