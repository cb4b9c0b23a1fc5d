"""Row cleaning."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import split_names

NULL_TEXT = "null"


def _columns(df: DataFrame, columns: str | Sequence[str] | None) -> list[str]:
    """The columns to clean: all if none are given. Names reading ``null`` are
    skipped; a list of nothing else cleans nothing."""
    given = split_names(columns)
    return df.columns if given is None else [c for c in given if c != NULL_TEXT]


def clean_null_rows(df: DataFrame, columns: str | Sequence[str] | None = None) -> DataFrame:
    """Drop rows whose given columns (default: all) are null or read ``null``
    once trimmed (case-sensitive). One filter; it reaches the scan."""
    cols = _columns(df, columns)
    if not cols:
        return df
    cond = reduce(lambda a, b: a & b,
                  [F.trim(F.col(f"`{c}`").cast("string")) != F.lit(NULL_TEXT) for c in cols])
    return df.filter(cond)


def clean_defaults(df: DataFrame, columns: str | Sequence[str] | None = None) -> DataFrame:
    """Replace nulls by ``0.0`` in the given columns (default: all).

    Numeric columns become double (null -> 0.0); text columns get ``'0.0'``;
    other types raise. Column order is kept; one projection.
    """
    cols = set(_columns(df, columns))
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name not in cols:
            out.append(c)
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(c.cast("double"), F.lit(0.0)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(c, F.lit("0.0")).alias(f.name))
        else:
            raise TypeError(f"cannot default column {f.name!r} of type {f.dataType.simpleString()} to 0.0")
    return df.select(*out)
