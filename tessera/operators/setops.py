"""Set operations used by change tracking."""

from __future__ import annotations

from pyspark.sql import DataFrame


def changed_rows(updated: DataFrame, previous: DataFrame) -> DataFrame:
    """Distinct rows of ``updated`` not in ``previous`` (new and changed keys;
    deletions are not reported). Nulls compare equal. One shuffle per side on all
    columns, with map-side de-duplication."""
    return updated.subtract(previous.select(*updated.columns))


def union_all(first: DataFrame, *rest: DataFrame) -> DataFrame:
    """Bag union by position."""
    out = first
    for df in rest:
        out = out.union(df)
    return out


def union_all_by_name(first: DataFrame, *rest: DataFrame) -> DataFrame:
    out = first
    for df in rest:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
