"""Conversions between ordinary DataFrames and cells."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.scalar import cell_text, history_key, salted_row_key
from tessera.operators import cells as C


def _entry_of_map(pos: int):
    # transform() inspects the lambda's arity, so the position is closed over.
    def entry(e: Column) -> Column:
        return F.struct(e["key"].cast("string").alias("qualifier"),
                        F.coalesce(e["value"].cast("string"), F.lit("")).alias("value"),
                        F.lit(pos).cast("bigint").alias("seq"))
    return entry


def _cell_entries(df: DataFrame, key_col: str, exclude: Sequence[str]) -> Column:
    """One array of ``(qualifier, value, seq)`` per row: a cell per scalar
    column, a cell per map entry; ``seq`` is the position, so a later column
    (or a map entry after it) wins over an earlier one of the same name."""
    skip = {key_col.lower(), *[e.lower() for e in exclude]}
    entry_t = "struct<qualifier:string,value:string,seq:bigint>"
    parts: list[Column] = []
    scalars: list[Column] = []
    for pos, field in enumerate(df.schema.fields):
        if field.name.lower() in skip:
            continue
        col = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.MapType):
            if scalars:
                parts.append(F.array(*scalars))
                scalars = []
            m = F.coalesce(col, F.create_map().cast(field.dataType))
            parts.append(F.transform(F.map_entries(m), _entry_of_map(pos)).cast(f"array<{entry_t}>"))
        else:
            scalars.append(F.struct(
                F.lit(field.name).alias("qualifier"),
                cell_text(col, field.dataType).alias("value"),
                F.lit(pos).cast("bigint").alias("seq")))
    if scalars:
        parts.append(F.array(*scalars))
    if not parts:
        return F.array().cast(f"array<{entry_t}>")
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def df_to_cells(df: DataFrame, *, family: str, key_col: str | None = None, num_salts: int = 0,
                ts: int | Column | None = None, exclude: Sequence[str] = ()) -> DataFrame:
    """A DataFrame as put mutations: one cell per non-key column, one per map entry.

    The key column (default: the first) is excluded case-insensitively and
    becomes the row key, salted when ``num_salts > 0``. Values are text, null
    as ``""``. A null map gives no cells; a null key fails the job. One generator, one pass, no union.
    Without ``ts`` the cells are newer than those of every earlier call.
    """
    key_col = key_col or df.columns[0]
    entries = _cell_entries(df, key_col, exclude)
    ts_c = ts if isinstance(ts, Column) else F.lit(C.next_version() if ts is None else ts)
    return C.keyed(
        df.select(salted_row_key(F.col(f"`{key_col}`"), num_salts).alias("row_key"),
                  ts_c.cast("bigint").alias("ts"), F.inline(entries))
        .select("row_key", F.lit(family).alias("family"), "qualifier", "ts", "seq",
                F.lit(C.PUT).alias("kind"), "value", F.lit(None).cast("bigint").alias("delta")),
        "row_key")


def put_dataframe(cells: DataFrame, df: DataFrame, *, family: str, num_salts: int = 0,
                  key_col: str | None = None, ts: int | Column | None = None) -> DataFrame:
    """Store sink of a DataFrame: salted cells appended to the log.

    An empty DataFrame appends nothing (no action is run to find out).
    """
    return C.append(cells, df_to_cells(df, family=family, key_col=key_col,
                                       num_salts=num_salts, ts=ts))


def history_rows(df: DataFrame, *, id_col: str, ts_col: str | Column, keep: Sequence[str],
                 key_name: str = "id_ts") -> DataFrame:
    """History rows keyed ``<id>:<yyyyMMddHHmmss>`` (time given, not read from the clock)."""
    ts_c = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return df.select(history_key(F.col(id_col), ts_c).alias(key_name), *keep)
