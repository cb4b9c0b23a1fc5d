"""Round trips through cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators.convert import df_to_cells
from tessera.operators.lookup import lookup_column

# Fixed values of the map round trip: the map adds the name under "NameKey"
# and three constant entries.
MAP_ENTRIES = [("testkey1", "testvalue1"), ("testkey2", "testvalue2"), ("testkey3", "testvalue3")]
NAME_KEY = "NameKey"


def with_map_column(df: DataFrame, name_col: str, map_col: str = "mapCol") -> DataFrame:
    """``t.*, map('NameKey', t.<name>, 'testkey1', 'testvalue1', ...) AS mapCol``."""
    args: list[Column] = [F.lit(NAME_KEY), F.col(name_col)]
    for k, v in MAP_ENTRIES:
        args += [F.lit(k), F.lit(v)]
    return df.select("*", F.create_map(*args).alias(map_col))


def map_round_trip(wide: DataFrame, *, key_col: str, name_col: str, family: str = "c",
                   key_name: str = "rowKeyId", store_path: str | None = None) -> DataFrame:
    """Wide rows + map column -> cells (stored at ``store_path`` when given)
    -> wide rows with one column per map key."""
    with_map = with_map_column(wide, name_col)
    cells = df_to_cells(with_map, family=family, key_col=key_col)
    if store_path is not None:
        C.write_cells(cells, store_path)
        cells = C.read_cells(wide.sparkSession, store_path)
    quals = [c for c in wide.columns if c.lower() != key_col.lower()] + [NAME_KEY] + [k for k, _ in MAP_ENTRIES]
    return C.scan_wide(cells, key_name=key_name, qualifiers=quals)


def enrich_and_store(df: DataFrame, *, lookup_col: str, dictionary_cells: DataFrame, row_key: str,
                     family: str = "c", num_salts: int = 6, limit: int | None = None,
                     suffix: str = "_lookup", key_col: str | None = None,
                     store_path: str | None = None) -> DataFrame:
    """Frame -> (optional top-n) -> lookup column -> salted put mutations,
    appended to the cell table at ``store_path`` when given (then read back)."""
    if limit is not None:
        df = df.limit(limit)
    enriched = lookup_column(df, lookup_col, dictionary_cells, row_key=row_key, family=family, suffix=suffix)
    cells = df_to_cells(enriched, family=family, num_salts=num_salts, key_col=key_col or df.columns[0])
    if store_path is None:
        return cells
    C.write_cells(cells, store_path)
    return C.read_cells(df.sparkSession, store_path)
