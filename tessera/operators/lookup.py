"""Dictionary lookup column.

The original looks each row's value up in one fixed store row, one remote
read per row from inside a UDF. Here the dictionary row is resolved once from
the cell log and joined: the row value, trimmed like ``String.trim``, is the
qualifier. Missing, null or empty lookups give null; an empty stored value
comes back as ``""``.

The dictionary is one row's cells, so it is broadcast only after its entry
count and text size are checked; above the limits the join shuffles (and AQE
may still broadcast from run-time sizes).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import jvm_trim
from tessera.operators import cells as C

DEFAULT_SUFFIX = "_lookup"
DEFAULT_BROADCAST_LIMIT = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def dictionary(cells: DataFrame, *, row_key: str, family: str) -> DataFrame:
    """``(qualifier, value)`` of one resolved row and family; the key filter reaches the scan."""
    return (C.scan(cells, start_row=row_key, families=[family])
            .filter(F.col("row_key") == F.lit(row_key))
            .select(F.col("qualifier").alias("_lk_qualifier"), F.col("value").alias("_lk_value")))


def lookup_column(df: DataFrame, column: str, cells: DataFrame, *, row_key: str, family: str,
                  suffix: str = DEFAULT_SUFFIX,
                  broadcast_limit: int | None = DEFAULT_BROADCAST_LIMIT,
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Add ``<column><suffix>`` holding the dictionary value for the row's value.

    The dictionary is broadcast only when one aggregate proves it small: at
    most ``broadcast_limit`` entries and ``broadcast_bytes`` of key and value
    text; otherwise the join shuffles.
    """
    dic = dictionary(cells, row_key=row_key, family=family)
    if broadcast_limit is not None:
        n, size = dic.agg(F.count(F.lit(1)),
                          F.coalesce(F.sum(F.octet_length("_lk_qualifier") + F.coalesce(
                              F.octet_length("_lk_value"), F.lit(0))), F.lit(0))).first()
        if n <= broadcast_limit and size <= broadcast_bytes:
            dic = F.broadcast(dic)
    probe = jvm_trim(F.col(f"`{column}`").cast("string"))
    joined = df.join(dic, (probe == F.col("_lk_qualifier")) & (probe != F.lit("")), "left")
    return joined.withColumnRenamed("_lk_value", f"{column}{suffix}").drop("_lk_qualifier")
