"""Inputs derived from the given tables for the registered queries.

Each function reads the parquet tables of one scale-factor folder and derives
the frame an operator works on (cells of ``customer``, mutations of
``events``, matching records from ``customer``...), so every query's work grows
with the tables. The DuckDB oracles in ``tessera.catalog`` derive the same
inputs in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.scalar import epoch_micros
from tessera.operators import cells as C
from tessera.operators.convert import df_to_cells
from tessera.session import scratch_path

FAMILY = "c"
CUSTOMER_QUALIFIERS = ["c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_cells(spark: SparkSession, sf_dir: str, *, num_salts: int = 0) -> DataFrame:
    """``customer`` as puts keyed by ``c_custkey`` in family ``c``."""
    return df_to_cells(table(spark, sf_dir, "customer"), family=FAMILY, key_col="c_custkey", ts=0,  # older than all events
                       num_salts=num_salts)


def event_version(events: DataFrame) -> dict:
    return {"ts": epoch_micros("ts"), "seq": F.col("event_id")}


def event_puts(spark: SparkSession, sf_dir: str, *, qualifier: Column | str | None = None,
               value: Column | str = "value") -> DataFrame:
    """``events`` as puts on (user, event_type) — or on a fixed qualifier."""
    ev = table(spark, sf_dir, "events")
    q = F.col("event_type") if qualifier is None else qualifier
    return C.mutations(ev, row_key="user_id", family=FAMILY, qualifier=q, value=value,
                       **event_version(ev))


# Fixed values of the segment dictionary: row "1" maps every segment to "-ALL-";
# row "2" maps a segment to "-" + its first four letters + "-".
DICT_ALL_VALUE = "-ALL-"


def segment_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionary cells: qualifiers are the market segments found in ``customer``."""
    segs = table(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    row1 = C.mutations(segs, row_key=F.lit("1"), family=FAMILY, qualifier=F.col("c_mktsegment"),
                       value=F.lit(DICT_ALL_VALUE))
    row2 = C.mutations(segs, row_key=F.lit("2"), family=FAMILY, qualifier=F.col("c_mktsegment"),
                       value=F.concat(F.lit("-"), F.upper(F.substring("c_mktsegment", 1, 4)), F.lit("-")))
    return C.append(row1, row2)


def lookup_probe(customer: DataFrame) -> DataFrame:
    """Customer rows with a probe column that is padded, sometimes unknown, sometimes null."""
    probe = (F.when(F.col("c_nationkey") == 0, F.lit("UNKNOWN"))
             .when(F.col("c_nationkey") == 1, F.lit(None).cast("string"))
             .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit("\t"))))
    return customer.select("c_custkey", "c_mktsegment", probe.alias("segment_probe"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching records derived from ``customer`` with controlled collisions and nulls."""
    c = table(spark, sf_dir, "customer")
    band = F.floor(F.col("c_acctbal") / 1000).cast("bigint").cast("string")
    return c.select(
        F.col("c_custkey").alias("app_id"),
        F.initcap("c_mktsegment").alias("first_name"),
        F.when(F.col("c_nationkey") == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit("-"), band)).alias("last_name"),
        F.lower(F.concat(F.col("c_mktsegment"), F.lit("."),
                         F.floor(F.col("c_acctbal") / 100).cast("bigint").cast("string"),
                         F.lit("@example.com"))).alias("email"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit("-"),
                            F.floor("c_acctbal").cast("bigint").cast("string"))).alias("phone"),
        F.when(F.col("c_mktsegment") == "MACHINERY", F.lit(None).cast("string"))
        .otherwise(F.concat(F.col("c_nationkey").cast("string"), F.lit(" "), F.col("c_mktsegment"),
                            F.lit(" St "), band)).alias("address"),
    )


def stored(cells: DataFrame, name: str) -> DataFrame:
    """The log written to the scratch folder and read back, as a stored table is read."""
    path = scratch_path(cells.sparkSession, name)
    C.write_cells(cells, path)
    return C.read_cells(cells.sparkSession, path)


# Fixed test binding of check-and-put: the status a new event type expects to
# replace (null = the status cell must be absent).
FUNNEL_EXPECTS = [("signup", None), ("view", "signup"), ("click", "view"),
                  ("purchase", "click"), ("error", "purchase")]


def funnel_expected(event_type: Column) -> Column:
    out = F.lit(None).cast("string")
    for new, exp in FUNNEL_EXPECTS:
        out = F.when(event_type == F.lit(new), F.lit(exp).cast("string")).otherwise(out)
    return out


def day_step(ts: Column) -> Column:
    """Start of the day, zone-free."""
    return ts.cast("date").cast("timestamp_ntz")
