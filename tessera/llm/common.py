"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tessera.session import scratch_path, ship_package

#: The white space of every contract here: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\f\r"
#: One word, as a regular expression of both Spark and DuckDB.
WORD = "[^\\x20\\x09-\\x0D]+"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts lineage in a way that survives lost executors, and lets later joins
    see plain scans with known sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def discard(*steps: DataFrame) -> None:
    """Delete the files of ``materialise``d steps that nothing reads any more."""
    for df in steps:
        path = df.__dict__.get("_written_to")
        if path is None:
            continue
        sc = df.sparkSession.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def arrow_rows(spark: SparkSession, most: int) -> Iterator[None]:
    """Hand Python tasks at most so many rows at once, in the jobs that are run (not only planned) meanwhile."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, now = spark.conf.get(name, None), int(spark.conf.get(name))
    spark.conf.set(name, str(min(now, most) if now > 0 else most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def ship(df: DataFrame) -> None:
    """Make this package importable in the Python workers of ``df``'s session."""
    ship_package(df.sparkSession)


def text_or_empty(col: Column | str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("string")


def small(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``most_rows`` rows, else as it is.

    ``df`` should be materialised: its rows are counted (from the files'
    footers). Beyond the bound the join is left to a shuffle.
    """
    return F.broadcast(df) if df.count() <= most_rows else df


def cut_spans(lines: Column, spans: Column, separator: str = "\n") -> Column:
    """The text of ``lines`` (array) without the line spans [first, last] in ``spans``, an array sorted by ``first``.

    Takes the slices between the spans, so its work is linear in the lines.
    Both should be plain columns: an expression would be computed again for
    every slice.
    """
    n = F.size(spans)

    def piece(i: Column) -> Column:
        begin = F.when(i > 0, F.get(spans, i - 1)["last"] + 1).otherwise(0)
        end = F.when(i < n, F.get(spans, i)["first"]).otherwise(F.size(lines))
        return F.slice(lines, begin + 1, F.greatest(end - begin, F.lit(0)))

    return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), n), piece)), separator)


def merged_spans(covered: DataFrame, key: list[str], extra: dict[str, str] | None = None) -> DataFrame:
    """Merge touching line spans (key..., first, last) of each document into ``spans``.

    ``extra`` names more columns to keep of each span, with "min" or "max".
    What is gathered for a key is at most one document's lines.
    """
    from pyspark.sql import Window as W

    order = W.partitionBy(*key).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    islands = covered.withColumn("opens", opens).withColumn("island", F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0)))
    more = [getattr(F, how)(c).alias(c) for c, how in (extra or {}).items()]
    merged = islands.groupBy(*key, "island").agg(F.min("first").alias("first"), F.max("last").alias("last"), *more)
    return merged.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("first", "last", *(extra or {})))).alias("spans"))
