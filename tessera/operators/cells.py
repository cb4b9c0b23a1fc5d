"""The cell table: a wide-column store held as an append-only mutation log.

Schema (one row per mutation)::

    row_key STRING, family STRING, qualifier STRING, ts BIGINT, seq BIGINT,
    kind STRING, value STRING, delta BIGINT

``(ts, seq)`` orders the mutations of a cell totally. ``kind`` is one of
``put``, ``increment``, ``delete_cell``, ``delete_family``, ``delete_row``.
Family deletes leave ``qualifier`` null; row deletes leave ``family`` null too.

Reading means *resolving* the log: per cell, the newest put wins; a tombstone
hides every put and increment at or before its own ``ts``, whatever their
``seq``; increments after the newest live put (or tombstone) are summed onto it. Resolution is a hash
aggregate per cell plus equi joins against the (usually tiny, AQE-broadcast)
family and row tombstones: no per-key collection, no window over a row, so a hot
row or a hot counter is combined map-side and split by AQE's skew handling.
"""

from __future__ import annotations

import math
import re
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUT = "put"
INCREMENT = "increment"
DELETE_CELL = "delete_cell"
DELETE_FAMILY = "delete_family"
DELETE_ROW = "delete_row"
KINDS = (PUT, INCREMENT, DELETE_CELL, DELETE_FAMILY, DELETE_ROW)

CELL_SCHEMA = T.StructType([
    T.StructField("row_key", T.StringType(), False),
    T.StructField("family", T.StringType(), True),
    T.StructField("qualifier", T.StringType(), True),
    T.StructField("ts", T.LongType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
    T.StructField("delta", T.LongType(), True),
])
CELL_COLUMNS = [f.name for f in CELL_SCHEMA.fields]
RESOLVED_COLUMNS = ["row_key", "family", "qualifier", "value", "ts", "seq"]


def _lit_or_col(v, *, literal_str: bool) -> Column:
    """Column as is; a Python str is a literal or a column name as asked."""
    if isinstance(v, Column):
        return v
    if isinstance(v, str) and not literal_str:
        return F.col(v)
    return F.lit(v)


def version(ts: Column | str = "ts", seq: Column | str = "seq") -> Column:
    """The total order of mutations of one cell."""
    ts_c = F.col(ts) if isinstance(ts, str) else ts
    seq_c = F.col(seq) if isinstance(seq, str) else seq
    return F.struct(ts_c.alias("ts"), seq_c.alias("seq"))


def empty_cells(spark: SparkSession) -> DataFrame:
    """An empty log as a constant-false relation, which the optimizer prunes away."""
    cols = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS {f.name}" for f in CELL_SCHEMA.fields)
    return spark.sql(f"SELECT {cols} WHERE 1 = 0")


def mutations(df: DataFrame, *, row_key, family=None, qualifier=None, value=None,
              kind: str | Column = PUT, ts=0, seq=0, delta=None) -> DataFrame:
    """Build mutation rows from user rows (the ``T => Mutation`` function).

    ``row_key`` and ``value`` take a Column or a column name; ``family``,
    ``qualifier`` and ``kind`` take a Column or a literal string; ``ts``,
    ``seq`` and ``delta`` take a Column or a literal number.
    """
    return df.select(
        _lit_or_col(row_key, literal_str=False).cast("string").alias("row_key"),
        _lit_or_col(family, literal_str=True).cast("string").alias("family"),
        _lit_or_col(qualifier, literal_str=True).cast("string").alias("qualifier"),
        _lit_or_col(ts, literal_str=False).cast("bigint").alias("ts"),
        _lit_or_col(seq, literal_str=False).cast("bigint").alias("seq"),
        _lit_or_col(kind, literal_str=True).cast("string").alias("kind"),
        _lit_or_col(value, literal_str=False).cast("string").alias("value"),
        _lit_or_col(delta, literal_str=False).cast("bigint").alias("delta"),
    )


def keyed(rows: DataFrame, *parts: str) -> DataFrame:
    """``rows`` whose key ``parts`` (all of row key, family and qualifier by default) may not be null.

    Reading a row without one fails the job.
    """
    parts = parts or ("row_key", "family", "qualifier")
    whole = F.lit(True)
    for c in parts:
        whole = whole & F.col(c).isNotNull()
    said = F.concat(F.lit("not a mutation: null in "), F.to_json(F.struct(*[F.coalesce(c, F.lit("null")).alias(c) for c in parts])))
    return rows.select(*[F.when(whole, F.col(c)).otherwise(F.raise_error(said)).alias(c) if c == "row_key" else F.col(c) for c in CELL_COLUMNS])


def append(cells: DataFrame, *more: DataFrame) -> DataFrame:
    """Append mutation logs (bag union by name)."""
    out = cells.select(*CELL_COLUMNS)
    for m in more:
        out = out.unionByName(m.select(*CELL_COLUMNS))
    return out


# --------------------------------------------------------------------------- resolve

_RESOLVE_SQL = """
WITH log AS (
  SELECT row_key, family, qualifier, ts, seq, kind, value, delta FROM {cells} WHERE row_key IS NOT NULL),
per_cell AS (
  SELECT row_key, family, qualifier,
         max(CASE WHEN kind = 'put' THEN struct(ts, seq, value) END) AS top,
         max(CASE WHEN kind = 'delete_cell' THEN struct(ts, 9223372036854775807L AS seq) END) AS tomb_cell,
         max(CASE WHEN kind = 'increment' THEN struct(ts, seq) END) AS last_inc
  FROM log
  WHERE kind IN ('put', 'increment', 'delete_cell') AND family IS NOT NULL AND qualifier IS NOT NULL
  GROUP BY row_key, family, qualifier),
fam AS (
  SELECT row_key, family, max(struct(ts, 9223372036854775807L AS seq)) AS tomb_family
  FROM log WHERE kind = 'delete_family' AND family IS NOT NULL GROUP BY row_key, family),
rowt AS (
  SELECT row_key, max(struct(ts, 9223372036854775807L AS seq)) AS tomb_row FROM log WHERE kind = 'delete_row' GROUP BY row_key),
incs AS (
  SELECT row_key, family, qualifier, struct(ts, seq) AS ver, delta
  FROM log WHERE kind = 'increment' AND family IS NOT NULL AND qualifier IS NOT NULL),
inc_keys AS (SELECT DISTINCT row_key, family, qualifier FROM incs),
inc_cell_base AS (
  SELECT l.row_key, l.family, l.qualifier,
         max(struct(l.ts, CASE WHEN l.kind = 'put' THEN l.seq ELSE 9223372036854775807L END AS seq)) AS cell_base
  FROM log l LEFT SEMI JOIN inc_keys k
    ON l.row_key = k.row_key AND l.family = k.family AND l.qualifier = k.qualifier
  WHERE l.kind IN ('put', 'delete_cell')
  GROUP BY l.row_key, l.family, l.qualifier),
inc_base AS (
  SELECT row_key, family, qualifier, greatest(b.cell_base, f.tomb_family, r.tomb_row) AS base_ver
  FROM inc_keys k
  LEFT JOIN inc_cell_base b USING (row_key, family, qualifier)
  LEFT JOIN fam f USING (row_key, family)
  LEFT JOIN rowt r USING (row_key)),
inc_sums AS (
  SELECT row_key, family, qualifier, sum(i.delta) AS inc_sum
  FROM incs i JOIN inc_base b USING (row_key, family, qualifier)
  WHERE b.base_ver IS NULL OR i.ver > b.base_ver
  GROUP BY row_key, family, qualifier),
state AS (
  SELECT row_key, family, qualifier, p.top, p.last_inc, s.inc_sum,
         CASE WHEN p.top IS NOT NULL THEN struct(p.top.ts AS ts, p.top.seq AS seq) END AS put_ver,
         greatest(p.tomb_cell, f.tomb_family, r.tomb_row) AS tomb
  FROM per_cell p
  LEFT JOIN fam f USING (row_key, family)
  LEFT JOIN rowt r USING (row_key)
  LEFT JOIN inc_sums s USING (row_key, family, qualifier)),
flagged AS (
  SELECT *, put_ver IS NOT NULL AND (tomb IS NULL OR put_ver > tomb) AS put_live,
         inc_sum IS NOT NULL AS counted
  FROM state)
SELECT row_key, family, qualifier,
       CASE WHEN counted
            THEN CAST((CASE WHEN put_live THEN coalesce(try_cast(top.value AS BIGINT), 0) ELSE 0 END) + inc_sum
                      AS STRING)
            ELSE top.value END AS value,
       CASE WHEN counted THEN last_inc.ts ELSE top.ts END AS ts,
       CASE WHEN counted THEN last_inc.seq ELSE top.seq END AS seq
FROM flagged
WHERE put_live OR counted
"""


def resolve(cells: DataFrame) -> DataFrame:
    """Current state of every live cell: ``row_key, family, qualifier, value, ts, seq``.

    Plan: one aggregate per cell (newest put, newest cell tombstone, newest
    increment) joined with the newest family and row tombstones. Counters
    are summed on a separate branch that only touches cells having
    increments: their base version (newest put or covering tombstone) is
    aggregated from a semi-joined slice of the log, so the main aggregate is
    computed once and a log without increments costs nothing extra. Written
    as one SQL statement so the whole plan is analysed once.
    """
    return cells.sparkSession.sql(_RESOLVE_SQL, cells=cells.select(*CELL_COLUMNS))


# --------------------------------------------------------------------------- scans

def restrict(cells: DataFrame, *, start_row: str | None = None, stop_row: str | None = None,
             families: Sequence[str] | None = None, qualifiers: Sequence[str] | None = None,
             min_ts: int | None = None, max_ts: int | None = None) -> DataFrame:
    """Filters of a scan applied to the *log*, before resolving.

    Key range ``[start_row, stop_row)`` in byte order and family / qualifier
    lists commute with resolution as long as the tombstones that cover the
    kept cells stay, so they are pushed to the Parquet scan. ``max_ts`` limits
    puts and increments; tombstones always apply. ``min_ts`` cannot be applied
    to the log, where it would cut the older part off a counter's total:
    :func:`scan` applies it to the resolved cells.
    """
    out = cells
    key = F.col("row_key")
    if start_row is not None:
        out = out.filter(key >= F.lit(start_row))
    if stop_row is not None:
        out = out.filter(key < F.lit(stop_row))
    kind = F.col("kind")
    if families is not None:
        out = out.filter(F.col("family").isin(list(families)) | (kind == DELETE_ROW))
    if qualifiers is not None:
        out = out.filter(F.col("qualifier").isin(list(qualifiers)) | kind.isin(DELETE_FAMILY, DELETE_ROW))
    if max_ts is not None:
        out = out.filter((F.col("ts") < F.lit(max_ts)) | kind.isin(DELETE_CELL, DELETE_FAMILY, DELETE_ROW))
    return out


def newest_versions(cells: DataFrame, versions: int) -> DataFrame:
    """The log with the newest ``versions`` puts of each cell; other mutations stay.

    Spark limits a ranked window's groups before the shuffle, so at most
    ``versions`` puts of a cell leave each task.
    """
    newest = Window.partitionBy("row_key", "family", "qualifier").orderBy(F.desc("ts"), F.desc("seq"), F.desc("value"))
    log = cells.select(*CELL_COLUMNS)
    puts = log.filter(F.col("kind") == PUT).withColumn("_place", F.row_number().over(newest))
    return append(puts.filter(F.col("_place") <= versions), log.filter(F.col("kind") != PUT))


def scan(cells: DataFrame, *, versions: int | None = None, **restriction) -> DataFrame:
    """Resolved cells of a scan (key range, families, qualifiers, time range).

    With ``versions`` a cell keeps its newest so many puts, and ``max_ts`` sees
    those alone. A log compacted with the same number gives the same cells.
    """
    if versions is not None:
        in_time = {k: v for k, v in restriction.items() if k in ("min_ts", "max_ts")}
        cells = newest_versions(restrict(cells, **{k: v for k, v in restriction.items() if k not in in_time}), versions)
    out = resolve(restrict(cells, **restriction))
    least = restriction.get("min_ts")
    return out if least is None else out.filter(F.col("ts") >= F.lit(least))


def scan_map(cells: DataFrame, mapping, **restriction) -> DataFrame:
    """Scan with a user mapping: a list of Columns over the resolved cells, or a
    function ``DataFrame -> DataFrame``."""
    resolved = scan(cells, **restriction)
    if callable(mapping):
        return mapping(resolved)
    return resolved.select(*mapping)


def scan_rows(cells: DataFrame, **restriction) -> DataFrame:
    """One row per key with its sorted list of ``(family, qualifier, value)``.

    This is the nested form of a row; its size is the width of one row. For
    rows of unbounded width use :func:`scan` (one output row per cell).
    """
    return (
        scan(cells, **restriction)
        .groupBy("row_key")
        .agg(F.array_sort(F.collect_list(F.struct("family", "qualifier", "value"))).alias("cells"))
    )


def scan_ranges(cells: DataFrame, split_keys: Sequence[str], **restriction) -> DataFrame:
    """Resolved cells tagged with the key range they fall in.

    ``split_keys`` play the role of region boundaries: range ``i`` holds keys
    in ``[split_keys[i-1], split_keys[i])``. Parquet row-group statistics
    prune the log by key when it is stored range-partitioned
    (:func:`write_cells`).
    """
    splits = sorted(split_keys, key=lambda k: k.encode())  # byte order, as Spark compares text
    step = max(1, math.isqrt(len(splits)))
    texts = lambda keys: F.lit(list(keys)) if keys else F.array().cast("array<string>")
    at_or_before = lambda keys: F.size(F.filter(keys, lambda s: s <= F.col("row_key")))
    # two steps: among every step-th key, then among the keys of that stretch
    coarse = at_or_before(texts(splits[step - 1::step]))
    out = scan(cells, **restriction).withColumn("_stretch", coarse)
    within = at_or_before(F.slice(texts(splits), F.col("_stretch") * step + 1, F.lit(step)))
    return out.withColumn("range_id", (F.col("_stretch") * step + within).cast("int")).drop("_stretch")


def to_map(resolved: DataFrame, *, key_name: str = "row_key") -> DataFrame:
    """Resolved cells to one row per key with a map ``cells`` of ``family:qualifier`` to value.

    The wide form for unknown qualifiers: no job looks for them, and no list of
    them reaches the driver. A row's map is as wide as the row.
    """
    entry = F.struct(F.concat_ws(":", "family", "qualifier").alias("name"), F.col("value"))
    return resolved.groupBy(F.col("row_key").alias(key_name)).agg(F.map_from_entries(F.collect_list(entry)).alias("cells"))


def to_wide(resolved: DataFrame, *, key_name: str = "row_key",
            qualifiers: Sequence[str] | None = None, by_family: bool = False) -> DataFrame:
    """Resolved cells to a wide DataFrame: the key, then one column per qualifier.

    With ``by_family`` the ``qualifiers`` and columns are named
    ``family:qualifier``. Without, a qualifier that several families of one row
    hold fails the job: families are never merged. A cell that is absent reads as null.
    Without ``qualifiers`` the wide form is that of :func:`to_map`.
    """
    if qualifiers is None:
        return to_map(resolved, key_name=key_name)
    if by_family:
        resolved = resolved.withColumn("qualifier", F.concat_ws(":", "family", "qualifier"))
        value = F.first("value")
    else:
        several = F.concat(F.lit("several families hold "), F.first("qualifier"), F.lit("; use by_family"))
        value = F.when(F.min("family") == F.max("family"), F.first("value")).when(F.max("family").isNotNull(), F.raise_error(several))
    wide = resolved.groupBy("row_key").pivot("qualifier", list(qualifiers)).agg(value)
    return wide.select(F.col("row_key").alias(key_name), *[F.col(f"`{q}`") for q in qualifiers])


def scan_wide(cells: DataFrame, *, key_name: str = "row_key", qualifiers: Sequence[str] | None = None,
              by_family: bool = False, **restriction) -> DataFrame:
    plain = qualifiers
    if qualifiers is not None and by_family:
        restriction.setdefault("families", sorted({q.split(":", 1)[0] for q in qualifiers}))
        plain = sorted({q.split(":", 1)[1] for q in qualifiers})
    return to_wide(scan(cells, qualifiers=plain, **restriction),
                   key_name=key_name, qualifiers=qualifiers, by_family=by_family)


# --------------------------------------------------------------------------- gets

#: Up to this many requested keys become literals that the Parquet reader checks.
LITERAL_KEYS = 1_000


def requested(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """The log of the rows in ``keys`` (one column ``row_key``).

    A few keys go into the scan as literals; with more, their least and
    greatest do and a semi join leaves the rest. Files and row groups of a stored log
    (sorted by key, with Bloom filters on it) are skipped by both. Looks at the keys now, at most
    ``LITERAL_KEYS`` of them on the driver.
    """
    found = keys.filter(F.col("row_key").isNotNull()).distinct()
    few = [r[0] for r in found.limit(LITERAL_KEYS + 1).collect()]
    if len(few) <= LITERAL_KEYS:
        return cells.filter(F.col("row_key").isin(few)) if few else cells.filter(F.lit(False))
    low, high = found.agg(F.min("row_key"), F.max("row_key")).first()
    return cells.filter((F.col("row_key") >= low) & (F.col("row_key") <= high)).join(found, "row_key", "left_semi")


def bulk_get(cells: DataFrame, keys: DataFrame, key_col: str, *, columns: str | None = None,
             keep_absent: bool = False, **restriction) -> DataFrame:
    """Cells of the requested keys: one output row per (request, cell).

    Duplicate requests are kept. ``columns`` names an array column of
    (family, qualifier) structs that lists what a request wants; a null
    qualifier stands for the whole family, a null or empty array for the row. A request
    that finds nothing yields nothing, or with ``keep_absent`` one row without a cell.
    A small request set is broadcast by AQE at run time; a large one shuffles.
    """
    req = keys.withColumn("row_key", F.col(f"`{key_col}`").cast("string"))
    resolved = scan(requested(cells, req.select("row_key")), **restriction)  # only requested rows are resolved
    how = "left" if keep_absent else "inner"
    if columns is None:
        return req.join(resolved, "row_key", how)
    wants = F.col(f"`{columns}`")
    listed = F.exists(wants, lambda w: (w["family"] == F.col("_cell.family")) & (w["qualifier"].isNull() | (w["qualifier"] == F.col("_cell.qualifier"))))
    packed = resolved.select("row_key", F.struct("family", "qualifier", "value", "ts", "seq").alias("_cell"))
    on = (F.col("row_key") == F.col("_key")) & (wants.isNull() | (F.size(wants) == 0) | listed)
    return req.join(packed.withColumnRenamed("row_key", "_key"), on, how).select("row_key", *[c for c in req.columns if c != "row_key"], "_cell.*")


def bulk_get_wide(cells: DataFrame, keys: DataFrame, key_col: str, *,
                  qualifiers: Sequence[str], key_name: str | None = None) -> DataFrame:
    """Requested keys as wide rows; a key without cells gives an all-null row.

    The key column name is a parameter; duplicate requests are kept.
    """
    req = keys.select(F.col(f"`{key_col}`").cast("string").alias("row_key"))
    wide = scan_wide(requested(cells, req), qualifiers=qualifiers)
    out = req.join(wide, "row_key", "left")
    return out.withColumnRenamed("row_key", key_name or key_col)


def point_get(cells: DataFrame, requests: DataFrame, *, row_col: str, family: str | Column,
              qualifier_col: str) -> DataFrame:
    """Set-oriented single-cell gets: ``value`` of (row, family, qualifier) per
    request row, null when absent. The qualifier is trimmed like the JVM does.
    Only requested rows, and of a literal family only its cells, are resolved."""
    from tessera.functions.scalar import jvm_trim

    fam = _lit_or_col(family, literal_str=True)
    req = requests.withColumn("_rk", F.col(row_col).cast("string")) \
        .withColumn("_fam", fam).withColumn("_q", jvm_trim(F.col(qualifier_col)))
    log = requested(cells, req.select(F.col("_rk").alias("row_key")))
    res = scan(log, families=[family] if isinstance(family, str) else None)
    res = res.select(F.col("row_key").alias("_rk"), F.col("family").alias("_fam"),
                     F.col("qualifier").alias("_q"), F.col("value"))
    return req.join(res, ["_rk", "_fam", "_q"], "left").drop("_rk", "_fam", "_q")


def latest_value(cells: DataFrame, *, family: str, qualifier: str) -> DataFrame:
    """Newest value of one column per row (``getColumnLatestCell``)."""
    return scan(cells, families=[family], qualifiers=[qualifier]).select("row_key", "value")


# --------------------------------------------------------------------------- mutations

_last_version = 0


def next_version() -> int:
    """A version newer than all that this process gave before: the time in microseconds, or one more."""
    global _last_version
    _last_version = max(time.time_ns() // 1000, _last_version + 1)
    return _last_version


def _stamped(mutation: dict) -> dict:
    """Mutations without a version get the next one, so a later call wins."""
    return mutation if mutation.get("ts") is not None else {**mutation, "ts": next_version()}


def _addressed(mutation: dict) -> dict:
    """Arguments that name a cell."""
    for part in ("row_key", "family", "qualifier"):
        if mutation.get(part) is None:
            raise ValueError(f"not a mutation: {part} is null")
    return mutation


def put(cells: DataFrame, df: DataFrame, **mutation) -> DataFrame:
    """Bulk put: append put mutations built from ``df``; without ``ts``, newer than every earlier call."""
    mutation = _stamped(_addressed(mutation))
    return append(cells, keyed(mutations(df, kind=PUT, **mutation)))


def increment(cells: DataFrame, df: DataFrame, *, delta=1, **mutation) -> DataFrame:
    """Bulk increment of 64-bit counters; without ``ts``, newer than every earlier call."""
    mutation = _stamped(_addressed(mutation))
    return append(cells, keyed(mutations(df, kind=INCREMENT, delta=delta, **mutation)))


def delete(cells: DataFrame, df: DataFrame, *, scope: str = "row", **mutation) -> DataFrame:
    """Bulk delete of rows, families or cells (tombstones)."""
    mutation = _stamped(mutation)
    kind = {"row": DELETE_ROW, "family": DELETE_FAMILY, "cell": DELETE_CELL}[scope]
    if scope == "row":
        mutation["family"] = None
        mutation["qualifier"] = None
    elif scope == "family":
        mutation["qualifier"] = None
    parts = {"row": ("row_key",), "family": ("row_key", "family"), "cell": ()}[scope]
    return append(cells, keyed(mutations(df, kind=kind, **mutation), *parts))


def mutate(cells: DataFrame, mutation_rows: DataFrame) -> DataFrame:
    """Batched mutations of any kind: rows that already carry ``kind``.

    A row of an unknown kind, or without the key parts its kind needs, fails
    the job when it is read.
    """
    kind = F.col("kind")
    keyed = F.col("row_key").isNotNull() & (kind.isin(DELETE_ROW) | F.col("family").isNotNull()) & (
        kind.isin(DELETE_ROW, DELETE_FAMILY) | F.col("qualifier").isNotNull())
    known = kind.isin(PUT, INCREMENT, DELETE_CELL, DELETE_FAMILY, DELETE_ROW)
    checked = F.when(known & keyed, kind).otherwise(
        F.raise_error(F.concat(F.lit("not a mutation: kind "), F.coalesce(kind, F.lit("null")),
                               F.lit(", row key "), F.coalesce("row_key", F.lit("null")))))
    return append(cells, mutation_rows.withColumn("kind", checked))


# --------------------------------------------------------------------------- storage

def write_cells(cells: DataFrame, path: str, *, mode: str = "append",
                num_partitions: int | None = None) -> None:
    """Store a mutation log in one folder per kind, range-partitioned and sorted by key.

    Sorted files carry tight min/max statistics per row group, so key-range
    scans and gets prune at the Parquet reader, which is what region splits
    did for the store. The folders tell :func:`read_cells` which kinds there are.
    """
    order = ["row_key", "family", "qualifier", "ts", "seq"]
    out = cells.select(*CELL_COLUMNS)
    # Ranges over the whole cell key: a hot row spreads over several files
    # instead of one, while the files stay globally ordered by row key.
    out = out.repartitionByRange(num_partitions, *order) if num_partitions \
        else out.repartitionByRange(*order)
    (out.sortWithinPartitions("kind", *order).write.mode(mode).partitionBy("kind")
     .option("parquet.bloom.filter.enabled#row_key", "true").parquet(path))


def _by_kind(log: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """A log partitioned by ``kind`` as a union of one branch for each kind there is.

    The kind is a literal in each branch, so the optimizer drops every part of
    :func:`resolve` that looks for kinds which the log doesn't hold.
    """
    spark = log.sparkSession
    branches = [log.filter(F.col("kind") == k).withColumn("kind", F.lit(k)) for k in KINDS if k in kinds]
    return append(*branches) if branches else empty_cells(spark)


_KIND_FOLDER = re.compile(r"/kind=([a-z_]+)/")


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """A stored log; one stored by kind has a branch for each kind in it."""
    log = spark.read.schema(CELL_SCHEMA).parquet(path)
    files = log.inputFiles()
    kinds = {m.group(1) for f in files if (m := _KIND_FOLDER.search(f))}
    if not kinds or not all(_KIND_FOLDER.search(f) for f in files):
        return log.select(*CELL_COLUMNS)
    return _by_kind(log, kinds)


def _read_files(spark: SparkSession, files: Sequence[str]) -> DataFrame:
    """The mutations in the given files of a log, stored by kind or not."""
    kinds: dict[str | None, list[str]] = {}
    for f in files:
        found = _KIND_FOLDER.search(f)
        kinds.setdefault(found.group(1) if found else None, []).append(f)
    stored = T.StructType([f for f in CELL_SCHEMA.fields if f.name != "kind"])
    parts = [spark.read.schema(CELL_SCHEMA).parquet(*names) if kind is None
             else spark.read.schema(stored).parquet(*names).withColumn("kind", F.lit(kind)) for kind, names in kinds.items()]
    return append(*parts)


def read_pinned(spark: SparkSession, path: str, pin: str) -> DataFrame:
    """A stored log as of the first call with this ``pin``, a folder that keeps the names of the files read."""
    pinned = spark.read.schema("file string").option("ignoreMissingFiles", "true")
    try:
        files = [r.file for r in pinned.parquet(pin).collect()]
    except AnalysisException:  # no such folder: the first call
        files = sorted(read_cells(spark, path).inputFiles())
        spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).write.mode("overwrite").parquet(pin)
    return _read_files(spark, files) if files else empty_cells(spark)


def compact(cells: DataFrame, *, versions: int = 1, settled_ts: int | None = None) -> DataFrame:
    """The log without rows that no later or late mutation can make count again.

    Kept are, for each cell, its newest ``versions`` puts as far as no tombstone
    covers them, its increments newer than the newest put or covering
    tombstone, and the newest tombstone of each cell, family and row. Resolving
    what is kept together with *any* other mutations, also older ones that
    arrive late, equals resolving everything. A read at an earlier time
    (``max_ts``) reaches back as many versions as are kept: ``scan`` with the same
    ``versions`` gives the same cells before and after.

    Nothing older than ``settled_ts`` may arrive any more: with it, a cell's kept
    increments up to then become one.
    """
    log = cells.select(*CELL_COLUMNS)
    ver = F.struct("ts", "seq")
    key = ["row_key", "family", "qualifier"]
    scopes = ((DELETE_CELL, key), (DELETE_FAMILY, key[:2]), (DELETE_ROW, key[:1]))
    tombs = [log.filter(F.col("kind") == kind).groupBy(*by).agg(F.max(ver).alias("v")) for kind, by in scopes]
    kept = [t.select(*[(F.col(c) if c in by else F.lit(None).cast("string").alias(c)) for c in key],
                     F.col("v.ts").alias("ts"), F.col("v.seq").alias("seq"), F.lit(kind).alias("kind"),
                     F.lit(None).cast("string").alias("value"), F.lit(None).cast("bigint").alias("delta"))
            for t, (kind, by) in zip(tombs, scopes)]
    covers = [t.select(*by, F.col("v.ts").alias(f"t{i}")) for i, (t, (_, by)) in enumerate(zip(tombs, scopes))]
    covered = F.greatest("t0", "t1", "t2")

    def with_tombs(df: DataFrame) -> DataFrame:
        for cover, (_, by) in zip(covers, scopes):
            df = df.join(cover, by, "left")
        return df

    puts = log.filter(F.col("kind") == PUT)
    live = with_tombs(newest_versions(puts, versions)).filter(covered.isNull() | (F.col("ts") > covered)).select(*CELL_COLUMNS)
    newest = puts.groupBy(*key).agg(F.max(ver).alias("put_ver"))
    incs = with_tombs(log.filter(F.col("kind") == INCREMENT).join(newest, key, "left"))
    open_incs = incs.filter((covered.isNull() | (F.col("ts") > covered)) & (F.col("put_ver").isNull() | (ver > F.col("put_ver")))).select(*CELL_COLUMNS)
    if settled_ts is not None:
        old = F.col("ts") <= settled_ts
        summed = (open_incs.filter(old).groupBy(*key).agg(F.max(ver).alias("v"), F.sum("delta").alias("delta"))
                  .select(*key, F.col("v.ts").alias("ts"), F.col("v.seq").alias("seq"), F.lit(INCREMENT).alias("kind"),
                          F.lit(None).cast("string").alias("value"), "delta"))
        open_incs = append(open_incs.filter(~old), summed)
    return append(live, open_incs, *kept)


def create_table(spark: SparkSession, name: str, location: str | None = None, *, buckets: int = 16) -> None:
    """Create an (empty) cell table in the catalog; an existing one is kept.

    Partitioned by kind, and bucketed by row key so that resolving it, and gets
    from it, need no exchange of the stored side. Choose ``buckets`` for the table's size.
    """
    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in [*[f for f in CELL_SCHEMA.fields if f.name != "kind"], CELL_SCHEMA["kind"]])
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet PARTITIONED BY (kind) "
              f"CLUSTERED BY (row_key) SORTED BY (row_key) INTO {int(buckets)} BUCKETS{loc}")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a cell table; an absent one is tolerated."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def insert_cells(spark: SparkSession, name: str, cells: DataFrame) -> None:
    """Append mutations to a catalog cell table; one exchange by row key keeps a file per bucket."""
    buckets = int(spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Num Buckets'").first()["data_type"])
    cells.select(*[c for c in CELL_COLUMNS if c != "kind"], "kind").repartition(buckets, "row_key").write.insertInto(name)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """The log in a catalog cell table, with a branch for each kind in it."""
    kinds = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]  # five at most
    return _by_kind(spark.table(name), kinds)


def compact_to(log: DataFrame, path: str, *, versions: int = 1, settled_ts: int | None = None) -> list[str]:
    """Write the compacted form of a *stored* log; returns the log files it covers.

    Those files can be dropped, or left to :func:`read_compacted` to skip. The
    list names files, not versions, so a mutation that arrives later with an
    older version is still read.
    """
    files = sorted(log.inputFiles())
    if not files:
        raise ValueError("only a log read from files can be compacted")
    write_cells(compact(log, versions=versions, settled_ts=settled_ts), path, mode="overwrite")
    return files


def read_compacted(spark: SparkSession, base_path: str, log: DataFrame, covered: Sequence[str]) -> DataFrame:
    """A compacted base plus the mutations in the log's files that it doesn't cover."""
    gone = set(covered)
    new = [f for f in log.inputFiles() if f not in gone]
    base = read_cells(spark, base_path)
    return append(base, _read_files(spark, new)) if new else base
