"""Check-and-mutate: mutations of a row that apply only if a
checked cell of it holds the expected value (a null expectation means "absent").

A request may carry several mutations, of the checked cell and of others of its
row. The requests of a row are applied in ``(ts, seq)`` order, each seeing what
the accepted ones before it did to any cell, as under a row lock (see
:mod:`tessera.operators.row_state`).

* One request per row (``single_per_row``): an equi join of the requests with
  the checked cells, no Python.
* Else a fold: requests, and before them the checked cells as they are now, are
  shuffled by row and sorted within partitions; one pass streams through them
  holding the checked cells of one row, so no group is gathered.
* Rows with more than ``hot_row_requests`` requests would keep one task busy
  for long. Then the requests are cut, in order of rows and versions, into
  checkpointed chunks, and the same fold runs over all chunks at once: first from
  the state that a row has now; then again for the chunks of a row whose
  predecessor turned out to end in another state than assumed, until none
  does. The first chunk of a row is right from the start, so each round settles at
  least one more, and usually all: what a chunk ends with seldom depends on
  what came before its last accepted requests. The result is that of the plain
  fold, whatever the number of chunks.

All return the *accepted* mutations as cell-log rows, to be appended.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators import cells as C
from tessera.operators.row_state import MAX_SEQ, RowState
from tessera.session import checkpoint_root, scratch_path, ship_package

_CELL = ["row_key", "family", "qualifier"]
THEN = "array<struct<kind:string,family:string,qualifier:string,value:string,delta:bigint>>"
_FOLDED = f"row_key string, ts bigint, seq bigint, then {THEN}"
_STATE = "row_key string, chunk int, family string, qualifier string, present boolean, value string, ts bigint, seq bigint"


def mutation(kind: str | Column, *, family: str | Column | None = None, qualifier: str | Column | None = None,
             value: Column | None = None, delta: int | Column | None = None) -> Column:
    """One mutation of a request: ``kind``, ``family`` and ``qualifier`` are literals or Columns."""
    part = lambda v, kind: (v if isinstance(v, Column) else F.lit(v)).cast(kind)
    return F.struct(part(kind, "string").alias("kind"), part(family, "string").alias("family"), part(qualifier, "string").alias("qualifier"),
                    part(value, "string").alias("value"), part(delta, "bigint").alias("delta"))


def requests(df: DataFrame, *, row_key, family, qualifier, expected, ts, seq=0, value=None,
             then: Sequence[Column] | Column | None = None) -> DataFrame:
    """Normalise user rows to ``(row_key, family, qualifier, expected, value, ts, seq[, then])``.

    ``row_key``, ``expected`` and ``value`` take a Column or a column name;
    ``family`` and ``qualifier`` a Column or a literal; ``ts``/``seq`` a Column or a
    number. ``value`` is what a check-and-put writes to the checked cell;
    ``then`` lists other mutations (see :func:`mutation`) instead, or is a column of such a list.
    """
    lit_or_col = C._lit_or_col
    out = df.select(
        lit_or_col(row_key, literal_str=False).cast("string").alias("row_key"),
        lit_or_col(family, literal_str=True).cast("string").alias("family"),
        lit_or_col(qualifier, literal_str=True).cast("string").alias("qualifier"),
        lit_or_col(expected, literal_str=False).cast("string").alias("expected"),
        lit_or_col(value, literal_str=False).cast("string").alias("value"),
        lit_or_col(ts, literal_str=False).cast("bigint").alias("ts"),
        lit_or_col(seq, literal_str=False).cast("bigint").alias("seq"),
        *([] if then is None else [(then if isinstance(then, Column) else F.array(*then)).cast(THEN).alias("then")]),
    )
    return out


def with_then(reqs: DataFrame, action: str, delete_scope: str) -> DataFrame:
    """Requests with their list of mutations: what they carry, else one by the action."""
    if "then" in reqs.columns:
        return reqs
    if action == "put":
        one = mutation(C.PUT, family=F.col("family"), qualifier=F.col("qualifier"), value=F.col("value"))
    else:
        kind = {"cell": C.DELETE_CELL, "family": C.DELETE_FAMILY, "row": C.DELETE_ROW}[delete_scope]
        one = mutation(kind, family=F.col("family") if delete_scope != "row" else None,
                       qualifier=F.col("qualifier") if delete_scope == "cell" else None)
    return reqs.withColumn("then", F.array(one))


def current(cells: DataFrame, reqs: DataFrame) -> DataFrame:
    """The checked cells of ``reqs`` as they are: ``row_key, family, qualifier, present, value, ts, seq``.

    ``(ts, seq)`` is the version of the cell's last change, null if there is
    none; an absent cell's is the newest tombstone over it. Only requested rows
    are resolved.
    """
    checked = reqs.select(*_CELL).distinct()
    log = cells.join(reqs.select("row_key").distinct(), "row_key", "left_semi").select(*C.CELL_COLUMNS)
    live = C.resolve(log).select(*_CELL, F.struct("value", "ts", "seq").alias("live"))
    out = checked.join(live, _CELL, "left")
    for i, (kind, by) in enumerate(((C.DELETE_CELL, _CELL), (C.DELETE_FAMILY, _CELL[:2]), (C.DELETE_ROW, _CELL[:1]))):
        newest = log.filter(F.col("kind") == kind).groupBy(*by).agg(F.max("ts").alias(f"t{i}"))
        out = out.join(newest, by, "left")
    tomb = F.greatest("t0", "t1", "t2")
    present = F.col("live").isNotNull()
    return out.select(*_CELL, present.alias("present"), F.col("live.value").alias("value"), F.when(present, F.col("live.ts")).otherwise(tomb).alias("ts"),
                      F.when(present, F.col("live.seq")).when(tomb.isNotNull(), F.lit(MAX_SEQ)).alias("seq"))


# --------------------------------------------------------------------------- the fold

_INPUT = ["row_key", "chunk", "is_seed", "family", "qualifier", "present", "value", "ts", "seq", "then"]


def _sorted_input(state: DataFrame, reqs: DataFrame) -> DataFrame:
    """Checked cells, then requests in order, for each (row, chunk); one exchange."""
    seeds = state.select("row_key", "chunk", F.lit(True).alias("is_seed"), "family", "qualifier", "present", "value", "ts", "seq", F.lit(None).cast(THEN).alias("then"))
    todo = reqs.select("row_key", "chunk", F.lit(False).alias("is_seed"), "family", "qualifier", F.col("expected").isNotNull().alias("present"),
                       F.col("expected").alias("value"), "ts", "seq", "then")
    return (seeds.unionByName(todo).repartition("row_key", "chunk")
            .sortWithinPartitions("row_key", "chunk", F.desc("is_seed"), "ts", "seq", "family", "qualifier", "value", F.xxhash64("then")).select(*_INPUT))


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, RowState, dict | None]]:
    """(row and chunk, its state, a request of it or None where it ends)."""
    key, state = None, RowState()
    for batch in batches:
        for r in batch.to_pylist():
            if (k := (r["row_key"], r["chunk"])) != key:
                if key is not None:
                    yield key, state, None
                key, state = k, RowState()
            if r["is_seed"]:
                state.seed(r["family"], r["qualifier"], r["present"], r["value"], r["ts"], r["seq"])
            else:
                yield key, state, r
    if key is not None:
        yield key, state, None


def _decide(state: RowState, r: dict) -> bool:
    return state.request(r["family"], r["qualifier"], r["value"] if r["present"] else None, r["ts"], r["seq"], r["then"])


_THEN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("family", pa.string()), ("qualifier", pa.string()), ("value", pa.string()), ("delta", pa.int64())]))
_FOLDED_TYPE = pa.schema([("row_key", pa.string()), ("ts", pa.int64()), ("seq", pa.int64()), ("then", _THEN_TYPE)])
_STATE_TYPE = pa.schema([("row_key", pa.string()), ("chunk", pa.int32()), ("family", pa.string()), ("qualifier", pa.string()), ("present", pa.bool_()),
                         ("value", pa.string()), ("ts", pa.int64()), ("seq", pa.int64())])


def _in_batches(rows: Iterator[dict], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _accepted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = (r for _, state, r in _segments(batches) if r is not None and _decide(state, r))
    yield from _in_batches(({"row_key": r["row_key"], "ts": r["ts"], "seq": r["seq"], "then": r["then"]} for r in found), _FOLDED_TYPE)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state in which each (row, chunk) ends."""
    def rows():
        for key, state, r in _segments(batches):
            if r is not None:
                _decide(state, r)
                continue
            for (family, qualifier), (present, value, last) in state.cells.items():
                ts, seq = last or (None, None)
                yield {"row_key": key[0], "chunk": key[1], "family": family, "qualifier": qualifier, "present": present, "value": value, "ts": ts, "seq": seq}

    yield from _in_batches(rows(), _STATE_TYPE)


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _chunk_starts(now: DataFrame, chunks: DataFrame) -> DataFrame:
    """The state in which each (row, chunk) starts: rounds of the fold until no start changes.

    ``now`` holds the checked cells as they are, ``chunks`` the requests with
    their chunk. Only chunks of rows that span several are folded here.
    """
    segments = _kept(chunks.select("row_key", "chunk").distinct().withColumn("before", F.lag("chunk").over(Window.partitionBy("row_key").orderBy("chunk"))), "cas-segments")
    state = [*_CELL, "chunk", "present", "value", "ts", "seq"]
    starts = _kept(now.join(segments.select("row_key", "chunk"), "row_key").select(*state), "cas-starts")
    followed = segments.filter(F.col("before").isNotNull()).select("row_key", F.col("before").alias("chunk"))
    if followed.isEmpty():
        return starts
    dirty, ends = _kept(followed, "cas-dirty"), None
    while True:
        redo = _sorted_input(starts.join(dirty, ["row_key", "chunk"], "left_semi"), chunks.join(dirty, ["row_key", "chunk"], "left_semi"))
        folded = redo.mapInArrow(_ends, _STATE)
        if ends is not None:
            folded = folded.unionByName(ends.join(dirty, ["row_key", "chunk"], "left_anti"))
        ends = _kept(folded.select(*state), "cas-ends")
        # a chunk starts as the one before it ends, as far as its cells are checked by anyone
        after = ends.withColumnRenamed("chunk", "before").join(segments.filter(F.col("before").isNotNull()), ["row_key", "before"]).select(*state)
        first = starts.join(segments.filter(F.col("before").isNull()), ["row_key", "chunk"], "left_semi").select(*state)
        fresh = _kept(first.unionByName(after), "cas-starts")
        changed = fresh.exceptAll(starts).unionByName(starts.exceptAll(fresh)).select("row_key", "chunk").distinct()
        dirty = _kept(changed.join(followed, ["row_key", "chunk"], "left_semi"), "cas-dirty")
        starts = fresh
        if dirty.isEmpty():
            return starts


def _accepted_requests(now: DataFrame, reqs: DataFrame, hot_row_requests: int | None, num_chunks: int | None) -> DataFrame:
    spark = reqs.sparkSession
    hot = hot_row_requests is not None and (
        hot_row_requests <= 0 or (reqs.groupBy("row_key").count().agg(F.max("count")).first()[0] or 0) > hot_row_requests)
    if not hot:
        one = F.lit(0).alias("chunk")
        return _sorted_input(now.select("*", one), reqs.select("*", one)).mapInArrow(_accepted, _FOLDED)
    checkpoint_root(spark)
    order = ["row_key", "ts", "seq", "family", "qualifier", "expected", F.xxhash64("then")]
    n = num_chunks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = (reqs.repartitionByRange(n, *order).withColumn("chunk", F.spark_partition_id()).checkpoint(eager=True))
    return _sorted_input(_chunk_starts(_kept(now, "cas-now"), chunks), chunks).mapInArrow(_accepted, _FOLDED)


def as_cells(accepted: DataFrame) -> DataFrame:
    """The mutations of accepted requests ``(row_key, ts, seq, then)`` as cell-log rows."""
    return accepted.select("row_key", "ts", "seq", F.inline("then")).select(*C.CELL_COLUMNS)


def check_and_mutate(cells: DataFrame, reqs: DataFrame, *, action: str = "put",
                     delete_scope: str = "cell", single_per_row: bool = False,
                     hot_row_requests: int | None = 1_000_000, num_chunks: int | None = None,
                     materialize: bool = True) -> DataFrame:
    """Accepted mutations of conditional requests.

    ``reqs`` has the columns of :func:`requests`. Requests without ``then`` put
    their value to the checked cell (``action='put'``) or delete the cell, its family or its
    row (``action='delete'``, ``delete_scope``). A request needs its key parts and
    version; a null one fails the job. Like the store operation it stands for, the
    decision is taken now: the accepted mutations are checkpointed to the shared
    folder (``materialize=False`` keeps them lazy), which also cuts the lineage later reads plan over.
    """
    ship_package(cells.sparkSession)
    parts = [F.coalesce(F.col(c), F.raise_error(F.lit(f"not a request: {c} is null"))).alias(c) for c in (*_CELL, "ts", "seq")]
    rest = [c for c in ("expected", "value", "then") if c in reqs.columns]
    reqs = with_then(reqs.select(*parts, *rest), action, delete_scope)
    now = current(cells, reqs)
    if single_per_row:
        joined = reqs.join(now.select(*_CELL, "present", F.col("value").alias("current"), F.struct("ts", "seq").alias("last")), _CELL, "left")
        holds = F.when(F.col("present"), F.col("current").eqNullSafe(F.col("expected")) & F.col("expected").isNotNull()).otherwise(F.col("expected").isNull())
        fresh = F.col("last.ts").isNull() | (F.struct("ts", "seq") > F.col("last"))
        accepted = joined.filter(holds & fresh).select("row_key", "ts", "seq", "then")
    else:
        accepted = _accepted_requests(now, reqs, hot_row_requests, num_chunks)
    out = as_cells(accepted)
    if not materialize:
        return out
    checkpoint_root(out.sparkSession)
    return out.checkpoint(eager=True)


def check_and_put(cells: DataFrame, reqs: DataFrame, **kw) -> DataFrame:
    return check_and_mutate(cells, reqs, action="put", **kw)


def check_and_delete(cells: DataFrame, reqs: DataFrame, *, scope: str = "cell", **kw) -> DataFrame:
    return check_and_mutate(cells, reqs, action="delete", delete_scope=scope, **kw)
