"""Structured Streaming forms of the store operators.

The original runs the batch operator on every micro-batch and keeps all state
in the store. Here:

* puts, increments, deletes and mixed batches append mutation rows through
  the Parquet file sink (exactly-once through its commit log); reads resolve;
* ``foreachBatch`` side effects write each batch to its own ``batch_id=``
  folder with overwrite, so a replayed batch replaces itself;
* check-and-put / check-and-delete keep each row's cells as state
  (``transformWithState``) and emit the accepted mutations;
* gets are a stream-static join against the resolved cells.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

from tessera.operators import cas
from tessera.operators import cells as C
from tessera.operators.row_state import MAX_SEQ, RowState
from tessera.session import ship_package


def file_stream(spark: SparkSession, path: str, schema: T.StructType | str, *, fmt: str = "parquet",
                max_files_per_trigger: int | None = 1) -> DataFrame:
    """A file source stream; each trigger takes up to ``max_files_per_trigger`` files."""
    reader = spark.readStream.schema(schema).format(fmt)
    if not path.rstrip("/").endswith("/") and os.path.isfile(path):
        # a single file: stream its folder, restricted to that file name
        path, name = os.path.split(path)
        reader = reader.option("pathGlobFilter", name)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def run_to_end(writer) -> None:
    """Start a writer with ``availableNow`` and wait until it has drained its input."""
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def append_to_files(stream: DataFrame, path: str, checkpoint: str, partition_by: str | None = None) -> None:
    """Append a stream to Parquet files, exactly once, and drain it (mutations: ``partition_by="kind"``)."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    run_to_end(writer.partitionBy(partition_by) if partition_by else writer)


def idempotent_batch_writer(path: str, transform: Callable[[DataFrame, int], DataFrame] | None = None):
    """A ``foreachBatch`` function writing each batch to ``path/batch_id=<id>``.

    Overwriting the batch's own folder makes a replay after failure harmless;
    a blind append would duplicate the batch.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform is not None else batch
        out.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run a side-effecting function on every micro-batch until the input is drained."""
    ship_package(stream.sparkSession)
    run_to_end(stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint))


def stream_map(stream: DataFrame, fn: Callable[[pd.DataFrame, object], pd.DataFrame], schema,
               setup: Callable[[], object] | None = None) -> DataFrame:
    """Streaming map over Arrow batches with one setup per partition."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ctx = setup() if setup is not None else None
        for b in batches:
            yield fn(b, ctx)

    ship_package(stream.sparkSession)
    return stream.mapInPandas(run, schema)


def stream_mutations(stream: DataFrame, **mutation) -> DataFrame:
    """Mutation rows built from a stream (same arguments as ``cells.mutations``)."""
    return C.mutations(stream, **mutation)


# ----------------------------------------------------------------- check-and-mutate

#: a request crosses to Python as one text of two lines; what it does, the second, is only read there if it is accepted
_ACCEPTED = "row_key string, ts bigint, seq bigint, then string"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_DECODE = json.JSONDecoder().raw_decode
#: Most characters of a row's cells, or of its tombstones, that are kept as one text.
NARROW = 16_384
#: Cells of a row that come as one text at the start.
PACK = 64
_WIDE = "wide"


class _KeptRow(RowState):
    """A row whose cells and tombstones are kept by a stream, in map states or :class:`_Held`.

    ``cells`` holds what is present, ``tombs`` the newest tombstone of the row
    (``row``), of families and of cells that no wider one covers.
    """

    def __init__(self, cells, tombs):
        super().__init__(closed=False)
        self._kept, self._tombs = cells, tombs
        self._read: dict[tuple[str, str], tuple | None] = {}
        self._has_tombs: bool | None = None
        self._tombs_before: int | None = None

    def _tomb(self, *key) -> int | None:
        """A kept tombstone; each call of a state is a round trip, and most rows have none."""
        if self._has_tombs is None:
            self._has_tombs = self._tombs.exists()
            self.row_tomb = self._tombs_before = self._tomb("row", "", "")
        found = self._tombs.getValue(key) if self._has_tombs else None
        return found[0] if found else None

    def load(self, family, qualifier):
        if found := self._kept.getValue((family, qualifier)):
            value, ts, seq = found
            known = True, value, None if ts is None else (ts, seq)
            if ts is None or seq == MAX_SEQ:  # only such a kept cell may have a kept tombstone over it
                self._tomb("row", "", "")
        else:
            tomb = self._tomb("cell", family, qualifier)
            known = None if tomb is None else (False, None, (tomb, MAX_SEQ))
        self._read[family, qualifier] = known
        return known

    def family_tomb(self, family):
        # before an absent cell or a delete was met, no kept tombstone matters
        if family not in self.family_tombs and self._has_tombs and (found := self._tomb("family", family, "")) is not None:
            self.family_tombs[family] = found
        return self.family_tombs.get(family)

    def _apply(self, m, ts, seq):
        if m["kind"] in ("delete_family", "delete_row") and self._has_tombs is None:
            self._tomb("row", "", "")
        if m["kind"] == "delete_family":
            self.family_tomb(m["family"])
        super()._apply(m, ts, seq)

    def save(self) -> None:
        """Write back what was met; entries that a delete covers go."""
        if self.row_tomb != self._tombs_before:
            self._tombs.updateValue(("row", "", ""), (self.row_tomb,))
        for family, ts in self.family_tombs.items():
            self._tombs.updateValue(("family", family, ""), (ts,))
        for (family, qualifier), cell in self.cells.items():
            if cell == (was := self._read[family, qualifier]):
                continue
            present, value, last = cell
            if present:
                self._kept.updateValue((family, qualifier), (value, *(last or (None, None))))
                continue
            if was is not None and was[0]:
                self._kept.removeKey((family, qualifier))
            if last is not None:
                self._tombs.updateValue(("cell", family, qualifier), (last[0],))
        if self.row_tomb != self._tombs_before or self.family_tombs:
            covered = lambda family, ts: ts is not None and ts <= max(self.row_tomb if self.row_tomb is not None else ts - 1, self.family_tombs.get(family, ts - 1))
            for key in [k for k, v in self._kept.iterator() if covered(k[0], v[1])]:
                self._kept.removeKey(key)
            for key in [k for k, v in self._tombs.iterator() if (k[0] == "cell" and covered(k[1], v[0])) or (
                    k[0] == "family" and self.row_tomb is not None and v[0] <= self.row_tomb)]:
                self._tombs.removeKey(key)


class _Held:
    """The entries of one value state, with the calls of a map state; each of those would be a round trip.

    The text is read when an entry is first asked for, and written once, by ``write``.
    """

    def __init__(self, value, key_parts: int):
        self._value, self._key_parts = value, key_parts
        self._text: str | None = None
        self._entries: dict[tuple, tuple] | None = None

    def text(self) -> str | None:
        """The text as it is kept."""
        self.entries()
        return self._text

    def entries(self) -> dict[tuple, tuple]:
        if self._entries is None:
            found = self._value.get()
            self._text = found[0] if found else None
            n = self._key_parts
            self._entries = {tuple(e[:n]): tuple(e[n:]) for e in json.loads(self._text)} if self._text not in (None, _WIDE) else {}
        return self._entries

    def exists(self) -> bool:
        return bool(self.entries())

    def getValue(self, key):
        return self.entries().get(key)

    def updateValue(self, key, value) -> None:
        self.entries()[key] = value

    def removeKey(self, key) -> None:
        self.entries().pop(key, None)

    def iterator(self):
        return iter([*self.entries().items()])

    def after(self) -> str | None:
        """The text to be kept; null for no entries."""
        if self._entries is None:
            return self._text
        return _as_text([[*k, *v] for k, v in self._entries.items()]) if self._entries else None

    def write(self) -> None:
        if (now := self.after()) == self._text:
            return
        if now is None:
            self._value.clear()
        else:
            self._value.update((now,))


def _as_text(entries: list[list]) -> str:
    return json.dumps(entries, ensure_ascii=False, separators=(",", ":"))


class ConditionalRows(StatefulProcessor):
    """Keeps each row's cells as state and emits the requests that it accepts.

    A row's cells are one value, its tombstones another, so a row costs a few
    calls of the state in a micro-batch, whatever its requests do. A row that outgrows
    ``NARROW`` moves to two map states for good, where only the cells that are met are read.
    """

    def init(self, handle) -> None:
        self.cells = handle.getValueState("cells", "entries string")
        self.tombs = handle.getValueState("tombs", "entries string")
        self.wide_cells = handle.getMapState("wide_cells", "family string, qualifier string", "value string, ts bigint, seq bigint")
        self.wide_tombs = handle.getMapState("wide_tombs", "scope string, family string, qualifier string", "ts bigint")

    def handleInitialState(self, key, initialState, timerValues) -> None:
        entries = [[*cell.values()] for cell in json.loads(initialState["cells"])]
        if initialState["alone"] and len(text := _as_text(entries)) <= NARROW:
            self.cells.update((text,))
            return
        self.cells.update((_WIDE,))
        for family, qualifier, *cell in entries:
            self.wide_cells.updateValue((family, qualifier), tuple(cell))

    def _keep(self, cells: _Held, tombs: _Held) -> None:
        """Write a row's values, or move what outgrew them to the map states."""
        if max(len(held.after() or "") for held in (cells, tombs)) <= NARROW:
            cells.write()
            tombs.write()
            return
        for held, wide in ((cells, self.wide_cells), (tombs, self.wide_tombs)):
            for k, v in held.iterator():
                wide.updateValue(k, v)
        self.cells.update((_WIDE,))
        self.tombs.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cells, tombs = _Held(self.cells, 2), _Held(self.tombs, 3)
        wide = cells.text() == _WIDE
        state = _KeptRow(self.wide_cells, self.wide_tombs) if wide else _KeptRow(cells, tombs)
        nulls_first = lambda v: (v is not None, v)

        def read(r: Row) -> tuple[list, str]:
            text = r["request"]
            request, end = _DECODE(text)
            return [*request.values()], text[end + 1:]

        order = lambda r: (*r[0][:4], nulls_first(r[0][4]), r[0][5])
        for (ts, seq, family, qualifier, expected, _), then in sorted(map(read, rows), key=order):
            if state.request(family, qualifier, expected, ts, seq, (m for text in (then,) for m in json.loads(text))):
                yield Row(row_key=key[0], ts=ts, seq=seq, then=then)
        state.save()
        if not wide:
            self._keep(cells, tombs)

    def close(self) -> None:
        pass


def use_map_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB, the provider that keyed state of several variables needs."""
    if "RocksDB" not in (spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") or ""):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", _ROCKS)


def stream_check_and_mutate(stream_reqs: DataFrame, current: DataFrame | None, *,
                            action: str = "put", delete_scope: str = "cell") -> DataFrame:
    """Accepted mutations of a stream of conditional requests, as cell-log rows.

    ``stream_reqs`` has the columns of ``cas.requests``; ``current`` (optional,
    static) holds the live cells at the start as ``(row_key, family, qualifier,
    value[, ts, seq])`` and becomes the initial state. Rows are the grain, as in
    the batch form: the requests of a row in a micro-batch are applied in version
    order, batches in arrival order, and a request that is older than its checked cell's
    last change is refused. What is held at a time is one row's requests of one
    micro-batch and the cells they meet (all of its cells, if they are at most
    ``NARROW`` characters). State is kept in RocksDB; a deleted
    cell's entry goes, and of a deleted row one tombstone stays.
    """
    spark = stream_reqs.sparkSession
    ship_package(spark)
    use_map_state(spark)
    reqs = cas.with_then(stream_reqs, action, delete_scope)
    text = lambda column: F.to_json(column, {"ignoreNullFields": "false"})
    request = text(F.struct("ts", "seq", "family", "qualifier", "expected", F.xxhash64("then").alias("tie")))
    reqs = reqs.select("row_key", F.concat(request, F.lit("\n"), F.coalesce(text("then"), F.lit("null"))).alias("request"))
    initial = None
    if current is not None:
        version = [F.col(c) if c in current.columns else F.lit(None).cast("bigint").alias(c) for c in ("ts", "seq")]
        cells = current.select("row_key", "family", "qualifier", "value", *version)
        of_row = Window.partitionBy("row_key")
        place = F.row_number().over(of_row.orderBy("family", "qualifier"))
        packed = cells.withColumn("pack", F.floor((place - 1) / PACK)).withColumn("alone", F.count("*").over(of_row) <= PACK)
        entries = text(F.collect_list(F.struct("family", "qualifier", "value", "ts", "seq")))
        initial = packed.groupBy("row_key", "pack", "alone").agg(entries.alias("cells")).select("row_key", "alone", "cells").groupBy("row_key")
    accepted = reqs.groupBy("row_key").transformWithState(ConditionalRows(), _ACCEPTED, "append", "none", initial)
    return cas.as_cells(accepted.withColumn("then", F.from_json("then", cas.THEN)))


def stream_enrich(stream: DataFrame, static: DataFrame, on, how: str = "left") -> DataFrame:
    """A stream-static join against (resolved, wide) cells; for a store that doesn't change."""
    return stream.join(static, on, how)


def stream_gets(stream: DataFrame, store: str, *, key_col: str, qualifiers: Sequence[str], path: str, checkpoint: str) -> DataFrame:
    """Streaming gets from a stored log that others go on writing to.

    Each micro-batch reads the files that the store has when the batch starts,
    and of those only its own keys' rows (``cells.requested``), so its work follows the
    batch and a put between two batches is seen by the next. Which files a batch read is written
    first, so a batch that is run again reads the same, and its output folder is replaced.
    Returns the stream's rows with a column for each qualifier (null if absent).
    """
    schema = T.StructType([*stream.schema.fields, *[T.StructField(q, T.StringType()) for q in qualifiers]])

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        cells = C.read_pinned(spark, store, f"{path}/pins/{batch_id}")
        rows = batch.persist()
        keys = rows.select(F.col(key_col).cast("string").alias("_key")).distinct()
        wide = C.bulk_get_wide(cells, keys, "_key", qualifiers=qualifiers)
        out = rows.join(wide, F.col(key_col).cast("string") == F.col("_key"), "left").drop("_key")
        out.write.mode("overwrite").parquet(f"{path}/data/batch_id={batch_id}")
        rows.unpersist()

    foreach_batch(stream, run, checkpoint)
    return stream.sparkSession.read.schema(schema).parquet(f"{path}/data")
