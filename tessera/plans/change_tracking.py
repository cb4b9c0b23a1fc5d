"""Change tracking: current state + history kept in step.

Each step derives a new status per key, keeps only the rows that differ from
the previous state (``except``), upserts those into the current-state cells
and appends them to a history table keyed ``<id>:<yyyyMMddHHmmss>``.

Two forms with the same result:

* :func:`change_history` / :func:`current_state` compute every step in one
  plan: observations are reduced per (key, step) first (map-side), then
  ``lag`` over each key's steps finds the changes. A key's rows are at most
  its number of steps, so a hot key does not pile its raw events on a task.
* :func:`run_steps` is the iterative job: each step gets the cells of its own keys,
  upserts those that differ and appends history; the stored cells are the state.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tessera.functions.scalar import epoch_micros, history_key
from tessera.operators import cells as C
from tessera.session import scratch_path


def step_observations(events: DataFrame, *, key: str, status: Column, ts: str, step: Column,
                      tiebreak: str | None = None) -> DataFrame:
    """Last observed status per (key, step): ``key, step_ts, status``."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return (events.groupBy(F.col(key).alias("key"), step.alias("step_ts"))
            .agg(F.max_by(status, order).alias("status")))


def change_history(obs: DataFrame) -> DataFrame:
    """Rows whose status differs from the key's previous step (or is its first)."""
    w = Window.partitionBy("key").orderBy("step_ts")
    first = F.lag(F.lit(1)).over(w).isNull()
    same = F.lag("status").over(w).eqNullSafe(F.col("status"))
    return obs.withColumn("_keep", first | ~same).filter("_keep").drop("_keep")


def history_table(changes: DataFrame, *, key_name: str = "id_ts") -> DataFrame:
    return changes.select(history_key(F.col("key"), F.col("step_ts")).alias(key_name),
                          F.col("status").alias("status"))


def current_state(obs: DataFrame) -> DataFrame:
    """Status after the last step, per key."""
    return obs.groupBy("key").agg(F.max_by("status", "step_ts").alias("status"))


def simulated_status(id_col: Column, step: int, seed: int = 7) -> Column:
    """A repeatable stand-in for a random 0/1 status: ``xxhash64(id, step, seed) % 2``."""
    return F.pmod(F.xxhash64(id_col, F.lit(step), F.lit(seed)), F.lit(2)).cast("string")


def _wall_time(epoch_us: int) -> Column:
    """Epoch microseconds as a zone-free timestamp (the wall time in UTC)."""
    import datetime as _dt
    wall = _dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=int(epoch_us))
    return F.lit(wall.isoformat(sep=" ")).cast("timestamp_ntz")


def run_steps(spark: SparkSession, initial: DataFrame, updates: Iterable[tuple[int, DataFrame]], *,
              key: str, status: str, family: str = "c") -> tuple[DataFrame, DataFrame]:
    """Iterate: compare with the current cells, upsert cells, append history.

    ``initial`` and each update are ``(key, status)`` frames; an update may
    cover only some keys (the others keep their status), add keys, or set a null
    status. The cells are the state: a step reads the cells of its own keys and writes
    what changed, so its work and its bytes follow the update. A step older than a
    cell's version doesn't change it. Returns the final state cells (resolved) and the history rows,
    both under the shared checkpoint folder.
    """
    root = scratch_path(spark, "change-tracking")
    cells_path, hist_path = f"{root}/cells", f"{root}/history"

    def write(changed: DataFrame, ts: int) -> None:
        C.write_cells(C.mutations(changed, row_key=key, family=family, qualifier=F.lit(status), value=status, ts=ts), cells_path)
        changed.select(history_key(F.col(key), _wall_time(ts)).alias("id_ts"), status).write.mode("append").parquet(hist_path)

    write(initial.select(key, status), 0)
    for n, (step_ts, update) in enumerate(updates):
        new = update.select(F.col(key), F.col(status), F.col(key).cast("string").alias("row_key"))
        cells = C.requested(C.read_cells(spark, cells_path), new.select("row_key"))
        old = C.resolve(cells).select("row_key", F.struct("value", "ts").alias("_old"))
        differs = F.col("_old").isNull() | ((F.col("_old.ts") < step_ts) & ~F.col("_old.value").eqNullSafe(F.col(status).cast("string")))
        changed = new.join(old, "row_key", "left").filter(differs).select(key, status).distinct()
        # written, not cached: a cache over the cells would be computed again once they are appended to
        changed.write.parquet(f"{root}/changed/{n}")
        write(spark.read.schema(changed.schema).parquet(f"{root}/changed/{n}"), step_ts)
    state = C.resolve(C.read_cells(spark, cells_path))
    return state, spark.read.parquet(hist_path)


class LastStatus(StatefulProcessor):
    """Keeps each key's newest status and its version; tells of each batch's newest whether it changes the status."""

    def init(self, handle) -> None:
        self.state = handle.getValueState("last", "status string, ts bigint, tie bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest, last_ts = None, None
        for r in rows:
            version = (r["ts"], r["tie"])
            last_ts = r["ts"] if last_ts is None else max(last_ts, r["ts"])
            if newest is None or version > newest[0]:
                newest = version, r["status"]
        before = self.state.get()
        fresh = before is None or newest[0] > tuple(before[1:])
        changed = fresh and (before is None or before[0] != newest[1])
        if fresh:
            self.state.update((newest[1], *newest[0]))
        yield Row(row_key=key[0], status=newest[1], ts=newest[0][0], tie=newest[0][1], last_ts=last_ts, changed=changed)

    def close(self) -> None:
        pass


def stream_change_tracking(stream: DataFrame, *, key: str, status: Column, ts: str, tiebreak: str,
                           root: str, checkpoint: str, family: str = "c") -> tuple[str, str]:
    """Change tracking over a stream of observations: one step per micro-batch.

    Each key's newest status and its version ``(ts, tiebreak)`` are keyed state, so a
    batch reads and writes the state of its own keys alone. A batch's newest
    observation of a key counts if it is newer than the state, whenever it arrives;
    if the status differs, a cell with the observation's version and a history row
    keyed with the batch's newest event time are written. Outputs of batch ``n`` go to its own
    ``batch_id=<n>`` folder with overwrite, so a replayed batch replaces itself.
    Observations without a time are left out. Returns the cells and history paths.
    """
    from tessera.streaming.mutations import foreach_batch, use_map_state

    use_map_state(stream.sparkSession)
    cells_path, hist_path = f"{root}/cells", f"{root}/history"
    obs = stream.filter(F.col(ts).isNotNull()).select(
        F.col(key).cast("string").alias("row_key"), status.cast("string").alias("status"), epoch_micros(ts).alias("ts"),
        F.coalesce(F.col(tiebreak).cast("bigint"), F.lit(0)).alias("tie"))
    told = obs.groupBy("row_key").transformWithState(
        LastStatus(), "row_key string, status string, ts bigint, tie bigint, last_ts bigint, changed boolean", "append", "none")

    def step(batch: DataFrame, batch_id: int) -> None:
        seen = batch.persist()
        newest = seen.agg(F.max("last_ts")).first()[0]
        if newest is not None:
            changed = seen.filter("changed")
            C.mutations(changed, row_key="row_key", family=family, qualifier=F.lit("status"), value="status", ts="ts", seq="tie") \
                .write.mode("overwrite").parquet(f"{cells_path}/batch_id={batch_id}")
            changed.select(history_key(F.col("row_key"), _wall_time(newest)).alias("id_ts"), "status") \
                .write.mode("overwrite").parquet(f"{hist_path}/batch_id={batch_id}")
        seen.unpersist()

    foreach_batch(told, step, checkpoint)
    return cells_path, hist_path
