import os
import time

from pyspark.sql import functions as F

from tessera import bindings as B
from tessera.functions.scalar import epoch_micros
from tessera.operators import cas
from tessera.operators import cells as C
from tessera.streaming import mutations as SM

from conftest import SF_SMALL, rows


def split_in_time_order(spark, path, parts=4):
    """Write events as several files, oldest first, with increasing mtimes."""
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    us = epoch_micros("ts")
    lo, hi = ev.agg(F.min(us), F.max(us)).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        ev.filter((us >= lo + i * step) & (us < lo + (i + 1) * step)).coalesce(1) \
            .write.mode("append").parquet(path)
    files = sorted((f for f in os.listdir(path) if f.endswith(".parquet")),
                   key=lambda f: os.path.getmtime(os.path.join(path, f)))
    now = time.time() - 1000
    for i, f in enumerate(files):  # pin distinct, ordered mtimes
        os.utime(os.path.join(path, f), (now + i, now + i))
    return ev


def test_stream_put_equals_batch_and_restarts(spark, tmp):
    ev = split_in_time_order(spark, f"{tmp}/in")
    stream = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)
    muts = C.mutations(stream, row_key="user_id", family="c", qualifier=F.col("event_type"), value="value",
                       ts=epoch_micros("ts"), seq=F.col("event_id"))
    SM.append_to_files(muts, f"{tmp}/out", f"{tmp}/ck")
    # a restart with nothing new changes nothing
    SM.append_to_files(muts, f"{tmp}/out", f"{tmp}/ck")
    got = rows(C.resolve(C.read_cells(spark, f"{tmp}/out")), "row_key", "qualifier", "value")
    batch = C.mutations(ev, row_key="user_id", family="c", qualifier=F.col("event_type"), value="value",
                        ts=epoch_micros("ts"), seq=F.col("event_id"))
    assert got == rows(C.resolve(batch), "row_key", "qualifier", "value")
    assert C.read_cells(spark, f"{tmp}/out").count() == ev.count()


def test_stream_check_and_put_equals_batch_fold(spark, tmp):
    ev = split_in_time_order(spark, f"{tmp}/in")
    stream = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)

    def reqs(df):
        return cas.requests(df, row_key="user_id", family="c", qualifier="status",
                            expected=B.funnel_expected(F.col("event_type")), value="event_type",
                            ts=epoch_micros("ts"), seq=F.col("event_id"))

    accepted = SM.stream_check_and_mutate(reqs(stream), None)
    SM.append_to_files(accepted, f"{tmp}/out", f"{tmp}/ck")
    got = rows(C.resolve(C.read_cells(spark, f"{tmp}/out")), "row_key", "value")
    base = C.empty_cells(spark)
    want = rows(C.resolve(cas.check_and_put(base, reqs(ev))), "row_key", "value")
    assert got == want and len(got) > 0


def test_foreach_batch_replay_is_idempotent(spark, tmp):
    ev = split_in_time_order(spark, f"{tmp}/in", parts=3)
    stream = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)
    writer = SM.idempotent_batch_writer(f"{tmp}/out")
    SM.foreach_batch(stream, writer, f"{tmp}/ck")
    # replaying batch 0 by hand (as after a crash before commit) replaces, not duplicates
    done = spark.read.parquet(f"{tmp}/out/batch_id=0")
    first = spark.createDataFrame(done.collect(), done.schema)  # the replayed batch's input
    writer(first, 0)
    assert spark.read.parquet(f"{tmp}/out").count() == ev.count()


def test_stream_enrich_and_map(spark, tmp):
    ev = split_in_time_order(spark, f"{tmp}/in", parts=2)
    stream = SM.file_stream(spark, f"{tmp}/in", ev.schema)
    cust = B.customer_cells(spark, SF_SMALL)
    wide = C.scan_wide(cust, key_name="k", qualifiers=["c_name"])
    joined = SM.stream_enrich(stream.select("event_id", F.col("user_id").cast("string").alias("k")), wide, "k")
    SM.append_to_files(joined, f"{tmp}/out", f"{tmp}/ck")
    assert spark.read.parquet(f"{tmp}/out").count() == ev.count()


def test_stream_change_tracking_replay_and_equivalence(spark, tmp):
    from tessera.plans.change_tracking import stream_change_tracking
    ev = split_in_time_order(spark, f"{tmp}/in", parts=3)
    stream = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)
    cells, hist = stream_change_tracking(stream, key="user_id", status=F.col("event_type"), ts="ts",
                                         tiebreak="event_id", root=f"{tmp}/ct", checkpoint=f"{tmp}/ck")
    first = rows(spark.read.parquet(hist))
    # restart: nothing new, nothing changes
    stream2 = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)
    stream_change_tracking(stream2, key="user_id", status=F.col("event_type"), ts="ts",
                           tiebreak="event_id", root=f"{tmp}/ct", checkpoint=f"{tmp}/ck")
    assert rows(spark.read.parquet(hist)) == first
    # the final state equals the last event type per user
    state = rows(C.resolve(C.read_cells(spark, cells).drop("batch_id")), "row_key", "value")
    last = ev.groupBy("user_id").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("s"))
    assert state == rows(last.select(F.col("user_id").cast("string"), "s"))


def test_stream_restart_picks_up_new_files_only(spark, tmp):
    ev = split_in_time_order(spark, f"{tmp}/all", parts=4)
    files = sorted((f for f in os.listdir(f"{tmp}/all") if f.endswith(".parquet")),
                   key=lambda f: os.path.getmtime(os.path.join(f"{tmp}/all", f)))
    os.makedirs(f"{tmp}/in")
    now = time.time() - 500

    def land(names, start):
        for i, f in enumerate(names):  # copy files into the watched folder, oldest first
            with open(os.path.join(f"{tmp}/all", f), "rb") as src, open(os.path.join(f"{tmp}/in", f), "wb") as dst:
                dst.write(src.read())
            os.utime(os.path.join(f"{tmp}/in", f), (now + start + i, now + start + i))

    def run():
        stream = SM.file_stream(spark, f"{tmp}/in", ev.schema, max_files_per_trigger=1)
        muts = C.mutations(stream, row_key="user_id", family="c", qualifier=F.col("event_type"), kind=C.INCREMENT,
                           delta=F.lit(1), ts=epoch_micros("ts"), seq=F.col("event_id"))
        SM.append_to_files(muts, f"{tmp}/out", f"{tmp}/ck")

    land(files[:2], 0)
    run()
    land(files[2:], 10)
    run()
    got = rows(C.resolve(C.read_cells(spark, f"{tmp}/out")), "row_key", "qualifier", "value")
    want = ev.groupBy(F.col("user_id").cast("string"), "event_type").agg(F.count("*").cast("string"))
    assert got == rows(want)
    assert C.read_cells(spark, f"{tmp}/out").count() == ev.count()


def test_stream_gets_see_puts_between_batches_and_replay_alike(spark, tmp):
    store = f"{tmp}/store"
    users = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    C.write_cells(C.put(C.empty_cells(spark), users, row_key="k", family="c", qualifier="name", value="v", ts=1), store)
    seen = spark.createDataFrame([(10, 1), (11, 9)], "id int, k int")
    seen.coalesce(1).write.parquet(f"{tmp}/in")

    def run():
        stream = SM.file_stream(spark, f"{tmp}/in", seen.schema, max_files_per_trigger=1)
        return SM.stream_gets(stream, store, key_col="k", qualifiers=["name"], path=f"{tmp}/out", checkpoint=f"{tmp}/ck")

    assert rows(run(), "id", "k", "name") == [(10, 1, "a"), (11, 9, None)]
    newer = users.filter("k = '1'").withColumn("v", F.lit("new"))
    C.write_cells(C.put(C.empty_cells(spark), newer, row_key="k", family="c", qualifier="name", value="v", ts=2), store)
    assert rows(C.resolve(C.read_pinned(spark, store, f"{tmp}/out/pins/0")), "value") == [("a",), ("b",)]
    spark.createDataFrame([(12, 1)], "id int, k int").coalesce(1).write.mode("append").parquet(f"{tmp}/in")
    assert rows(run(), "id", "name") == [(10, "a"), (11, None), (12, "new")]


def test_change_tracking_of_late_batches(spark, tmp):
    """A batch that comes late changes neither state nor cells; a batch writes its changes only."""
    from tessera.plans.change_tracking import stream_change_tracking

    batches = [[("u", "a", 10, 1), ("w", "x", 10, 2), ("z", "s", 10, 9)], [("u", "a", 20, 3)], [("u", "b", 15, 4), ("w", "y", 30, 5)]]
    schema = "user string, status string, t long, id long"
    for i, batch in enumerate(batches):
        df = spark.createDataFrame(batch, schema).select("user", "status", F.timestamp_seconds("t").cast("timestamp_ntz").alias("ts"), "id")
        df.coalesce(1).write.mode("append").parquet(f"{tmp}/in/p={i}")
        for f in os.listdir(f"{tmp}/in/p={i}"):
            os.utime(f"{tmp}/in/p={i}/{f}", (time.time() - 1000 + i,) * 2)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp}/in")
    cells, hist = stream_change_tracking(stream, key="user", status=F.col("status"), ts="ts", tiebreak="id", root=f"{tmp}/ct", checkpoint=f"{tmp}/ck")
    written = spark.read.parquet(cells)
    assert rows(written, "batch_id", "row_key", "value") == [(0, "u", "a"), (0, "w", "x"), (0, "z", "s"), (2, "w", "y")]
    assert rows(C.resolve(C.read_cells(spark, cells).drop("batch_id")), "row_key", "value") == [("u", "a"), ("w", "y"), ("z", "s")]
    assert rows(spark.read.parquet(hist), "id_ts") == [("u:19700101000010",), ("w:19700101000010",), ("w:19700101000030",), ("z:19700101000010",)]


def test_event_slices_of_several_files_replay_in_order(spark, tmp):
    import datetime as dt

    from tessera.catalog import _event_slices

    # the third quarter of the time has two events, so its slice lacks files; an event without time comes first
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(hours=n)
    hours = [*range(0, 50), 60, *range(75, 101)]
    spark.createDataFrame([(i, day(h), i % 7, "view", 1.0, "{}") for i, h in enumerate(hours)] + [(999, None, 1, "view", 1.0, "{}")],
                          "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp}/events.parquet")
    root, schema, files = _event_slices(spark, tmp, rows_per_file=5)
    assert files == 4
    batches = {}
    stream = SM.file_stream(spark, root, schema, max_files_per_trigger=files)
    SM.foreach_batch(stream, lambda b, i: batches.__setitem__(i, sorted(r.event_id for r in b.select("event_id").collect())), f"{tmp}/ck")
    step = 25 + 1e-9  # the last time belongs to the last slice
    want = [sorted([i for i, h in enumerate(hours) if min(int(h / step), 3) == k] + [999] * (k == 0)) for k in range(4)]
    assert [batches[i] for i in sorted(batches)] == want
