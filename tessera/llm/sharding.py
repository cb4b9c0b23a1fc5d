"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Each shard owns ``VNODES`` places on a ring of 64-bit hashes; a row goes to
the first place clockwise from its key's hash. Loads are bounded: a shard
takes no more rows than its capacity, and rows that find it full go on
clockwise. With capacities that add up to the number of rows (as here, where
they differ by one at most) counts are at most one apart; with more room
fewer rows move when a shard is added.

How it runs: rows are counted by arc of the ring. The counts, one for each
virtual node whatever the number of rows, are walked clockwise on the driver:
each node takes what its shard has room for, first its own rows, and passes on the rest.
The walk yields for every arc the ranges of ranks that go to each shard, with
the slots they take. Rows get their rank within their arc (a window over one
arc's rows, 1 / (shards x VNODES) of all) and find their range by a join with
that table, whose size depends on the number of virtual nodes only. Slots are
gapless by construction.

The key is the doc_id with the text's hash, so that equal ids spread. Null
texts have no bytes; null ids hash as such. Equal rows are interchangeable.
Extra columns are ignored by ``assign``. An empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window as W, functions as F

VNODES = 256


def ring(shards: int, vnodes: int = VNODES) -> list[tuple[int, int]]:
    """(place, shard) in ring order; places are signed 64-bit numbers."""
    place = lambda s, v: int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True)
    return sorted((place(s, v), s) for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """Rows each shard may take: with no slack they add up to ``rows`` and differ by one at most."""
    room = int(rows * (1 + slack))
    return [room // shards + (s < room % shards) for s in range(shards)]


def walk(counts: list[int], owners: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) for the rows of every arc.

    counts: rows by arc in ring order; owners: each arc's shard; room: by shard.
    Rows passed on wait in line, the oldest first.
    """
    room, taken, ranges = list(room), [0] * len(room), []
    waiting: list[list[int]] = []  # [arc, first rank, end rank]
    for step in range(2 * len(counts)):
        arc = step % len(counts)
        own = [[arc, 0, counts[arc]]] if step < len(counts) and counts[arc] else []
        shard, line = owners[arc], own + waiting
        waiting = []
        for piece in line:
            n = min(room[shard], piece[2] - piece[1])
            if n:
                ranges.append((piece[0], piece[1], piece[1] + n, shard, taken[shard]))
                room[shard] -= n
                taken[shard] += n
            if piece[1] + n < piece[2]:
                waiting.append([piece[0], piece[1] + n, piece[2]])
    if waiting:
        raise ValueError("the shards have less room than there are rows")
    return ranges


def assign(docs: DataFrame, shards: int = 16, vnodes: int = VNODES, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    places = ring(shards, vnodes)
    rows = docs.select(F.col("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    rows = rows.select("doc_id", (F.col("bytes") + 1).alias("size"), "text_crc32", F.xxhash64("doc_id", "text_crc32", "bytes").alias("spot"))
    # the arc of a hash ends at the first place at or after it; after the last, at the first
    top, keys, parts = 8, [p for p, _ in places], []
    for b in range(-(1 << (top - 1)), 1 << (top - 1)):  # places are looked up among those that begin with the same bits
        i, j = bisect.bisect_left(keys, b << (64 - top)), bisect.bisect_left(keys, (b + 1) << (64 - top))
        parts.append((b, keys[i:j], i))
    table = spark.createDataFrame(parts, "top long, places array<long>, base int")
    hit = rows.join(F.broadcast(table), F.shiftright("spot", 64 - top) == F.col("top"))
    arc = (F.col("base") + F.size(F.filter("places", lambda p: p < F.col("spot")))) % len(places)
    rows = hit.select("doc_id", "size", "text_crc32", "spot", arc.cast("int").alias("arc"))

    counted = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}  # one row for each virtual node
    counts = [counted.get(i, 0) for i in range(len(places))]
    ranges = walk(counts, [s for _, s in places], capacities(sum(counts), shards, slack))
    by_arc: dict[int, list] = {}
    for a, first, end, shard, slot in ranges:
        by_arc.setdefault(a, []).append((first, end, shard, slot))
    plan = spark.createDataFrame(list(by_arc.items()), "of_arc int, ranges array<struct<first:long,end:long,shard:int,slot:long>>")
    rank = F.row_number().over(W.partitionBy("arc").orderBy("spot", "doc_id", "size", "text_crc32")) - 1
    ranked = rows.withColumn("rank", rank.cast("long")).join(F.broadcast(plan), F.col("arc") == F.col("of_arc"))
    mine = F.get(F.filter("ranges", lambda r: (F.col("rank") >= r["first"]) & (F.col("rank") < r["end"])), F.lit(0))
    return ranked.withColumn("mine", mine).select("doc_id", "size", "text_crc32", F.col("mine.shard").alias("shard"), (F.col("mine.slot") + F.col("rank") - F.col("mine.first")).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16) -> None:
    """Write whole rows (doc_id, text and what else there is) as Parquet, one folder ``shard=N`` each.

    Rows meet their shard by (doc_id, size, CRC-32 of the text); of rows equal
    in these each lands once in any one of their shards.
    """
    same = lambda df: df.withColumn("_n", F.row_number().over(W.partitionBy("_id", "_size", "_crc").orderBy(F.lit(1))))
    put = same(assign(docs, shards).select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("text_crc32").alias("_crc"), "shard", "slot"))
    rows = same(docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_id"), (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("_size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("_crc")))
    put = put.select(*[F.col(c).alias(f"p{c}") for c in ("_id", "_size", "_crc", "_n")], "shard", "slot")
    both = rows.join(put, F.col("_id").eqNullSafe(F.col("p_id")) & (F.col("_size") == F.col("p_size")) & (F.col("_crc") == F.col("p_crc")) & (F.col("_n") == F.col("p_n")))
    both.select("shard", "slot", "_row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
