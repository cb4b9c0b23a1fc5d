"""Exact dedup through an extendible-hash index on shared files.

Texts are normalised (white space of the contract deleted) and hashed
(SHA-256; its leading bits are the index's hash). The index is extendible: a
directory maps the first bits of a hash to a bucket, and as long as a bucket
holds more than ``capacity`` entries the directory doubles and the bucket is
split by one more bit. Entries are one for each distinct (hash, digest), with
its group's size and survivor, so copies do not overfill a bucket. Buckets are
written as files of the shared folder, each by the task that owns its range
of hashes, sorted by hash.

Entries with equal hash are chained. Hashes that occur more than once have
their texts compared byte by byte: rows are grouped by (hash, whole normalised
text), with copies combined before the shuffle. Texts that differ under one
hash become links of one chain, told apart by their digests; two texts with
one digest would fail the job. Each row then finds its entry in the index.

Null counts as empty. Rows with a null id rank after all others; rows equal in
id and length are interchangeable, and all rows with the survivor's id and
text count as kept. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F

from .common import WHITE, materialise, text_or_empty

from tessera.session import scratch_path

#: Entries in a bucket before it splits.
CAPACITY = 100_000
#: Bits of the hash that the index uses.
HASH_BITS = 60
_ID_SPAN = Decimal(10**20)


def normalised(text: Column) -> Column:
    return F.translate(text_or_empty(text), WHITE, "")


def directory(entries: DataFrame, capacity: int, hash_bits: int) -> DataFrame:
    """(depth, prefix) of every bucket: doubles until no bucket that can split is overfull.

    Each doubling is one count of the entries of overfull buckets, by prefix.
    What reaches the driver is one number for each doubling.
    """
    buckets, depth = None, 0
    counts = entries.groupBy(F.shiftright("hash", hash_bits - min(hash_bits, 16)).alias("top")).agg(F.count("*").alias("n"))
    counts, fine = materialise(counts, "dir-counts"), min(hash_bits, 16)
    open_ = counts
    while True:
        if depth > fine:  # more bits are asked for than were counted
            fine = min(hash_bits, depth + 8)
            still = open_.select(F.col("prefix").alias("of")).distinct()
            deep = entries.withColumn("of", F.shiftright("hash", hash_bits - depth + 1)).join(still, "of")
            open_ = materialise(deep.groupBy(F.shiftright("hash", hash_bits - fine).alias("top")).agg(F.count("*").alias("n")), "dir-deep")
        at = open_.withColumn("prefix", F.shiftright("top", fine - depth))
        full = at.groupBy("prefix").agg(F.sum("n").alias("held"))
        done = full if depth == hash_bits else full.where(F.col("held") <= capacity)
        leaves = done.select(F.lit(depth).alias("depth"), "prefix", "held")
        buckets = leaves if buckets is None else buckets.union(leaves)
        if depth == hash_bits:
            break
        over = materialise(full.where(F.col("held") > capacity).select("prefix"), "dir-over")
        if not over.limit(1).count():
            break
        open_ = at.join(over, "prefix")
        depth += 1
    return materialise(buckets, "directory")


def build_index(rows: DataFrame, capacity: int = CAPACITY, hash_bits: int = HASH_BITS) -> str:
    """Write the index of (hash, digest, rank) rows; returns the folder of its bucket files.

    Files hold (depth, prefix, hash, digest, copies, best); ``best`` is the
    survivor's rank, see ``rank_of``.
    """
    entries = materialise(rows.groupBy("hash", "digest").agg(F.count("*").alias("copies"), F.max("rank").alias("best")), "entries")
    buckets = directory(entries, capacity, hash_bits)
    depths = [r["depth"] for r in buckets.select("depth").distinct().collect()]  # at most hash_bits + 1
    owned = None
    for d in depths:
        part = entries.withColumn("prefix", F.shiftright("hash", hash_bits - d)).join(buckets.where(F.col("depth") == d).select("prefix"), "prefix").withColumn("depth", F.lit(d))
        owned = part if owned is None else owned.union(part)
    path = scratch_path(rows.sparkSession, "hash-index")
    owned = entries.withColumn("prefix", F.lit(0).cast("long")).withColumn("depth", F.lit(0)) if owned is None else owned
    start = F.expr(f"shiftleft(prefix, {hash_bits} - depth)")  # a bucket's range is never divided
    owned.repartitionByRange(start).sortWithinPartitions("hash", "digest").write.parquet(path)
    return path


def rank_of(n_chars: Column, doc_id: Column) -> Column:
    """Greater for longer originals, then for smaller ids; null ids rank below all others."""
    order = F.coalesce(F.lit(2**63 - 1).cast("decimal(20,0)") - doc_id.cast("decimal(20,0)") + 1, F.lit(0).cast("decimal(20,0)"))
    return (n_chars.cast("decimal(12,0)") * F.lit(_ID_SPAN).cast("decimal(21,0)") + order).cast("decimal(38,0)")


def survivor_id(rank: Column) -> Column:
    order = (rank % F.lit(_ID_SPAN).cast("decimal(38,0)")).cast("decimal(38,0)")
    return F.when(order > 0, (F.lit(Decimal(2**63)).cast("decimal(38,0)") - order).cast("long"))


def exact_groups(docs: DataFrame, capacity: int = CAPACITY, hash_bits: int = HASH_BITS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (doc_id, text)."""
    norm = normalised(F.col("text"))
    digest = F.sha2(norm.cast("binary"), 256)
    n_chars = F.length(text_or_empty())
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), norm.alias("norm"), digest.alias("digest"), n_chars.alias("n_chars"))
    base = base.withColumn("hash", F.shiftright(F.conv(F.substring("digest", 1, 15), 16, 10).cast("long"), 60 - hash_bits)).withColumn("rank", rank_of(F.col("n_chars"), F.col("doc_id")))
    spark = docs.sparkSession
    lean = materialise(base.select("doc_id", "hash", "digest", "rank"), "hashed")
    path = build_index(lean.select("hash", "digest", "rank"), capacity, hash_bits)
    index = spark.read.parquet(path)

    # chains: the whole texts under each hash that occurs more than once
    crowded = materialise(index.groupBy("hash").agg(F.sum("copies").alias("rows")).where("rows > 1").select("hash"), "crowded")
    texts = base.select("hash", "digest", "norm").join(crowded, "hash", "left_semi").groupBy("hash", "norm").agg(F.count("*").alias("copies"), F.max("digest").alias("digest"))
    chains = materialise(texts.select("hash", "digest", "copies"), "chains")
    wrong = chains.groupBy("hash", "digest").agg(F.count("*").alias("texts")).where("texts > 1").limit(1).count()
    if wrong:
        raise ValueError("two different texts have the same SHA-256 digest")

    entries = index.select(F.col("hash").alias("i_hash"), F.col("digest").alias("i_digest"), "best", "copies")
    found = lean.join(entries, (lean.hash == F.col("i_hash")) & (lean.digest == F.col("i_digest")))
    return found.select("doc_id", survivor_id(F.col("best")).alias("keep_id"), F.col("copies").cast("long").alias("group_size"), (F.col("rank") == F.col("best")).alias("kept"), F.col("digest").alias("text_sha256"))
