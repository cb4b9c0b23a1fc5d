"""Mix sources to target weights, with DataFrame functions only.

Efraimidis-Spirakis sampling: every document gets the exponential key
``-ln(u) / weight``, with u drawn from a hash of its id and a seed, so reruns
agree, and ``weight`` its quality. Each source takes whole epochs first
(every document, ``floor(target / size of the source)`` times), then documents
in ascending order of key, prefix-summed, until the rest of its budget is
used; the document on the edge is taken if that brings the sum nearer.

Targets: sources in code-point order (null last) have the weights of
``weights``, repeating, and share the total size by weight. No target exceeds
``most_epochs`` times its source's size; what is over is shared again by
weight among the others until none is above, which is the water level found
here by prefix sums over the sources in order of (cap / weight).

A source may hold a third of all rows, so no source is sorted whole: its
documents fall by key into ranges of about ``RANGE_ROWS`` documents, the sums
of ranges are prefix-summed, and only the one range in which the budget ends
is sorted. That gives each source a threshold (range, then key, id, size), and
documents are taken or left by comparing with it in a narrow pass; texts are
never shuffled. Windows without partition see one row for each source only.

A null text has size 0; documents of size 0 are returned with ``taken`` 0.
A null id hashes as an empty one. Rows with equal id and size are
interchangeable. Extra columns are ignored. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import WORD, materialise, small

RANGE_ROWS = 4096
#: Most sources whose table is broadcast.
BROADCAST_SOURCES = 100_000
#: Most quality weights that are broadcast (16 bytes each).
BROADCAST_WEIGHTS = 500_000


def word_count(text: Column) -> Column:
    """Words of a text as long; null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """(source_no, source, n_docs, source_size, target) from (source, n_docs, source_size), one row a source."""
    everything = W.partitionBy()
    listed = F.array(*[F.lit(w).cast("long") for w in weights])
    ranked = sizes.withColumn("source_no", F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())))
    ranked = ranked.withColumn("weight", F.get(listed, (F.col("source_no") - 1) % len(weights))).withColumn("cap", F.col("source_size") * most_epochs)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "source_no")
    level = (ranked.withColumn("place", F.row_number().over(by_ratio))
             .withColumn("filled", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
             .withColumn("open_weight", F.sum("weight").over(by_ratio.rowsBetween(0, W.unboundedFollowing)))
             .withColumn("left", F.sum("source_size").over(everything) - F.col("filled")))
    # the first place from which no source reaches its cap
    fits = F.col("left") * F.col("weight") <= F.col("cap") * F.col("open_weight")
    level = level.withColumn("edge", F.min(F.when(fits, F.col("place"))).over(everything))
    at_edge = lambda c: F.max(F.when(F.col("place") == F.col("edge"), F.col(c))).over(everything)
    level = level.withColumn("rest", at_edge("left")).withColumn("shares", at_edge("open_weight"))
    target = F.when(F.col("place") < F.col("edge"), F.col("cap").cast("double")).otherwise((F.col("rest") * F.col("weight")).cast("double") / F.col("shares"))
    return level.select("source_no", "source", "n_docs", "source_size", target.alias("target"))


def unit_random(identifier: Column, seed: int) -> Column:
    """A number in (0, 1) from the MD5 of the id and the seed."""
    text = F.concat(F.coalesce(identifier.cast("string"), F.lit("")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(16**13)


def keyed(docs: DataFrame, weights: DataFrame, seed: int = 7) -> DataFrame:
    """``docs`` (doc_id, source, text) as struct ``row`` with ``size`` and ``key``.

    ``weights`` is (doc_id, quality_weight); documents without one weigh 1. It
    is broadcast if it has at most ``BROADCAST_WEIGHTS`` rows.
    """
    named = weights.select(F.col("doc_id").alias("w_id"), F.col("quality_weight").cast("double").alias("quality_weight"))
    rows = docs.select(F.struct("*").alias("row")).join(small(named, BROADCAST_WEIGHTS), F.col("row.doc_id") == F.col("w_id"), "left")
    key = -F.ln(unit_random(F.col("row.doc_id"), seed)) / F.coalesce("quality_weight", F.lit(1.0))
    return rows.select("row", word_count(F.col("row.text")).alias("size"), key.alias("key"))


def _range(n_docs: Column, key: Column) -> Column:
    n = F.ceil(n_docs / RANGE_ROWS)
    return F.least(n - 1, F.floor(n * (1 - F.exp(-key)))).cast("long")


def _order(key: str, doc: str, size: str) -> Column:
    return F.struct(F.col(key).alias("key"), F.coalesce(F.col(doc).cast("long"), F.lit(-(2**63))).alias("id"), F.col(size).alias("size"))


def thresholds(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3) -> DataFrame:
    """One row for each source of (doc_id, source, size, key): its target, epochs and where fractional selection ends."""
    per_source = rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    sources = targets(per_source, weights, most_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("epochs", epochs).withColumn("rest", F.col("target") - (F.col("epochs") * F.col("source_size")).cast("double"))
    sources = materialise(sources.withColumnRenamed("source", "of_source"), "mix-sources")
    own = F.col("source").eqNullSafe(F.col("of_source"))
    placed = rows.join(small(sources, BROADCAST_SOURCES), own).withColumn("range", _range(F.col("n_docs"), F.col("key")))
    before = W.partitionBy("source_no").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    sums = placed.groupBy("source_no", "rest", "range").agg(F.sum("size").alias("held")).withColumn("offset", F.coalesce(F.sum("held").over(before), F.lit(0)))
    edges = sums.where(F.col("offset") + F.col("held") > F.col("rest")).groupBy("source_no").agg(F.min("range").alias("edge"), F.min("offset").alias("edge_offset"))
    edges = materialise(sources.join(edges, "source_no", "left"), "mix-edges")
    at_edge = rows.join(small(edges, BROADCAST_SOURCES), own).where(_range(F.col("n_docs"), F.col("key")) == F.col("edge")).withColumn("at", _order("key", "doc_id", "size"))
    inside = W.partitionBy("source_no").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    taken = at_edge.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).where(F.col("edge_offset") + F.col("inside") + F.col("size") / 2 <= F.col("rest"))
    return materialise(edges.join(taken.groupBy("source_no").agg(F.max("at").alias("last")), "source_no", "left"), "mix-thresholds")


def times_taken(rows: DataFrame, limits: DataFrame) -> DataFrame:
    """``rows`` (with ``source``, ``doc_id``, ``size``, ``key``) plus source_size, target and ``times``, how often each is taken."""
    found = rows.join(small(limits, BROADCAST_SOURCES), F.col("source").eqNullSafe(F.col("of_source")))
    place = _range(F.col("n_docs"), F.col("key"))
    more = F.coalesce((F.col("rest") > 0) & ((place < F.col("edge")) | ((place == F.col("edge")) & (_order("key", "doc_id", "size") <= F.col("last")))), F.lit(False))
    return found.select(*rows.columns, "source_size", "target", (F.col("epochs") + more.cast("long")).cast("int").alias("times"))


def mix(docs: DataFrame, weights: DataFrame, shares: tuple[int, ...] = (1, 2, 3), most_epochs: int = 3, seed: int = 7) -> DataFrame:
    """``docs`` as struct ``row`` with size, source_size, target and ``times``; see the module's text."""
    rows = keyed(docs, weights, seed).select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), "size", "key")
    lean = materialise(rows.drop("row"), "mix-keyed")
    return times_taken(rows, thresholds(lean, shares, most_epochs))


def quality_weights(labels: DataFrame) -> DataFrame:
    """(doc_id, quality_weight): 2 for documents labelled good, 0.5 for bad ones."""
    rows = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.when(F.max("quality") >= 1, 2.0).otherwise(0.5).alias("quality_weight"))
    return materialise(rows, "mix-weights")
