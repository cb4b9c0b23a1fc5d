"""Line dedup over overlapping windows of three lines, with DataFrame functions only.

A text's lines (split at U+000A) are trimmed of white space; lines that are
then empty stand in no window. Every three consecutive lines of what remains
form a window, known by two 64-bit hashes. Of equal windows anywhere in the
table the earliest stays, by ``doc_id`` (null last), then by place. Lines that
a later occurrence covers are removed; covered places that overlap or touch
are merged into one span, and empty lines inside a span go with it.

Plan: windows are counted by hash (combined before the shuffle, so a window
that a third of the table holds is one row for each task), the repeated ones
joined back (skewed keys are split by the adaptive join), and only spans meet
the texts. Hot windows are never gathered.

A null or empty text has no lines and stays as it is; fewer than three lines
make no window. Rows equal in ``doc_id`` and text are the same document and
get the same result; rows with one ``doc_id`` and other texts rank alike, so
windows at the same place in them all stay. All other columns are returned as
they are, also when they are called like a column of this operator. An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import WHITE, cut_spans, merged_spans

LINES = 3
_LAST = 2**63 - 1


def _windows(base: DataFrame) -> DataFrame:
    """(doc_id, text_key, first, last, h1, h2) of every window: the line numbers it spans and its hashes.

    Windows are shifted slices of one array zipped together, so their number
    and the work are linear in the lines.
    """
    placed = F.transform("lines", lambda l, i: F.struct(i.alias("at"), F.btrim(l, F.lit(WHITE)).alias("line")))
    full = base.select("doc_id", "text_key", F.filter(placed, lambda s: s["line"] != "").alias("full"))
    n = F.greatest(F.size("full") - (LINES - 1), F.lit(0))
    zipped = F.arrays_zip(*[F.slice("full", F.lit(k + 1), n).alias(f"l{k}") for k in range(LINES)])
    rows = full.select("doc_id", "text_key", F.explode(zipped).alias("w"))
    rows = rows.select("doc_id", "text_key", *[F.col("w")[str(k)].alias(f"l{k}") for k in range(LINES)]) if rows.schema["w"].dataType.names[0] == "0" else rows.select("doc_id", "text_key", "w.*")
    held = [F.col(f"l{k}.line") for k in range(LINES)]
    return rows.select("doc_id", "text_key", F.col("l0.at").alias("first"), F.col(f"l{LINES - 1}.at").alias("last"), F.xxhash64(*held).alias("h1"), F.xxhash64(F.lit("second"), *held).alias("h2"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, spans) for the documents that lose lines; ``spans`` holds (first, last), from 0."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), F.xxhash64("text").alias("text_key"), F.split("text", "\n", -1).alias("lines"))
    held = _windows(base)
    held = held.withColumn("rank", F.col("doc_id").cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("first").cast("decimal(10,0)"))
    kept = held.groupBy("h1", "h2").agg(F.min("rank").alias("kept"), F.max("rank").alias("latest")).where("latest > kept").drop("latest")
    later = held.join(kept, ["h1", "h2"]).where("rank > kept").select("doc_id", "text_key", "first", "last").distinct()
    return merged_spans(later, ["doc_id", "text_key"])


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``doc_id``, ``text``) as struct ``row``, plus ``n_lines``, ``spans`` and the new ``clean_text``."""
    spans = repeated_spans(docs).withColumnRenamed("doc_id", "span_id").withColumnRenamed("text_key", "span_key")
    rows = docs.select(F.struct("*").alias("row"))
    on = (F.coalesce(F.col("row.doc_id").cast("long"), F.lit(_LAST)) == F.col("span_id")) & (F.xxhash64("row.text") == F.col("span_key"))
    out = rows.join(spans, on, "left").select("row", "spans", F.split("row.text", "\n", -1).alias("lines"))  # split once, ahead of the slices
    n_lines = F.coalesce(F.when(F.col("row.text") != "", F.size("lines")), F.lit(0)).cast("long")
    clean = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(cut_spans(F.col("lines"), F.col("spans")))
    return out.select("row", n_lines.alias("n_lines"), "spans", clean.alias("clean_text"))
