"""Substring dedup on lines, paragraphs or sentences.

Units are the pieces of a text that end with a match of an expression: a line
feed, an empty line, or also the end of a sentence. A unit is normalised (lower case, white space
runs as one space, trimmed) and known by a 128-bit digest. Digests are grouped over
the whole table; the occurrence with the least (doc_id, null last; place) stays and
later ones, in the same text or in others, are repeated units. Every unit that
isn't only white space counts, however short.

Repeated units that follow each other (white space aside) make a run, and
runs of at least ``run_words`` words are removed: with 1 each repeated unit, with more
passages only, so that a short common line is left where it stands alone. A
unit has as many words as white space separates, or a word for each
``CHARS_PER_WORD`` characters if that is more, so lines without spaces count too. The result
keeps, for each removed run, its offsets in the original text, the unit's own ends
included; what stays is unchanged.

Digests are counted with a combine before the shuffle, so a unit that a third
of the table holds moves one row for each task; the join back is on the
digest, where skewed keys are split by the adaptive join.

Null and empty texts have no units and stay as they are. Rows equal in
``doc_id`` and text are one document and get the same result; rows with one
``doc_id`` and other texts rank alike. Extra columns are carried in ``row``.
An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import merged_spans, ship

_LAST = 2**63 - 1
#: Ends of units, as regular expressions.
LINES, PARAGRAPHS, SENTENCES = r"\n", r"\n\n", r"\n|[.!?][ \t]+"
CHARS_PER_WORD = 8


def units(text: str, end: re.Pattern) -> list[tuple[int, int, int, int, bytes]]:
    """(place, start, stop, words, digest) of the units that aren't only white space; offsets in code points."""
    out, start = [], 0
    for stop in [*[m.end() for m in end.finditer(text)], len(text)]:
        words = text[start:stop].split()
        if words:
            normal = " ".join(words).lower()
            digest = hashlib.blake2b(normal.encode("utf-8", "surrogatepass"), digest_size=16).digest()
            out.append((len(out), start, stop, max(len(words), len(normal) // CHARS_PER_WORD), digest))
        start = stop
    return out


def _unit_rows(base: DataFrame, unit_end: str) -> DataFrame:
    names = ["doc_id", "text_key", "first", "start", "stop", "size", "digest"]

    def batch_of(rows: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(r, t) for r, t in zip(rows, _TYPES, strict=True)], names)

    def run(batches):
        end = re.compile(unit_end)
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            for doc, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                for unit in units(text.as_py() or "", end):
                    for column, value in zip(rows, (doc, key, *unit), strict=True):
                        column.append(value)
                if len(rows[0]) >= 50_000:
                    yield batch_of(rows)
                    rows = [[] for _ in names]
            yield batch_of(rows)

    return base.mapInArrow(run, "doc_id long, text_key long, first int, start long, stop long, size long, digest binary")


def _cut(docs: DataFrame) -> DataFrame:
    """(row, spans) with ``clean_text``, the row's text without the spans."""
    row, spans = (docs.schema[c].dataType.simpleString() for c in ("row", "spans"))

    def run(batches):
        for batch in batches:
            texts, out = batch.column(0).field("text"), []
            for text, cuts in zip(texts, batch.column(1), strict=True):
                if not cuts.is_valid:
                    out.append(text.as_py())
                    continue
                whole, kept, at = text.as_py(), [], 0
                for cut in cuts.as_py():
                    kept.append(whole[at : cut["start"]])
                    at = cut["stop"]
                out.append("".join([*kept, whole[at:]]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string())], ["row", "spans", "clean_text"])

    return docs.mapInArrow(run, f"row {row}, spans {spans}, clean_text string")


_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]


def dedup_units(docs: DataFrame, unit_end: str = LINES, run_words: int = 1) -> DataFrame:
    """``docs`` (with ``doc_id``, ``text``) as struct ``row``, plus ``spans`` and ``clean_text``.

    ``spans``: removed runs of units, as (first, last) unit numbers, (start, stop)
    offsets in the original text and ``size`` in words; null if nothing was removed.
    """
    ship(docs)
    docs = docs.withColumn("text", F.col("text").cast("string"))
    base = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    held = _unit_rows(base, unit_end)
    # by whole numbers (doc_id, place); the join moves their parts alone
    rank = F.col("doc_id").cast("decimal(20,0)") * F.lit(2**31).cast("decimal(10,0)") + F.col("first").cast("decimal(10,0)")
    kept = held.groupBy("digest").agg(F.min(rank).alias("kept"), F.count("*").alias("times")).where("times > 1").select("digest", "kept")
    later = held.join(kept, "digest").where(rank > F.col("kept")).select("doc_id", "text_key", "first", F.col("first").alias("last"), "start", "stop", "size").distinct()
    runs = merged_spans(later, ["doc_id", "text_key"], {"start": "min", "stop": "max", "size": "sum"})
    long = F.filter("spans", lambda s: s["size"] >= run_words)
    spans = runs.select(F.col("doc_id").alias("span_id"), F.col("text_key").alias("span_key"), long.alias("spans")).where(F.size("spans") > 0)
    on = (F.coalesce(F.col("row.doc_id").cast("long"), F.lit(_LAST)) == F.col("span_id")) & (F.xxhash64("row.text") == F.col("span_key"))
    return _cut(docs.select(F.struct("*").alias("row")).join(spans, on, "left").select("row", "spans"))
