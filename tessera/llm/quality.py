"""Quality classifier by compression.

Two zstandard dictionaries hold text labelled good and bad. A text is cut into
blocks of ``BLOCK`` bytes; each is compressed with either dictionary and with
none. The score comes from the compressed sizes alone: the normalised
difference (bad - good) / (bad + good) over the whole text and for its worst
block, both sizes against the plain one, the plain ratio by block and for the
text as a whole, and the length. A logistic curve, fitted on labelled texts
that are not in the dictionaries, calibrates it to the probability of label 1.

Fitting uses a bounded sample: of either label at most ``SAMPLE_ROWS`` rows of
at most ``SAMPLE_CHARS`` characters, the first by the MD5 of their id; of
these up to ``DICTIONARY_BYTES`` fill a dictionary and the rest calibrate,
weighted by the labels' true counts. Rows held out (CRC-32 of the id's text
divisible by ``FOLDS``) are never used. Everything else covers all rows and whole texts;
scoring is a narrow pass without shuffle.

Null counts as empty; empty texts are scored like any other. If either label
has no usable rows, the score is the share of label 1 (0.5 without labels).
Null qualities are ignored, and the greatest of an id's labels counts.
Extra columns are ignored (``score``) or carried (``row``). An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import ship, text_or_empty

FOLDS = 5
SAMPLE_ROWS, SAMPLE_CHARS = 4000, 20_000
DICTIONARY_BYTES = 1_000_000
#: Of a label's sample at most this share fills its dictionary.
DICTIONARY_SHARE = 0.5
BLOCK, LEVEL = 2048, 6
THRESHOLD = 0.3
#: The measures that neither dictionary enters: good texts may lie in their middle, so their squares count as well.
#: Those of the dictionaries count in one direction only; the more a text is like the good one, the better.
PLAIN = slice(2, 5)


@dataclass
class Model:
    """Dictionaries and calibration; ``prior`` alone if there is nothing to fit."""

    prior: float
    good: bytes = b""
    bad: bytes = b""
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


class Measure:
    """Turns texts into sizes."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard as z

        own = []
        for raw in (good, bad):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            own.append(z.ZstdCompressor(dict_data=d).compress)
        self.good, self.bad, self.plain = *own, z.ZstdCompressor(level=LEVEL).compress

    def features(self, text: str) -> list[float]:
        raw = text.encode("utf-8", "surrogatepass")
        good = bad = plain = 0
        worst = 1.0
        for at in range(0, max(len(raw), 1), BLOCK):
            block = raw[at : at + BLOCK]
            g, b = len(self.good(block)), len(self.bad(block))
            good, bad, plain = good + g, bad + b, plain + len(self.plain(block))
            worst = min(worst, (b - g) / (b + g))
        n = max(len(raw), 1)
        return [(bad - good) / (bad + good), worst, plain / n, len(self.plain(raw)) / n, math.log1p(len(raw)), good / plain, bad / plain]


def _terms(x: np.ndarray, model: Model) -> np.ndarray:
    """Terms of the curve. Measures beyond those it was fitted on, as texts inside a dictionary have, count as the outermost."""
    z = np.clip((np.clip(x, model.low, model.high) - model.mean) / model.spread, -6, 6)
    return np.concatenate([np.ones((len(z), 1)), z, z[:, PLAIN] ** 2], axis=1)


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the rows of ``labels`` (doc_id, quality) that are not held out."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.max("quality") >= 1).alias("good"))
    known = known.where(~held_out(F.col("doc_id"))).withColumn("order", F.md5(F.col("doc_id").cast("string")))
    counts = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    prior = counts.get(True, 0) / total if total else 0.5
    drawn = {}
    for label in (True, False):  # bounded: SAMPLE_ROWS ids, then their rows
        ids = known.where(F.col("good") == label).orderBy("order").limit(SAMPLE_ROWS).select("doc_id", "order")
        rows = docs.select("doc_id", text_or_empty().alias("text")).join(F.broadcast(ids), "doc_id").where(F.length("text").between(1, SAMPLE_CHARS))
        drawn[label] = [r["text"] for r in rows.orderBy("order", F.md5("text")).limit(SAMPLE_ROWS).select("text").collect()]
    if min(map(len, drawn.values())) < 2:
        return Model(prior)
    texts, rest = {}, {}
    for label, own in drawn.items():
        held, n = 0, 0
        while n < DICTIONARY_SHARE * len(own) and held < DICTIONARY_BYTES:
            held += len(own[n].encode())
            n += 1
        texts[label], rest[label] = "\n".join(own[:n]).encode("utf-8", "surrogatepass")[-DICTIONARY_BYTES:], own[n:]
    measure = Measure(texts[True], texts[False])
    x = np.array([measure.features(t) for label in (True, False) for t in rest[label]])
    y = np.array([float(label) for label in (True, False) for _ in rest[label]])
    weight = np.where(y == 1, counts[True] / max(len(rest[True]), 1), counts[False] / max(len(rest[False]), 1))
    weight /= weight.sum()
    mean, spread = weight @ x, x.std(axis=0) + 1e-9
    model = Model(prior, texts[True], texts[False], mean, spread, None, x.min(axis=0), x.max(axis=0))
    terms = _terms(x, model)
    w = np.zeros(terms.shape[1])
    for _ in range(60):  # Newton steps on the penalised likelihood
        p = 1 / (1 + np.exp(-np.clip(terms @ w, -30, 30)))
        slope = terms.T @ (weight * (p - y)) + 1e-4 * w
        bend = (terms * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ terms + 1e-4 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-9))
    model.weights = w
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score): each row of ``docs`` as a struct, and the score of its ``text``."""
    ship(docs)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), text_or_empty().alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        measure = Measure(own.good, own.bad) if own.weights is not None else None
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                if measure is None:
                    found = np.full(part.num_rows, own.prior)
                else:
                    x = np.array([measure.features(t.as_py()) for t in part.column(1)])
                    found = 1 / (1 + np.exp(-np.clip(_terms(x, own) @ own.weights, -30, 30)))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["row", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")
