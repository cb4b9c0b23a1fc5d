"""Document fingerprints by a randomised edit embedding.

Every text is walked from its first character: at step j the walk emits the
character it stands on and moves on if the shared random bit of (j, character)
is 1. Two texts at small edit distance fall back into step after an edit, so
their emitted strings are at small Hamming distance. A text of n characters is
walked whole, about 2 n steps.

The fingerprint is a sample of the embedding (bit sampling): texts of 2^(k-2)
to 2^(k-1) characters have scale k and are sampled at ``SAMPLES`` shared random steps
below 2.25 * 2^k, and as many of scale k - 1, whose steps cover the whole text.
Texts whose lengths differ by a factor of up to two (or more, if their scales
are neighbours) so share a scale that covers both whole.
It is written as ``k:`` and two hexadecimal digits a sample, 00 after the
text's end. The likeness of two fingerprints is the share of equal samples of
the scale that covers the longer text, of those where either text goes on (0 if
they don't share it, 1 for two empty texts).

Walks run in lockstep over many texts of one scale with numpy (the bits of a
step are one 64-bit word), few or very long ones alone.

Null counts as empty: its fingerprint is the empty string. Rows with one
``doc_id`` are ordered by their texts' hashes, null ids come last in descending
order. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise, ship, text_or_empty
from .ngram_join import _labelled, components

SAMPLES, LEAST_SCALE = 128, 3
#: Characters walked together; bounds a worker's memory.
HELD_CHARS = 6_000_000
#: Fewer texts than this are walked one by one.
LOCKSTEP = 40
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x + _U(0x9E3779B97F4A7C15)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(30))) * _U(0x94D049BB133111EB)
    x = (x ^ (x >> _U(27))) * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def scale(n: int) -> int:
    """The larger scale of a text of n characters; the steps of the one below cover the text."""
    return max(LEAST_SCALE, (n - 1).bit_length()) + 1


@functools.lru_cache(maxsize=64)
def sample_steps(k: int) -> np.ndarray:
    """The shared steps of scale k, ascending."""
    span = (9 << k) // 4
    return np.sort((_mix(np.arange(SAMPLES, dtype=np.uint64) + _U(k * 1_000_003)) % _U(span)).astype(np.int64))


@functools.lru_cache(maxsize=2)
def _steps(n: int) -> np.ndarray:
    """The random words of the first n steps; bit 63 is 0, so a walk stays at its end."""
    return _mix(np.arange(n, dtype=np.uint64)) >> _U(1)


def _walk(classes: np.ndarray, symbols: np.ndarray, begin: np.ndarray, end: np.ndarray, k: int) -> np.ndarray:
    """Samples of scales k and k - 1 for the texts at begin..end (where the end mark is), one row each."""
    low = [sample_steps(k), sample_steps(max(k - 1, LEAST_SCALE))]
    wanted = np.concatenate(low)
    steps = np.unique(wanted)
    seen = np.zeros((len(steps), len(begin)), np.uint8)
    words = _steps(int(steps[-1]) + 1)
    if len(begin) < LOCKSTEP:
        for t, (b, e) in enumerate(zip(begin.tolist(), end.tolist(), strict=True)):
            own, at, j = classes[b : e + 1].tobytes(), 0, 0
            for s, upto in enumerate(steps.tolist()):
                if at < e - b:
                    for word in words[j:upto].tolist():
                        at += word >> own[at] & 1
                j = upto
                seen[s, t] = symbols[b + at]
    else:
        at, live, j = begin.copy(), np.arange(len(begin)), 0
        for s, upto in enumerate(steps.tolist()):
            here = at[live]
            for word in words[j:upto]:
                here += ((word >> classes[here]) & _U(1)).astype(np.int64)
            at[live] = here
            j = upto
            seen[s] = symbols[at]
            live = live[here < end[live]]
            if not len(live):
                break
    return seen[np.searchsorted(steps, wanted)].T


def embed(texts: list[str]) -> list[str]:
    """The fingerprints of the texts."""
    out = [""] * len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    end = np.cumsum(lengths + 1) - 1
    begin = end - lengths
    mixed = _mix(codes)
    classes, symbols = (mixed >> _U(58)).astype(np.uint8), ((mixed >> _U(32)) % _U(255) + _U(1)).astype(np.uint8)
    classes[classes == 63] = 62
    del mixed, codes
    classes[end], symbols[end] = 63, 0
    classes = classes.astype(np.uint64) if len(texts) >= LOCKSTEP else classes
    scales = np.array([scale(n) for n in lengths.tolist()])
    for k in np.unique(scales[lengths > 0]):
        which = np.flatnonzero((scales == k) & (lengths > 0))
        alone = len(which) < LOCKSTEP
        samples = _walk(classes.astype(np.uint8) if alone and classes.dtype != np.uint8 else classes, symbols, begin[which], end[which], int(k))
        for i, row in zip(which.tolist(), samples, strict=True):
            out[i] = f"{k}:{row.tobytes().hex()}"
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal samples at the scale that covers the longer text, 0 to 1."""
    if not a or not b:
        return float(a == b)
    (ka, sa), (kb, sb) = ((int(x[0]), np.frombuffer(bytes.fromhex(x[1]), np.uint8)) for x in (a.split(":"), b.split(":")))
    if abs(ka - kb) > 1:
        return 0.0
    k = max(ka, kb) - 1
    x, y = (s[:SAMPLES] if own == k else s[SAMPLES:] for own, s in ((ka, sa), (kb, sb)))
    goes_on = int(np.count_nonzero((x > 0) | (y > 0)))
    return int(np.count_nonzero((x == y) & (x > 0))) / goes_on if goes_on else 0.0


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) for every row of ``docs`` (doc_id, text); no shuffle."""
    ship(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _held((i, t) for b in batches for i, t in zip(b.column(0).to_pylist(), b.column(1), strict=True)):
            texts = [t.as_py() for t in texts]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(embed(texts), pa.string())], ["doc_id", "fingerprint"])

    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def _held(pairs):
    """Lists of ids and texts of about HELD_CHARS together."""
    ids, texts, held = [], [], 0
    for i, t in pairs:
        ids.append(i)
        texts.append(t)
        held += len(t.as_buffer()) if t.is_valid and hasattr(t, "as_buffer") else 0
        if held >= HELD_CHARS:
            yield ids, texts
            ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def edited(text: str, following: str) -> str:
    """The last half of the text (rounded down) replaced by as much of the beginning of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order_with_next(docs: DataFrame) -> DataFrame:
    """Rows (part, tail, doc_id, tie, text), dealt out by id so that each task has descending runs.

    Ids are cut at approximate quantiles. After the last row of each part
    comes a copy of the row that follows it in the whole order (``tail``), so
    every row meets its successor. The texts are shuffled once; the driver
    sees one boundary row for each part.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("tie", F.xxhash64("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.select(F.percentile_approx("key", [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts")).head()["cuts"] or []
    cuts = sorted(set(cuts))
    part = F.size(F.filter(F.lit(cuts).cast("array<bigint>") if cuts else F.array().cast("array<bigint>"), lambda c: c < F.col("key")))
    placed = rows.withColumn("part", part)
    heads = [(r["part"], r["top"]["key"], r["top"]["tie"]) for r in placed.groupBy("part").agg(F.max(F.struct("key", "tie")).alias("top")).collect()]  # a row a part
    heads.sort(reverse=True)
    before = {(key, tie): heads[i - 1][0] for i, (_, key, tie) in enumerate(heads)}  # the part that this row ends
    copies = spark.createDataFrame([(k, t, p) for (k, t), p in before.items()], "h_key long, h_tie long, h_part int")
    ends = (placed.join(F.broadcast(copies), (F.col("key") == F.col("h_key")) & (F.col("tie") == F.col("h_tie")))
            .select(F.col("h_part").alias("part"), F.lit(True).alias("tail"), "key", "doc_id", "tie", "text"))
    whole = placed.select("part", F.lit(False).alias("tail"), "key", "doc_id", "tie", "text").union(ends)
    order = [F.col("part"), F.col("tail"), F.col("key").desc(), F.col("tie").desc()]
    return whole.repartition(max(n, 1), "part").sortWithinPartitions(*order).select("part", "tail", "doc_id", "text")


def edit_likeness(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row."""
    ship(docs)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def emit(ids, texts, last):
        """Rows of the ids; ``last`` follows the last text."""
        after = [*texts[1:], last]
        changed = [edited(t, f) for t, f in zip(texts, after, strict=True)]
        prints = embed([*texts, last, *changed])
        own, other = prints[: len(texts) + 1], prints[len(texts) + 1 :]
        columns = [ids, [len(t) for t in texts], [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed], own[:-1], other,
                   [likeness(a, b) for a, b in zip(own, other)], [likeness(a, b) for a, b in zip(own, own[1:], strict=False)]]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, held, at, done = [], [], 0, None, False
        for batch in batches:
            for part, tail, doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), strict=True):
                text = text.as_py()
                if part != at:
                    at, done = part, False
                if done:  # further copies of an equal boundary row
                    continue
                if ids and (tail or held >= HELD_CHARS):
                    yield emit(ids, texts, text)
                    ids, texts, held = [], [], 0
                if tail:
                    done = True
                    continue
                ids.append(doc)
                texts.append(text)
                held += len(text)

    return in_order_with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def near_components(prints: DataFrame, least: float = 0.8, bands: int = 32, width: int = 4) -> DataFrame:
    """(fingerprint, class_id, component_id) from (doc_id, fingerprint): banding, then verification.

    Rows with equal fingerprints form a class. Bands are ``width`` sampled
    symbols of one scale; of each bucket all classes are verified against the
    one with the least id, by ``likeness``, and verified links are connected.
    Where classes stay outside their hub's component, the least of them is
    the group's pivot and all are verified against it, too. What is still
    apart is compared by differences from the pivot: two like fingerprints
    share one of the first of their differing samples, in any order that all
    agree on (rare ones first), or both are close to the pivot (prefix
    filter). Pairs met so are verified as they are joined and only links are
    kept, so no all-pairs list is built. No link between classes that share a
    bucket is left out if it could change a component; in the worst case (many
    strangers with the same rare samples) that takes a group's size squared.

    A pair of likeness ``least`` or more always shares a bucket if fewer than
    ``bands`` of its samples may differ and bands don't overlap, as by default;
    else a pair of likeness s does with probability 1 - (1 - s^width)^bands.
    """
    ship(prints)
    classes = materialise(prints.where("fingerprint <> ''").groupBy("fingerprint").agg(F.min("doc_id").alias("class_id")), "fp-classes")
    k, body = F.split_part("fingerprint", F.lit(":"), F.lit(1)).cast("int"), F.split_part("fingerprint", F.lit(":"), F.lit(2))
    stride = SAMPLES // bands

    def band(level: int):
        start = lambda i: level * 2 * SAMPLES + i * 2 * stride + 1
        return F.array(*[F.concat_ws("/", (k - level).cast("string"), F.lit(str(i)), F.substring(body, start(i), 2 * min(width, stride))) for i in range(bands)])

    def linked(pairs: DataFrame) -> DataFrame:
        both = pairs.join(classes.select(F.col("class_id").alias("a"), F.col("fingerprint").alias("fa")), "a").join(classes.select(F.col("class_id").alias("b"), F.col("fingerprint").alias("fb")), "b")
        return both.select("a", "b", "fa", "fb").mapInArrow(verify, "a long, b long")

    def verify(batches):
        for b in batches:
            a, c, x, y = (col.to_pylist() for col in b.columns)
            kept = [(i, j) for i, j, p, q in zip(a, c, x, y, strict=True) if likeness(p, q) >= least]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in kept], pa.int64()), pa.array([j for _, j in kept], pa.int64())], ["a", "b"])

    posted = classes.select("class_id", F.explode(F.concat(band(0), band(1))).alias("band"))
    posted = posted.where(~F.col("band").rlike("/0+$")).withColumn("scale", F.split_part("band", F.lit("/"), F.lit(1)).cast("int"))
    hubs = materialise(posted.groupBy("band").agg(F.min("class_id").alias("hub"), F.max("class_id").alias("top")).where("top > hub").select("band", "hub"), "fp-hubs")
    stars = materialise(posted.join(hubs, "band").where("hub <> class_id").select(F.col("hub").alias("a"), F.col("class_id").alias("b"), "scale").distinct(), "fp-stars")
    links = materialise(linked(stars.select("a", "b").distinct()), "fp-links")
    labels = components(links)

    # groups of which a member is outside its hub's component: the least such member is the pivot
    outside = _labelled(_labelled(stars, labels, "a"), labels, "b").where("label_a <> label_b")
    pivots = materialise(outside.groupBy("a", "scale").agg(F.min("b").alias("pivot")), "fp-pivots")
    groups = materialise(stars.join(pivots, ["a", "scale"]).select(F.col("pivot").alias("a"), "b", "scale").distinct(), "fp-groups")
    links = links.union(materialise(linked(groups.where("a <> b").select("a", "b").distinct()), "fp-turned"))
    labels = components(links)

    # what is apart from its pivot shares an early difference with what it links with
    members = _labelled(_labelled(groups, labels, "a"), labels, "b").withColumn("apart", F.col("label_a") != F.col("label_b"))
    open_groups = members.groupBy("a", "scale").agg(F.max("apart").alias("open")).where("open").select("a", "scale")
    sampled = lambda end, name: classes.select(F.col("class_id").alias(end), k.alias(f"k_{end}"), body.alias(name))
    at_scale = lambda end, name: F.unhex(F.substring(F.col(name), 2 * SAMPLES * (F.col(f"k_{end}") - F.col("scale")) + 1, F.lit(2 * SAMPLES)))
    members = members.join(open_groups, ["a", "scale"]).join(sampled("a", "at_a"), "a").join(sampled("b", "at_b"), "b")
    members = materialise(members.select("a", "scale", "b", "k_b", "label_b", "apart", at_scale("b", "at_b").alias("own"), at_scale("a", "at_a").alias("pivot")), "fp-members")
    early = materialise(_early_differences(members, least), "fp-early")
    one, other = early.where("apart").alias("x"), early.alias("y")
    met = (one.join(other, (F.col("x.a") == F.col("y.a")) & (F.col("x.scale") == F.col("y.scale")) & (F.col("x.element") == F.col("y.element")))
           .where((F.col("x.label_b") != F.col("y.label_b")) & (~F.col("y.apart") | (F.col("x.b") < F.col("y.b"))))
           .where(F.greatest("x.k_b", "y.k_b") == F.col("x.scale") + 1)  # others are compared at the scale below
           .select(F.col("x.b").alias("a"), F.col("y.b").alias("b"), F.col("x.own").alias("fa"), F.col("y.own").alias("fb")))

    def verify_sampled(batches):
        for b in batches:
            x, y = _sampled(b.column(2)), _sampled(b.column(3))
            goes_on = np.count_nonzero((x > 0) | (y > 0), axis=1)
            like = np.count_nonzero((x == y) & (x > 0), axis=1) / np.maximum(goes_on, 1) >= least
            yield pa.RecordBatch.from_arrays([b.column(0).filter(pa.array(like)), b.column(1).filter(pa.array(like))], ["a", "b"])

    more = materialise(met.mapInArrow(verify_sampled, "a long, b long").distinct(), "fp-more")
    if more.limit(1).count():
        labels = components(links.union(more))
    return classes.join(labels.select(F.col("node").alias("class_id"), "label"), "class_id", "left").select("fingerprint", "class_id", F.coalesce("label", "class_id").alias("component_id"))


def _sampled(column: pa.Array) -> np.ndarray:
    """The samples of one scale, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SAMPLES)


def _early_differences(members: DataFrame, least: float) -> DataFrame:
    """(a, scale, b, k_b, label_b, apart, own, element) from ``members``: the rarest differences of ``own`` from ``pivot``.

    With g samples before its end a fingerprint differs from a like one in
    at most ``most`` of g (1 - least) / least samples (the other may be
    longer), so ``most`` + 1 differences are enough. If like ones share none,
    both have at most ``most``; all such have element -1.
    """
    places = np.arange(SAMPLES, dtype=np.int64) * 256

    def count(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            x, scales = _sampled(b.column(1)), b.column(0).to_numpy()
            for level in np.unique(scales):
                held[level] = held.get(level, 0) + np.bincount((x[scales == level] + places).ravel(), minlength=256 * SAMPLES)
        for level, n in held.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), level, np.int32)), pa.array(at), pa.array(n[at])], ["scale", "element", "n"])

    counted = members.select("scale", "own").mapInArrow(count, "scale int, element long, n long").groupBy("scale", "element").agg(F.sum("n").alias("n"))
    held = {}
    for page in counted.groupBy("scale").agg(F.collect_list(F.struct("element", "n")).alias("cells")).toLocalIterator():  # a scale has at most 32,768 cells
        held[page["scale"]] = np.zeros(256 * SAMPLES, np.int64)
        held[page["scale"]][[c["element"] for c in page["cells"]]] = [c["n"] for c in page["cells"]]
    shared = members.sparkSession.sparkContext.broadcast(held)
    never = np.iinfo(np.int64).max

    def run(batches):
        for b in batches:
            x, p, scales = _sampled(b.column(6)), _sampled(b.column(7)), b.column(1).to_numpy()
            codes, differ = x + places, x != p
            ranks = np.full(codes.shape, never)
            for level in np.unique(scales):
                own = scales == level
                ranks[own] = shared.value[level][codes[own]] * (256 * SAMPLES) + codes[own]
            ranks[~differ] = never
            n, goes_on = differ.sum(axis=1), np.count_nonzero(x, axis=1)
            most = np.minimum(goes_on * (1 - least) / max(least, 1e-9), SAMPLES * (1 - least)) + 1e-9
            most = most.astype(np.int64)
            order = np.argsort(ranks, axis=1)
            row, place = np.nonzero(np.arange(SAMPLES) < np.minimum(n, most + 1)[:, None])
            close = np.flatnonzero(n <= most)
            rows = np.concatenate([row, close])
            elements = np.concatenate([codes[row, order[row, place]], np.full(len(close), -1)])
            for at in range(0, len(rows), 50_000):
                part = pa.array(rows[at : at + 50_000])
                yield pa.RecordBatch.from_arrays([*(c.take(part) for c in b.columns[:7]), pa.array(elements[at : at + 50_000])], [*b.schema.names[:7], "element"])

    return members.mapInArrow(run, "a long, scale int, b long, k_b int, label_b long, apart boolean, own binary, element long")
