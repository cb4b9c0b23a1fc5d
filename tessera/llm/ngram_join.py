"""N-gram Jaccard self join by universe partitioning.

Every text becomes the set of its distinct word shingles, held as 64-bit
hashes. Two sets R, S with Jaccard similarity t or more differ in at most
``D = (|R| + |S|) (1 - t) / (1 + t)`` elements. The universe of hashes is cut
into segments, as many as a size band's D asks for; similar sets then agree on
one segment exactly, or up to one element on a segment that is indexed with
its one-deletion neighbourhood (pigeonhole). Bands with D > 1 have D + 1 exact
segments; only with D = 1 a cost decides between the two ways. Of an empty
segment the next one is indexed up to one deletion instead.

How the job runs:

1. Each document yields the keys of its segments (numpy in Arrow batches), and
   the number of them that any similar set must share: all segments of the
   common bands but D, less the document's empty ones.
   Counts by key, combined before the shuffle, give the keys that occur twice;
   they are marked in a bitmap of fixed size, which is broadcast.
2. A second pass over the texts keeps only marked keys, so what is joined on
   keys are the postings of near copies. A document with fewer marked keys
   than it needs can't link; of the others' keys, rarest first, the last
   ``needed - 1`` are left out (prefix filter: two sets that share so many keys
   share an earlier one). The bitmap lets false positives
   through (more of them if it fills up, which costs time, not results).
3. In each bucket of a key one member, that shares most postings, is the hub.
   Each set is compared exactly with the hub it shares most keys with, then
   with those hubs that are still in other components; links give connected
   components. Where
   members stay outside their hub's component, the nearest of them becomes the
   group's pivot and is compared with all members, too.
4. What is still apart from its pivot p is compared with other members by
   differences: as R xor S = (R xor p) xor (S xor p), two similar sets of which
   one isn't similar to p must share an element of their differences from p,
   and one among the first D + 1 in any order that a group agrees on (prefix
   filter). Elements that more than an eighth of a group's differences hold
   (edits of the pivot itself) come last, those outside p first. Of two sets
   that share an element, the places it has in both orders bound how many they
   can share, and the sizes of their differences how many they must (positional
   filter), so most pairs end there. So no all-pairs list is
   built within a group of near copies, and no link that could change a
   component is skipped.

Texts with equal sets form one class and take part once. Hashes of 64 bits
stand for shingles and sets (each byte at each place of a word has a mixed number of its own, so words
that differ meet by chance alone, near 2^-64 for two given ones). Nulls and texts without words have the empty set, link with nothing and
keep their own component. Rows without ids take part by their texts; a component
of them alone has a null id. Rows with equal ``doc_id`` are one document for the
purpose of ``component_id`` (each row is returned). An empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window as W, functions as F

from .common import arrow_rows, discard, materialise, ship, small, text_or_empty

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z hash as a-z
_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes of text that are hashed together (some 60 bytes of arrays for each), and rows that a task is handed at once; they bound the memory of a task.
CHUNK_BYTES, ARROW_ROWS = 1 << 18, 1_000
#: Ratio between the sizes of neighbouring bands.
BAND_RATIO = 1.5
#: log2 of the bits of the broadcast bitmap (8 MiB).
BITMAP_LOG2 = 26
#: Most rows of an id list that is broadcast; beyond it, joins shuffle.
BROADCAST_ROWS = 500_000
#: Members that are compared with a hub in one task.
HUB_PART = 2_000
#: Classes of a part of a component whose links are counted, and most parts of one.
COUNT_PART, MOST_PARTS = 2_000, 64


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """For each text (UTF-8) the sorted distinct hashes of its shingles of so many words."""
    ends = np.cumsum([len(t) for t in texts])
    if not len(ends) or not ends[-1]:
        return [np.empty(0, np.uint64) for _ in texts]
    data = np.frombuffer(b"".join(texts), np.uint8)
    white = _IS_WHITE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0] = after[-1] = True
    before[1:], after[:-1] = white[:-1], white[1:]
    before[ends[ends < len(data)]] = True
    after[ends[ends > 0] - 1] = True
    begins = ~white & before
    start, stop = np.flatnonzero(begins), np.flatnonzero(~white & after) + 1
    if not len(start):
        return [np.empty(0, np.uint64) for _ in texts]
    place = np.arange(len(data)) - start[np.maximum(np.cumsum(begins) - 1, 0)]
    place[white] = 0
    value = _mix(_BYTE[data] + place.astype(np.uint64) * _GOLD)  # each byte at each place has a number of its own
    value[white] = 0
    word = _mix(np.add.reduceat(value, start) + (stop - start).astype(np.uint64) * _GOLD)
    first = np.searchsorted(start, np.concatenate([[0], ends]))  # of each text among all words
    run = word.copy()
    for k in range(1, min(words, len(word) + 1)):  # a chunk may have fewer words in all
        run[: len(word) - k] = _mix(run[: len(word) - k] * _GOLD + word[k:])
    sets = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= words:
            sets.append(np.unique(run[a : b - words + 1]))
        elif b > a:  # fewer words: the whole sequence
            h = word[a : a + 1]
            for k in range(a + 1, b):
                h = _mix(h * _GOLD + word[k : k + 1])
            sets.append(_mix(h + _U(b - a)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


class Bands:
    """Size bands, and for each its segments: so many indexed up to one deletion, so many exactly."""

    def __init__(self, percent: int, documents: int):
        self.percent = percent
        self.low = [1]
        while self.low[-1] < 2**40:
            d = self.most_apart(self.low[-1], self.low[-1])
            step = next(x for x in range(self.low[-1] + 1, 2**41) if self.most_apart(x, x) > 0) if d == 0 else math.ceil(self.low[-1] * BAND_RATIO)
            self.low.append(step)
        self.plan = [self._allocate(k, max(documents, 1)) for k in range(len(self.low) - 1)]
        self._cases: dict[int, list] = {}

    def most_apart(self, a: int, b: int) -> int:
        """Most elements that only one of two similar sets of these sizes has."""
        return (a + b) * (100 - self.percent) // (100 + self.percent)

    def _allocate(self, k: int, documents: int) -> tuple[int, int]:
        """(segments up to one deletion, exact segments) with 2 * first + second > D, at least cost.

        Cost for a document: its keys, plus the partners it meets by chance in
        buckets of nearly empty segments, taking a tenth of all documents to
        be in the band.
        """
        apart, size = self.most_apart(self.low[k + 1] - 1, self.low[k + 1] - 1), self.low[k]
        if apart == 0:
            return 0, 0
        if apart > 1:
            return 0, apart + 1
        halves = 2 + 0.1 * documents * 2 * math.exp(-size) * (1 + size)
        return (1, 0) if 1 + size < halves else (0, 2)

    def of(self, size: int) -> list[int]:
        """The bands a set of this size takes part in: its own, and the next if a partner may be there."""
        k = int(np.searchsorted(self.low, size, "right")) - 1
        nxt = [k + 1] if 100 * size >= self.percent * self.low[k + 1] else []
        return [b for b in (k, *nxt) if sum(self.plan[b])]

    def least_shared(self, size: int, empty: dict[int, int]) -> int:
        """Fewest keys that a set of this size shares with any similar one, of its number of empty segments by band.

        Of a band's segments, as many as D(R, S) differ at most, and of those that
        agree only the empty ones have no key of their own. D grows with
        the partner's size, so the largest size of each choice of common bands decides.
        """
        cases = self._cases.get(size)
        if cases is None:
            own, bands = int(np.searchsorted(self.low, size, "right")) - 1, set(self.of(size))
            most, near = size * 100 // self.percent, range(max(own - 2, 0), min(own + 4, len(self.low)))
            starts = {self.low[k] for k in near} | {-(-self.percent * self.low[k] // 100) for k in near}
            ends = {most, *(s - 1 for s in starts if size * self.percent <= 100 * (s - 1) and s - 1 < most)}
            cases = [[(k, self.plan[k][1] - self.most_apart(size, s)) for k in bands & set(self.of(s)) if not self.plan[k][0]] for s in ends]
            if len(self._cases) >= 100_000:
                self._cases.clear()
            self._cases[size] = cases
        return max(1, min(sum(max(0, n - empty[k]) for k, n in case) for case in cases))


def segment_keys(h: np.ndarray, bands: Bands) -> tuple[np.ndarray, int]:
    """The keys a set is indexed under, as int64, and how many of them any similar set has, too."""
    if not len(h):
        return np.empty(0, np.int64), 1
    out, v, empty = [], _mix(h + _GOLD), {}
    for k in bands.of(len(h)):
        loose, exact = bands.plan[k]
        m = loose + exact
        seg = ((h >> _U(32)) % _U(m)).astype(np.int64)
        total = np.zeros(m, np.uint64)
        np.add.at(total, seg, v)
        tag = _mix((np.arange(m, dtype=np.uint64) + _U(k << 40)) * _GOLD)
        held = np.bincount(seg, minlength=m) > 0
        empty[k] = m - int(held.sum())
        out.append(_mix(total + tag)[held])
        if loose:
            out.append(_mix(total[seg] - v + tag[seg]))
        for i in np.flatnonzero(~held):  # an empty segment: the next one up to one deletion
            after = (i + 1) % m
            own = tag[i : i + 1] ^ _GOLD
            out += [_mix(total[after : after + 1] + own), _mix(total[after] - v[seg == after] + own)]
    keys = np.unique(np.concatenate(out)).view(np.int64) if out else np.empty(0, np.int64)
    return keys, bands.least_shared(len(h), empty)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    """(ids, texts) of bounded size; texts as UTF-8."""
    for batch in batches:
        ids, texts, held = [], [], 0
        for i, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            t = t.as_buffer().to_pybytes() if t.is_valid else b""
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= CHUNK_BYTES:
                yield ids, texts
                ids, texts, held = [], [], 0
        if ids:
            yield ids, texts


def _slices(batch: pa.RecordBatch, texts: int, most_rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded size, by the bytes in its column ``texts``; a text that alone is longer stays whole."""
    begin, held = 0, 0
    for row, n in enumerate(pc.binary_length(batch.column(texts)).to_pylist()):
        if row > begin and (held + n > CHUNK_BYTES or row - begin >= most_rows):
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values) if values else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat, pa.int64()))


def _all_keys(df: DataFrame, words: int, bands: Bands) -> DataFrame:
    """One row (seg_key) for each key of each document."""

    def run(batches):
        for _, texts in _chunks(batches):
            keys = [segment_keys(h, bands)[0] for h in shingle_sets(texts, words)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys), pa.int64())], ["seg_key"])

    return df.mapInArrow(run, "seg_key long")


def _marked_keys(df: DataFrame, words: int, bands: Bands, bitmap) -> DataFrame:
    """(doc_id, n_shingles, set_key, needed, keys): of the keys those marked in the bitmap, or none if these are fewer than any link needs."""

    def run(batches):
        bits, shift = np.frombuffer(bitmap.value, np.uint8), _U(64 - BITMAP_LOG2)
        for ids, texts in _chunks(batches):
            sizes, sums, least, keys = [], [], [], []
            for h in shingle_sets(texts, words):
                k, needed = segment_keys(h, bands)
                at = (_mix(k.view(np.uint64)) >> shift).astype(np.int64)
                k = k[(bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
                keys.append(k if len(k) >= needed else k[:0])
                least.append(needed)
                sizes.append(len(h))
                sums.append(int(_mix(np.add.reduce(_mix(h), dtype=np.uint64, keepdims=True)).view(np.int64)[0]) if len(h) else None)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(least, pa.int32()), _lists(keys)], ["doc_id", "n_shingles", "set_key", "needed", "keys"])

    return df.mapInArrow(run, "doc_id long, n_shingles long, set_key long, needed int, keys array<long>")


def _bit_rows(keys: DataFrame) -> DataFrame:
    """Which bytes of the bitmap the keys set: (slot, word) with word the or of 32 bits."""

    def run(batches):
        shift = _U(64 - BITMAP_LOG2)
        for b in batches:
            at = (_mix(b.column(0).to_numpy().view(np.uint64)) >> shift).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.left_shift(np.int64(1), at & 31))], ["slot", "word"])

    return keys.mapInArrow(run, "slot long, word long").groupBy("slot").agg(F.bit_or("word").alias("word"))


def _repeated_bitmap(df: DataFrame, words: int, bands: Bands) -> bytes:
    """Marks the keys that occur twice or more; at most 2^BITMAP_LOG2 bits, so at most 2^21 rows of 16 bytes reach the driver."""
    repeated = _all_keys(df, words, bands).groupBy("seg_key").count().where("count > 1").select("seg_key")
    chunked = _bit_rows(repeated).groupBy((F.col("slot") / 4096).cast("int").alias("page")).agg(F.collect_list(F.struct("slot", "word")).alias("cells"))
    bits = np.zeros(1 << (BITMAP_LOG2 - 5), np.uint32)
    for page in chunked.toLocalIterator():  # a page has at most 4,096 cells
        at = np.array([c["slot"] for c in page["cells"]], np.int64)
        bits[at] = np.array([c["word"] for c in page["cells"]], np.int64).astype(np.uint32)
    return bits.tobytes()


def _sets_of(words: int):
    """Turns (set_key, text) into (set_key, grams), the whole sets."""

    def run(batches):
        for batch in batches:
            for some in _slices(batch, 1):
                sets = shingle_sets([t.as_buffer().to_pybytes() for t in some.column(1)], words)
                yield pa.RecordBatch.from_arrays([some.column(0), _lists([h.view(np.int64) for h in sets])], ["set_key", "grams"])

    return run


def _texts(df: DataFrame, words: int) -> DataFrame:
    """(set_key, text) of the given documents; texts are smaller than their sets, and shrink further when written."""

    def run(batches):
        for _, texts in _chunks(batches):
            sets = shingle_sets(texts, words)
            keep = [i for i, h in enumerate(sets) if len(h)]
            sums = [int(_mix(np.add.reduce(_mix(sets[i]), dtype=np.uint64, keepdims=True)).view(np.int64)[0]) for i in keep]
            yield pa.RecordBatch.from_arrays([pa.array(sums, pa.int64()), pa.array([texts[i] for i in keep], pa.binary())], ["set_key", "text"])

    return df.mapInArrow(run, "set_key long, text binary")


def _verify(pairs: DataFrame, texts: DataFrame, words: int, percent: int, differences: bool = False) -> DataFrame:
    """(a, b, shared, total, linked) for pairs (a, b): sizes of intersection and union, exactly.

    With ``differences`` also b's elements outside a (``own``) and those of a
    that it lacks (``lacks``). Each member's text goes to its hub ``a``, and the hub's
    once to each part of its members, so a hub that many share takes many tasks.
    """
    parts = materialise(pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_PART).cast("int").alias("parts")), "hub-parts")
    dealt = pairs.join(small(parts, BROADCAST_ROWS), "a").select("a", "b", F.pmod(F.xxhash64("b"), "parts").cast("int").alias("part"))
    dealt = materialise(dealt, "dealt")
    members = texts.join(small(dealt.withColumnRenamed("b", "set_key"), BROADCAST_ROWS), "set_key")
    hubs = small(parts.select(F.col("a").alias("set_key"), "parts"), BROADCAST_ROWS)
    first = texts.join(hubs, "set_key").select("set_key", "text", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    both = members.select("a", "part", F.lit(1).alias("later"), F.col("set_key").alias("b"), "text").union(
        first.select(F.col("set_key").alias("a"), "part", F.lit(0), "set_key", "text"))
    ordered = both.repartition("a", "part").sortWithinPartitions("a", "part", "later").select("b", "text", "a", "part", "later")

    def run(batches):
        key, hub = None, None
        for batch in batches:
            for some in _slices(batch, 1):
                raw = [t.as_buffer().to_pybytes() for t in some.column(1)]
                out: list[list] = [[] for _ in range(7)]
                for b, h, a_key, part, later in zip(some.column(0).to_pylist(), shingle_sets(raw, words), *[some.column(k).to_pylist() for k in (2, 3, 4)], strict=True):
                    if not later:
                        key, hub = (a_key, part), h
                        continue
                    if key != (a_key, part):
                        raise RuntimeError("a hub's text is missing")
                    place = np.searchsorted(hub, h)
                    held = hub[np.minimum(place, len(hub) - 1)] == h
                    shared = int(held.sum())
                    total = len(hub) + len(h) - shared
                    row = [a_key, b, shared, total, shared * 100 >= total * percent]
                    if differences:
                        left = np.ones(len(hub), bool)
                        left[place[held]] = False
                        row += [h[~held].view(np.int64), hub[left].view(np.int64)]
                    for column, value in zip(out, row, strict=False):
                        column.append(value)
                columns = [pa.array(c, t) for c, t in zip(out, (pa.int64(),) * 4 + (pa.bool_(),), strict=False)]
                names = ["a", "b", "shared", "total", "linked"]
                if differences:
                    columns, names = [*columns, _lists(out[5]), _lists(out[6])], [*names, "own", "lacks"]
                yield pa.RecordBatch.from_arrays(columns, names)

    more = ", own array<long>, lacks array<long>" if differences else ""
    return ordered.mapInArrow(run, f"a long, b long, shared long, total long, linked boolean{more}")


def _near_in_size(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b, via) those whose sizes allow a link."""
    of = lambda end: small(sizes.select(F.col("set_key").alias(end), F.col("size").alias(f"size_{end}")), BROADCAST_ROWS)
    sized = pairs.join(of("a"), "a").join(of("b"), "b")
    return sized.where(F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent).select("a", "b", "via")


def components(links: DataFrame) -> DataFrame:
    """(node, label): for every node of the links (a, b) the smallest node it is connected with.

    Labels fall to the least label among a node's neighbours, then to their
    label's label, until none changes; each round is written to the shared
    folder. Rounds grow with the logarithm of a component's width.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    labels = before = materialise(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        near = edges.join(labels, edges.b == labels.node).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = materialise(labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next")), "step")
        jump = stepped.select(F.col("node").alias("next"), F.col("next").alias("far"))
        after = materialise(stepped.join(jump, "next", "left").select("node", "label", F.least("next", F.coalesce("far", "next")).alias("next")), "jump")
        changed = after.where("next <> label").limit(1).count()
        discard(before, stepped)
        labels, before = after.select("node", F.col("next").alias("label")), after
        if not changed:
            discard(edges)
            return labels


def _labelled(pairs: DataFrame, labels: DataFrame, end: str) -> DataFrame:
    """``pairs`` with the component of one end as ``label_<end>``; a node without links is its own."""
    named = labels.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
    return pairs.join(named, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))


def _link_counts(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(set_key, n_links): with how many other classes each class links, exactly.

    Links lie within components, so each component is joined with itself,
    large ones in parts, and verified pairs are counted as they come: pairs
    aren't written or shuffled, but all of a component are looked at, so this
    takes its size squared.
    """
    held = labels.groupBy("label").agg(F.least(F.ceil(F.count("*") / COUNT_PART), F.lit(MOST_PARTS)).cast("int").alias("parts"))
    own = sets.dropDuplicates(["set_key"]).join(labels.select(F.col("node").alias("set_key"), "label").join(held, "label"), "set_key")
    own = materialise(own.withColumn("part", F.pmod(F.xxhash64("set_key"), "parts").cast("int")), "grouped")
    x, y = own.alias("x"), own.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).alias("y")
    near = F.least(F.size("x.grams"), F.size("y.grams")) * 100 >= F.greatest(F.size("x.grams"), F.size("y.grams")) * percent
    pairs = x.join(y, (F.col("x.label") == F.col("y.label")) & (F.col("x.part") == F.col("y.part")) & (F.col("x.set_key") < F.col("y.set_key")) & near)
    shared = F.size(F.array_intersect("x.grams", "y.grams")).cast("long")
    counted = pairs.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b"), shared.alias("shared"), (F.size("x.grams") + F.size("y.grams")).cast("long").alias("sizes"))
    linked = counted.where(F.col("shared") * 100 >= (F.col("sizes") - F.col("shared")) * percent)
    return linked.select(F.explode(F.array("a", "b")).alias("set_key")).groupBy("set_key").agg(F.count("*").alias("n_links"))


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80, count_links: bool = False) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of ``percent`` / 100 or more.

    ``docs`` has ``doc_id`` and ``text``. Returns for each row ``doc_id``,
    ``n_shingles`` (set size), ``component_id`` (smallest doc_id reachable by
    links, its own included) and ``class_id`` (smallest doc_id with an equal set),
    and with ``count_links`` also ``n_links`` (links to other classes, all of
    them), for which every pair within a component is compared.
    See the module's text for nulls, empty texts, repeated rows and empty tables.
    """
    ship(docs)
    with arrow_rows(docs.sparkSession, ARROW_ROWS):  # all Python steps are run meanwhile
        return _components_of(docs, words, percent, count_links)


def _components_of(docs: DataFrame, words: int, percent: int, count_links: bool) -> DataFrame:
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    bands = Bands(percent, base.count())
    bitmap = spark.sparkContext.broadcast(_repeated_bitmap(base.select("doc_id", "text"), words, bands))
    marked = materialise(_marked_keys(base, words, bands, bitmap), "marked")

    members = marked.where("set_key is not null")
    sizes = materialise(members.groupBy("set_key").agg(F.min("doc_id").alias("class_id"), F.max("n_shingles").alias("size")), "classes")

    posted = materialise(members.select(F.explode("keys").alias("seg_key"), "set_key", "needed").distinct(), "posted")
    shared = posted.groupBy("seg_key").agg(F.count("*").alias("held")).where("held > 1")
    # similar sets share ``needed`` keys, so they share one that isn't among the last ``needed - 1`` of either, rarest keys first
    of_set = W.partitionBy("set_key")
    placed = posted.join(shared, "seg_key").withColumn("place", F.row_number().over(of_set.orderBy("held", "seg_key"))).withColumn("n", F.count("*").over(of_set))
    counted = materialise(placed.where("place <= n - needed + 1").select("seg_key", "set_key", "held"), "shared")
    discard(posted)
    score = counted.groupBy("set_key").agg(F.sum("held").alias("score"))
    hubs = counted.join(score, "set_key").groupBy("seg_key").agg(F.max(F.struct("score", F.col("set_key").alias("hub"))).alias("top")).select("seg_key", F.col("top.hub").alias("hub"))
    found = counted.join(hubs, "seg_key").where("hub <> set_key").groupBy(F.col("hub").alias("a"), F.col("set_key").alias("b")).agg(F.count("*").alias("via"))
    found = materialise(found, "found")
    stars = materialise(_near_in_size(found, sizes, percent), "stars")
    discard(counted)

    nodes = materialise(found.select(F.explode(F.array("a", "b")).alias("set_key")).distinct().join(sizes, "set_key").select("set_key", F.col("class_id").alias("doc_id")), "wanted")
    wanted = nodes.where("doc_id is not null").select("doc_id")
    named = base.join(small(wanted, BROADCAST_ROWS), "doc_id", "left_semi").select("doc_id", "text")
    nameless = nodes.where("doc_id is null").select("set_key")
    texts = _texts(named, words)
    if nameless.limit(1).count():  # classes of rows without ids
        texts = texts.union(_texts(base.where("doc_id is null"), words).join(nameless, "set_key", "left_semi").dropDuplicates(["set_key"]))
    texts = materialise(texts, "texts")

    # each set is compared with the hub it shares most keys with, then with those hubs whose components it isn't in
    best = materialise(stars.groupBy("b").agg(F.max(F.struct("via", "a")).alias("top")).select("top.a", "b"), "best")
    first = materialise(_verify(best, texts, words, percent).distinct(), "checked")
    labels = components(first.where("linked"))
    rest = _labelled(_labelled(stars.join(best, ["a", "b"], "left_anti"), labels, "a"), labels, "b").where("label_a <> label_b").select("a", "b")
    rest = materialise(rest, "rest")
    second = materialise(_verify(rest, texts, words, percent).distinct(), "checked")
    discard(stars, best, rest)
    checked = first.union(second)
    links = checked.where("linked").select("a", "b")
    if second.where("linked").limit(1).count():
        labels = components(links)

    # groups of which a member is outside its hub's component: the nearest such member is the pivot
    outside = _labelled(_labelled(found.select("a", "b"), labels, "a"), labels, "b").where("label_a <> label_b")
    far = outside.join(checked.select("a", "b", (F.col("total") - F.col("shared")).alias("far")), ["a", "b"], "left")  # without, their sizes don't allow a link
    pivots = materialise(far.groupBy("a").agg(F.min(F.struct(F.coalesce("far", F.lit(1 << 60)).alias("far"), "b")).alias("top")).select("a", F.col("top.b").alias("pivot")), "pivots")
    grouped = found.select("a", "b").union(pivots.select("a", F.col("a").alias("b"))).join(pivots, "a")
    around = grouped.where("pivot <> b").select(F.col("pivot").alias("a"), "b").distinct()
    around = materialise(around, "around")
    turned = materialise(_verify(around, texts, words, percent, differences=True).dropDuplicates(["a", "b"]), "turned")
    discard(around, pivots, found)
    links = links.union(turned.where("linked").select("a", "b"))
    labels = components(links)

    # what is apart from its pivot shares an early element of the differences with what it links with
    members = _labelled(_labelled(turned, labels, "a"), labels, "b").withColumn("apart", F.col("label_a") != F.col("label_b"))
    open_groups = materialise(members.groupBy("a").agg(F.count("*").alias("n"), F.max("apart").alias("open")).where("open").select("a", "n"), "open")
    members = materialise(members.join(open_groups, "a").join(sizes.select(F.col("set_key").alias("b"), "size"), "b").select("a", "b", "n", "label_b", "apart", "size", "own", "lacks"), "members")
    counted = members.select("a", "n", F.explode(F.concat("own", "lacks")).alias("element")).groupBy("a", "n", "element").agg(F.count("*").alias("held"))
    common = materialise(counted.where("held > 1 and 8 * held > n").groupBy("a").agg(F.collect_list("element").alias("common")), "common")  # at most eight times a difference's mean size
    ranked = members.join(common, "a", "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>")))
    parts = [f(F.sort_array(side), F.col("common")) for f in (F.array_except, F.array_intersect) for side in ("own", "lacks")]
    most = F.floor(F.col("size") * (100 - percent) / percent).cast("int") + 1
    ordered = F.concat(parts[0], parts[1], F.sort_array(F.concat(parts[2], parts[3])))
    early = ranked.select("a", "b", "label_b", "apart", "size", (F.size("own") + F.size("lacks")).alias("far"), F.posexplode(F.slice(ordered, F.lit(1), most)).alias("at", "element"))
    early = materialise(early, "early")
    discard(members, common)
    one, other = early.where("apart").alias("x"), early.alias("y")
    # two sets that link have at most ``most_apart`` elements that are not in both, so their differences from the pivot
    # share at least half of what exceeds that; at the first element shared, so many must be left in both
    most_apart = F.floor((F.col("x.size") + F.col("y.size")) * (100 - percent) / (100 + percent))
    enough = 2 * F.least(F.col("x.far") - F.col("x.at"), F.col("y.far") - F.col("y.at")) >= F.col("x.far") + F.col("y.far") - most_apart
    met = (one.join(other, (F.col("x.a") == F.col("y.a")) & (F.col("x.element") == F.col("y.element")) & (F.col("x.label_b") != F.col("y.label_b"))
                    & (~F.col("y.apart") | (F.col("x.b") < F.col("y.b")))
                    & (F.least("x.size", "y.size") * 100 >= F.greatest("x.size", "y.size") * percent) & enough)
           .select(F.least("x.b", "y.b").alias("a"), F.greatest("x.b", "y.b").alias("b")).distinct())
    met = materialise(met, "met")
    more = materialise(_verify(met, texts, words, percent).where("linked").select("a", "b").distinct(), "more")
    if more.limit(1).count():
        links = links.union(more)
        labels = components(links)
    discard(early, met)

    classes = materialise(sizes.join(labels.withColumnRenamed("node", "set_key"), "set_key", "left").withColumn("label", F.coalesce("label", "set_key")), "classed")
    least = materialise(classes.groupBy("label").agg(F.min("class_id").alias("component_id")), "least")
    final = materialise(classes.join(least, "label").select("set_key", "class_id", "component_id"), "final")
    found = marked.select("doc_id", "n_shingles", "set_key").join(final, "set_key", "left")
    columns = ["doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("class_id", "doc_id").alias("class_id")]
    if count_links:
        sets = materialise(texts.mapInArrow(_sets_of(words), "set_key long, grams array<long>"), "sets")
        found = found.join(_link_counts(sets, labels, percent), "set_key", "left")
        columns.append(F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    return found.select(*columns)
