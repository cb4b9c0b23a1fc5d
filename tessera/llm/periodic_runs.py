"""Periodic runs of words, found by internal pattern matching.

A run is a stretch of words with smallest period q that no neighbouring word
extends keeping that period; reported are runs of at least ``MIN_WORDS`` words
and ``MIN_PERIODS`` periods. Method, over the suffix array of many short texts
at once (words are numbered by text, so nothing is shared between texts):

* Ranks of all stretches of 1, 2, 4, ... words, by doubling, until all differ: the
  last give the suffix array, all of them longest common extensions.
* For periods in [m, 2m), the dyadic blocks of m words: a run of three periods
  holds a block with its copy q words on. The occurrences of a block are an
  interval of the suffix array; a wavelet matrix over it answers range
  successor queries, so the occurrences that start in a neighbouring window of m
  words are counted, and the first two found, in one logarithm each. Periods
  below 16 take blocks of 8 words and both neighbouring windows, as runs have
  24 words.
* In such a window occurrences form one arithmetic progression. One or two
  are candidates by themselves. Of three or more the difference p is the
  block's own period: either the run has period p, or the block and its copy
  lie in different stretches of period p, and q is the distance of these
  stretches' starts or of their ends (else the run would be shorter than
  2q + p < 3q). So each block gives at most four candidates.
* Each candidate is extended both ways and kept if it is long enough. Of equal
  stretches the least period stays: every run is found with its own.

Work is n log n in the words of a batch; a batch holds ``BATCH_WORDS`` words or
one longer text, whole. Texts don't meet, so there is no shuffle.

Null and empty texts have no words and no runs. Repeated rows are treated alike.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

MIN_WORDS, MIN_PERIODS = 24, 3
SMALLEST_BLOCK = 3  # 2 ** 3 words, a third of MIN_WORDS
BATCH_WORDS = 1 << 16


class WaveletMatrix:
    """Counts and selects among the values of any stretch of a sequence; queries come as arrays."""

    def __init__(self, values: np.ndarray):
        self.levels = []
        for bit in range(len(values).bit_length() - 1, -1, -1):
            ones = (values >> bit) & 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            set_ = ones.astype(bool)
            self.levels.append((bit, before, len(values) - int(before[-1])))
            values = np.concatenate([values[~set_], values[set_]])

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values at left <= place < right are less than ``limit``."""
        count = np.zeros(len(left), np.int64)
        for bit, before, zeros in self.levels:
            l1, r1 = before[left], before[right]
            one = (limit >> bit) & 1 == 1
            count += np.where(one, (right - r1) - (left - l1), 0)
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return count

    def select(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of the given rank (from 0) among those at left <= place < right."""
        value = np.zeros(len(left), np.int64)
        for bit, before, zeros in self.levels:
            l1, r1 = before[left], before[right]
            none = (right - r1) - (left - l1)
            one = rank >= none
            rank = np.where(one, rank - none, rank)
            value |= one.astype(np.int64) << bit
            left, right = np.where(one, zeros + l1, left - l1), np.where(one, zeros + r1, right - r1)
        return value


class Stretches:
    """Ranks of all stretches of 2 ** k words of one sequence, and what follows from them."""

    def __init__(self, words: np.ndarray, levels: int | None = None):
        """``levels`` stops after so many doublings; else at the first level without repetitions."""
        self.n = len(words)
        self.ranks: list[np.ndarray] = []
        names = np.unique(words, return_inverse=True)[1]
        k = 0
        while True:
            self.ranks.append(names.astype(np.int32))
            kinds = int(names.max()) + 1 if self.n else 0
            if kinds == self.n or k == levels:
                break
            later = np.zeros(self.n, np.int64)  # 0: beyond the end
            later[: max(self.n - (1 << k), 0)] = names[1 << k :] + 1
            names = np.unique(names.astype(np.int64) * (kinds + 1) + later, return_inverse=True)[1]
            k += 1
        self.distinct = kinds == self.n

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the words from ``a`` and from ``b`` (a < b) agree."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ok = b + far + (1 << k) <= self.n
            x, y = np.where(ok, a + far, 0), np.where(ok, b + far, 0)
            far += (ok & (self.ranks[k][x] == self.ranks[k][y])).astype(np.int64) << k
        return far

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the words before ``a`` and before ``b`` (a < b) agree."""
        far = np.zeros(len(a), np.int64)
        for k in range(len(self.ranks) - 1, -1, -1):
            ok = a - far - (1 << k) >= 0
            x, y = np.where(ok, a - far - (1 << k), 0), np.where(ok, b - far - (1 << k), 0)
            far += (ok & (self.ranks[k][x] == self.ranks[k][y])).astype(np.int64) << k
        return far

    def extended(self, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest stretches [first, end) around ``at`` in which words ``period`` apart are equal."""
        return at - self.backward(at, at + period), at + period + self.forward(at, at + period)


def _candidates(text: Stretches, k: int, tree: WaveletMatrix) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block starts, periods) to try, from the blocks of 2 ** k words."""
    m = 1 << k
    sizes = np.bincount(text.ranks[k])
    ends = np.cumsum(sizes)
    blocks = np.arange(0, text.n - m + 1, m, dtype=np.int64)
    names = text.ranks[k][blocks]
    blocks, names = blocks[sizes[names] > 1], names[sizes[names] > 1]
    if not len(blocks):
        return
    right = ends[names]
    left = right - sizes[names]
    windows = [(m, 2 * m)] if k > SMALLEST_BLOCK else [(1, m + 1), (m + 1, 2 * m)]
    for low, high in windows:
        first = tree.below(left, right, np.minimum(blocks + low, text.n))
        count = tree.below(left, right, np.minimum(blocks + high, text.n)) - first
        some = count > 0
        j, l, r, first, count = blocks[some], left[some], right[some], first[some], count[some]
        if not len(j):
            continue
        one = tree.select(l, r, first)
        yield j, one - j
        more = count > 1
        j, one, two, count = j[more], one[more], tree.select(l[more], r[more], first[more] + 1), count[more]
        yield j[count == 2], (two - j)[count == 2]
        many = count > 2
        j, one, p = j[many], one[many], (two - one)[many]
        if len(j):
            a, b = text.extended(j, p)
            c, d = text.extended(one, p)
            yield j, p
            yield j[c > a], (c - a)[c > a]
            yield j[c > a], (d - b)[c > a]


def runs_of(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(first, end, smallest period) of all runs of a sequence, in order."""
    if len(words) < MIN_WORDS:
        return []
    text = Stretches(words)
    if len(text.ranks) <= SMALLEST_BLOCK:
        return []
    order = np.empty(text.n, np.int64)
    order[text.ranks[-1]] = np.arange(text.n)
    tree = WaveletMatrix(order)
    found = []
    for k in range(SMALLEST_BLOCK, len(text.ranks)):
        for at, period in _candidates(text, k, tree):
            ok = (period > 0) & (at + period < text.n)
            at, period = at[ok], period[ok]
            first, end = text.extended(at, period)
            long = end - first >= np.maximum(MIN_WORDS, MIN_PERIODS * period)
            found.append(np.stack([first[long], end[long], period[long]], axis=1))
    if not found:
        return []
    least: dict[tuple[int, int], int] = {}
    for first, end, period in np.unique(np.concatenate(found), axis=0).tolist():
        least.setdefault((first, end), period)  # sorted, so the least period comes first
    return [(first, end, period) for (first, end), period in least.items()]


def runs_by_text(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of many texts, as (first, end, period) in its words."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    number: dict[bytes, int] = {}
    flat = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    lengths = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    flat += owner * len(number)
    if len(flat) < MIN_WORDS:
        return out
    # only texts that repeat some stretch of eight words can hold a run
    short = Stretches(flat, SMALLEST_BLOCK)
    if len(short.ranks) <= SMALLEST_BLOCK:
        return out
    names = short.ranks[SMALLEST_BLOCK]
    repeats = np.bincount(owner, weights=np.bincount(names)[names] > 1, minlength=len(texts)) > 0
    chosen = repeats[owner]
    first_word = np.cumsum(lengths) - lengths
    kept = owner[chosen]
    moved = np.arange(len(flat))[chosen] - first_word[kept]  # place in its text, by place among the chosen
    for first, end, period in runs_of(flat[chosen]):
        doc = int(kept[first])
        begin = int(moved[first])
        out[doc].append((begin, begin + end - first, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for first, end, period in runs:
        change[first + period] += 1
        change[end] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def planted_period(key: int | None, words: list[bytes]) -> list[bytes]:
    """Words of a tenth of all texts, by their id's checksum, repeated with a period from some word on."""
    n, h = len(words), zlib.crc32(str(key).encode())
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def find_runs(docs: DataFrame, text: str = "text", alter: Callable[[object, list[bytes]], list[bytes]] | None = None, key: str = "doc_id") -> DataFrame:
    """(row, n_words, runs, clean_text) for each row of ``docs``.

    ``row`` is the row as a struct without its text; ``runs`` lists (start,
    length, period) in words, by start, then period; ``clean_text`` has the words
    joined by single spaces, without what repeats within a run. ``alter`` may
    change a text's words, given the value of column ``key``, before all this.
    """
    ship(docs)
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in rest]).alias("row"), docs[f"`{key}`"].alias("key"), docs[f"`{text}`"].cast("string").alias("text"))
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def written(row: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        found = runs_by_text(texts)
        listed = [[{"start": a, "length": b - a, "period": q} for a, b, q in sorted(r, key=lambda x: (x[0], x[2]))] for r in found]
        clean = [b" ".join(collapsed(t, r)).decode("utf-8", "surrogatepass") for t, r in zip(texts, found, strict=True)]
        columns = [row, pa.array([len(t) for t in texts], pa.int64()), pa.array(listed, pa.list_(run_type)), pa.array(clean, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["row", "n_words", "runs", "clean_text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, words, first = [], 0, 0
            for i in range(batch.num_rows):
                whole = (batch.column(2)[i].as_py() or "").encode("utf-8").split()  # bytes split at space and U+0009 to U+000D alone
                held.append(alter(batch.column(1)[i].as_py(), whole) if alter else whole)
                words += len(whole)
                if words >= BATCH_WORDS or i + 1 == batch.num_rows:
                    yield written(batch.column(0).slice(first, len(held)), held)
                    held, words, first = [], 0, i + 1

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, clean_text string")
