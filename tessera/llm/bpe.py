"""Byte-level BPE encoding and decoding with a given vocabulary of ranks.

Each match of the pre-split pattern is encoded separately. Bytes are mapped to
the Latin-1 characters of the same numbers, and an Aho-Corasick automaton
finds every vocabulary entry in a piece in one pass, so the longest entry at
each place is known. The encoder walks a piece from left to right with longest
matches; a token may follow another only if the merges, run on the two tokens'
bytes, give back just these two (memoised; found by undoing the merges on both
sides of the border, the latest first). If not, the next shorter prefix is
tried; if none is left, the place is marked dead and the last token is taken
back. A sequence of which all neighbours are compatible is the one that the
merges yield, so the result is exact; each place is visited a bounded number
of times, so time is linear in the piece.

Pieces that are entries themselves are that entry. Words of up to
``CACHED_CHARS`` characters are cached with the space before them: a single
space between two other characters always opens a match of the pattern, so
texts may be cut there first. Caches hold two generations of ``CACHE`` entries
at most; entries in use move on to the newer one.

Null and empty texts have no ids and decode to no bytes. Null ids decode to no
bytes as well; an id that the vocabulary lacks fails the job. Vocabulary files are read by path on every worker and never
copied. Documents are independent, so there is no shuffle and no group.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

CACHE, CACHED_CHARS = 500_000, 48
#: Text, in characters or ids, after which a worker hands on what it has.
HAND_ON = 1 << 20
#: Spaces that aren't between two characters other than white space.
_ODD = re.compile(r" (?:(?=\s)|\Z|(?<=\s )|(?<=\A ))")
_EVEN = re.compile(r"(?<=\S) (?=\S)")


class Cache:
    """The newer and the older generation of what was found."""

    def __init__(self):
        self.new: dict = {}
        self.old: dict = {}

    def miss(self, key):
        """What the older generation has, moved to the newer; None if nothing."""
        found = self.old.get(key)
        if found is not None:
            self.keep(key, found)
        return found

    def keep(self, key, found):
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}
        self.new[key] = found


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def by_id(ranks: dict[bytes, int]) -> list[bytes]:
    entry = [b""] * (max(ranks.values(), default=-1) + 1)
    for raw, i in ranks.items():
        entry[i] = raw
    return entry


class Vocabulary:
    """Encodes by the ranks of one file."""

    def __init__(self, path: str, pattern: str):
        import ahocorasick
        import regex

        self.rank = read_ranks(path)
        self.entry = by_id(self.rank)
        self.length = [len(e) for e in self.entry]
        self.pieces = regex.compile(pattern).findall
        self.found = ahocorasick.Automaton()
        self.left, self.right = list(range(len(self.entry))), list(range(len(self.entry)))  # what an entry's last merge joined
        for raw, i in self.rank.items():
            parts = self.merged(raw, 2)
            if len(parts) != 2 or parts[0] not in self.rank or parts[1] not in self.rank:
                continue  # one byte; an entry that no merges lead to can't be part of a longer piece
            self.left[i], self.right[i] = self.rank[parts[0]], self.rank[parts[1]]
            self.found.add_word(raw.decode("latin-1"), (len(raw) - 1, i))
        if len(self.found):
            self.found.make_automaton()
        self.single = [self.rank.get(bytes([b]), -1) for b in range(256)]  # one byte's entry needs no search
        self.shorter = self._shorter()
        self.decimal = [str(i) for i in range(len(self.entry))]
        self.fits = Cache()
        self.known = Cache()
        self.words = Cache(), Cache()  # at the start of a text, after a space

    def merged(self, raw: bytes, stop: int = 1) -> list[bytes]:
        """The plain merges, lowest rank first, until ``stop`` parts are left; for short byte strings."""
        parts = [raw[i : i + 1] for i in range(len(raw))]
        while len(parts) > stop:
            ranks = [self.rank.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(ranks)
            if best == 1 << 40:
                break
            at = ranks.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, one: int, two: int) -> bool:
        """Whether the merges of both entries' bytes end with just these two.

        Undoes the later merge of the two at the border, again and again: if
        the parts that then touch could have been joined before that merge
        was made, they would have been. Of equal merges the left one goes first.
        """
        before = 1 << 40
        while True:
            joined = self.rank.get(self.entry[one] + self.entry[two])
            if joined is not None and joined < before:
                return False
            inner, outer = self.right[one], self.left[two]
            if inner != one and (one > two or outer == two):
                before, one = one, inner
            elif outer != two:
                before, two = two + 1, outer
            else:
                return True

    def _shorter(self) -> list[int]:
        """For each entry the longest entry that is a proper prefix of it; -1 if there is none."""
        shorter, above = [-1] * len(self.entry), []
        for text in sorted(self.found):  # an entry's prefixes come before it, the longest last
            while above and not text.startswith(above[-1]):
                above.pop()
            shorter[self.found.get(text)[1]] = self.found.get(above[-1])[1] if above else self.single[ord(text[0])]
            above.append(text)
        return shorter

    def piece(self, raw: bytes) -> list[int]:
        if (whole := self.rank.get(raw)) is not None:
            return [whole]
        n, length, shorter, fits = len(raw), self.length, self.shorter, self.fits
        known = fits.new.get
        single = self.single
        longest = [single[b] for b in raw]
        for end, (back, token) in self.found.iter(raw.decode("latin-1")) if len(self.found) else ():
            longest[end - back] = token  # of the same start, later ends are longer
        dead: set[int] = set()
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                end = at + length[token]
                if not dead or end not in dead:
                    if last < 0:
                        break
                    pair = last << 32 | token
                    good = known(pair)
                    if good is None:
                        if (good := fits.miss(pair)) is None:
                            good = self.compatible(last, token)
                            fits.keep(pair, good)
                        known = fits.new.get  # the generation may have changed
                    if good:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at, last = end, token
                token = longest[at] if at < n else -1
            elif out:
                dead.add(at)
                token = out.pop()  # what it led to is dead now, so a shorter one follows
                at -= length[token]
                last = out[-1] if out else -1
            else:
                raise ValueError("the vocabulary lacks a byte of the text")
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        """The ids of a stretch of text that begins where a match begins."""
        out: list[int] = []
        for piece in self.pieces(word):
            out += self.known.new.get(piece) or self._piece(piece)
        return tuple(out)

    def _piece(self, piece: str) -> tuple[int, ...]:
        if (ids := self.known.miss(piece)) is None:
            ids = tuple(self.piece(piece.encode("utf-8")))  # unlike lists, tuples of numbers cost the garbage collector nothing
            if len(piece) <= CACHED_CHARS:
                self.known.keep(piece, ids)
        return ids

    def after_spaces(self, words: list[str]) -> list[list[int]]:
        """The ids of each word with a space before it; no word holds a space or begins or ends with white space.

        One search for all: a match begins at every space, and nowhere else does one hold a space.
        """
        out: list[list[int]] = []
        for piece in self.pieces(" " + " ".join(words)):
            ids = self.known.new.get(piece) or self._piece(piece)
            if piece[0] == " ":
                out.append(list(ids))
            else:
                out[-1] += ids
        return out

    def _cached(self, cache: Cache, key: str, word: str) -> tuple[int, ...]:
        if (ids := cache.miss(key)) is None:
            ids = self._word(word)
            if len(key) <= CACHED_CHARS:
                cache.keep(key, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        first, later = self.words
        words = text.split(" ") if not _ODD.search(text) else _EVEN.split(text)
        out += self._cached(first, words[0], words[0])
        for word in words[1:]:
            out += later.new.get(word) or self._cached(later, word, " " + word)
        return out


class Teller:
    """Encodes and decodes word by word, and keeps what it found: (number of ids, ids in decimal, the bytes they decode to)."""

    def __init__(self, coder: Vocabulary):
        self.coder = coder
        self.words = Cache(), Cache()  # at the start of a text, after a space

    def _tell(self, cache: Cache, key: str, ids: Sequence[int]) -> tuple[int, str, bytes]:
        entry, decimal = self.coder.entry, self.coder.decimal
        found = len(ids), ",".join([decimal[i] for i in ids]), b"".join([entry[i] for i in ids])
        if len(key) <= CACHED_CHARS:
            cache.keep(key, found)
        return found

    def _told(self, cache: Cache, key: str, word: str) -> tuple[int, str, bytes]:
        return cache.miss(key) or self._tell(cache, key, self.coder._word(word))

    def _later(self, words: list[str], plain: bool) -> list[tuple[int, str, bytes]]:
        """What is told of words that follow spaces."""
        later = self.words[1]
        found = list(map(later.new.get, words))
        if None not in found:
            return found
        lacking = list(dict.fromkeys([w for f, w in zip(found, words, strict=True) if f is None]))
        fresh = {w: f for w in lacking if (f := later.miss(w)) is not None}
        lacking = [w for w in lacking if w not in fresh]
        if lacking:
            coded = self.coder.after_spaces(lacking) if plain else [self.coder._word(" " + w) for w in lacking]
            for w, ids in zip(lacking, coded, strict=True):
                fresh[w] = self._tell(later, w, ids)
        return [f or fresh[w] for f, w in zip(found, words, strict=True)]

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, and the digests of the ids in decimal and of the bytes they decode to."""
        plain = not _ODD.search(text)
        words = text.split(" ") if plain else _EVEN.split(text)
        parts = [self._told(self.words[0], words[0], words[0])] if words[0] else []
        ids, raw, total = hashlib.sha256(), hashlib.sha256(), 0
        for a in range(1, len(words) + 1, 1 << 16):
            parts += self._later(words[a : a + (1 << 16)], plain)
            if parts:
                counts, decimals, decoded = zip(*parts, strict=True)
                ids.update(((b"," if total else b"") + ",".join(decimals).encode()))
                raw.update(b"".join(decoded))
                total += sum(counts)
                parts = []
        return total, ids.hexdigest(), raw.hexdigest()


@functools.lru_cache(maxsize=2)
def teller(path: str, pattern: str) -> Teller:
    """One for each worker process and file."""
    return Teller(vocabulary(path, pattern))


@functools.lru_cache(maxsize=2)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    """One for each worker process and file."""
    return Vocabulary(path, pattern)


@functools.lru_cache(maxsize=2)
def entries(path: str) -> list[bytes]:
    """The bytes of every id; all that decoding needs."""
    return by_id(read_ranks(path))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(row, ids) for each row of ``docs``: the row as a struct without its text, and the ids of its text."""
    ship(docs)
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[docs[c] for c in rest]).alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary(path, pattern)
        for batch in batches:
            lists, held, first = [], 0, 0
            for i, t in enumerate(batch.column(1)):
                lists.append(coder.encode(t.as_py() or ""))
                held += len(lists[-1])
                if held >= HAND_ON or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, i + 1 - first), pa.array(lists, pa.list_(pa.int32()))], ["row", "ids"])
                    lists, held, first = [], 0, i + 1

    return rows.mapInArrow(run, f"{_named('row', rows)}, ids array<int>")


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256) for each row of ``docs``, encoded and decoded in one pass.

    The same as digests of what :func:`encode` and :func:`decode` give, without
    handing the ids from one Python worker to the next.
    """
    ship(docs)
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[docs[c] for c in rest]).alias("row"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tell = teller(path, pattern).digests
        for batch in batches:
            found = [tell(t.as_py() or "") for t in batch.column(1)]
            columns = [pa.array([f[k] for f in found], kind) for k, kind in enumerate((pa.int64(), pa.string(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["row", "n_tokens", "ids_sha256", "decoded_sha256"])

    return rows.mapInArrow(run, f"{_named('row', rows)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(row, ids, decoded) from (row, ids): the bytes the ids stand for."""
    ship(encoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        entry = entries(path)
        for batch in batches:
            step = max(1, min(batch.num_rows, 256))
            for a in range(0, batch.num_rows, step):
                part = batch.slice(a, step)
                raw = [b"".join([entry[i] for i in ids.as_py() or []]) for ids in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(raw, pa.binary())], ["row", "ids", "decoded"])

    return encoded.mapInArrow(run, f"{_named('row', encoded)}, ids array<int>, decoded binary")


def _named(column: str, df: DataFrame) -> str:
    return f"`{column}` {df.schema[column].dataType.simpleString()}"
