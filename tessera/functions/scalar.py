"""Scalar column functions.

All of them are built from native Spark expressions, so they stay inside
whole-stage codegen and push down where Catalyst can push them.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the original behaviour:
#   * the row-key salt is left-padded with "0" to 4 characters, then ":" and the id;
#   * the history key joins id and time with ":", time as yyyyMMddHHmmss;
#   * the JVM's String.trim strips every code point from U+0000 to U+0020.
SALT_WIDTH = 4
SALT_PAD = "0"
KEY_SEPARATOR = ":"
HISTORY_TIME_PATTERN = "yyyyMMddHHmmss"
MONTH_INT_PATTERN = "YYYYMM"
_JVM_TRIM_CHARS = "".join(chr(c) for c in range(0x00, 0x21))  # U+0000 .. U+0020


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_string_hash(c: Column | str) -> Column:
    """``String.hashCode`` of a string column, as a 32-bit int.

    The JVM hashes UTF-16 code units: h = 31*h + unit (mod 2^32). The string is
    folded code point by code point; a code point above U+FFFF contributes its
    two surrogate units. The result's sign is folded like Java's int.
    """
    mask = F.lit(0xFFFFFFFF).cast("bigint")

    def step(acc: Column, ch: Column) -> Column:
        cp = F.ascii(ch).cast("bigint")
        high = F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10)
        low = F.lit(0xDC00) + (cp - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
        pair = (((acc * 31 + high).bitwiseAND(mask)) * 31 + low).bitwiseAND(mask)
        return F.when(cp > 0xFFFF, pair).otherwise((acc * 31 + cp).bitwiseAND(mask))

    chars = F.filter(F.split(_col(c), ""), lambda ch: ch != "")
    h = F.aggregate(chars, F.lit(0).cast("bigint"), step)
    return F.when(h >= F.lit(2**31), h - F.lit(2**32)).otherwise(h).cast("int")


def salted_row_key(c: Column | str, num_salts: int) -> Column:
    """``lpad(abs(hash(id) % n), 4, '0') + ':' + id``; ``n <= 0`` means no salt.

    ``lpad`` truncates longer text, so the padding is only applied below the
    width, which keeps salts of five or more digits whole.
    """
    text = _col(c).cast("string")
    if num_salts is None or num_salts <= 0:
        return text
    salt = F.abs(java_string_hash(text) % F.lit(int(num_salts))).cast("string")
    padded = F.when(F.length(salt) >= SALT_WIDTH, salt).otherwise(F.lpad(salt, SALT_WIDTH, SALT_PAD))
    return F.concat(padded, F.lit(KEY_SEPARATOR), text)


def jvm_trim(c: Column | str) -> Column:
    """Trim like ``String.trim``: all control characters and space, both ends."""
    return F.btrim(_col(c), F.lit(_JVM_TRIM_CHARS))


def cell_text(c: Column | str, data_type: T.DataType | None = None) -> Column:
    """Value as cell text: ``toString`` of the value, null as ``""``.

    Arrays, structs and maps have no useful ``toString`` and are written as JSON;
    binary values are refused.
    """
    col = _col(c)
    if isinstance(data_type, T.BinaryType):
        raise TypeError("binary columns cannot be written as cell text")
    if isinstance(data_type, (T.ArrayType, T.StructType, T.MapType)):
        return F.coalesce(F.to_json(col), F.lit(""))
    return F.coalesce(col.cast("string"), F.lit(""))


def epoch_micros(c: Column | str) -> Column:
    """Microseconds since the epoch of a timestamp (with or without zone)."""
    col = _col(c)
    return F.unix_micros(F.to_utc_timestamp(col.cast("timestamp"), F.current_timezone()))


def history_key(id_col: Column | str, ts_col: Column | str,
                pattern: str = HISTORY_TIME_PATTERN) -> Column:
    """History row key ``<id>:<yyyyMMddHHmmss>`` with the time as an argument."""
    return F.concat_ws(KEY_SEPARATOR, _col(id_col).cast("string"), F.date_format(_col(ts_col), pattern))


# fixed values: pattern letters whose meaning both notations share, with the most repeats Spark takes
_SAME_LETTERS = {"y": 6, "D": 3, "d": 2, "K": 2, "h": 2, "H": 2, "k": 2, "m": 2, "s": 2, "S": 9}
_SPECIAL = frozenset("[]{}#'")
_PATTERN_PARTS = re.compile(r"(?P<letters>([A-Za-z])\2*)|(?P<quoted>''|'(?!')(?:[^']|'')*'(?!'))|.", re.S)


def _pattern_letters(letter: str, n: int, pattern: str) -> str:
    """Spark's letters for a run of ``n`` equal Joda letters; raises where Spark has none."""
    letter = {"Y": "y"}.get(letter, letter)  # year of era
    if letter in _SAME_LETTERS and n <= _SAME_LETTERS[letter]:
        return letter * n
    if letter == "M":  # number, number of two digits, short name, name
        return "M" * min(n, 4)
    if letter in "Ez":  # short name, name
        return letter if n < 4 else letter * 4
    if letter in "Ga":  # one form only
        return letter
    if letter == "Z":  # offset, offset with colon, name of the zone
        return {1: "xx", 2: "xxx"}.get(n, "VV")
    raise ValueError(f"{letter * n!r} in the pattern {pattern!r} has no counterpart")


def translate_joda_pattern(pattern: str) -> str:
    """Spark's date pattern for a Joda-style one.

    ``Y`` is the year of the era (Spark's ``Y`` is a week year) and ``Z``, ``ZZ``, ``ZZZ`` are
    forms of the zone. Quoted text stays text, and so do brackets, braces and ``#``, which are
    plain characters in the old notation. Century, week year, week, number of the weekday and other
    letters, or more repeats than Spark takes, raise ``ValueError``, as does an open quote.
    """
    parts: list[tuple[bool, str]] = []  # whether it is text
    for found in _PATTERN_PARTS.finditer(pattern):
        part = found.group()
        if found["letters"]:
            parts.append((False, _pattern_letters(part[0], len(part), pattern)))
        elif found["quoted"]:
            parts.append((True, part[1:-1].replace("''", "'") or "'"))  # two quotes stand for one
        elif part == "'":
            raise ValueError(f"open quote in the pattern {pattern!r}")
        else:
            parts.append((True, part))
    out = ""
    for literal, run in itertools.groupby(parts, key=lambda p: p[0]):
        text = "".join(t for _, t in run)
        if literal and any(c in _SPECIAL or c.isascii() and c.isalpha() for c in text):
            text = "'" + text.replace("'", "''") + "'"
        out += text
    return out


def parse_date(text: Column | str, pattern: str) -> Column:
    """Parse text by a (Joda-style) pattern; invalid text raises under ANSI."""
    return F.to_timestamp_ntz(_col(text), F.lit(translate_joda_pattern(pattern)))


def ts_to_int(ts: Column | str, pattern: str = MONTH_INT_PATTERN) -> Column:
    """Timestamp rendered by a pattern and read as a long, e.g. 202401."""
    return F.date_format(_col(ts), translate_joda_pattern(pattern)).cast("bigint")


def equals_ignore_case(a: Column | str, b: Column | str) -> Column:
    """``a.equalsIgnoreCase(b)``; a null on either side is false."""
    return F.coalesce(F.lower(_col(a)) == F.lower(_col(b)), F.lit(False))


def levenshtein(a: Column | str, b: Column | str) -> Column:
    """Edit distance (built in); null if either side is null."""
    return F.levenshtein(_col(a), _col(b))


def split_names(names: str | list[str] | None) -> list[str] | None:
    """A comma list of names to a list; ``None``/empty means "not given"."""
    if names is None:
        return None
    if isinstance(names, (list, tuple)):
        parts = list(names)
    else:
        parts = names.split(",")
    parts = [p.strip() for p in parts if p.strip()]
    return parts or None
