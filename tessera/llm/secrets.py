"""Secret scans: known shapes, and strings that a battery of randomness tests can't tell from random ones.

Known shapes are assignments to a name such as ``password``, access key ids and
long lower-case hexadecimal numbers, found by regular expressions, leftmost and
without overlap for each kind.

The battery looks at every other long token. Its encoding is the first alphabet
of ``ENCODINGS`` that holds all its symbols, its trailing ``=`` set aside. Under
the hypothesis that symbols are drawn evenly and independently of each other,

* chi-squared of the symbols' counts, with its exact mean and variance at this
  length, scaled to a normal value by Wilson and Hilferty's cube root;
* runs of symbols in the lower and upper half of the alphabet (Wald, Wolfowitz);
* serial correlation of neighbouring symbols' places in the alphabet (Knuth)

give three p-values, of which the least, corrected for being the least of
three, is the token's. Words are far from even, so their p-values are near 0;
those of random strings are spread evenly over 0 to 1.

False discoveries are controlled with respect to length in two ways. A token is
tested only from the length on where ordinary text of that alphabet (equal
symbols meet with probability ``ordinary``) lies three standard deviations off on
average; shorter ones can't be told apart. And for each encoding and band of
lengths, over the tokens of all documents, twice the number of p-values above a
half estimates the random ones; what exceeds their even share between t and a half
are others. The least t in steps of 0.01 at which they make up at most
``FALSE_SHARE`` of the p-values above t is the class's threshold.

The work is a few passes of built-in expressions over each text, one written
table without texts, and an aggregate to at most encodings x bands x 100 rows.
Texts aren't shuffled. Null texts count as empty and have no spans; repeated
rows are tested each; offsets are code points, ends exclusive. Tables without
rows or tokens have no thresholds and give no spans of the battery.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import materialise, text_or_empty

#: Fixed shapes of the contract.
ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 6

TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}"
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: (name, alphabet, probability that two symbols of ordinary text are equal). Letters: the usual index
#: of coincidence; hexadecimal digits: that of plain numbers.
ENCODINGS = (
    ("hex", _DIGITS + "abcdef", 0.1), ("HEX", _DIGITS + "ABCDEF", 0.1), ("lower", _LOWER, 0.066), ("upper", _UPPER, 0.066),
    ("base32", _UPPER + "234567", 0.066), ("base36", _LOWER + _DIGITS, 0.066), ("BASE36", _UPPER + _DIGITS, 0.066), ("letters", _UPPER + _LOWER, 0.066),
    ("base64", _UPPER + _LOWER + _DIGITS + "+/", 0.066), ("base64url", _UPPER + _LOWER + _DIGITS + "-_", 0.066))
BANDS = (24, 32, 48, 64)
FALSE_SHARE, DEVIATIONS = 0.05, 3.0


def least_length(symbols: int, ordinary: float) -> int:
    """From this length on ordinary text lies ``DEVIATIONS`` standard deviations off an even spread."""
    return math.ceil(1 + DEVIATIONS * math.sqrt(2 * (symbols - 1)) / (symbols * ordinary - 1))


def with_spans(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """``df`` with its column ``text`` replaced by the matches of each pattern: name -> array of (start, stop, word).

    A match begins where the pieces of the text before it, as cut by the
    pattern, and the matches before it end. Sums run over blocks of matches, so that
    work is n ** 1.5 at most. Each step is a column of its own, as an
    expression within a lambda function would be computed again for every element.
    """
    others = [c for c in df.columns if c != "text"]
    plus = lambda a, x: a + x
    zero = F.lit(0).cast("long")
    stage = df.select("*", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(name) for name, p in patterns.items()])

    def sizes(name: str, pattern: str) -> Column:
        gaps = F.transform(F.split("text", pattern, -1), lambda g: F.length(g).cast("long"))
        sums = F.slice(F.zip_with(gaps, name, lambda g, w: g + F.length(w)), F.lit(1), F.size(name))
        return F.when(F.size(name) > 0, sums).otherwise(F.array().cast("array<bigint>")).alias(f"sizes_{name}")

    stage = stage.select(*others, *patterns, *[sizes(*x) for x in patterns.items()])
    root = {x: F.greatest(F.ceil(F.sqrt(F.size(x))).cast("int"), F.lit(1)) for x in patterns}
    stage = stage.select("*", *[root[x].alias(f"block_{x}") for x in patterns])

    def starts(x: str) -> Column:
        block = F.col(f"block_{x}")
        numbers = F.sequence(F.lit(0), F.ceil(F.size(x) / block).cast("int"))
        blocks = F.transform(numbers, lambda b: F.aggregate(F.slice(f"sizes_{x}", b * block + 1, block), zero, plus))
        return F.aggregate(blocks, F.array(zero), lambda a, s: F.concat(a, F.array(F.element_at(a, -1) + s))).alias(f"starts_{x}")

    stage = stage.select("*", *[starts(x) for x in patterns])

    def spans(x: str) -> Column:
        block = F.col(f"block_{x}")

        def span(w: Column, i: Column) -> Column:
            within = F.aggregate(F.slice(f"sizes_{x}", (i - i % block + 1).cast("int"), (i % block + 1).cast("int")), zero, plus)
            stop = F.get(f"starts_{x}", F.floor(i / block).cast("int")) + within
            return F.struct((stop - F.length(w)).alias("start"), stop.alias("stop"), w.alias("word"))

        return F.transform(x, span).alias(x)

    return stage.select(*others, *[spans(x) for x in patterns])


def _upper_tail(z: Column) -> Column:
    """The chance that a normal value exceeds ``z`` >= 0 (Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    return 0.3989422804014327 * F.exp(-z * z / 2) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))


def _tail(z: Column) -> Column:
    return F.when(z >= 0, _upper_tail(z)).otherwise(1 - _upper_tail(-z))


def _looked_up(values: list, at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), at)


def _tested(df: DataFrame) -> DataFrame:
    """The column ``tokens`` of (start, stop, word) with encoding, band and p-value in place of the word; untestable ones go."""
    holds = lambda w: F.coalesce(*[F.when(w.rlike(f"^[{alphabet.replace('-', chr(92) + '-')}]+$"), F.lit(i + 1)) for i, (_, alphabet, _) in enumerate(ENCODINGS)])
    least = [least_length(len(alphabet), ordinary) for _, alphabet, ordinary in ENCODINGS]
    df = df.withColumn("tokens", F.transform("tokens", lambda t: F.struct(t["start"], t["stop"], t["word"], holds(t["word"]).alias("encoding"))))
    long = F.filter("tokens", lambda t: t["encoding"].isNotNull() & (F.length(t["word"]) >= _looked_up(least, t["encoding"])))
    df = df.withColumn("tokens", long)

    def spread(t: Column) -> Column:
        letters = F.regexp_extract_all(t["word"], F.lit("."), F.lit(0))
        places = F.transform(letters, lambda c: (F.position(c, _looked_up([a for _, a, _ in ENCODINGS], t["encoding"])) - 1).cast("double"))
        n = F.length(t["word"]).cast("double")
        squares = F.aggregate(
            F.array_distinct(letters), F.lit(0.0), lambda a, c: a + F.pow(n - F.length(F.replace(t["word"], c, F.lit(""))), F.lit(2.0)))
        return F.struct(t["start"], t["stop"], t["encoding"], n.alias("n"), places.alias("places"), squares.alias("squares"))

    df = df.withColumn("tokens", F.transform("tokens", spread))

    def sums(t: Column) -> Column:
        half = _looked_up([len(a) / 2 for _, a, _ in ENCODINGS], t["encoding"])
        first = F.element_at(t["places"], 1)
        start = F.struct(F.element_at(t["places"], -1).alias("last"), *[F.lit(0.0).alias(c) for c in ("turns", "upper", "total", "squared", "products")])
        folded = F.aggregate(t["places"], start, lambda a, x: F.struct(
            x.alias("last"), (a["turns"] + F.when((x >= half) != (a["last"] >= half), 1.0).otherwise(0.0)).alias("turns"),
            (a["upper"] + F.when(x >= half, 1.0).otherwise(0.0)).alias("upper"), (a["total"] + x).alias("total"),
            (a["squared"] + x * x).alias("squared"), (a["products"] + x * a["last"]).alias("products")))
        # the fold goes round: a change of halves between the last and the first symbol begins no run
        wraps = F.when((first >= half) != (F.element_at(t["places"], -1) >= half), 1.0).otherwise(0.0)
        return F.struct(t["start"], t["stop"], t["encoding"], t["n"], t["squares"], folded.alias("sum"), wraps.alias("wraps"))

    df = df.withColumn("tokens", F.transform("tokens", sums))

    def scores(t: Column) -> Column:
        n, k, s = t["n"], _looked_up([float(len(a)) for _, a, _ in ENCODINGS], t["encoding"]), t["sum"]
        even = k / n * t["squares"] - n
        shape = (k - 1) * n / (2 * (n - 1))  # mean k - 1, variance 2 (k - 1) (n - 1) / n
        uneven = (F.pow(even / (k - 1), F.lit(1 / 3)) - (1 - 1 / (9 * shape))) * 3 * F.sqrt(shape)
        mean = 1 + 2 * s["upper"] * (n - s["upper"]) / n
        spread = (mean - 1) * (mean - 2) / (n - 1)
        runs = F.when(spread > 0, (s["turns"] - t["wraps"] + 1 - mean) / F.sqrt(spread))
        bottom = n * s["squared"] - s["total"] * s["total"]
        serial = F.when(bottom > 0, ((n * s["products"] - s["total"] * s["total"]) / bottom + 1 / (n - 1)) * (n - 1) * F.sqrt(n - 2) / n)
        return F.struct(t["start"], t["stop"], t["encoding"], n.alias("n"), uneven.alias("uneven"), runs.alias("runs"), serial.alias("serial"))

    df = df.withColumn("tokens", F.transform("tokens", scores))

    def combined(t: Column) -> Column:
        # one half or one symbol alone is no random string
        two_sided = lambda z: F.when(z.isNull(), 0.0).otherwise(2 * _upper_tail(F.abs(z)))
        least_p = F.least(_tail(t["uneven"]), two_sided(t["runs"]), two_sided(t["serial"]))
        band = sum((F.when(t["n"] >= b, 1).otherwise(0) for b in BANDS), F.lit(0))
        return F.struct(t["start"], t["stop"], t["encoding"], band.alias("band"), (1 - F.pow(1 - least_p, F.lit(3.0))).alias("p"))

    return df.withColumn("tokens", F.transform("tokens", combined))


def thresholds(tested: DataFrame) -> DataFrame:
    """(encoding, band, least): the p-value from which on a class's tokens count as random."""
    tokens = tested.select(F.explode("tokens").alias("t")).select("t.encoding", "t.band", "t.p")
    bins = tokens.groupBy("encoding", "band", F.greatest(F.lit(0), F.least(F.lit(99), F.floor(F.col("p") * 100).cast("int"))).alias("bin")).count()
    every = bins.select("encoding", "band").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(99))))
    known = every.join(bins, ["encoding", "band", "bin"], "left").fillna(0, ["count"])
    upward = W.partitionBy("encoding", "band").orderBy(F.desc("bin"))
    sums = known.withColumn("above", F.sum("count").over(upward)).withColumn(
        "high", F.sum(F.when(F.col("bin") >= 50, F.col("count")).otherwise(0)).over(W.partitionBy("encoding", "band")))
    # of those from the bin on, what exceeds an even spread at twice the upper half's height
    excess = F.col("above") - F.col("high") - F.col("high") * (50 - F.col("bin")) / 50.0
    good = sums.where((F.col("bin") <= 50) & (excess <= FALSE_SHARE * F.col("above")))
    return good.groupBy("encoding", "band").agg((F.min("bin") / 100.0).alias("least"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, base, added) for each row of ``docs``: the row as a struct without its text, and its spans.

    ``base`` lists the spans (start, place of the kind in ``KINDS``, stop) of the
    known shapes, ``added`` those of the battery that meet none of them.
    """
    rest = [c for c in docs.columns if c != text]
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in rest]).alias("row"), text_or_empty(docs[f"`{text}`"]).alias("text"))
    found = with_spans(rows, {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "tokens": TOKEN})
    valued = F.filter("assign", lambda s: F.length(F.regexp_extract(s["word"], ASSIGN, 1)) >= LEAST_VALUE)

    def of_kind(spans: Column | str, kind: str) -> Column:
        return F.transform(spans, lambda s: F.struct(s["start"], F.lit(KINDS.index(kind)).alias("kind"), s["stop"]))

    listed = [of_kind(valued, "assign"), of_kind("access", "access"), of_kind("hex", "hex")]
    tested = _tested(found.select("row", F.array_sort(F.concat(*listed)).alias("base"), "tokens"))
    tested = materialise(tested, "secret-tokens")
    least = {(r.encoding, r.band): r.least for r in thresholds(tested).collect()}  # encodings x bands at most
    limits = F.create_map(*[F.lit(x) for (e, b), t in least.items() for x in (e * 10 + b, float(t))]) if least else F.lit(None).cast("map<int,double>")
    random = F.filter("tokens", lambda t: F.coalesce(t["p"] >= F.try_element_at(limits, t["encoding"] * 10 + t["band"]), F.lit(False)))
    apart = F.filter(random, lambda t: ~F.exists("base", lambda b: (b["start"] < t["stop"]) & (t["start"] < b["stop"])))
    return tested.select("row", "base", of_kind(apart, "random").alias("added"))


def written(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    name = lambda s: F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s), s["start"].cast("string"), s["stop"].cast("string"))), ",")
