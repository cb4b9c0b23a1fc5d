"""The registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, conversations, exact_dedup, fingerprints, html_extract, line_dedup, mixing, ngram_join, periodic_runs, quality, secrets, sharding, substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: What makes a passage of repeated lines and sentences: so many words in a row.
PASSAGE_WORDS = 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _query(f):
    QUERIES[f.__name__] = f
    return f


@_query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 3-word shingles at a Jaccard similarity of 0.9 or more."""
    linked = ngram_join.jaccard_components(_table(spark, sf_dir, "documents"), words=3, percent=90)
    return linked.select("doc_id", "n_shingles", "component_id")


def byte_bpe_file() -> tuple[str, str]:
    """The default vocabulary: (path, pattern) of the multilingual byte-level ranks."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def bpe_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256) by encoding and decoding the texts."""
    return bpe.digests(docs, path, pattern)


@_query
def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes they decode to."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digests(docs, *byte_bpe_file()).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that occur earlier, and what was removed, by original offsets."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substring_dedup.dedup_units(docs, substring_dedup.SENTENCES, run_words=PASSAGE_WORDS)
    runs = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))
    total = lambda f: F.aggregate(runs, F.lit(0).cast("long"), lambda a, s: a + f(s))
    return found.select(
        "row.doc_id", total(lambda s: (s["last"] - s["first"] + 1).cast("long")).alias("n_removed"), total(lambda s: s["stop"] - s["start"]).alias("removed_chars"),
        F.array_join(F.transform(runs, lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string"))), ",").alias("removed_spans"), F.col("clean_text").alias("text"))


@_query
def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weights 1, 2, 3 takes of every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.mix(docs, mixing.quality_weights(_table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).cast("long").alias("taken"))


@_query
def op5_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@_query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents equal but for white space."""
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


@_query
def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    return fingerprints.edit_likeness(_table(spark, sf_dir, "documents"))


@_query
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines of three-line windows that occur earlier."""
    found = line_dedup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["last"] - s["first"] + 1), F.lit(0))
    return found.select("row.doc_id", "n_lines", removed.cast("long").alias("n_removed"), F.col("clean_text").alias("text"))


@_query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 16 shards whose row counts are at most one apart."""
    placed = sharding.assign(_table(spark, sf_dir, "documents"), 16)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score(docs, quality.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select("row.doc_id", quality.held_out(F.col("row.doc_id")).alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


@_query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation."""
    return conversations.repair(conversations.damage(_table(spark, sf_dir, "conversations")), gone="gone")


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The runs of every document, the most repeating one, and what is left without repetitions."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(docs, alter=periodic_runs.planted_period)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    # more exponent, then smaller start, then smaller period; runs come by start and period
    best = F.reduce("runs", F.get("runs", F.lit(0)), lambda b, r: F.when(r["length"] * b["period"] > b["length"] * r["period"], r).otherwise(b))
    return found.select("row.doc_id", "runs", "clean_text", lines.alias("lines"), best.alias("best")).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join("lines", "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("clean_text").cast("binary"), 256).alias("collapsed_sha256"))


@_query
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every document that hold secrets."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(kinds) - F.size(F.array_remove(kinds, k)) for k in range(3)]
    return found.select("row.doc_id", *[c.cast("long").alias(f"n_{k}") for c, k in zip(counts, secrets.KINDS, strict=False)], F.sha2(secrets.written("base").cast("binary"), 256).alias("base_sha256"),
                        secrets.written(F.array_sort(F.concat("base", "added"))).alias("spans"))


_WORDS = r"[^\x20\x09-\x0D]+"

ORACLES["op1_ngram_jaccard_join"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, g FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
popular AS (SELECT g, count(*) AS f FROM shingles GROUP BY g),
ordered AS (
  SELECT s.doc_id, s.g, z.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY p.f, s.g) AS r FROM shingles s JOIN popular p USING (g) JOIN sizes z USING (doc_id)),
prefixes AS (SELECT doc_id, g, n FROM ordered WHERE r <= n - (90 * n + 99) // 100 + 1),
pairs AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM prefixes a JOIN prefixes b USING (g)
  WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN shingles x ON x.doc_id = p.a JOIN shingles y ON y.doc_id = p.b AND y.g = x.g
  GROUP BY p.a, p.b, p.na, p.nb HAVING 100 * count(*) >= 90 * (p.na + p.nb - count(*))),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT a AS node, a AS other FROM both_ways
  UNION SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.other),
labels_of AS (SELECT node, min(other) AS component_id FROM reached GROUP BY node)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, coalesce(l.component_id, d.doc_id)::BIGINT AS component_id
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN labels_of l ON l.node = d.doc_id
"""

ORACLES["op3_substring_dedup"] = rf"""
WITH pieces AS (
  SELECT doc_id, text, string_split(regexp_replace(text, '({substring_dedup.SENTENCES})', '\1' || chr(57344), 'g'), chr(57344)) AS u FROM documents WHERE text IS NOT NULL),
placed AS (
  SELECT doc_id, unnest(u) AS unit, generate_subscripts(u, 1) AS k FROM pieces),
offsets AS (
  SELECT doc_id, k, unit, coalesce(sum(length(unit)) OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM placed),
normal AS (
  SELECT *, lower(trim(regexp_replace(unit, '[\x1c-\x20\x09-\x0D\x{{85}}\x{{a0}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+', ' ', 'g'))) AS n FROM offsets),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS place, greatest(len(string_split(n, ' ')), length(n) // {substring_dedup.CHARS_PER_WORD}) AS size FROM normal WHERE n <> ''),
flagged AS (
  SELECT *, row_number() OVER (PARTITION BY n ORDER BY doc_id, place) > 1 AS gone FROM numbered),
islands AS (
  SELECT *, place - row_number() OVER (PARTITION BY doc_id, gone ORDER BY place) AS island FROM flagged),
runs AS (
  SELECT doc_id, min(place) AS place, count(*) AS n, min(start) AS start, max(start + length(unit)) AS stop
  FROM islands WHERE gone GROUP BY doc_id, island HAVING sum(size) >= {PASSAGE_WORDS}),
removed AS (
  SELECT doc_id, sum(n)::BIGINT AS n_removed, sum(stop - start)::BIGINT AS removed_chars, string_agg(start || '-' || stop, ',' ORDER BY place) AS removed_spans FROM runs GROUP BY doc_id),
kept AS (
  SELECT o.doc_id, string_agg(o.unit, '' ORDER BY o.k) AS text FROM offsets o
  WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = o.doc_id AND o.start >= r.start AND o.start + length(o.unit) <= r.stop AND length(o.unit) > 0) GROUP BY o.doc_id)
SELECT d.doc_id, coalesce(x.n_removed, 0)::BIGINT AS n_removed, coalesce(x.removed_chars, 0)::BIGINT AS removed_chars, coalesce(x.removed_spans, '') AS removed_spans,
  CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN removed x ON x.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

ORACLES["op4_mix_sources"] = rf"""
WITH sized AS (
  SELECT d.doc_id, d.source, len(regexp_extract_all(coalesce(d.text, ''), '{_WORDS}'))::BIGINT AS size,
    -ln((('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '') || ':7'), 1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496.0) / coalesce(w.quality_weight, 1.0) AS key
  FROM documents d LEFT JOIN (
    SELECT doc_id, CASE WHEN max(quality) >= 1 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS quality_weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id) w ON w.doc_id = d.doc_id),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
numbered AS (SELECT *, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight, 3 * source_size AS cap FROM sources),
levels AS (
  SELECT *, row_number() OVER o AS place,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS rest,
    (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS shares
  FROM numbered WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
edge AS (SELECT place AS edge, rest AS edge_rest, shares AS edge_shares FROM levels WHERE rest * weight <= cap * shares ORDER BY place LIMIT 1),
aims AS (
  SELECT source, source_size, CASE WHEN place < edge THEN cap::DOUBLE ELSE (edge_rest * weight)::DOUBLE / edge_shares::DOUBLE END AS target FROM levels, edge),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM aims),
sums AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs, b.target - (b.epochs * b.source_size)::DOUBLE AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (size * (epochs + CASE WHEN before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM sums
"""

ORACLES["op6_exact_dedup"] = r"""
WITH normal AS (
  SELECT doc_id, length(coalesce(text, '')) AS n_chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW w AS (PARTITION BY norm ORDER BY n_chars DESC, doc_id)
"""

ORACLES["op8_line_dedup"] = r"""
WITH pieces AS (
  SELECT doc_id, text, CASE WHEN coalesce(text, '') = '' THEN [] ELSE string_split(text, chr(10)) END AS u FROM documents),
lines AS (
  SELECT doc_id, line, pos, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM (SELECT doc_id, unnest(u) AS line, generate_subscripts(u, 1) - 1 AS pos FROM pieces)),
windows AS (
  SELECT * FROM (
    SELECT doc_id, pos AS p0, lead(pos, 2) OVER o AS p2, bare AS a, lead(bare) OVER o AS b, lead(bare, 2) OVER o AS c
    FROM lines WHERE bare <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE p2 IS NOT NULL),
later AS (
  SELECT doc_id, p0, p2 FROM (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p0) AS r FROM windows) WHERE r > 1),
gone AS (SELECT DISTINCT l.doc_id, l.pos FROM lines l JOIN later s ON s.doc_id = l.doc_id AND l.pos BETWEEN s.p0 AND s.p2),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.pos) AS text FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT p.doc_id, len(p.u)::BIGINT AS n_lines, coalesce(r.n, 0)::BIGINT AS n_removed, CASE WHEN p.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text
FROM pieces p LEFT JOIN removed r ON r.doc_id = p.doc_id LEFT JOIN kept k ON k.doc_id = p.doc_id
"""


def _edited(state: str, cost: int, letter: str) -> str:
    """A state of the SQL repair is its cost in nine digits, then its audit, so that text order is the order wanted."""
    return f"lpad((left({state}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}'"


_I2 = f"least(x2, {_edited('x0', 5, 'I')}, {_edited('x1', 5, 'I')}, {_edited('x3', 5, 'I')})"
_KEPT = {
    x: " , ".join(f"CASE WHEN NOT m THEN CASE WHEN r = '{x}' THEN " + _edited(y, 0, "K") + " ELSE " + _edited(y, 1, "R") + " END END" for y in ys)
    for x, ys in {"u": ("y0", "y1", "y3"), "a": ("y2",)}.items()
}
ORACLES["op11_conversation_repair"] = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256)) AS i)),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS h
  FROM conversations, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT * FROM hashed UNION ALL SELECT * FROM hashed WHERE h = 3) WHERE h <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS r FROM damaged),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '{_WORDS}') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) || r AS met FROM placed),
steps AS (SELECT conv_id, i, r, fault IN ('blank', 'duplicate') AS m, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS t FROM faults),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (met IS NOT NULL AND met NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id),
states AS (
  SELECT conv_id, 0::BIGINT AS i, '000000000' AS x0, NULL::VARCHAR AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM counts
  UNION ALL
  SELECT conv_id, i, {_edited('y0', 2, 'D')},
    least({_edited('y1', 2, 'D')}, CASE WHEN NOT m AND r = 's' THEN lpad((left(y0, 9)::INT + t)::VARCHAR, 9, '0') || substr(y0, 10) || 'K' END),
    least({_edited('y2', 2, 'D')}, k2), least({_edited('y3', 2, 'D')}, k3)
  FROM (
    SELECT *, lpad((left(u, 9)::INT + t)::VARCHAR, 9, '0') || substr(u, 10) AS k2, lpad((left(a, 9)::INT + t)::VARCHAR, 9, '0') || substr(a, 10) AS k3
    FROM (
      SELECT *, least({_KEPT['u']}, NULL) AS u, least({_KEPT['a']}, NULL) AS a
      FROM (
        SELECT s.conv_id, w.i, w.r, w.m, w.t, x0 AS y0, x1 AS y1, {_I2} AS y2, least(x3, {_edited(_I2, 5, 'I')}) AS y3
        FROM states s JOIN steps w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = s.i + 1)))),
goals AS (
  SELECT s.conv_id, least(x0, x3, {_edited(_I2, 5, 'I')}) AS best FROM states s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND c.n = s.i),
letters AS (
  SELECT conv_id, unnest(string_split(substr(best, 10), '')) AS letter, generate_subscripts(string_split(substr(best, 10), ''), 1) AS p FROM goals WHERE length(best) > 9),
numbered AS (
  SELECT *, count(*) FILTER (letter <> 'I') OVER w AS i, count(*) FILTER (letter <> 'D') OVER w AS o FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
written AS (
  SELECT n.conv_id, n.letter, n.p, n.o, f.role, f.r, f.text FROM numbered n LEFT JOIN placed f ON n.letter <> 'I' AND f.conv_id IS NOT DISTINCT FROM n.conv_id AND f.i = n.i
  WHERE n.letter <> 'D'),
heads AS (SELECT conv_id, bool_or(o = 1 AND letter = 'K' AND r = 's')::INT AS head FROM written GROUP BY conv_id),
repaired AS (
  SELECT w.conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - 1 - head) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
  FROM written w JOIN heads h ON h.conv_id IS NOT DISTINCT FROM w.conv_id GROUP BY w.conv_id)
SELECT k.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank, coalesce(c.duplicate, 0)::BIGINT AS duplicate,
  coalesce(c.truncated, 0)::BIGINT AS truncated, coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(left(g.best, 9)::BIGINT, 0) AS cost,
  coalesce(substr(g.best, 10), '') AS audit, sha256(coalesce(p.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN goals g ON g.conv_id IS NOT DISTINCT FROM k.conv_id
LEFT JOIN repaired p ON p.conv_id IS NOT DISTINCT FROM k.conv_id
"""

_ASSIGN = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password") + "|" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in ("passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_SHAPES = {
    "assign": rf"(?:{_ASSIGN})[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]+", "hex": "[0-9a-f]+", "random": "[A-Za-z0-9+/_-]+"}
_LEAST = {"assign": 1, "access": 20, "hex": 24, "random": 16}
_Z = "(CASE WHEN {0} >= 0 THEN {1} ELSE 1 - {2} END)"


def _tail_sql(z: str) -> str:
    t = f"(1 / (1 + 0.2316419::DOUBLE * {z}))"
    return (f"(0.3989422804014327::DOUBLE * exp(-{z} * {z} / 2) * {t} * (0.319381530::DOUBLE + {t} * (-0.356563782::DOUBLE"
            f" + {t} * (1.781477937::DOUBLE + {t} * (-1.821255978::DOUBLE + {t} * 1.330274429::DOUBLE)))))")  # fmt: skip


_CLASSES = ", ".join(f"({i}, '{a}', {secrets.least_length(len(a), o)})" for i, (_, a, o) in enumerate(secrets.ENCODINGS, 1))
_ENCODING = "CASE " + " ".join(f"WHEN regexp_full_match(word, '[{a.replace('-', chr(92) + '-')}]+') THEN {i}" for i, (_, a, _) in enumerate(secrets.ENCODINGS, 1)) + " END"
_MATCHES = " UNION ALL ".join(
    f"SELECT rid, '{kind}' AS kind, regexp_extract_all(text, '{p}') AS w, string_split_regex(text, '{p}') AS g FROM d" for kind, p in _SHAPES.items())
ORACLES["op13_secret_scan"] = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
matches AS (SELECT rid, kind, unnest(w) AS word, unnest(g[1:len(w)]) AS gap, generate_subscripts(w, 1) AS i FROM ({_MATCHES})),
placed AS (SELECT rid, kind, word, sum(length(gap) + length(word)) OVER (PARTITION BY rid, kind ORDER BY i) AS stop FROM matches),
found AS MATERIALIZED (
  SELECT rid, kind, word, (stop - length(word))::BIGINT AS start, stop::BIGINT AS stop FROM placed
  WHERE length(word) >= CASE kind {' '.join(f"WHEN '{k}' THEN {v}" for k, v in _LEAST.items())} END
    AND (kind <> 'assign' OR length(regexp_extract(word, '{_SHAPES['assign']}', 1)) >= {secrets.LEAST_VALUE})),
base AS (SELECT rid, start, stop, kind, CASE kind WHEN 'assign' THEN 0 WHEN 'access' THEN 1 ELSE 2 END AS place FROM found WHERE kind <> 'random'),
classes(encoding, alphabet, least) AS (VALUES {_CLASSES}),
tokens AS (
  SELECT row_number() OVER () AS tid, rid, start, stop, word, encoding, alphabet, length(word)::DOUBLE AS n, length(alphabet)::DOUBLE AS k
  FROM (SELECT *, {_ENCODING} AS encoding FROM found WHERE kind = 'random') JOIN classes USING (encoding) WHERE length(word) >= least),
symbols AS (
  SELECT tid, k, i, (strpos(alphabet, c) - 1)::DOUBLE AS x FROM (
    SELECT tid, k, alphabet, unnest(string_split(word, '')) AS c, generate_subscripts(string_split(word, ''), 1) AS i FROM tokens)),
pairs AS (SELECT *, lag(x) OVER (PARTITION BY tid ORDER BY i) AS before, first(x) OVER (PARTITION BY tid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_x,
  last(x) OVER (PARTITION BY tid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_x FROM symbols),
sums AS (
  SELECT tid, sum(CASE WHEN before IS NOT NULL AND (x >= k / 2) <> (before >= k / 2) THEN 1.0 ELSE 0.0 END)::DOUBLE AS turns,
    sum(CASE WHEN x >= k / 2 THEN 1.0 ELSE 0.0 END)::DOUBLE AS upper_, sum(x) AS total, sum(x * x) AS squared, sum(coalesce(x * before, x * last_x)) AS products
  FROM pairs GROUP BY tid),
squares AS (SELECT tid, sum(c * c)::DOUBLE AS squares FROM (SELECT tid, x, count(*) AS c FROM symbols GROUP BY tid, x) GROUP BY tid),
scored AS (
  SELECT t.*, (pow((k / n * squares - n) / (k - 1), (1 / 3)::DOUBLE) - (1 - 1 / (9 * ((k - 1) * n / (2 * (n - 1)))))) * 3 * sqrt((k - 1) * n / (2 * (n - 1))) AS uneven,
    1 + 2 * upper_ * (n - upper_) / n AS mean, turns, n * squared - total * total AS bottom, n * products - total * total AS top
  FROM tokens t JOIN sums USING (tid) JOIN squares USING (tid)),
spread AS (
  SELECT *, CASE WHEN (mean - 1) * (mean - 2) / (n - 1) > 0 THEN abs((turns + 1 - mean) / sqrt((mean - 1) * (mean - 2) / (n - 1))) END AS runs,
    CASE WHEN bottom > 0 THEN abs((top / bottom + 1 / (n - 1)) * (n - 1) * sqrt(n - 2) / n) END AS serial FROM scored),
tested AS (
  SELECT *, {' + '.join(f'(n >= {b})::INT' for b in secrets.BANDS)} AS band,
    1 - pow(1 - least({_Z.format('uneven', _tail_sql('uneven'), _tail_sql('(-uneven)'))}, CASE WHEN runs IS NULL THEN 0 ELSE 2 * {_tail_sql('runs')} END,
      CASE WHEN serial IS NULL THEN 0 ELSE 2 * {_tail_sql('serial')} END), 3.0::DOUBLE) AS p FROM spread),
bins AS (SELECT encoding, band, greatest(0, least(99, floor(p * 100)))::INT AS bin FROM tested),
levels AS (
  SELECT encoding, band, bin, (SELECT count(*) FROM bins b WHERE b.encoding = e.encoding AND b.band = e.band AND b.bin >= l.bin) AS above,
    (SELECT count(*) FROM bins b WHERE b.encoding = e.encoding AND b.band = e.band AND b.bin >= 50) AS high
  FROM (SELECT DISTINCT encoding, band FROM bins) e, (SELECT unnest(range(0, 51))::INT AS bin) l),
limits AS (SELECT encoding, band, min(bin) / 100.0::DOUBLE AS lowest FROM levels WHERE above - high - high * (50 - bin) / 50.0::DOUBLE <= {secrets.FALSE_SHARE} * above GROUP BY encoding, band),
added AS (
  SELECT rid, start, stop, 'random' AS kind, 3 AS place FROM tested JOIN limits USING (encoding, band)
  WHERE p >= lowest AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = tested.rid AND b.start < tested.stop AND tested.start < b.stop)),
told AS (SELECT rid, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS k, count(*) FILTER (kind = 'hex') AS h,
  string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) AS spans FROM base GROUP BY rid),
whole AS (SELECT rid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, place, stop) AS spans FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY rid)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(k, 0)::BIGINT AS n_access, coalesce(h, 0)::BIGINT AS n_hex,
  sha256(coalesce(told.spans, '')) AS base_sha256, coalesce(whole.spans, '') AS spans
FROM d LEFT JOIN told USING (rid) LEFT JOIN whole USING (rid)
"""
