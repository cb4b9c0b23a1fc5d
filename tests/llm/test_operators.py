"""The other training-data operators against brute force, and on awkward inputs."""

import base64
import collections
import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, fingerprints, html_extract, line_dedup, mixing, quality, queries, sharding, substring_dedup

WHITE = " \t\n\x0b\f\r"
AWKWARD = [(1, "a b\nc d e f g h\nx y z\nlast one"), (2, None), (3, ""), (4, " \n\t\n"), (5, "long " * 30_000), (5, "long " * 30_000),
           (None, "a b\nc d e f g h\nx y z\nlast one"), (7, "\n".join(["same line of six words here"] * 5)), (8, "Zażółć 🙂 gęślą"), (7, "other")]


def awkward(spark, rows=None):
    """doc_id, text, source and columns that are called like what operators add."""
    schema = "doc_id long, text string, source string, size int, row string, key string, rank int, spans string, kept int, shard int"
    return spark.createDataFrame([(i, t, "s" if (i or 0) % 2 else None, 1, "r", "k", 2, "sp", 3, 4) for i, t in (AWKWARD if rows is None else rows)], schema)


def empty(spark):
    return awkward(spark, [])


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


# ------------------------------------------------------------------ byte-level BPE

def plain_merges(ranks, raw):
    parts = [raw[i:i + 1] for i in range(len(raw))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_bpe_equals_merges_and_round_trips(spark):
    path, pattern = queries.byte_bpe_file()
    coder = bpe.vocabulary(path, pattern)
    rng = random.Random(5)
    texts = [t or "" for _, t in AWKWARD] + ["".join(rng.choice("abcdeth éü日 .,!*\n'") for _ in range(300)) for _ in range(60)] + ["  two  spaces ", "x" * 4000]
    for text in texts:
        want = [i for piece in coder.pieces(text) for i in ([coder.rank[piece.encode()]] if piece.encode() in coder.rank else plain_merges(coder.rank, piece.encode()))]
        assert coder.encode(text) == want
        assert b"".join(coder.entry[i] for i in want) == text.encode()


def test_words_told_together_equal_words_coded_apart():
    coder, teller = bpe.vocabulary(*queries.byte_bpe_file()), bpe.Teller(bpe.vocabulary(*queries.byte_bpe_file()))
    rng = random.Random(8)
    for n in range(1500):
        text = "".join(rng.choice("ab1é日.,'’\n\t  \u00a0") for _ in range(n % 40))
        ids = coder.encode(text)
        assert ids == [i for piece in coder.pieces(text) for i in coder.piece(piece.encode())]
        want = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), text.encode())]
        assert teller.digests(text) == (len(ids), *want), repr(text)


def test_bpe_frames(spark):
    got = queries.bpe_digests(awkward(spark), *queries.byte_bpe_file())
    texts = collections.Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t in AWKWARD)
    assert collections.Counter(r.decoded_sha256 for r in got.collect()) == texts
    assert queries.bpe_digests(empty(spark), *queries.byte_bpe_file()).count() == 0


# ------------------------------------------------------------------ exact dedup

@pytest.mark.parametrize("bits", [60, 3, 0])
def test_exact_groups_with_chained_hashes(spark, bits):
    """With few hash bits all texts collide; capacity 1 makes the directory double to its end."""
    rng = random.Random(bits)
    rows = [(i, rng.choice(["ab c", "a bc", "abc ", "x", "", None, " \t", "y\x0bz"])) for i in range(60)] + [(None, "abc  "), (3, "x")]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, "doc_id long, text string"), capacity=1, hash_bits=bits).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups["".join(c for c in t or "" if c not in WHITE)].append((-len(t or ""), i if i is not None else 2**63, i))
    want = sorted((str(i), str(min(g)[2]), len(g), hashlib.sha256(n.encode()).hexdigest()) for n, g in groups.items() for _, _, i in g)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want


# ------------------------------------------------------------------ line and substring dedup

def brute_lines(rows):
    seen, out = {}, {}
    for i, t in sorted(((i if i is not None else 2**63 - 1, t) for i, t in set(rows)), key=lambda r: (r[0], r[1] or "")):
        lines = (t or "").split("\n")
        full = [(k, x.strip(WHITE)) for k, x in enumerate(lines) if x.strip(WHITE)]
        gone = set()
        for a in range(len(full) - 2):
            window = tuple(x for _, x in full[a:a + 3])
            if seen.setdefault(window, (i, full[a][0])) != (i, full[a][0]):
                gone |= set(range(full[a][0], full[a + 2][0] + 1))
        out[i, t] = t if t is None else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(["a", " a", "b", "c", "", "d"]) for _ in range(rng.randrange(0, 25)))) for i in range(40)]
    rows += [(100, AWKWARD[0][1]), (101, AWKWARD[0][1]), (102, None), (None, AWKWARD[0][1])]
    want = brute_lines(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.row.doc_id if r.row.doc_id is not None else 2**63 - 1, r.row.text): r.clean_text for r in line_dedup.dedup_lines(df).collect()}
    assert got == want


def test_substring_dedup_keeps_offsets(spark):
    line = "one two three four five six"
    rows = [(2, f"head\n{line}\ntail"), (1, f"{line.upper()}  \nx"), (3, f"{line}\n{line}"), (4, None), (5, "")]
    got = {r.row.doc_id: r for r in substring_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i: r.clean_text for i, r in got.items()} == {1: rows[1][1], 2: "head\ntail", 3: "", 4: None, 5: ""}
    assert [(s.start, s.stop) for s in got[2].spans] == [(5, 6 + len(line))]
    assert [(s.start, s.stop) for s in got[3].spans] == [(0, 2 * len(line) + 1)]
    paragraphs = spark.createDataFrame([(1, f"{line}\n\nx"), (2, f"y\n\n{line}\n\nz")], "doc_id long, text string")
    assert {r.row.doc_id: r.clean_text for r in substring_dedup.dedup_units(paragraphs, "\n\n").collect()} == {1: f"{line}\n\nx", 2: "y\n\nz"}


def test_substring_dedup_removes_short_and_spaceless_lines(spark):
    chinese, url = "重复的一行没有空格" * 20, "https://example.org/" + "a" * 300
    rows = [(1, f"{chinese}\n{url}\nDie tz."), (2, f"own\n{chinese}\n\n{url}\nlast"), (3, "die  TZ."), (4, "\n \n")]
    got = {r.row.doc_id: r.clean_text for r in substring_dedup.dedup_units(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "own\nlast", 3: "", 4: "\n \n"}


def plain_passages(rows, unit_end, least):
    """Text by text, in order of ids: units seen before, in runs of so many words, go."""
    seen, out = set(), {}
    for i, text in sorted((r for r in rows if r[1] is not None), key=lambda r: r[0]):
        kept, run, words, at = [], [], 0, 0
        ends = [m.end() for m in re.finditer(unit_end, text)] + [len(text)]
        for stop in [*ends, None]:
            unit = text[at:stop] if stop is not None else None
            normal = " ".join(unit.split()).lower() if unit is not None else "end"
            if unit is not None and not normal:
                run.append(unit)
            elif unit is not None and normal in seen:
                run.append(unit)
                words += max(len(normal.split()), len(normal) // 8)
            else:
                # white space at both ends of a run stays
                body = "".join(run) if words < least else plain_ends(run)
                kept.append(body)
                run, words = [], 0
                if unit is not None:
                    kept.append(unit)
                    seen.add(normal)
            at = stop if stop is not None else at
        out[i] = "".join(kept)
    return out


def plain_ends(run):
    """The blank units before the first and after the last other unit of a run."""
    full = [k for k, u in enumerate(run) if u.split()]
    return "".join(run[: full[0]] + run[full[-1] + 1 :])


@pytest.mark.parametrize("least", [1, 6, 20])
def test_passages_equal_brute_force(spark, least):
    rng = random.Random(least)
    sentences = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) + " w" * rng.randint(0, 9) + rng.choice(".!?") for _ in range(25)] + ["重复的一行没有空格" * 9]
    rows = []
    for i in range(80):
        parts = [rng.choice(sentences) if rng.random() < 0.8 else f"own {i} {rng.random()}." for _ in range(rng.randint(0, 14))]
        rows.append((i, "".join(p + rng.choice([" ", "\n", "  ", "\n\n", "\t\n"]) for p in parts)))
    rows.append((99, None))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.row.doc_id: r for r in substring_dedup.dedup_units(df, substring_dedup.SENTENCES, run_words=least).collect()}
    assert got[99].clean_text is None
    assert {i: r.clean_text for i, r in got.items() if i != 99} == plain_passages(rows, substring_dedup.SENTENCES, least)
    for i, r in got.items():
        for s in r.spans or []:
            assert r.row.text[s.start:s.stop].strip() and s.size >= least


def test_fused_digests_equal_encode_and_decode(spark):
    path, pattern = queries.byte_bpe_file()
    docs = awkward(spark).union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        "doc_id", "text", "source", *[F.lit(None).alias(c) for c in ("size", "row", "key", "rank", "spans", "kept", "shard")]))
    both = bpe.decode(bpe.encode(docs, path, pattern), path)
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    plain = both.select("row.doc_id", F.size("ids").cast("long"), F.sha2(listed.cast("binary"), 256), F.sha2("decoded", 256))
    fused = bpe.digests(docs, path, pattern).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_dedups_on_awkward_rows(spark):
    for f in (line_dedup.dedup_lines, substring_dedup.dedup_units):
        assert f(awkward(spark)).count() == len(AWKWARD)
        assert f(empty(spark)).count() == 0


# ------------------------------------------------------------------ mixing

def test_mix_reaches_targets(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(0, 30)), rng.choice("aaaaaabbc")) for i in range(9000)] + [(20_000 + i, "x y", None) for i in range(50)] + [(None, None, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, mixing.quality_weights(labels(spark, [(i, i % 2, 0) for i in range(0, 9000, 7)]))).select("row.*", "size", "source_size", "target", "times").collect()
    assert len(got) == len(rows)
    by = collections.defaultdict(list)
    for r in got:
        assert r.size == len((r.text or "").split()) and 0 <= r.times <= 3
        by[r.source].append(r)
    total = sum(r.size for r in got)
    assert math.isclose(sum(v[0].target for v in by.values()), total)
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v) and v[0].target <= 3 * v[0].source_size
        assert abs(sum(r.times * r.size for r in v) - v[0].target) <= 15
        assert len({r.times for r in v if r.size}) <= 2
    assert mixing.mix(empty(spark), mixing.quality_weights(labels(spark))).count() == 0
    assert mixing.mix(awkward(spark), mixing.quality_weights(labels(spark))).count() == len(AWKWARD)


PARAGRAPHS = [f"Paragraph {i} of a page about nothing at all, " + "with many plain words in it, " * 4 + "and an end." for i in range(5)]


@pytest.mark.parametrize("wrapper", [
    '<div class="has-sidebar">%s</div>', '<div class="elementor-widget-container">%s</div>', '<div class="page-header-fixed">%s</div>',
    '<div class="post category-legal">%s</div>', '<form id="aspnetForm">%s<input><label>x</label></form>',
    '<form><div class="has-nav"><div class="sidebar">Few words aside.</div>%s<div class="comments"><p>Nice read.</p></div><form>Sign up.</form></div></form>'])
def test_page_wide_wrappers_keep_their_text(wrapper):
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    page = f'<html><body><nav><a href="/">Home</a></nav>{wrapper % body}<div class="footer">All rights.</div></body></html>'
    assert html_extract.main_text(page) == "\n\n".join(PARAGRAPHS)


def test_suspect_blocks_go_beside_an_article():
    body = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
    for name in ("sidebar", "comments", "related-posts"):
        page = f'<body><article><p>The short article itself.</p></article><div class="{name}">{body}</div></body>'
        assert html_extract.main_text(page) == "The short article itself."
    assert html_extract.main_text(f'<body><p>{PARAGRAPHS[0]}</p><div class="comments">{body}</div></body>') == PARAGRAPHS[0]


def test_pages_empty_and_with_clashing_columns(spark):
    schema = "page_id long, url string, html string, text string, row string, n_chars int"
    assert html_extract.extract(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, "u", "<p>One  two</p>", "t", "r", 3), (1, "u", "<p>One  two</p>", "t", "r", 3), (None, None, None, None, None, None), (2, "v", "<p>" + "long " * 200_000 + "</p>", "", "", 0)]
    got = html_extract.extract(spark.createDataFrame(rows, schema)).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, "u", "One two"), (1, "u", "One two"), (None, None, ""), (2, "v", ("long " * 200_000).strip())], key=str)


# ------------------------------------------------------------------ sharding

def test_ranges_equal_a_walk_row_by_row():
    """The dealt rule itself: rows go clockwise from their arc to the first shard with room, an arc's own rows before those passed on."""
    rng = random.Random(3)
    for _ in range(300):
        shards, arcs = rng.randint(1, 5), rng.randint(1, 12)
        owners = list(range(shards)) + [rng.randrange(shards) for _ in range(arcs)]
        rng.shuffle(owners)
        counts = [rng.choice([0, 0, 1, 2, 5, 40]) for _ in owners]
        room = sharding.capacities(sum(counts), shards, rng.choice([0.0, 0.3]))
        got = {(arc, rank): (shard, slot + rank - first) for arc, first, end, shard, slot in sharding.walk(counts, owners, room) for rank in range(first, end)}
        left, taken, line, want = list(room), [0] * shards, [], {}
        for arc, shard in enumerate(owners + owners):
            line = ([(arc, rank) for rank in range(counts[arc])] if arc < len(counts) else []) + line
            here, line = line[:left[shard]], line[left[shard]:]
            for row in here:
                want[row] = shard, taken[shard]
                taken[shard] += 1
            left[shard] -= len(here)
        assert got == want and not line and len(got) == sum(counts)


def test_sharding_equals_a_sequential_walk(spark):
    rows = [(i, f"text {i % 9}") for i in range(500)] + [(None, None), (1, "text 1"), (1, "text 1")]
    got = sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 7, vnodes=5).collect()
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(got) == len(rows)
    for s in range(7):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(counts[s]))
    # with ample room, rows go to their own arc's shard, and a new shard takes rows only into itself
    before = {(r.doc_id, r.text_crc32): r.shard for r in sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 7, slack=7.0).collect()}
    after = {(r.doc_id, r.text_crc32): r.shard for r in sharding.assign(spark.createDataFrame(rows, "doc_id long, text string"), 8, slack=8.0).collect()}
    moved = {k for k in before if before[k] != after[k]}
    assert moved and all(after[k] == 7 for k in moved)
    assert sharding.assign(empty(spark)).count() == 0


def test_written_shards_hold_every_row(spark, tmp):
    sharding.write_shards(awkward(spark), f"{tmp}/shards", 3)
    back = spark.read.parquet(f"{tmp}/shards")
    assert back.count() == len(AWKWARD) and back.select("shard", "slot").distinct().count() == len(AWKWARD)


# ------------------------------------------------------------------ pages

def test_main_text_of_pages(spark):
    page = ("<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>"
            "<div class='cookie-notice'>We use cookies</div><article><h1>A &amp; B</h1><p>First  <b>bold</b>\ntext.<p>Second<br>line</p>"
            "<aside>side</aside><ul><li>one</li><li>two</li></ul><div id='comments'><p>reader says</p></div><form>mail</form></article>"
            "<div class=sidebar>more</div><script>var t='</p>';</script><footer>&copy; x</footer></body></html>")
    want = "A & B\n\nFirst bold text.\n\nSecond line\n\none\n\ntwo"
    assert html_extract.main_text(page) == want
    body = "".join(f"<p>{'Some words of a paragraph, number ' * 5}{i}.</p>" for i in range(5))
    plain = f"<body><div><a href=1>a</a> <a href=2>b</a></div><div class='content'>{body}</div><div><a href=3>c</a></div></body>"
    assert html_extract.main_text(plain).count("\n\n") == 4 and "a" != html_extract.main_text(plain)[0]
    df = spark.createDataFrame([(1, "u", page, "t"), (2, None, None, "t"), (None, "u", "", "t"), (4, "u", "just text", "t"), (5, "u", "<div>" * 5000 + "deep", "t")], "page_id long, url string, html string, text string")
    got = {r.page_id: r.text for r in html_extract.extract(df).collect()}
    assert got == {1: want, 2: "", None: "", 4: "just text", 5: "deep"}


# ------------------------------------------------------------------ fingerprints

def brute_walk(text, k):
    """Samples of the embedding by a plain walk, for scale k."""
    out, at, step = [], 0, 0
    wanted = sorted({int(x) for level in (k, max(k - 1, fingerprints.LEAST_SCALE)) for x in fingerprints.sample_steps(level)})
    words = fingerprints._steps(wanted[-1] + 2)
    import numpy as np
    mixed = fingerprints._mix(np.array([ord(c) for c in text], np.uint64))
    cls = [min(int(m >> np.uint64(58)), 62) for m in mixed]
    sym = [int((m >> np.uint64(32)) % np.uint64(255)) + 1 for m in mixed]
    seen = {}
    for step in range(wanted[-1] + 1):
        if step in wanted:
            seen[step] = sym[at] if at < len(text) else 0
        if at < len(text) and int(words[step]) >> cls[at] & 1:
            at += 1
    out = [seen[int(x)] for level in (k, max(k - 1, fingerprints.LEAST_SCALE)) for x in fingerprints.sample_steps(level)]
    return f"{k}:" + bytes(out).hex()


def test_fingerprints_equal_a_plain_walk_in_lockstep_and_alone():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abc déf") for _ in range(rng.randrange(1, 300))) for _ in range(400)]
    together = fingerprints.embed(texts)
    assert together == [brute_walk(t, fingerprints.scale(len(t))) for t in texts]
    assert [fingerprints.embed([t])[0] for t in texts[:40]] == together[:40]


def test_likeness_looks_at_the_whole_of_the_longer_text():
    rng = random.Random(8)
    for n in (1100, 1400, 1700, 2000, 2048):
        found = []
        for _ in range(12):
            text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
            changed = fingerprints.edited(text, "".join(rng.choice("ABCDEFG") for _ in range(10)))  # one scale lower
            found.append(fingerprints.likeness(*fingerprints.embed([text, changed])))
        assert 0.4 < sum(found) / len(found) < 0.6, (n, found)
    text = "".join(rng.choice("abcdefghij ") for _ in range(1800))
    other = text[:900] + text[900:].upper()  # one scale
    assert 0.35 < fingerprints.likeness(*fingerprints.embed([text, other])) < 0.65 and fingerprints.likeness(*fingerprints.embed([text, text])) == 1


def test_edited_texts_meet_their_successors(spark):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(0, 400)))) for i in rng.sample(range(1000), 120)] + [(2000, None)]
    got = {r.doc_id: r for r in fingerprints.edit_likeness(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    order = sorted(rows, reverse=True)
    for (i, t), (_, n) in zip(order, order[1:] + order[:1]):
        t, n = t or "", n or ""
        half = len(t) // 2
        changed = t[:len(t) - half] + n[:half]
        assert got[i].edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and got[i].n_chars == len(t)
        assert 0 <= got[i].near_next <= 1 and got[i].near_edited == fingerprints.likeness(got[i].fingerprint, got[i].edited_fingerprint)
    near = [r.near_edited - r.near_next for r in got.values() if r.n_chars > 100]
    assert sum(near) / len(near) > 0.3
    assert fingerprints.edit_likeness(empty(spark)).count() == 0
    assert fingerprints.edit_likeness(awkward(spark)).count() == len(AWKWARD)


def test_near_components_find_near_copies(spark):
    rng = random.Random(6)
    rows = []
    for g in range(12):
        base = "".join(rng.choice("abcdefghij ") for _ in range(600))
        rows += [(10 * g, base), (10 * g + 1, base), (10 * g + 2, base[:-3] + "xyz")]
    prints = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    found = {r.doc_id: r.component_id for r in prints.join(fingerprints.near_components(prints), "fingerprint").collect()}
    assert sum(found[10 * g + 2] == 10 * g for g in range(12)) >= 11 and all(found[i] // 10 == i // 10 for i in found)


def test_near_components_among_strangers_on_one_template(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    template = [rng.integers(1, 30, 128) for _ in range(3)]  # scales 7, 8 and 9

    def stranger():
        out = [t.copy() for t in template]
        for s in out:
            s[92:] = rng.integers(1, 30, 36)  # whole bands are the template's, so the least id is every such bucket's hub
        return out

    def near(of, n):
        out = [s.copy() for s in of]
        for s in out:
            at = np.concatenate([92 + 4 * np.arange(9), rng.permutation([i for i in range(92, 128) if i % 4])])[:n]  # no band beyond the template agrees
            s[at] = (s[at] + rng.integers(1, 28, n)) % 29 + 1
        return out

    def written(scales, k):  # at scale k the text ends halfway if k covers it twice
        high, low = scales[k - 7].copy(), scales[k - 8]
        return f"{k}:" + bytes([int(x) for x in [*high, *low]]).hex()

    made = []
    for g in range(100):
        first = stranger()
        made.append(written(first, 8 + g % 2))
        if g % 2:
            made.append(written(near(first, 20 + g % 8), 8 + g // 2 % 2))
    rng.shuffle(made)
    prints = spark.createDataFrame([(i, f) for i, f in enumerate(made)], "doc_id long, fingerprint string")
    found = {r.class_id: r.component_id for r in fingerprints.near_components(prints).collect()}
    root = list(range(len(made)))
    links = [(i, j) for i in root for j in range(i) if fingerprints.likeness(made[i], made[j]) >= 0.8]
    for _ in root:
        for i, j in links:
            root[i] = root[j] = min(root[i], root[j])
    assert len(links) > 20 and found == dict(enumerate(root))


# ------------------------------------------------------------------ quality

def test_quality_on_held_out_labels(spark):
    d = "/root/testdata/sf0.01"
    docs, known = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = quality.score(docs.select("doc_id", "text"), quality.fit(docs, known)).select("row.doc_id", "score")
    rows = scored.join(known, "doc_id").where(quality.held_out(F.col("doc_id"))).collect()
    good, bad = [r.score for r in rows if r.quality], [r.score for r in rows if not r.quality]
    assert sum(g > b for g in good for b in bad) >= 0.9 * len(good) * len(bad)
    assert sum(g >= 0.3 for g in good) >= 0.95 * len(good)


def test_quality_without_labels(spark):
    model = quality.fit(awkward(spark), labels(spark))
    assert {r.score for r in quality.score(awkward(spark), model).collect()} == {0.5}
    assert quality.score(empty(spark), model).count() == 0
