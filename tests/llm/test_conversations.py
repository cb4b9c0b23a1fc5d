"""Conversation repair against every sequence of edits."""

import hashlib
import itertools
import random
import re
import zlib

from tessera.llm import conversations

WHITE = " \t\n\x0b\f\r"
SCHEMA = "conv_id long, turn long, role string, text string, gone int, again string, digest string, place int"


def frame(spark, rows):
    """Turns and columns that are called like what the operator adds."""
    return spark.createDataFrame([(*r, 1, "x", "y", 2) for r in rows], SCHEMA)


def plain_damage(rows):
    out, seen = [], {}
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        seen.setdefault(conv, [])
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        seen[conv] += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    for conv, turns in seen.items():
        out.append((conv, sorted(turns, key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))))
    return out


def plain_repair(turns):
    """All audits: each row kept, given a role or deleted, with an inserted row or none at every place."""
    faults, seen = [], set()
    for _, role, text in turns:
        bare = text.rstrip(WHITE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    gaps = [[(), ("u",), ("a",)]] * (len(turns) + 1)
    own = [["D"] if f in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for f in faults]
    for edits in itertools.product(*own):
        for inserted in itertools.product(*gaps):
            cost, audit, roles = 0, "", []
            for i in range(len(turns) + 1):
                for x in inserted[i]:
                    cost, audit, roles = cost + 5, audit + "I", roles + [(x, {"u": "user", "a": "assistant"}[x], "")]
                if i < len(turns):
                    e = edits[i]
                    cost += {"K": 0, "D": 2}.get(e, 1) + (5 if faults[i] == "truncated" and e != "D" else 0)
                    audit += e[0]
                    if e == "K":
                        roles.append((turns[i][1][:1], turns[i][1], turns[i][2]))
                    elif e != "D":
                        roles.append((e[1], {"u": "user", "a": "assistant"}[e[1]], turns[i][2]))
            if best is not None and (cost, audit) >= best[:2]:
                continue
            if all(len(r[0]) == 1 for r in roles) and re.fullmatch("(s?(ua)+)?", "".join(r[0] for r in roles)):
                best = cost, audit, "\n".join(f"{r}:{t}" for _, r, t in roles)
    known = [t for t, _, _ in turns if t is not None]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, best[0], best[1],
            hashlib.sha256(best[2].encode()).hexdigest())


def some_rows(rng, convs, most):
    rows = []
    for conv in convs:
        for turn in range(rng.randint(1, most)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            text = rng.choice(["Hi.", "Hi.", "Well", "Yes!\n", "", " \t", None, "a\nb?", "🙂"])
            rows.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return rows


def test_repair_equals_all_edits(spark):
    rng = random.Random(3)
    rows = some_rows(rng, [None, *range(150)], 3)
    got = {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damage(frame(spark, rows)), gone="gone").collect()}
    want = {conv: plain_repair(turns) for conv, turns in plain_damage(rows)}
    assert got == want
    assert {"K", "R", "D"} <= set("".join(w[6] for w in want.values())) and "" in {w[6] for w in want.values()}


def test_dear_deletions_lead_to_insertions(monkeypatch):
    """With the contract's costs no insertion pays; with dearer deletions it does."""
    monkeypatch.setattr(conversations, "DELETE", 9)
    monkeypatch.setattr(conversations, "REROLE", 9)
    repair = conversations.Repair()
    out = [*repair.add(0, "system", "Be brief.", False), *repair.add(1, "assistant", "Yes.", False), *repair.end()]
    assert out == [("K", "system", "Be brief."), ("I", "user", ""), ("K", "assistant", "Yes.")]
    assert repair.summary()[-2:] == (5, "KIK")


def test_blocks_do_not_matter(monkeypatch):
    """Decided prefixes of long conversations, with blocks of any size, give one whole agenda's repair."""
    rng = random.Random(4)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["Hi.", "Well", ""]) + str(i), False) for i in range(rng.randint(0, 60))]
        results = set()
        for block in (1, 2, 7, 10_000):
            monkeypatch.setattr(conversations, "BLOCK", block)
            repair, out = conversations.Repair(), []
            for i, (role, text, again) in enumerate(rows):
                out += repair.add(i, role, text, again)
            out += repair.end()
            results.add((repair.summary(), tuple(out)))
        assert len(results) == 1


def test_long_conversation_streams(spark):
    """A conversation that holds most rows, and a very long text."""
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Line {i}.") for i in range(5_000)] + [(2, 0, "user", "word " * 200_000 + "."), (2, 1, "assistant", "Yes.")]
    plain = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in conversations.repair(plain).collect()}
    assert (got[1].cost, got[1].audit, got[2].audit) == (0, "K" * 5_000, "KK")
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for _, _, r, t in rows[:5_000]).encode()).hexdigest()
    out = conversations.repaired_rows(plain).where("conv_id = 1").collect()
    assert sorted((r.place, r.role, r.text, r.edit) for r in out) == [(i, r, t, "K") for _, i, r, t in rows[:5_000]]


def test_repair_of_nothing(spark):
    assert conversations.repair(frame(spark, [])).count() == 0
    assert conversations.repaired_rows(frame(spark, [])).count() == 0
    gone = spark.createDataFrame([(7, 1, "user", "Hi.", True)], "conv_id long, turn long, role string, text string, gone boolean")
    row = conversations.repair(gone, gone="gone").first()
    assert tuple(row) == (7, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
