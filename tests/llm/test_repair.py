import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from lumenframe.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
WORDY = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    out = []
    sp = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{sp(conv)}:{sp(turn)}".encode()) % 20
        role, text = sp(role), sp(text)
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))


def faults_of(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        found = WORDY.findall(text)
        out.append("blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(initials, faults):
    """All edit sequences by dynamic programming over roles so far: (cost, audit, roles)."""
    moves = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @lru_cache(None)
    def best(i, q, inserts):
        options = []
        if i == len(initials):
            if q in ("", "a"):
                options.append((0, ""))
        else:
            extra = faults[i] == "truncated"
            options.append(cons(3, "D", best(i + 1, q, 0)))
            if faults[i] not in ("blank", "duplicate"):
                if (q, initials[i]) in moves:
                    options.append(cons(extra, "K", best(i + 1, moves[q, initials[i]], 0)))
                options += [cons(2 + extra, "R", best(i + 1, moves[q, r], 0)) for r in "ua" if (q, r) in moves]
        if inserts < 4:
            options += [cons(2, "I", best(i, moves[q, r], inserts + 1)) for r in "ua" if (q, r) in moves]
        return min((o for o in options if o), default=None)

    def cons(cost, edit, rest):
        return rest and (cost + rest[0], edit + rest[1])

    return best(0, "", 0)


def applied(rows, audit):
    out, at = [], iter(rows)
    for edit in audit:
        row = None if edit == "I" else next(at)
        if edit == "D":
            continue
        need = "a" if out and out[-1][0][:1] == "u" else "u"
        role = row[2] if edit == "K" else {"u": "user", "a": "assistant"}[need]
        out.append((role, "" if edit == "I" else row[3]))
    return out


def brute(rows):
    by = {r[0]: [] for r in rows}
    for r in damaged(rows):
        by[r[0]].append(r)
    want = {}
    for conv, part in by.items():
        part = in_order(part)
        faults = faults_of(part)
        initials = [r[2][:1] for r in part]
        turns = [r[1] for r in part if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit = cheapest(tuple(initials), tuple(faults))
        fixed = applied(part, audit)
        assert LEGAL.match("".join(r[:1] for r, _ in fixed))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in fixed).encode()).hexdigest()
        want[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha)
    return want


def conversations(n=120, seed=1):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 14)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None, "a\nb", "üser"])
            if rng.random() < 0.6:
                role = "user" if t % 2 == 0 else "assistant"
            text = rng.choice(["Yes.", "No!", "cut", "a b? ", " \t", "", None, "é🙂", "end.\n", "Yes."])
            text = text and rng.random() < 0.5 and f"{text} {t}." or text
            turn = rng.choice([t, t, t, t + 5, None]) if c % 4 == 0 else t
            rows.append((c, turn, role, text) if c else (None, turn, role, text))
    return rows


def collected(spark, rows, block=4096, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    got = repair.repair_damaged(df.repartition(3), block=block).collect()
    assert len(got) == len({r.conv_id for r in got})
    return {r.conv_id: tuple(r)[1:] for r in got}


@pytest.mark.parametrize("block", [4096, 3, 1])
def test_repairs_equal_brute_force(spark, block):
    rows = conversations(seed=block)
    rows += [(500, 3, "user", "Hi."), (500, 3, "user", "Hi."), (500, 3, "user", "Hi.")]
    rows += [(501, t, "assistant", f"turn {t}." if t % 3 else "") for t in range(40)]
    rows += [(502 + k, 0, "user", "x.") for k in range(60)]
    want = brute(rows)
    assert collected(spark, rows, block, ("conv", "key", "rn", "block", "fault", "audit", "copy", "k")) == want
    assert {len(w[6]) == 0 for w in want.values()} == {True, False}
    assert set("".join(w[6] for w in want.values())) == set("DIKR")


def test_lightest_equals_every_sequence():
    rng = random.Random(7)
    for _ in range(400):
        n = rng.randrange(0, 7)
        rows = [(rng.choice("suatx "), rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(n)]
        got = repair.lightest(rows, repair.TAILS, (0,))[0]
        assert got == cheapest(tuple(r[0] for r in rows), tuple(r[1] for r in rows))


def test_long_conversation_in_blocks(spark):
    rng = random.Random(9)
    rows = [(1, t, rng.choice(["user", "assistant", "tool"]), f"text {rng.randrange(900)}.") for t in range(3000)]
    rows += [(2, 0, "user", "short.")]
    blocks = collected(spark, rows, 64)
    assert blocks == collected(spark, rows)
    turns = repair.repair(repair.damage(spark.createDataFrame(rows, SCHEMA)), 64)[1]
    roles = [r.role[:1] for r in turns.where("key = '=1'").orderBy("block", "place").collect()]
    assert LEGAL.match("".join(roles)) and len(roles) > 1000


def test_weights_are_monotone_and_superior():
    """What the agenda rests on: a deduction never gives less than its parts, and keeps their order."""
    rng = random.Random(2)
    rows = [w for f in ("", "blank", "truncated") for w in repair.edits("u", f).values()] + [(2, 0, "I")]
    for _ in range(500):
        n = rng.randrange(1, 6)
        rests = [(rng.randrange(9), n, "".join(rng.choice("DIKR") for _ in range(6)) + "K") for _ in range(2)]
        a = rng.choice(rows)
        x, y = (repair._plus(a, r) for r in sorted(rests))
        assert x <= y and x >= min(rests) and x[:2] >= a[:2]


def test_empty_table(spark):
    got = repair.repair_damaged(spark.createDataFrame([], SCHEMA))
    assert got.collect() == [] and got.columns[0] == "conv_id"
