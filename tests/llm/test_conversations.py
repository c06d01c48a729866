"""Conversation repair against a plain-Python version of the contract."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest

from curation.llm import conversations as conv

SIGN = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    out = {}
    for c, turn, role, text in rows:
        kept = out.setdefault(c, [])
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if h == 0:
            continue
        if h == 1:
            text = ""
        if h == 2:
            text = re.sub("[.!?]", "", text)
        if h == 4:
            role = "user"
        kept += [(turn, role, text)] * (2 if h == 3 else 1)
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def least(rows, faults):
    """(cost, audit, repaired rows): the least of all edits."""
    n = len(rows)

    @lru_cache(None)
    def best(i, prev, inserts):
        found = []
        if i == n and prev in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:  # three in a row cannot be cheapest
            for role, need in (("user", ("", "s", "a")), ("assistant", ("u",))):
                if prev in need and (got := best(i, role[0], inserts + 1)):
                    found.append((3 + got[0], "I" + got[1], (f"{role}:",) + got[2]))
        if i < n:
            _, role, text = rows[i]
            if got := best(i + 1, prev, 0):
                found.append((4 + got[0], "D" + got[1], got[2]))
            if faults[i] in ("", "truncated"):
                extra = 3 * (faults[i] == "truncated")
                after = {"s": ("",), "u": ("", "s", "a"), "a": ("u",)}
                if prev in after.get(role[:1], ()) and (got := best(i + 1, role[:1], 0)):
                    found.append((extra + got[0], "K" + got[1], (f"{role}:{text}",) + got[2]))
                for new in ("user", "assistant"):
                    if prev in after[new[0]] and (got := best(i + 1, new[0], 0)):
                        found.append((3 + extra + got[0], "R" + got[1], (f"{new}:{text}",) + got[2]))
        return min(found) if found else None
    return best(0, "", 0)


def brute(rows):
    out = []
    for c, kept in damaged(rows).items():
        faults, seen = [], set()
        for _, role, text in kept:
            signs = SIGN.findall(text)
            faults.append("blank" if not signs else "duplicate" if (role, text) in seen else
                          "truncated" if signs[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = {t for t, _, _ in kept if t is not None}
        first = [role[:1] for _, role, _ in kept]
        cost, audit, fixed = least(kept, faults)
        out.append((c, max(turns) - min(turns) + 1 - len(turns) if turns else 0,
                    *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:])),
                    cost, audit, hashlib.sha256("\n".join(fixed).encode()).hexdigest()))
    return sorted(out, key=str)


def table(seed, n, longest=9):
    rnd = random.Random(seed)
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", None, "up", "Émile"]
    texts = ["Yes.", "No!", "why?", "so", "", " \t\n", None, "...", "x. \x0b", "é", "😀"] + [f"line {i}." for i in range(30)]
    rows = []
    for c in range(n):
        for t in range(rnd.randint(1, longest)):
            turn = rnd.choice([t, t, t, t, 0, 2 * t, None])
            rows.append((c, turn, rnd.choice(roles), rnd.choice(texts)))
    rows += [(None, t, "user", "Hi.") for t in (None, 1, 1, 2)] + rows[:5]
    rows += [(10_000, t, "user" if t % 2 == 0 else "assistant", f"turn {t}.") for t in range(120)]
    rows += [(10_001, None, rnd.choice(roles), rnd.choice(texts)) for _ in range(60)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "own") for r in rows], "conv_id long, turn long, role string, text string, "
                                                                 "cost long, audit string").repartition(5)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_repair(spark):
    rows = table(1, 400)
    df = frame(spark, rows)
    want = brute(rows)
    assert got(conv.repair(conv.damage(df))) == want
    # every conversation of more than three rows goes the way of long ones
    assert got(conv.repair(conv.damage(df), long_rows=3)) == want
    assert conv.repair(conv.damage(df.limit(0))).count() == 0


def test_nothing_left(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:5".encode()) % 20 == 0)
    rows = [(gone, 5, "user", "Hi.")] * 6
    want = [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
    assert brute(rows) == want
    for most in (100, 2):
        assert got(conv.repair(conv.damage(frame(spark, rows)), long_rows=most)) == want


@pytest.mark.parametrize("cut", [1, 2, 7, 64])
def test_cuts_give_the_same_audit(cut):
    rnd = random.Random(cut)
    steps = conv.Steps()
    for _ in range(150):
        codes = bytes(rnd.choice([0, 1, 2, 1, 2, 1, 2, 3]) + 4 * rnd.choice([0, 0, 0, 1, 2, 3]) for _ in range(rnd.randint(0, 40)))
        rows = [(i, ("system", "user", "assistant", "x")[c & 3], str(i)) for i, c in enumerate(codes)]
        want = least(rows, [("", "truncated", "blank", "duplicate")[c >> 2] for c in codes])
        for most in (cut, 1000):
            cost, audit = conv.audits(steps, [codes], most)[0]
            assert (cost, audit.decode()) == want[:2]


def test_long_sequences():
    steps = conv.Steps()
    rnd = random.Random(2)
    codes = bytes(rnd.choice([1, 2, 3, 0]) + 4 * rnd.choice([0, 0, 1, 2]) for _ in range(200_000))
    assert conv.audits(steps, [codes], 1 << 14) == conv.audits(steps, [codes], 1 << 20)
    assert len(steps.costs) < 500
