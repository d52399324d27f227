"""Repair of conversations against all edits, and against the rule step by step."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from chartspark.llm import conversations as module
from chartspark.llm.conversations import as_they_are, cheapest, damaged, repair_report, repaired, repaired_rows

WANTED = re.compile(r"(s?(ua)+)?")


def every_edit(rows):
    """(cost, letters) of all edits with up to two new rows in a gap, by trying them."""
    best = None
    gaps = [g for n in range(3) for g in itertools.product("ua", repeat=n)]
    choices = []
    for initial, goes, cut in rows:
        one = [("D", "", 3)]
        if not goes:
            one += [("K", initial or "?", cut), ("R", "u", 2 + cut), ("R", "a", 2 + cut)]
        choices.append(one)
    for edits in itertools.product(*choices):
        for new in itertools.product(gaps, repeat=len(rows) + 1):
            roles = letters = ""
            cost = 0
            for i, gap in enumerate(new):
                roles += "".join(gap)
                letters += "I" * len(gap)
                cost += 2 * len(gap)
                if i < len(rows):
                    letter, role, price = edits[i]
                    roles, letters, cost = roles + role, letters + letter, cost + price
            if WANTED.fullmatch(roles) and (best is None or (cost, letters) < best):
                best = cost, letters
    return best


@pytest.mark.parametrize("seed", range(40))
def test_cheapest_of_all_edits(seed):
    pick = random.Random(seed)
    rows = [(pick.choice(["s", "u", "a", "u", "a", "x", "", " "]), pick.random() < 0.2, pick.random() < 0.3) for _ in range(pick.randrange(4))]
    assert cheapest(rows) == every_edit(rows)


def by_frontier(rows):
    """Least cost by plain numbers from behind, then the least letter at each place from the front."""
    n, far = len(rows), 10**9
    after = [[far] * 4 for _ in range(n + 1)]

    def moves(i, state):
        if i < n:
            initial, goes, cut = rows[i]
            yield "D", 3, i + 1, state
            for (s, w), t in module.STEPS.items():
                if s == state and not goes:
                    if initial == w:
                        yield "K", int(cut), i + 1, t
                    if w in "ua":
                        yield "R", 2 + int(cut), i + 1, t
        for (s, w), t in module.STEPS.items():
            if s == state and w in "ua":
                yield "I", 2, i, t

    after[n][0] = after[n][3] = 0
    for i in range(n, -1, -1):
        for _ in range(4):
            for state in range(4):
                after[i][state] = min([after[i][state], *(c + after[j][t] for _, c, j, t in moves(i, state))])
    cost, letters, front = after[0][0], "", {(0, 0)}
    left = cost
    spent = {(0, 0): 0}
    while True:
        if any(i == n and s in (0, 3) and spent[i, s] == cost for i, s in front):
            return cost, letters
        steps = [(letter, j, t, spent[i, s] + c) for i, s in front for letter, c, j, t in moves(i, s) if spent[i, s] + c + after[j][t] == cost]
        least = min(x[0] for x in steps)
        letters += least
        front = {(j, t) for letter, j, t, _ in steps if letter == least}
        spent = {(j, t): c for letter, j, t, c in steps if letter == least}


@pytest.mark.parametrize("seed", range(30))
def test_longer_conversations(seed):
    pick = random.Random(seed)
    rows = [(pick.choice("suauaxua"), pick.random() < 0.15, pick.random() < 0.2) for _ in range(pick.randrange(4, 120))]
    assert cheapest(rows) == by_frontier(rows)


def test_long_conversation():
    cost, letters = cheapest([("u", False, False)] * 3000)
    assert cost == 3000 and letters.count("R") + letters.count("I") == 1500
    assert cheapest([]) == (0, "")


def spoil(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        how = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if how == 0:
            continue
        text = "" if how == 1 else re.sub("[.!?]", "", text) if how == 2 else text
        role = "user" if how == 4 else role
        out += [(conv, turn, role, text)] * (2 if how == 3 else 1)
    return out


def plain(rows, spoilt):
    """One conversation after the other; equal turns by role and text's hash, as the operator has them."""
    out = []
    for conv in {r[0] for r in rows}:
        mine = [r for r in spoilt if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.md5(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()))
        seen, steps, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, _, role, text in mine:
            ink = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            steps.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {r[1] for r in mine} - {None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in itertools.pairwise(steps))
        cost, letters = by_frontier(steps)
        said = "\n".join(f"{r}:{t}" for r, t in repaired([r[2:] for r in mine], letters))
        out.append((conv, gaps, *n.values(), illegal, cost, letters, hashlib.sha256(said.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(seed):
    pick = random.Random(seed)
    texts = ["Yes.", "No", "a. b ", "What?\n", "", " \t", None, "x ", "é!", "Yes.", "long " * 5000]
    return [
        (pick.choice([None, *range(60)]), pick.choice([None, 1, 2, 3, 4, 7, 900]), pick.choice(["user", "assistant", "system", "tool", "", None, "User"]), pick.choice(texts))
        for _ in range(500)
    ]


COLUMNS = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


@pytest.mark.parametrize("seed", range(2))
def test_conversations_are_repaired(spark, seed):
    rows = conversations(seed)
    frame = spark.createDataFrame([(*r, 1, "z") for r in rows], "conv_id long, turn long, role string, text string, conv int, audit string")
    spoilt = damaged(frame, "conv_id", "turn", "role", "text")
    got = sorted((tuple(r[c] for c in COLUMNS) for r in repair_report(spoilt).collect()), key=repr)
    assert got == plain(rows, spoil(rows))
    undamaged = as_they_are(frame, "conv_id", "turn", "role", "text")
    kept = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    got = sorted((tuple(r[c] for c in COLUMNS) for r in repair_report(undamaged).collect()), key=repr)
    assert got == plain(rows, kept)


def test_repaired_rows(spark):
    rows = conversations(5)
    frame = damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    said = {}
    for r in sorted(repaired_rows(frame).collect(), key=lambda r: (repr(r.conv), r.place)):
        said.setdefault(r.conv, []).append((r.place, r.role, r.text))
    for r in repair_report(frame).collect():
        mine = said.get(r.conv, [])
        assert [p for p, _, _ in mine] == list(range(len(mine)))
        assert WANTED.fullmatch("".join(role[0] for _, role, _ in mine))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for _, a, b in mine).encode()).hexdigest() == r.repaired_sha256


def test_no_conversations(spark):
    empty = damaged(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    assert repair_report(empty).collect() == [] and repaired_rows(empty).collect() == []


def test_a_conversation_of_which_no_row_stays(spark):
    gone = [(c, t) for c in range(300) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    frame = spark.createDataFrame([(c, t, "user", "Yes.") for c, t in gone], "conv_id long, turn long, role string, text string")
    rows = repair_report(damaged(frame, "conv_id", "turn", "role", "text")).collect()
    assert [tuple(r)[1:] for r in rows] == [(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())] * len(gone)
