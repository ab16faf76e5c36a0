"""Conversation repair against a search over all edits, on odd tables and with conversations cut into segments."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import cache

import pytest

from folioforge.llm import turns

BLANKS = " \t\n\x0b\x0c\r"


def damage(rows):
    space = lambda x: " " if x is None else str(x)
    out = []
    for conv_id, turn, role, text in rows:
        lot = zlib.crc32(f"{space(conv_id)}:{space(turn)}".encode()) % 20
        role, text = space(role), space(text)
        text = "" if lot == 1 else "".join(c for c in text if c not in ".!?") if lot == 2 else text
        out += [(conv_id, turn, "user" if lot == 4 else role, text)] * {0: 0, 3: 2}.get(lot, 1)
    return out


def repaired(rows):
    """(faults, cost, audit, lines) by a search from the end; rows are (role, text) in order."""
    faults, seen = [], set()
    for role, text in rows:
        words = text.strip(BLANKS)
        faults.append("blank" if not words else "duplicate" if (role, text) in seen else None if words[-1] in ".!?" else "truncated")
        seen.add((role, text))
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @cache
    def best(i, state, inserts):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        for made in "ua":
            if inserts < 3 and (state, made) in step:
                cost, audit, lines = best(i, step[state, made], inserts + 1)
                ways.append((cost + 5, "I" + audit, ({"u": "user:", "a": "assistant:"}[made], *lines)))
        if i < len(rows):
            cost, audit, lines = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit, lines))
            role, text = rows[i]
            if faults[i] not in ("blank", "duplicate"):
                for letter, new, more in (("K", role, 0), ("R", "user", 1), ("R", "assistant", 1)):
                    if (state, new[:1]) in step:
                        cost, audit, lines = best(i + 1, step[state, new[:1]], 0)
                        ways.append((cost + more + (5 if faults[i] else 0), letter + audit, (f"{new}:{text}", *lines)))
        return min(ways, default=(10**9, "", ()))

    cost, audit, lines = best(0, "", 0)
    return faults, cost, audit, "\n".join(lines)


def report(rows):
    want = []
    after = damage(rows)
    for conv_id in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv_id), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        numbers = [r[1] for r in own if r[1] is not None]
        faults, cost, audit, text = repaired([r[2:] for r in own])
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:], strict=False))
        want.append((conv_id, max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, faults.count("blank"),
                     faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(want, key=str)


def rows_of(seed):
    rng = random.Random(seed)
    texts = ["Yes.", "Why?", "no end", "", " \t", "Good!  ", "é.\n", "half", "x." * 400, "Yes."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "$", None]
    rows = []
    for conv_id in [*range(60), None]:
        for turn in range(rng.randint(1, 9)):
            rows.append((conv_id, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles[: rng.choice([2, 5, 9])]), rng.choice([*texts, None, f"own {turn}."])))
    # Rows of one turn that differ are put in order by a hash; the search here doesn't know it.
    unique = {}
    for row in rows:
        unique.setdefault(row[:2] if row[1] is not None else (row[0], None), row)
    rows = list(unique.values())
    return [*rows, rows[0], rows[0], rows[7]]


def got_of(spark, rows):
    frame = spark.createDataFrame([(*r, "x", 1, True) for r in rows],
                                  "conv_id long, turn long, role string, text string, audit string, place int, before boolean").repartition(3)
    return sorted(map(tuple, turns.repair_report(frame, turns.damaged(frame)).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repairs_equal_a_search_over_all_edits(spark, seed):
    rows = rows_of(seed)
    assert got_of(spark, rows) == report(rows)


def test_long_conversations_in_segments_are_repaired_alike(spark, monkeypatch):
    monkeypatch.setattr(turns, "SEGMENT_ROWS", 7)
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No?", f"own {t}.", "open", ""]))
            for c in (1, 2, None) for t in range(60)]
    rows += [(3, t, "user", "Same.") for t in range(40)] + [(4, 5, "user", "Same.")] * 30 + [(5, 0, "user", "A."), (5, 1, "assistant", "B.")]
    assert got_of(spark, rows) == report(rows)


def test_merged_stacks_lose_nothing():
    """Every way to split a conversation in two gives the same repair."""
    rng = random.Random(7)
    for _ in range(200):
        marked = [(rng.choice("uuaas"), rng.choice([None, None, "truncated", "blank"])) for _ in range(rng.randint(0, 7))]
        want = turns.finished(turns.parses(marked))
        text = {None: "x.", "truncated": "x", "blank": ""}
        rows = [({"u": "user", "a": "assistant", "s": "system"}[i], f"{n}{text[f]}" if f != "blank" else "") for n, (i, f) in enumerate(marked)]
        assert want == repaired(rows)[1:3]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turns.repair_report(empty, turns.damaged(empty)).collect() == []
    # crc32("0:6") % 20 is 0: nothing is left of this conversation.
    gone = next(t for t in range(100) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(0, gone, "user", "Hi.")], empty.schema)
    assert [tuple(r) for r in turns.repair_report(frame, turns.damaged(frame)).collect()] == [
        (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]
