"""Repairs against an exhaustive search over edits, long conversations across blocks, odd rows."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salestide.llm import conversation_repair, edit_path

SCHEMA = "conv_id long, turn long, role string, text string"


def cheapest(codes: bytes) -> tuple[int, str]:
    """Least (cost, edits) by trying all edits."""
    best = (2 * len(codes), "D" * len(codes))

    def legal(made: str) -> bool:
        return re.fullmatch("s?(ua)*u?", made) is not None

    def search(at: int, made: str, cost: int, edits: str) -> None:
        nonlocal best
        if cost > best[0] or len(made) > 2 * len(codes) + 3:
            return
        if at == len(codes) and re.fullmatch("(s?(ua)+)?", made):
            best = min(best, (cost, edits))
        for new in "ua":
            if legal(made + new):
                search(at, made + new, cost + 5, edits + "I")
        if at == len(codes):
            return
        search(at + 1, made, cost + 2, edits + "D")
        if codes[at] & edit_path.MUST_GO:
            return
        stay = 5 if codes[at] & edit_path.CUT else 0
        kept = made + "sua?"[codes[at] & 3]
        if legal(kept):
            search(at + 1, kept, cost + stay, edits + "K")
        for new in "ua":
            if legal(made + new):
                search(at + 1, made + new, cost + stay + 1, edits + "R")

    search(0, "", 0, "")
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from([0, 1, 2, 3, 4, 5, 6, 9]), max_size=6), st.integers(0, 6))
def test_walk_is_the_cheapest_and_least(codes, cut):
    codes = bytes(codes)
    edits, state, cost = edit_path.walk(codes, edit_path.START, edit_path.END)
    assert (cost, edits + edit_path.closing(state)) == cheapest(codes)
    head, tail = codes[:cut], codes[cut:]
    middle = edit_path.through(edit_path.cross(tail), edit_path.END)
    first, state, whole = edit_path.walk(head, edit_path.START, middle)
    second, state, _ = edit_path.walk(tail, state, edit_path.END)
    assert whole == cost and first + second == edits


def by_hand(rows: list[tuple]) -> tuple:
    """The contract's columns of one damaged conversation, in one loop."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, codes, counts, pairs = set(), [], [0, 0, 0], 0
    for turn, role, text in rows:
        shown = text.strip(" \t\n\x0b\x0c\r")
        code = "sua".find(role[:1]) if role else -1
        code = 3 if code < 0 else code
        if not shown:
            counts[0] += 1
            code |= edit_path.MUST_GO
        elif (role, text) in seen:
            counts[1] += 1
            code |= edit_path.MUST_GO
        elif shown[-1] not in ".!?":
            counts[2] += 1
            code |= edit_path.CUT
        seen.add((role, text))
        codes.append(code)
    pairs = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    edits, state, cost = edit_path.walk(bytes(codes), edit_path.START, edit_path.END)
    edits += edit_path.closing(state)
    kept = edit_path.apply(edits, [(c, r, t) for c, (_, r, t) in zip(codes, rows)], edit_path.START)
    body = "\n".join(f"{r}:{t}" for r, t in kept)
    return gaps, *counts, pairs, int(cost), edits, hashlib.sha256(body.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def undamaged(df):
    return df.selectExpr("conv_id", "turn", "coalesce(role, ' ') role", "coalesce(text, ' ') text", "false dropped")


@pytest.mark.parametrize("block", [{"block_turns": 3}, {"block_bytes": 200}, {}])
def test_conversations_across_blocks_and_partitions(spark, block):
    """One conversation holds a third of the rows, and one identical row is a tenth of all."""
    rng = random.Random(5)
    rows = [(1, t, rng.choice(["user", "assistant", "system", "tool", ""]), rng.choice(["a.", "b", "  ", f"c{t}!", f"d{t}"])) for t in range(300)]
    rows += [(2, 7, "user", "same.")] * 90
    rows += [(c, rng.choice([None, 0, 1, 2, 3, 9]), rng.choice(["user", "assistant", "system"]), rng.choice(["x.", "", "y"])) for c in range(3, 120) for _ in range(4)]
    rows += [(None, 1, "user", "q."), (None, None, "assistant", "r.")]
    rng.shuffle(rows)
    repaired = conversation_repair.repair(undamaged(frame(spark, rows).repartition(7)), **block)
    got = {r[0]: tuple(r[1:]) for r in conversation_repair.audit(repaired).collect()}
    assert got == {c: by_hand([r[1:] for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    lines: dict = {}
    for r in sorted(conversation_repair.turns(repaired).collect(), key=lambda r: (r.block, r.place)):
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conversation, found in got.items():
        assert hashlib.sha256("\n".join(lines.get(conversation, [])).encode()).hexdigest() == found[-1]


def test_damage_and_odd_rows(spark):
    import zlib

    rows = [(c, t, r, x) for c in (1, None) for t in (*range(25), None) for r, x in [("user", "Hi. You? Yes!"), (None, None)]]
    got = sorted(map(tuple, conversation_repair.damage(frame(spark, rows)).collect()), key=repr)
    expected = []
    for c, t, r, x in rows:
        fault = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        x = "" if fault == 1 else re.sub("[.!?]", "", x) if fault == 2 else x
        expected += [(c, t, "user" if fault == 4 else r, x, fault == 0)] * (2 if fault == 3 else 1)
    assert got == sorted(expected, key=repr)


def test_dropped_conversations_and_empty_tables(spark):
    empty = frame(spark, [])
    damaged = conversation_repair.damage(empty)
    assert conversation_repair.audit(conversation_repair.repair(damaged)).count() == 0
    gone = frame(spark, [(5, 1, "user", "a."), (6, 1, "user", "b."), (6, 2, "assistant", "c.")]).selectExpr("*", "conv_id = 5 dropped")
    got = {r.conv_id: r for r in conversation_repair.audit(conversation_repair.repair(gone)).collect()}
    assert tuple(got[5])[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got[6].audit == "KK" and got[6].cost == 0


def test_very_long_turns_and_clashing_columns(spark):
    rows = [(1, 0, "user", "é" * 2_000_000 + "."), (1, 1, "assistant", "ok."), (1, 2, "user", "x " * 1_000_000)]
    df = undamaged(frame(spark, rows)).selectExpr("*", "1 part", "2 number", "3 codes", "4 edits", "5 kind", "6 row", "7 last", "8 tie")
    got = conversation_repair.audit(conversation_repair.repair(df)).collect()
    assert [tuple(r[1:]) for r in got] == [by_hand([r[1:] for r in rows])]
