"""Cheapest edits that give the turns of a conversation legal roles.

Legal are no turn at all, or an optional system turn and then user and assistant in alternation, ending with the
assistant. A state says which turn was last; a vector holds, for each state, the least cost of what is still to come.
Vectors are computed backwards and kept at checkpoints only, a square root of the turns apart; the walk forward
recomputes one block of vectors at a time and takes, of the edits that are tight, the one with the least letter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from math import inf, isqrt

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Fixed costs of the edits: delete, insert, rerole; and of a truncated turn that stays.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# A turn's code: its initial (0 system, 1 user, 2 assistant, 3 other), and what is wrong with it.
CUT, MUST_GO = 4, 8

Vector = tuple[float, float, float, float]

#: The turn that may be inserted, or made by a new role, in each state; it names the next state as well.
TURN = (USER, USER, ASSISTANT, USER)
#: The state that a turn of initial system, user, assistant, other leads to; None where it is not legal.
KEPT = ((SYSTEM, USER, None, None), (None, USER, None, None), (None, None, ASSISTANT, None), (None, USER, None, None))


def _with_inserts(start: float, system: float, user: float, assistant: float) -> Vector:
    first = min(user, INSERT + assistant)
    return min(start, INSERT + first), min(system, INSERT + first), first, min(assistant, INSERT + user)


#: At the end of a conversation.
END = _with_inserts(0, inf, inf, 0)
#: Ends in one state each: what comes after them is added later.
UNITS = tuple(tuple(0 if state == at else inf for state in range(4)) for at in range(4))


@lru_cache(maxsize=1 << 16)
def _before(code: int, after: Vector) -> Vector:
    costs = []
    for state in range(4):
        least = DELETE + after[state]
        if not code & MUST_GO:
            stay = TRUNCATED if code & CUT else 0
            least = min(least, stay + REROLE + after[TURN[state]])
            to = KEPT[state][code & 3]
            if to is not None:
                least = min(least, stay + after[to])
        costs.append(least)
    return _with_inserts(*costs)


def before(code: int, after: Vector) -> Vector:
    """The vector before a turn, given the one after it. Vectors that differ by a constant share the work."""
    least = min(after)
    return tuple(x + least for x in _before(code, tuple(x - least for x in after)))


def cross(codes: bytes) -> list[float]:
    """Least cost of leading each state through ``codes`` to each state at their end, row by row."""
    ends = list(UNITS)
    for code in reversed(codes):
        ends = [before(code, vector) for vector in ends]
    return [ends[to][state] for state in range(4) for to in range(4)]


def through(matrix: list[float], after: Vector) -> Vector:
    """The vector before a block, given its ``cross`` and the vector after it."""
    return tuple(min(matrix[4 * state + to] + after[to] for to in range(4)) for state in range(4))


def walk(codes: bytes, state: int, end: Vector) -> tuple[str, int, float]:
    """The least tight edits of ``codes`` from ``state`` on, the state they end in, and their cost with what follows.

    ``end`` is the vector after the last code. Edits are D(elete), I(nsert), K(eep), R(erole).
    """
    total, width = len(codes), isqrt(len(codes)) + 1
    checkpoints, vector = {total: end}, end
    for at in range(total - 1, -1, -1):
        vector = before(codes[at], vector)
        if at % width == 0:
            checkpoints[at] = vector
    cost, edits = vector[state], []
    for start in range(0, total, width):
        stop = min(start + width, total)
        block = [checkpoints[stop]]
        for at in range(stop - 1, start - 1, -1):
            block.append(before(codes[at], block[-1]))
        block.reverse()
        for at in range(start, stop):
            code, now, after = codes[at], block[at - start], block[at - start + 1]
            stay = TRUNCATED if code & CUT else 0
            while True:
                to = KEPT[state][code & 3]
                if DELETE + after[state] == now[state]:
                    edits.append("D")
                    break
                if INSERT + now[TURN[state]] == now[state]:
                    edits.append("I")
                    state = TURN[state]
                    continue
                if to is not None and stay + after[to] == now[state]:
                    edits.append("K")
                    state = to
                else:
                    edits.append("R")
                    state = TURN[state]
                break
    return "".join(edits), state, cost


def closing(state: int) -> str:
    """The inserts that complete a conversation that stands in ``state``."""
    return {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}[state]


def apply(edits: str, turns: Iterable[tuple[int, str | None, str | None]], state: int) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that ``edits`` leave of ``turns`` (code, role, text)."""
    left = iter(turns)
    for edit in edits:
        if edit == "I":
            state = TURN[state]
            yield ROLES[state], ""
            continue
        code, role, text = next(left)
        if edit == "K":
            state = KEPT[state][code & 3]
            yield role, text
        elif edit == "R":
            state = TURN[state]
            yield ROLES[state], text
