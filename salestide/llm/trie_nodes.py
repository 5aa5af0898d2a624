"""Numbers for the nodes of a trie of all keys of a table, without any task that holds the trie.

Keys are range-sorted; a task walks its keys in order and holds one path, the nodes of the last key. A key has the nodes
that its common prefix with the key before gives it, and new ones below. Prefixes that reach over the border of two tasks
would be numbered twice: each task numbers the nodes of its first key by their depth, and after all tasks have ended,
those that the last key of the task before has as well get that key's numbers (``Seams``). Per task, the driver sees its
first and last key and one path.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from salestide.session import materialize

# A number is the task, a bit for nodes of the task's first key, and a count (the depth, for those).
TASK_BITS, FIRST = 40, 1 << 39
ROWS = 1 << 13
_DDL = "place bigint, key string, carry bigint, nodes array<bigint>, first string"
_SCHEMA = pa.schema([
    ("place", pa.int64()), ("key", pa.string()), ("carry", pa.int64()), ("nodes", pa.list_(pa.int64())), ("first", pa.string()),
])


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    at = 0
    for x, y in zip(a, b):
        if x != y:
            break
        at += 1
    return at


def _walk(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId() << TASK_BITS
    first = last = None
    path: list[int] = []
    count = place = size = 0
    rows: list[tuple] = []
    for batch in batches:
        for key, carry in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if last is None:
                first = key
                path = [task | FIRST | depth for depth in range(len(key) + 1)]
            else:
                shared = common(last, key)
                new = len(key) - shared
                path = path[: shared + 1] + list(range(task | count, (task | count) + new))
                count += new
            last = key
            rows.append((task | place, key, carry, path, None))
            place += 1
            size += len(path)
            if size > ROWS * 16:
                yield _batch(rows)
                rows, size = [], 0
    if last is not None:
        rows.append((task | place, last, None, path, first))
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


class Seams:
    """Numbers of the nodes that a task's first key shares with keys of earlier tasks."""

    def __init__(self, borders: list[tuple[int, str, str, list[int]]]) -> None:
        """``borders``: of each task its number, first and last key, and the nodes of the last key."""
        starts = np.zeros(max((task for task, *_ in borders), default=-1) + 2, np.int64)
        flat: list[int] = []
        self._shared = np.zeros(len(starts), np.int64)
        self._starts, self._flat = starts, np.zeros(0, np.int64)
        before: tuple[str, list[int]] | None = None
        for task, first, last, path in sorted(borders):
            known = before[1][: common(before[0], first) + 1] if before else []
            starts[task], self._shared[task] = len(flat), len(known)
            flat += known
            own = common(first, last) + 1
            before = last, [known[d] if d < min(own, len(known)) else path[d] for d in range(len(path))]
        self._flat = np.array(flat, np.int64)

    def sewn(self, nodes: np.ndarray) -> np.ndarray:
        """``nodes`` with one number for each prefix."""
        nodes = nodes.copy()
        at = np.flatnonzero(nodes & FIRST)
        tasks, depths = nodes[at] >> TASK_BITS, nodes[at] & (FIRST - 1)
        known = depths < self._shared[tasks]
        nodes[at[known]] = self._flat[self._starts[tasks[known]] + depths[known]]
        return nodes


def number(keys: DataFrame, label: str) -> tuple[DataFrame, Callable[[np.ndarray], np.ndarray]]:
    """``place, key, carry, nodes`` of ``keys`` (key, carry; keys are distinct), and what makes nodes of it unique.

    ``place`` grows with the key in code-point order. ``nodes`` has a number for each prefix, the empty one first; two
    keys have the same number after the returned function, for a prefix of both, and for nothing else.
    """
    walked = materialize(
        keys.select("key", "carry").repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_walk, _DDL), label
    )
    ends = walked.filter("first is not null").select("place", "first", "key", "nodes").collect()
    seams = Seams([(r.place >> TASK_BITS, r.first, r.key, r.nodes) for r in ends])
    return walked.filter("first is null").drop("first"), seams.sewn
