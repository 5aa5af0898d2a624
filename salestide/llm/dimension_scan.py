"""Scan of a block of rotated vectors, column block by column block, that abandons candidates early.

After a random rotation the first columns of a difference are a fair sample of it, so a partial distance over d of D
columns, scaled by D / d, tests the hypothesis that the whole distance is within a bound. The test errs with a probability
that falls with ``EPSILON`` and with d; a candidate that passes all tests has its whole distance.
"""

from __future__ import annotations

import numpy as np

#: Columns that are added between two tests.
WIDTH = 16
#: How far the scaled partial distance may exceed the bound, in units of 1 / sqrt(d).
EPSILON = 2.1
#: Candidates between two updates of the bounds.
STRIDE = 256
#: Rounding of single-precision columns: squared distances of unit vectors this close count as equal until scored exactly.
SLACK = 1e-5
#: Above this share of survivors a column block is computed for all candidates at once.
DENSE = 0.15


def column_blocks(rows: np.ndarray) -> bytes:
    """``rows`` in single precision, with the columns of a block together, one after the other."""
    return b"".join(np.ascontiguousarray(rows[:, at : at + WIDTH].T, "<f4").tobytes() for at in range(0, rows.shape[1], WIDTH))


def from_column_blocks(data: bytes, columns: int) -> list[np.ndarray]:
    """The column blocks as arrays of (columns of the block, rows)."""
    flat = np.frombuffer(data, "<f4")
    count = len(flat) // columns
    return [flat[at * count : min(at + WIDTH, columns) * count].reshape(-1, count).astype(np.float64) for at in range(0, columns, WIDTH)]


def scan(
    blocks: list[np.ndarray], queries: np.ndarray, bounds: np.ndarray, k: int, epsilon: float = EPSILON
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, candidate and squared distance of pairs that include, up to the tests, each query's ``k`` nearest within its bound."""
    columns, total = queries.shape[1], blocks[0].shape[1]
    bounds = bounds.copy()
    best = np.full((len(queries), k), np.inf)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    parts = [queries[:, at : at + WIDTH] for at in range(0, columns, WIDTH)]
    own = [np.einsum("ij,ij->i", part, part) for part in parts]
    theirs = [np.einsum("ij,ij->j", block, block) for block in blocks]
    for start in range(0, total, STRIDE):
        stop = min(start + STRIDE, total)
        sums, alive, done = np.zeros((len(queries), stop - start)), None, 0
        for part, block, a, b in zip(parts, blocks, own, theirs):
            block, b = block[:, start:stop], b[start:stop]
            done += part.shape[1]
            if alive is None or len(alive[0]) > DENSE * sums.size:
                sums += a[:, None] + b[None, :] - 2 * (part @ block)
            else:
                difference = part[alive[0]] - block.T[alive[1]]
                sums[alive] += np.einsum("ij,ij->i", difference, difference)
            share = done / columns
            limit = (bounds + SLACK) * share * (1 + epsilon / np.sqrt(done)) ** 2 if done < columns else bounds + SLACK
            if alive is None:
                alive = np.nonzero(sums <= limit[:, None])
            else:
                passed = sums[alive] <= limit[alive[0]]
                alive = alive[0][passed], alive[1][passed]
            if not len(alive[0]):
                break
        if not len(alive[0]):
            continue
        whole = sums[alive]
        found.append((alive[0], alive[1] + start, whole))
        touched = np.unique(alive[0])
        here = np.full((len(queries), stop - start), np.inf)
        here[alive] = whole
        best[touched] = np.partition(np.concatenate([best[touched], here[touched]], axis=1), k - 1, axis=1)[:, :k]
        bounds[touched] = np.minimum(bounds[touched], best[touched].max(axis=1))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    query, candidate, distance = (np.concatenate(x) for x in zip(*found))
    near = distance <= bounds[query] + SLACK
    return query[near], candidate[near], distance[near]
