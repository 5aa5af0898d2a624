"""Exact forward and forward-backward recursions of a hidden Markov model over many sequences at once.

All sequences advance together, token by token, as long as enough of them go on (their heads). What is left of the
longest is cut into segments. A segment's transfer matrix says how its tokens carry any state distribution from its
left end to its right end; all segments advance together too. Passing the boundary distributions from segment to
segment then gives the same numbers as one recursion along the whole sequence, with only as many steps in order as a
head or segment has tokens or a sequence has segments. Matrices cost as many times more as there are states, heads
one step for each token: so heads end where few sequences are left.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SEGMENT = 64
# Heads go on while so many sequences do.
TOGETHER = 8
_RESCALE = 8
# Between two rescalings a distribution's sum changes by so many powers of ten at most, in either direction; and the most steps between them.
_POWERS, _MOST_STEPS = 15, 16


@dataclass(frozen=True)
class Hmm:
    """Start and transition probabilities, and emissions as ratios to ``unigram`` (one column per symbol)."""

    start: np.ndarray
    move: np.ndarray
    ratio: np.ndarray
    unigram: np.ndarray

    def cast(self, kind: type) -> Hmm:
        return Hmm(self.start.astype(kind), self.move.astype(kind), np.ascontiguousarray(self.ratio.T, kind).T, self.unigram)


class Pieces:
    """Stretches of symbols that advance together, longest first; all have a symbol at least."""

    def __init__(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> None:
        order = np.argsort(-size, kind="stable")
        self.symbols, self.begin, self.size = symbols, begin[order], size[order]
        #: Where each given piece is now.
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.arange(len(order))
        steps = np.arange(int(self.size[0]) if len(order) else 0)
        #: How many pieces have a symbol at each step; they come first.
        self.active = np.searchsorted(-self.size, -steps, side="left").tolist()

    def at(self, step: int) -> np.ndarray:
        """Symbols at a step of the pieces that have it."""
        return self.symbols[self.begin[: self.active[step]] + step]

    def by_step(self) -> np.ndarray:
        """All symbols, step by step."""
        steps = np.repeat(np.arange(len(self.active)), self.active)
        first = np.cumsum([0, *self.active])
        return self.symbols[self.begin[np.arange(len(steps)) - first[steps]] + steps]


class Parts:
    """Sequences on end (``symbols``, ``offsets``; each with a symbol at least) as heads and, of the longest, segments."""

    def __init__(self, symbols: np.ndarray, offsets: np.ndarray) -> None:
        lengths = np.diff(offsets)
        by_length = np.sort(lengths)
        head = max(int(by_length[-TOGETHER]) if len(lengths) >= TOGETHER else 0, SEGMENT)
        self.heads = Pieces(symbols, offsets[:-1], np.minimum(lengths, head))
        counts = -(-np.maximum(lengths - head, 0) // SEGMENT)
        sequence = np.repeat(np.arange(len(counts)), counts)
        starts = np.cumsum(counts) - counts
        number = np.arange(len(sequence)) - starts[sequence]
        done = head + number * SEGMENT
        self.segments = Pieces(symbols, offsets[sequence] + done, np.minimum(SEGMENT, lengths[sequence] - done))
        #: Sequences with segments, those with most first, and for each segment number: the segments of those that have it.
        self.long = np.argsort(-counts, kind="stable")[: int(np.count_nonzero(counts))]
        self.chain = []
        for j in range(int(counts.max()) if len(counts) else 0):
            have = int(np.searchsorted(-counts[self.long], -j, side="left"))
            self.chain.append(self.segments.place[starts[self.long[:have]] + j])


def transfers(model: Hmm, segments: Pieces) -> tuple[np.ndarray, np.ndarray]:
    """Transfer matrix of each segment, scaled, and the logarithm of its scale."""
    k = len(model.start)
    emit = model.ratio.T
    if not len(segments.begin):
        return np.zeros((0, k, k), model.move.dtype), np.zeros(0)
    matrix = model.move * emit[segments.at(0)][:, None, :]
    scale = np.zeros(len(matrix))
    for t, n in enumerate(segments.active[1:], 1):
        moved = (matrix[:n].reshape(-1, k) @ model.move).reshape(n, k, k)
        moved *= emit[segments.at(t)][:, None, :]
        if t % _RESCALE == 0:
            most = moved.max(axis=(1, 2))
            moved /= most[:, None, None]
            scale[:n] += np.log(most)
        matrix[:n] = moved
    most = matrix.max(axis=(1, 2))
    matrix /= most[:, None, None]
    return matrix, scale + np.log(most)


def _steps_unscaled(model: Hmm) -> int:
    """How many steps may go without rescaling: a step's sum lies between the smallest and the largest ratio."""
    if not model.ratio.size or model.ratio.min() <= 0:
        return 1
    powers = max(float(np.abs(np.log10([model.ratio.min(), model.ratio.max()])).max()), 1e-9)
    return max(1, min(_MOST_STEPS, int(_POWERS / powers)))


def _forward(
    model: Hmm, pieces: Pieces, left: np.ndarray, heads: bool, emits: np.ndarray | None = None
) -> tuple[np.ndarray | None, np.ndarray, np.ndarray]:
    """Distributions at each step, if the ``emits`` of all symbols step by step are given; at the pieces' ends; logarithms of what was scaled away.

    ``left`` is the distribution before each piece; a head's first symbol is no move away from it. Distributions are scaled every
    few steps only: those at the ends too have a sum other than one.
    """
    emit, every = model.ratio.T, _steps_unscaled(model)
    ahead = None if emits is None else np.empty_like(emits)
    now, done = left, 0
    scaled = np.zeros(len(left))
    end = np.empty_like(left)
    for t, n in enumerate(pieces.active):
        end[n : len(now)] = now[n:]
        own = emit[pieces.at(t)] if emits is None else emits[done : done + n]
        into = np.empty((n, left.shape[1]), left.dtype) if ahead is None else ahead[done : done + n]
        if heads and t == 0:
            np.multiply(now[:n], own, out=into)
        else:
            np.matmul(now[:n], model.move, out=into)
            into *= own
        now = into
        if t and t % every == 0:
            total = now.sum(axis=1)
            now /= total[:, None]
            scaled[:n] += np.log(total)
        done += n
    end[: len(now)] = now
    return ahead, end, scaled


def log_likelihoods(model: Hmm, symbols: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each sequence of symbols."""
    if len(offsets) < 2:
        return np.zeros(0)
    parts = Parts(symbols, offsets)
    start = np.tile(model.start, (len(parts.heads.begin), 1))
    logs = _through(model, parts, *_forward(model, parts.heads, start, True)[1:], *transfers(model, parts.segments))[0]
    return logs + np.add.reduceat(np.log(model.unigram)[symbols], offsets[:-1])


def _through(
    model: Hmm, parts: Parts, end: np.ndarray, scaled: np.ndarray, matrix: np.ndarray, scale: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Log-likelihood (as ratio to the unigrams) of each sequence, and the distribution before each segment."""
    left = np.zeros((len(matrix), len(model.start)), matrix.dtype)
    total = end.sum(axis=1)
    logs = (scaled + np.log(total))[parts.heads.place]
    state = (end / total[:, None])[parts.heads.place[parts.long]]
    for chain in parts.chain:
        n = len(chain)
        left[chain] = state[:n]
        ahead = np.matmul(state[:n, None, :], matrix[chain])[:, 0]
        total = ahead.sum(axis=1)
        state[:n] = ahead / total[:, None]
        logs[parts.long[:n]] += np.log(total) + scale[chain]
    return logs, left


def expected_counts(
    model: Hmm, symbols: np.ndarray, offsets: np.ndarray, emitted: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected starts, moves and emissions (state by symbol) over the sequences, and their log-likelihood.

    Emissions are added to ``emitted``, if it is given.
    """
    k, alphabet = len(model.start), model.ratio.shape[1]
    if emitted is None:
        emitted = np.zeros((k, alphabet))
    if len(symbols) == 0:
        return np.zeros(k), np.zeros((k, k)), emitted, 0.0
    parts = Parts(symbols, offsets)
    matrix, scale = transfers(model, parts.segments)
    start = np.tile(model.start, (len(parts.heads.begin), 1))
    order = parts.heads.by_step()
    emits = model.ratio.T[order]
    ahead, end, scaled = _forward(model, parts.heads, start, True, emits)
    logs, left = _through(model, parts, end, scaled, matrix, scale)
    right = np.ones_like(left)
    behind = np.ones((len(parts.long), k), left.dtype)
    for chain in reversed(parts.chain):
        n = len(chain)
        right[chain] = behind[:n]
        back = np.matmul(matrix[chain], behind[:n, :, None])[:, :, 0]
        behind[:n] = back / back.sum(axis=1, keepdims=True)
    after = np.ones_like(start)
    after[parts.heads.place[parts.long]] = behind
    pairs = _backward(model, parts.heads, start, end, after, ahead, emits, True)
    starts = ahead[: len(start)].sum(axis=0, dtype=np.float64)
    for s in range(k):
        emitted[s] += np.bincount(order, ahead[:, s], alphabet)
    if len(left):
        order = parts.segments.by_step()
        emits = model.ratio.T[order]
        ahead, end, _ = _forward(model, parts.segments, left, False, emits)
        pairs += _backward(model, parts.segments, left, end, right, ahead, emits, False)
        for s in range(k):
            emitted[s] += np.bincount(order, ahead[:, s], alphabet)
    return starts, pairs * model.move, emitted, float(logs.sum())


def _backward(
    model: Hmm, pieces: Pieces, left: np.ndarray, end: np.ndarray, after: np.ndarray, ahead: np.ndarray, emits: np.ndarray, heads: bool
) -> np.ndarray:
    """Make the states' shares of each symbol of ``ahead``; returns the expected moves over ``model.move``.

    What comes after a step is scaled against what leads to it, so that a step's shares are their product. ``emits`` is used up.
    """
    every = _steps_unscaled(model)
    pairs = np.zeros(model.move.shape)
    back = after / (end * after).sum(axis=1, keepdims=True)
    done = len(ahead)
    turned = np.ascontiguousarray(model.move.T)
    for t in range(len(pieces.active) - 1, -1, -1):
        n = pieces.active[t]
        done -= n
        later = emits[done : done + n]
        ahead[done : done + n] *= back[:n]
        if heads and t == 0:  # no move leads into the first symbol of a sequence
            break
        later *= back[:n]
        earlier = later @ turned
        before = ahead[done - pieces.active[t - 1] :][:n] if t else left
        if t == 0 or t % every == 0:
            total = (before * earlier).sum(axis=1, keepdims=True)
            later /= total
            earlier /= total
        pairs += before.T @ later
        back[:n] = earlier
    return pairs
