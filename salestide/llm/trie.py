"""Similarity join of ordered sets in a trie."""

from __future__ import annotations

import numpy as np

#: Two sets link when PER * intersection >= share * union.
SHARE, PER = 90, 100


def prefix_length(size: int, share: int = SHARE) -> int:
    """So many of the first tokens of a set in global order meet those of every set it links to.

    Linked sets have at least ``share`` of ``PER`` of a set's tokens in common.
    """
    return size - -(-share * size // PER) + 1 if size else 0


class _Trie:
    """Sequences of increasing tokens, sorted, with the lengths of what neighbours have in common."""

    def __init__(self, sequences: list[np.ndarray], sizes: np.ndarray) -> None:
        flat = np.concatenate(sequences)
        tokens, local = np.unique(flat, return_inverse=True)
        counts = np.array([len(s) for s in sequences])
        cuts = np.cumsum(counts)[:-1]
        rows = np.split(local.astype(np.int64), cuts)
        self.order = sorted(range(len(rows)), key=lambda i: rows[i].astype(">u4").tobytes())
        self.rows = [rows[i] for i in self.order]
        self.sizes = np.asarray(sizes, np.int64)[self.order]
        self.lengths = counts[self.order]
        self.vocabulary = len(tokens)
        self.common = np.array([self._shared(a, b) for a, b in zip(self.rows, self.rows[1:])], np.int64)
        owner = np.repeat(np.arange(len(self.rows)), self.lengths)
        every = np.concatenate(self.rows)
        by_token = np.argsort(every, kind="stable")
        #: Sequences by token, and where each token's begin.
        self.owners = owner[by_token]
        self.first = np.concatenate([[0], np.cumsum(np.bincount(every, minlength=self.vocabulary))])
        #: Tokens by sequence, as one increasing list.
        self.keys = owner * self.vocabulary + every
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.last = np.array([r[-1] for r in self.rows])

    @staticmethod
    def _shared(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def holders(self, tokens: np.ndarray) -> np.ndarray:
        """How many of ``tokens`` each sequence has."""
        begin, size = self.first[tokens], self.first[tokens + 1] - self.first[tokens]
        at = np.repeat(begin - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        return np.bincount(self.owners[at], minlength=len(self.rows))

    def consumed(self, active: np.ndarray, token: int) -> np.ndarray:
        """How many tokens of each sequence are not greater than ``token``."""
        return np.searchsorted(self.keys, active * self.vocabulary + token, side="right") - self.starts[active]


def pairs(sequences: list[np.ndarray], sizes: list[int], share: int = SHARE) -> list[tuple[int, int]]:
    """Pairs (i, j), i < j, of distinct sets that may link, given their first tokens in global order.

    ``sizes`` are those of the whole sets. If the sequences are whole, exactly the linked pairs are returned. If
    they are prefixes, every linked pair is among those returned.

    All sets are stored in one trie. It is walked once; each node adds the tokens of its edge to the partial
    overlaps of all sets that are still in play, so that stored sets with a common beginning share that work.
    A set leaves a subtree when its overlap so far, and the most that the rests of both sides can add, are too
    few for any size of set below.
    """
    live = [i for i, s in enumerate(sequences) if len(s)]
    if len(live) < 2:
        return []
    trie = _Trie([sequences[i] for i in live], np.array([sizes[i] for i in live]))
    found = []
    everyone = np.arange(len(live))
    stack = [(0, len(live), 0, np.zeros(len(live), np.int64), everyone)]
    while stack:
        i, j, depth, overlap, active = stack.pop()
        end = int(trie.common[i : j - 1].min()) if j - i > 1 else len(trie.rows[i])
        if end > depth:
            edge = trie.rows[i][depth:end]
            overlap = overlap + trie.holders(edge)
        if end:
            last = int(trie.rows[i][end - 1])
            rest = trie.sizes[active] - trie.consumed(active, last)
            size = np.clip(end + rest, trie.sizes[i:j].min(), trie.sizes[i:j].max())
            # Beyond the end of a set's own prefix, tokens on the other side may still meet its unseen ones.
            other = np.where(last <= trie.last[active], size - end, rest)
            most = overlap[active] + np.minimum(rest, other)
            size = np.where(last <= trie.last[active], size, np.minimum(size, trie.sizes[i:j].min()))
            active = active[(PER + share) * most >= share * (trie.sizes[active] + size)]
        if not len(active):
            continue
        if trie.lengths[i] == end:  # sets that end here come first
            stop = i + 1
            while stop < j and trie.lengths[stop] == end:
                stop += 1
            for y in range(i, stop):
                # Each side's tokens up to the other's last one are settled; what may add are the rests of both.
                rest = trie.sizes[active] - trie.consumed(active, int(trie.last[y]))
                other = trie.sizes[y] - np.searchsorted(trie.rows[y], trie.last[active], side="right")
                most = overlap[active] + np.minimum(rest, other)
                fits = (PER + share) * most >= share * (trie.sizes[active] + trie.sizes[y])
                found += [(x, y) for x in active[fits].tolist() if x != y]
            i = stop
        begin = i
        for k in range(i, j):
            if k == j - 1 or trie.common[k] == end:
                stack.append((begin, k + 1, end, overlap, active))
                begin = k + 1
    named = {tuple(sorted((live[trie.order[x]], live[trie.order[y]]))) for x, y in found}
    return sorted(named)
