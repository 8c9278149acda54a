"""Byte-pair merging of many short sequences at once, in ragged numpy arrays."""

from __future__ import annotations

import numpy as np

NEVER = np.int64(1) << 40
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


class PairTable:
    """(left, right) to (rank, merged symbol): open addressing in numpy arrays."""

    def __init__(self, left, right, rank, merged):
        keys = self._keys(np.asarray(left), np.asarray(right))
        bits = max(10, int(4 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, _EMPTY, np.uint64)
        index = np.full(1 << bits, -1, np.int64)
        waiting, at, step = np.arange(len(keys)), self._home(keys), 0
        while len(waiting):
            spot = (at[waiting] + step) & self.mask
            free = index[spot] < 0
            index[spot[free]] = waiting[free]
            waiting, step = waiting[index[spot] != waiting], step + 1
        taken = index >= 0
        self.slots[taken] = keys[index[taken]]
        self.rank = np.full(1 << bits, NEVER, np.int64)
        self.merged = np.zeros(1 << bits, np.int32)
        self.rank[taken] = np.asarray(rank, np.int64)[index[taken]]
        self.merged[taken] = np.asarray(merged, np.int32)[index[taken]]

    @staticmethod
    def _keys(left, right):
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _home(self, keys):
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left, right):
        """Ranks (``NEVER`` for no such pair) and merged symbols."""
        keys = self._keys(left, right)
        spot = self._home(keys)
        here = self.slots[spot]
        todo = np.flatnonzero((here != keys) & (here != _EMPTY))
        while len(todo):
            spot[todo] = (spot[todo] + 1) & self.mask
            here = self.slots[spot[todo]]
            todo = todo[(here != keys[todo]) & (here != _EMPTY)]
        return self.rank[spot], self.merged[spot]


def merge_all(symbols, lengths, table: PairTable, every: bool):
    """Merge each sequence until no pair of it is in the table.

    ``symbols`` holds the sequences one after another, ``lengths`` their lengths. Each
    round finds every unfinished sequence's lowest rank and applies it in all sequences
    simultaneously: ``every`` occurrence of that pair from the left, or the leftmost one
    only. Finished sequences leave the arrays. Returns symbols and lengths.
    """
    symbols = np.array(symbols, np.int32)
    lengths = np.asarray(lengths, np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    rank = np.full(len(symbols), NEVER, np.int64)
    merged = np.zeros(len(symbols), np.int32)
    inner = np.flatnonzero(owner[1:] == owner[:-1])
    rank[inner], merged[inner] = table.find(symbols[inner], symbols[inner + 1])
    done = []
    while len(owner):
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        counts = np.diff(np.append(starts, len(owner)))
        best = np.minimum.reduceat(rank, starts)
        live = best < NEVER
        if not live.all():
            stay = np.repeat(live, counts)
            done.append((owner[~stay], symbols[~stay]))
            owner, symbols, rank, merged = (x[stay] for x in (owner, symbols, rank, merged))
            best, counts = best[live], counts[live]
            if not len(owner):
                break
        at = np.flatnonzero(rank == np.repeat(best, counts))
        if every:
            # Of overlapping occurrences (aaa) every other one counts, from the left.
            order = np.arange(len(at))
            opens = np.concatenate([[True], np.diff(at) != 1])
            at = at[(order - np.maximum.accumulate(np.where(opens, order, 0))) % 2 == 0]
        else:
            at = at[np.concatenate([[True], owner[at][1:] != owner[at][:-1]])]
        symbols[at] = merged[at]
        touched = np.zeros(len(owner), bool)
        touched[at] = touched[np.maximum(at - 1, 0)] = True
        stay = np.ones(len(owner), bool)
        stay[at + 1] = False
        owner, symbols, rank, merged, touched = (
            x[stay] for x in (owner, symbols, rank, merged, touched)
        )
        new = np.flatnonzero(touched)
        rank[new] = NEVER
        new = new[new < len(owner) - 1]
        new = new[owner[new] == owner[new + 1]]
        rank[new], merged[new] = table.find(symbols[new], symbols[new + 1])
    if not done:
        return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
    owners = np.concatenate([x[0] for x in done])
    order = np.argsort(owners, kind="stable")
    return (
        np.concatenate([x[1] for x in done])[order],
        np.bincount(owners, minlength=len(lengths)),
    )
