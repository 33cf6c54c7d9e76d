"""Counts of packed word-id sequences: a shallow trie over the digits of the ids with burstable hash containers."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np

ID_BITS = 21  # three ids make one key of 63 bits; id 0 stands for "no word"
DIGIT_BITS = 7
BURST = 32_768  # entries of a container before it bursts


def packed(ids: list[np.ndarray]) -> np.ndarray:
    """One key per sequence of one to three ids (counted from 0): first id in the highest bits."""
    key = np.zeros(len(ids[0]), np.int64)
    for place in range(3):
        key <<= ID_BITS
        if place < len(ids):
            key |= ids[place].astype(np.int64) + 1
    return key


def unpacked(keys: np.ndarray) -> list[np.ndarray]:
    """The three ids of each key; -1 where there is none."""
    mask = (1 << ID_BITS) - 1
    return [((keys >> (ID_BITS * (2 - place))) & mask) - 1 for place in range(3)]


class HatTrie:
    """Containers cover neighbouring ranges of keys. A container that grows beyond ``burst`` entries bursts at the
    highest digit in which its keys differ: one child for each digit, small neighbours sharing a container."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.lows: list[int] = [0]  # first key of each container's range
        self.containers: list[Counter] = [Counter()]
        self.entries = 0

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(keys)
        cuts = np.searchsorted(keys, np.array(self.lows[1:], np.int64)) if len(self.lows) > 1 else np.zeros(0, np.int64)
        bounds = [0, *cuts.tolist(), len(keys)]
        crowded = []
        for k, container in enumerate(self.containers):
            if bounds[k] < bounds[k + 1]:
                before = len(container)
                container.update(keys[bounds[k]:bounds[k + 1]].tolist())
                self.entries += len(container) - before
                if len(container) > self.burst:
                    crowded.append(self.lows[k])
        for low in crowded:
            self._burst(bisect_right(self.lows, low) - 1)

    def _burst(self, place: int) -> None:
        keys, counts = _sorted(self.containers[place])
        shift = (int(keys[0] ^ keys[-1]).bit_length() - 1) // DIGIT_BITS * DIGIT_BITS
        firsts = np.flatnonzero(np.diff(keys >> shift, prepend=-1))
        starts = [0]
        for first in firsts.tolist():
            if first - starts[-1] >= self.burst // 8:
                starts.append(first)
        if len(starts) == 1:  # nearly all keys have one digit, the last one: it parts from the others
            starts.append(int(firsts[-1]))
        ends = [*starts[1:], len(keys)]
        lows = [self.lows[place], *(int(keys[s]) >> shift << shift for s in starts[1:])]
        children = [Counter(dict(zip(keys[s:e].tolist(), counts[s:e].tolist()))) for s, e in zip(starts, ends)]
        self.lows[place:place + 1] = lows
        self.containers[place:place + 1] = children
        for low in [w for w, child in zip(lows, children) if len(child) > self.burst]:
            self._burst(bisect_right(self.lows, low) - 1)

    def spill(self, share: float = 1.0) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Take out whole containers until ``share`` of the entries are gone, those with the fewest occurrences per entry
        first; neighbours leave as one sorted run of (keys, counts)."""
        order = sorted(range(len(self.containers)), key=lambda k: sum(self.containers[k].values()) / (len(self.containers[k]) or 1))
        wanted, chosen = share * self.entries, []
        for k in order:
            if wanted <= 0:
                break
            wanted -= len(self.containers[k])
            chosen.append(k)
        run: list[tuple[np.ndarray, np.ndarray]] = []
        chosen.sort()
        for place, k in enumerate(chosen):
            if self.containers[k]:
                run.append(_sorted(self.containers[k]))
                self.entries -= len(self.containers[k])
                self.containers[k] = Counter()
            if run and (place + 1 == len(chosen) or chosen[place + 1] != k + 1):
                yield np.concatenate([r[0] for r in run]), np.concatenate([r[1] for r in run])
                run = []
        if not self.entries:
            self.lows, self.containers = [0], [Counter()]


def _sorted(container: Counter) -> tuple[np.ndarray, np.ndarray]:
    keys = np.fromiter(container.keys(), np.int64, len(container))
    counts = np.fromiter(container.values(), np.int64, len(container))
    order = np.argsort(keys)
    return keys[order], counts[order]
