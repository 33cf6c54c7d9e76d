"""A generalised suffix automaton over sequences of word numbers."""

from __future__ import annotations


class SuffixAutomaton:
    """Accepts every run of words of the items; ``longest`` and ``link`` are the usual lengths and suffix links."""

    def __init__(self):
        self.longest, self.link, self.next = [0], [-1], [{}]

    def add(self, words: list[int]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def _new(self, longest: int, link: int, moves: dict[int, int]) -> int:
        self.longest.append(longest)
        self.link.append(link)
        self.next.append(moves)
        return len(self.longest) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state for the longest word run of p with ``word``: q itself if that is q's longest, else a copy of q."""
        if self.longest[q] == self.longest[p] + 1:
            return q
        copy = self._new(self.longest[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (q := self.next[last].get(word)) is not None:
            return self._split(last, q, word)
        state, p = self._new(self.longest[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = state
            p = self.link[p]
        if p >= 0:
            self.link[state] = self._split(p, self.next[p][word], word)
        return state

    def step(self, state: int, length: int, word: int) -> tuple[int, int]:
        """Read a word: the state and length of the longest suffix read so far that occurs in an item."""
        while (target := self.next[state].get(word)) is None:
            if state == 0:
                return 0, 0
            state = self.link[state]
            length = self.longest[state]
        return target, length + 1

    def suffix(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.longest[self.link[state]] >= length:
            state = self.link[state]
        return state
