"""Suffix automata over words."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """A suffix automaton of several sequences that tells, while it grows, what it has seen before.

    Feeding the sequences in order gives matching statistics against everything fed earlier, the
    sequence's own earlier words included: after a word, the longest suffix that also ended earlier
    is the current state itself if no state was added, and its suffix link otherwise.
    """

    def __init__(self):
        self.following: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.longest = [0]

    def _state(self, following: dict, link: int, longest: int) -> int:
        self.following.append(following)
        self.link.append(link)
        self.longest.append(longest)
        return len(self.link) - 1

    def _split(self, at: int, word: Hashable, old: int) -> int:
        """The state of the strings at ``at`` continued by ``word``, cut off from ``old`` if needed."""
        if self.longest[old] == self.longest[at] + 1:
            return old
        new = self._state(dict(self.following[old]), self.link[old], self.longest[at] + 1)
        while at >= 0 and self.following[at].get(word) == old:
            self.following[at][word] = new
            at = self.link[at]
        self.link[old] = new
        return new

    def feed(self, sequence: Iterable[Hashable]) -> list[int]:
        """Append a sequence; for each word, how many words up to it also occurred earlier."""
        matched = []
        last = 0
        for word in sequence:
            old = self.following[last].get(word)
            if old is not None:
                last = self._split(last, word, old)
                matched.append(self.longest[last])
                continue
            new = self._state({}, 0, self.longest[last] + 1)
            at = last
            while at >= 0 and word not in self.following[at]:
                self.following[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, self.following[at][word])
            last = new
            matched.append(self.longest[self.link[new]])
        return matched


def seen_windows(passages: Sequence[Sequence[Hashable]], window: int) -> list[list[bool]]:
    """For each passage and each of its windows: did the window start in what came before it?"""
    automaton = SuffixAutomaton()
    known: set = set()
    result = []
    for passage in passages:
        whole = tuple(passage)
        if whole in known:  # the automaton would match all of it
            result.append([True] * (len(whole) - window + 1))
            continue
        known.add(whole)
        result.append([m >= window for m in automaton.feed(whole)[window - 1 :]])
    return result
