"""The suffix automaton of a set of words, and where words end in a text."""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Mapping


class SuffixAutomaton:
    """The smallest automaton that reads every part of every word, in flat arrays.

    A state stands for the parts that end at the same places of the words.  ``length`` is that of its longest part, ``link``
    leads to the state of the longest suffix that ends at more places.  A word as a whole ends where nothing longer
    can, so it is the longest part of its state; ``number`` is that of the word, else -1, and ``nearest`` the next state
    along the links that has one.  Empty words end nowhere and are left out; of equal words the last one counts.
    """

    def __init__(self, words: Mapping[str, int]) -> None:
        self.length, self.link, self.number = array("l", [0]), array("l", [-1]), array("l", [-1])
        edges: list[dict[int, int]] = [{}]
        for word, number in words.items():
            if word:
                state = 0
                for character in map(ord, word):
                    state = self._extended(edges, state, character)
                self.number[state] = number
        self.nearest = array("l", [0]) * len(edges)
        for state in sorted(range(1, len(edges)), key=self.length.__getitem__):
            above = self.link[state]
            self.nearest[state] = above if self.number[above] >= 0 else self.nearest[above]
        self._step = {state << 21 | character: to for state, following in enumerate(edges) for character, to in following.items()}

    def _state(self, edges: list[dict[int, int]], length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.number.append(-1)
        edges.append(following)
        return len(edges) - 1

    def _suffix(self, edges: list[dict[int, int]], state: int, character: int) -> int:
        """The state of the longest part of ``state`` and one more character; split off if it stood for longer parts too."""
        to = edges[state][character]
        if self.length[to] == self.length[state] + 1:
            return to
        split = self._state(edges, self.length[state] + 1, self.link[to], dict(edges[to]))
        self.link[to] = split
        while state >= 0 and edges[state].get(character) == to:
            edges[state][character] = split
            state = self.link[state]
        return split

    def _extended(self, edges: list[dict[int, int]], state: int, character: int) -> int:
        if character in edges[state]:
            return self._suffix(edges, state, character)
        new = self._state(edges, self.length[state] + 1, 0, {})
        while state >= 0 and character not in edges[state]:
            edges[state][character] = new
            state = self.link[state]
        if state >= 0:
            # Splitting may add a state, so the link is set by its number, not within an expression on arrays.
            link = self._suffix(edges, state, character)
            self.link[new] = link
        return new

    def longest_ends(self, text: str) -> Iterator[tuple[int, int]]:
        """(position of the last character, state) of the longest word that ends there, if any does.

        ``nearest`` leads from there to the shorter ones; 0 is none.
        """
        step, link, length, number, nearest = self._step.get, self.link, self.length, self.number, self.nearest
        state = read = 0
        for at, character in enumerate(map(ord, text)):
            to = step(state << 21 | character)
            while to is None and state:
                state = link[state]
                read = length[state]
                to = step(state << 21 | character)
            if to is None:
                continue
            state, read = to, read + 1
            end = state if number[state] >= 0 and read == length[state] else nearest[state]
            if end:
                yield at, end

    def matches(self, text: str) -> Iterator[tuple[int, int, int]]:
        """(position of the last character, number, length) of each word in ``text``, by end, longest first."""
        for at, end in self.longest_ends(text):
            while end:
                yield at, self.number[end], self.length[end]
                end = self.nearest[end]
