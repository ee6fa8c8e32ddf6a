"""A suffix automaton over word numbers, with the weight of each of its sequences."""

from __future__ import annotations


class SuffixAutomaton:
    """All subsequences of weighted sequences; weigh() then counts how often each one occurs."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.weight = [0]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.weight.append(0)
        return len(self.link) - 1

    def _split(self, at: int, symbol: int) -> int:
        """The state of the longest suffix of `at` followed by symbol, made where it needs a state of its own."""
        follows, link, length = self.next, self.link, self.length
        target = follows[at][symbol]
        if length[target] == length[at] + 1:
            return target
        copy = self._state(length[at] + 1, link[target], follows[target].copy())
        link[target] = copy
        while at >= 0 and follows[at].get(symbol) == target:
            follows[at][symbol] = copy
            at = link[at]
        return copy

    def add(self, sequence: list[int], weight: int) -> None:
        """Enter a sequence that occurs `weight` times."""
        follows, link = self.next, self.link
        last = 0
        for symbol in sequence:
            if symbol in follows[last]:
                last = self._split(last, symbol)
            else:
                state = self._state(self.length[last] + 1, 0, {})
                at = last
                while at >= 0 and symbol not in follows[at]:
                    follows[at][symbol] = state
                    at = link[at]
                if at >= 0:
                    link[state] = self._split(at, symbol)
                last = state
            self.weight[last] += weight

    def weigh(self) -> None:
        """Hand every state's weight on to its suffixes, longest first."""
        weight, link, length = self.weight, self.link, self.length
        for state in sorted(range(1, len(link)), key=length.__getitem__, reverse=True):
            weight[link[state]] += weight[state]

    def repeated(self, sequence: list[int], span: int) -> int:
        """Bit p is set where the `span` symbols from p on occur at least twice.

        The sequence is streamed; the state always stands for its longest matching suffix, shortened
        to the span (matching statistics).
        """
        follows, link, length = self.next, self.link, self.length
        state, matched, bits = 0, 0, 0
        for i, symbol in enumerate(sequence):
            while state and symbol not in follows[state]:
                state = link[state]
                matched = length[state]
            if symbol in follows[state]:
                state = follows[state][symbol]
                matched += 1
            while state and length[link[state]] >= span:
                state = link[state]
                matched = length[state]
            if matched >= span and self.weight[state] >= 2:
                bits |= 1 << (i + 1 - span)
        return bits
