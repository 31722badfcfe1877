"""Multi-pattern search in short free text: one pass finds all aliases, the longest at each place wins."""

from __future__ import annotations

from collections.abc import Iterable

import ahocorasick


class AliasFinder:
    """Aho-Corasick automaton over lower-cased aliases, each with a meaning."""

    def __init__(self, aliases: Iterable[tuple[str, object]]):
        self.automaton = ahocorasick.Automaton()
        for alias, meaning in aliases:
            self.automaton.add_word(alias, (len(alias), meaning))
        self.automaton.make_automaton()

    def hits(self, text: str) -> list[tuple[int, int, object]]:
        """``(start, end, meaning)`` of every alias in lower-cased ``text``.

        An alias that begins or ends in a letter must not touch a further letter there.
        """
        out = []
        for last, (size, meaning) in self.automaton.iter(text):
            start, end = last - size + 1, last + 1
            if text[start].isalpha() and start and text[start - 1].isalpha():
                continue
            if text[last].isalpha() and end < len(text) and text[end].isalpha():
                continue
            out.append((start, end, meaning))
        return out

    def find(self, text: str) -> list[tuple[int, int, object]]:
        """The hits from left to right and without overlap: of those that overlap the longest stays, of equal ones the
        left.
        """
        return longest(self.hits(text))


def longest(hits: list[tuple[int, int, object]]) -> list[tuple[int, int, object]]:
    """Of hits that overlap the longest, of equal ones the left, in order of their places."""
    taken: list[tuple[int, int, object]] = []
    for hit in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        if all(hit[1] <= t[0] or hit[0] >= t[1] for t in taken):
            taken.append(hit)
    return sorted(taken)
