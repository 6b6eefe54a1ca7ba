"""Multi-pattern automaton over a phrase dictionary, with longest non-overlapping whole-word matches."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable

import ahocorasick


class PhraseAutomaton:
    """Finds all phrases of a dictionary in a text in one pass.

    Payloads are hashable. A phrase given twice keeps its first payload.
    `whole_words` asks that a match is not preceded or followed by a letter or digit.
    """

    def __init__(self, phrases: Iterable[tuple[str, object]], whole_words: bool = True):
        self.whole_words = whole_words
        self.payload: dict[str, object] = {}
        for phrase, payload in phrases:
            if phrase:
                self.payload.setdefault(phrase, payload)
        self.longest_phrase = max(map(len, self.payload), default=0)
        self.machine = ahocorasick.Automaton()
        for phrase, payload in self.payload.items():
            self.machine.add_word(phrase, (len(phrase), payload))
        if self.payload:
            self.machine.make_automaton()

    def every(self, text: str) -> list[tuple[int, int, object]]:
        """All matches as (start, end, payload)."""
        if not self.payload or not text:
            return []
        found = []
        last = len(text) - 1
        for end, (length, payload) in self.machine.iter(text):
            start = end - length + 1
            if self.whole_words and (
                (start > 0 and text[start - 1].isalnum() and text[start].isalnum())
                or (end < last and text[end + 1].isalnum() and text[end].isalnum())
            ):
                continue
            found.append((start, end + 1, payload))
        return found

    def longest(self, text: str) -> list[tuple[int, int, object]]:
        """Non-overlapping matches: the longest wins, of equal lengths the first; in text order."""
        starts: list[int] = []
        taken: list[tuple[int, int, object]] = []
        for match in sorted(self.every(text), key=lambda m: (m[0] - m[1], m[0])):
            k = bisect_left(starts, match[0])
            if (k == len(taken) or match[1] <= taken[k][0]) and (k == 0 or taken[k - 1][1] <= match[0]):
                starts.insert(k, match[0])
                taken.insert(k, match)
        return taken
