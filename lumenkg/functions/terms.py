"""Multi-pattern search: which terms of a table a text contains."""
from __future__ import annotations

import unicodedata

import ahocorasick

#: The automaton that this worker used last, by name of its table.
_last: dict = {}


def is_word(ch: str) -> bool:
    """A word character: letters, marks, decimal digits, connectors and joiners."""
    return ch.isalnum() or ch in "\u200c\u200d" or unicodedata.category(ch) in ("Mn", "Mc", "Me", "Pc", "Nl")


def compiled(name: str, terms: dict[str, list]):
    """(text, whole words only) -> entries of the terms that it contains; compiled once a worker."""
    if name not in _last:
        _last.clear()
        automaton = ahocorasick.Automaton()
        for needle in terms:
            automaton.add_word(needle, needle)
        if terms:
            automaton.make_automaton()
        _last[name] = automaton
    automaton = _last[name]

    def find(text: str, word_boundary: bool) -> list:
        found = set()
        if terms:
            for end, needle in automaton.iter(text):
                if needle in found:
                    continue
                if word_boundary:
                    start = end + 1 - len(needle)
                    if start and is_word(text[start - 1]) or end + 1 < len(text) and is_word(text[end + 1]):
                        continue
                found.add(needle)
        return [entry for needle in sorted(found) for entry in terms[needle]]

    return find
