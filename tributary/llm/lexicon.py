"""A lexicon trie intersected with Levenshtein automata, walked as one lazily built automaton.

A state is the set of trie nodes that the characters read so far may stand at, each with the fewest edits that lead there.
States and their transitions are built when a token first needs them and then kept, so a token that resembles
no entry is left after its first few characters. Most tokens need not be walked: two words within d edits of each other have
a string in common that at most d deleted characters leave of either, so a token without such a string cannot match.
Hashes of these strings come from prefix sums, for many tokens at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

#: Trie nodes in all states that an automaton keeps before it starts anew.
NODES = 500_000
#: Letters of an entry up to which its strings with characters deleted are kept; tokens near longer entries are always walked.
LISTED = 24
#: Tokens whose hashes are made at once.
CHUNK = 4096

_MIX, _BASE = np.uint64(0xBF58476D1CE4E5B9), 0x9E3779B97F4A7C15
_UP = np.array([pow(_BASE, k, 1 << 64) for k in range(64)], np.uint64)
_DOWN = np.uint64(pow(_BASE, -1, 1 << 64))


class Entry(NamedTuple):
    """A term, or a stem that any ending may follow."""

    term: str
    stem: bool

    @property
    def edits(self) -> int:
        """Edits at which a token still counts as a misspelling: short terms and stems allow none, long terms two."""
        return int(len(self.term) >= 6) if self.stem else (len(self.term) >= 5) + (len(self.term) >= 9)


def _left(words: Sequence[str], edits: int) -> np.ndarray:
    """Hashes of what is left of words of one length when up to ``edits`` (two at most) characters are deleted, a row for each word."""
    n = len(words[0])
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), n).astype(np.uint64)
    sums = np.zeros((len(words), n + 1), np.uint64)
    np.cumsum(_MIX * (codes + np.uint64(1)) * _UP[:n], axis=1, out=sums[:, 1:])
    total, i = sums[:, -1:], np.arange(n)
    out = [total]
    if edits > 0:
        out.append(sums[:, i] + (total - sums[:, i + 1]) * _DOWN)
    if edits > 1:
        i, j = np.triu_indices(n, 1)
        out.append(sums[:, i] + (sums[:, j] - sums[:, i + 1]) * _DOWN + (total - sums[:, j + 1]) * _DOWN * _DOWN)
    return np.concatenate(out, axis=1)


class _Known:
    """Hashes in a sorted array, and a table of their leading bits that answers most questions."""

    def __init__(self, hashes: list[np.ndarray]):
        self.hashes = np.unique(np.concatenate([h.ravel() for h in hashes])) if hashes else np.empty(0, np.uint64)
        self.table = np.zeros(1 << 22, bool)
        self.table[self.hashes * _MIX >> np.uint64(42)] = True

    def any(self, hashes: np.ndarray) -> np.ndarray:
        """For each row, whether one of its hashes is known."""
        row, column = np.nonzero(self.table[hashes * _MIX >> np.uint64(42)])
        out = np.zeros(len(hashes), bool)
        out[row[np.isin(hashes[row, column], self.hashes)]] = True
        return out


class FuzzyLexicon:
    """With ``first_letter`` only tokens match whose first letter is the entry's and has no edit."""

    def __init__(self, entries: Sequence[Entry], first_letter: bool = True):
        self.entries, self.first_letter = list(entries), first_letter
        # By edits allowed, and for stems by their length too: shortest and longest entry, strings left of the entries.
        terms: dict[tuple[int, int], list[str]] = {}
        for entry in self.entries:
            terms.setdefault((entry.edits, len(entry.term) if entry.stem else 0), []).append(entry.term)
        self.lengths = {kind: (min(map(len, of)), max(map(len, of))) for kind, of in terms.items()}
        self.left = {kind: _Known([_left([t], kind[0]) for t in of if len(t) <= LISTED]) for kind, of in terms.items()}
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.reach = [0]
        for number, entry in enumerate(self.entries):
            node = 0
            self.reach[0] = max(self.reach[0], entry.edits)
            for c in entry.term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], entry.edits)
            self.ends[node].append(number)
        self._clear()

    def _clear(self) -> None:
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.steps: list[dict[str, int]] = []
        self.stems: list[tuple] = []
        self.nodes = 0
        self.start = self._state({0: 0}) if self.first_letter else self._number({0: 0})

    def _number(self, nodes: dict[int, int]) -> int:
        """The state of these nodes and all that lie behind deleted characters of the lexicon."""
        waiting = list(nodes.items())
        while waiting:  # deleted characters
            node, edits = waiting.pop()
            if nodes[node] == edits:
                for child in self.children[node].values():
                    if edits < self.reach[child] and edits + 1 < nodes.get(child, 99):
                        nodes[child] = edits + 1
                        waiting.append((child, edits + 1))
        return self._state(nodes)

    def _state(self, nodes: dict[int, int]) -> int:
        state = tuple(sorted(nodes.items()))
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.nodes += len(state)
            self.steps.append({})
            self.stems.append(tuple(self._ends(state, stem=True)))
        return self.numbers[state]

    def _ends(self, state: tuple, stem: bool):
        for node, edits in state:
            for number in self.ends[node]:
                if self.entries[number].stem == stem and edits <= self.entries[number].edits:
                    yield edits, number

    def _step(self, state: int, c: str) -> int:
        after: dict[int, int] = {}
        if self.first_letter and state == self.start:
            return self._number({self.children[0][c]: 0}) if c in self.children[0] else -1
        for node, edits in self.states[state]:
            moves = [(child, edits + (key != c)) for key, child in self.children[node].items()]
            for to, cost in [*moves, (node, edits + 1)]:
                if cost <= self.reach[to] and cost < after.get(to, 99):
                    after[to] = cost
        return self._number(after) if after else -1

    def near(self, tokens: Sequence[str]) -> list[str]:
        """The tokens that an entry can match; some of them may still match none."""
        by_length: dict[int, list[str]] = {}
        for token in tokens:
            by_length.setdefault(min(len(token), LISTED + 3), []).append(token)
        out = []
        for n, group in by_length.items():
            for begin in range(0, len(group), CHUNK):
                part = group[begin : begin + CHUNK]
                out.extend(t for t, near in zip(part, self._near(part, n), strict=True) if near)
        return out

    def _near(self, tokens: list[str], n: int) -> np.ndarray:
        """Whether tokens of ``n`` letters (or of more, if ``n`` is above ``LISTED`` + 2) may match."""
        out = np.zeros(len(tokens), bool)
        left: dict[tuple[int, int], np.ndarray] = {}
        for (edits, stem), (low, high) in self.lengths.items():
            if high > LISTED and n > LISTED - edits:
                return np.ones(len(tokens), bool)
            if n < low - edits or not stem and n > high + edits:
                continue
            for k in range(stem - edits, min(stem + edits, n) + 1) if stem else (n,):
                if (k, edits) not in left:
                    left[k, edits] = _left([t[:k] for t in tokens], edits)
                out |= self.left[edits, stem].any(left[k, edits])
        return out

    def match(self, token: str) -> tuple[int, int] | None:
        """The entry that the token spells with the fewest edits, ``(entry, edits)``; among equals the first entry."""
        if self.nodes > NODES:
            self._clear()
        state, found = self.start, []
        for c in token:
            known = self.steps[state]
            state = known[c] if c in known else known.setdefault(c, self._step(state, c))
            if state < 0:
                break
            found.extend(self.stems[state])
        else:
            found.extend(self._ends(self.states[state], stem=False))
        return min(found)[::-1] if found else None
