"""A run-length index of repetitive bytes: long matches from the run ends of a Burrows-Wheeler transform.

The index keeps the transform's runs and the suffix positions at their two ends. For two neighbours inside a run, the
characters before them are equal, so their common prefix continues one that starts a byte earlier; only neighbours on
either side of a run end can start a longest match. Matching statistics therefore stream over the text from the
matches at run ends: each lasts until its end, and the longest that covers a position is the position's statistic.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: A byte that UTF-8 never holds, between the pieces of an index.
SEPARATOR = 0xFF


@dataclass
class RunIndex:
    """``head[r], tail[r]``: positions of the suffixes before and after the r-th border of two runs; ``length``: their common prefix."""

    n: int
    head: np.ndarray
    tail: np.ndarray
    length: np.ndarray

    @property
    def runs(self) -> int:
        return len(self.head) + 1

    def statistics(self) -> np.ndarray:
        """For each position the length of the longest match that also starts elsewhere, up to the index's depth."""
        reach = np.arange(self.n)
        np.maximum.at(reach, self.head, self.head + self.length)
        np.maximum.at(reach, self.tail, self.tail + self.length)
        return np.maximum.accumulate(reach) - np.arange(self.n)


def _ranked(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, bool]:
    """Suffix order by ``keys``, dense ranks by position, and whether all keys differ."""
    order = np.argsort(keys)
    held = keys[order]
    new = np.empty(len(keys), bool)
    new[:1], new[1:] = True, held[1:] != held[:-1]
    dense = np.cumsum(new)
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = dense
    return order, ranks, bool(dense[-1] == len(keys))


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    if by < len(values):
        out[: len(values) - by] = values[by:]
    return out


def build(text: np.ndarray, depth: int) -> RunIndex:
    """Index bytes (at most 2^20 or so) with suffixes compared over at least ``depth`` bytes.

    Suffixes are ranked by ever longer prefixes, three times as long in each round.
    """
    n = len(text)
    if n < 2:
        return RunIndex(n, *(np.empty(0, np.int64) for _ in range(3)))
    code = np.zeros(256, np.int64)
    present = np.flatnonzero(np.bincount(text, minlength=256))
    code[present] = np.arange(1, len(present) + 1)
    bits = max(1, int(len(present)).bit_length())
    width = 62 // bits
    coded = code[text]
    keys = np.zeros(n, np.int64)
    for k in range(width):
        keys = keys << bits | _shifted(coded, k)
    levels = []
    order, ranks, done = _ranked(keys)
    levels.append((width, ranks))
    reached, rank_bits = width, int(n + 1).bit_length()
    fold = 3 if rank_bits * 3 <= 63 else 2
    while reached < depth and not done:
        keys = ranks
        for k in range(1, fold):
            keys = keys << rank_bits | _shifted(ranks, k * reached)
        order, ranks, done = _ranked(keys)
        reached *= fold
        levels.append((reached, ranks))
    before = text[order - 1]
    border = np.flatnonzero((before[1:] != before[:-1]) | (order[1:] == 0) | (order[:-1] == 0)) + 1
    head, tail = order[border - 1], order[border]
    length = np.zeros(len(border), np.int64)
    for step, ranks in reversed(levels):
        for _ in range(fold if step != reached else 1):
            a, b = head + length, tail + length
            same = (np.maximum(a, b) < n) & (ranks[np.minimum(a, n - 1)] == ranks[np.minimum(b, n - 1)])
            length += np.where(same, step, 0)
    for _ in range(width):
        a, b = head + length, tail + length
        same = (np.maximum(a, b) < n) & (text[np.minimum(a, n - 1)] == text[np.minimum(b, n - 1)])
        if not same.any():
            break
        length += same
    return RunIndex(n, head, tail, np.minimum(length, n - np.maximum(head, tail)))


def repeated_starts(pieces: list[bytes], size: int, depth: int) -> list[np.ndarray]:
    """For each piece the starts of its ``size``-byte strings that start anywhere else in the pieces, too."""
    text = np.frombuffer(bytes([SEPARATOR]).join([*pieces, b""]), np.uint8)
    matched = build(text, depth).statistics() >= size
    out, at = [], 0
    for piece in pieces:
        out.append(np.flatnonzero(matched[at : at + max(0, len(piece) - size + 1)]))
        at += len(piece) + 1
    return out
