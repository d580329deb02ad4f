"""Fill-in-middle: texts cut at unit borders found by rank and select over SWAR words.

A unit is a run of ASCII letters or any other single code point. The UTF-8 bytes of a text are viewed as 64-bit words; arithmetic on
whole words sets the high bit of every byte that ends a unit. Set bits are counted per word, a search in
the running counts finds the word of the k-th border, and clearing the lowest set bits finds its byte.

Nulls: a null text is empty, a null id hashes as the empty text. Empty texts stay plain. Very long texts are masked block by block; the
masks take as much memory as the text. Repeated rows and ids are treated row by row, equal ids and texts alike. Only the id and
text columns are read, so others cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import map_arrow, text_steps

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"

#: Words that are masked at once.
BLOCK = 1 << 17

_ONES = np.uint64(0x0101010101010101)
_HIGH = _ONES * np.uint64(0x80)
_LOW = _ONES * np.uint64(0x7F)
_CASE = _ONES * np.uint64(0x20)
_FROM_A, _FROM_Z = _ONES * np.uint64(0x80 - ord("a")), _ONES * np.uint64(0x80 - ord("z") - 1)
_1, _8, _56 = np.uint64(1), np.uint64(8), np.uint64(56)


def _letters(words: np.ndarray) -> np.ndarray:
    """High bits of the bytes A-Z and a-z."""
    small = (words | _CASE) & _LOW
    return (small + _FROM_A) & ~(small + _FROM_Z) & ~words & _HIGH


def _continued(words: np.ndarray) -> np.ndarray:
    """High bits of the bytes inside a code point, 10xxxxxx."""
    return words & ~(words << _1) & _HIGH


def _following(mask: np.ndarray, after: np.uint64) -> np.ndarray:
    """The mask bits of each next byte; ``after`` is the mask of the word behind the last."""
    return (mask >> _8) | (np.append(mask[1:], after) << _56)


class Units:
    """Unit borders of one text."""

    def __init__(self, data: bytes):
        n = len(data)
        words = np.frombuffer(data + bytes(16 - n % 8), "<u8")  # at least one zero word behind the text
        self.ends = np.empty(len(words) - 1, np.uint64)
        self.inside = np.empty(len(words) - 1, np.uint64)
        for a in range(0, len(self.ends), BLOCK):
            part = words[a : a + BLOCK + 1]
            letters, inside = _letters(part), _continued(part)
            joined = (letters[:-1] & _following(letters[:-1], letters[-1])) | _following(inside[:-1], inside[-1])
            self.ends[a : a + BLOCK], self.inside[a : a + BLOCK] = ~joined & _HIGH, inside[:-1]
        if n % 8:  # padding ends no unit
            self.ends[-1] &= np.uint64((1 << 8 * (n % 8)) - 1)
        else:
            self.ends[-1] = 0
        self.upto = np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)
        self.count = int(self.upto[-1])

    def select(self, k: int) -> int:
        """Bytes of the first ``k`` units."""
        if k == 0:
            return 0
        at = int(np.searchsorted(self.upto, k))
        word = int(self.ends[at])
        for _ in range(k - 1 - (int(self.upto[at - 1]) if at else 0)):
            word &= word - 1
        return 8 * at + ((word & -word).bit_length() + 7) // 8

    def characters(self, begin: int, end: int) -> int:
        """Code points in a range of bytes whose ends are borders."""
        first, last = begin // 8, -(-end // 8)
        held = self.inside[first:last].copy()
        if len(held):
            held[0] &= np.uint64((-1 << 8 * (begin - 8 * first)) & (1 << 64) - 1)
            held[-1] &= np.uint64((1 << 8 * (end - 8 * (last - 1))) - 1)
        return end - begin - int(np.bitwise_count(held).sum(dtype=np.int64))


def transform(data: bytes, h: tuple[int, int, int, int], keep: int, swap: int) -> tuple[int, str, int | None, int | None, bytes]:
    """``units, form, prefix characters, middle characters, output`` of one text under four hash values."""
    units = Units(data)
    n = units.count
    if not data or h[2] % 100 >= keep or any(mark in data for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, data
    a, b = sorted((units.select(h[0] % (n + 1)), units.select(h[1] % (n + 1))))
    lengths = units.characters(0, a), units.characters(a, b)
    if h[3] % 100 < swap:
        return n, "spm", *lengths, b"".join((SUFFIX, data[b:], PREFIX, data[:a], MIDDLE, data[a:b]))
    return n, "psm", *lengths, b"".join((PREFIX, data[:a], SUFFIX, data[b:], MIDDLE, data[a:b]))


def hash_parts(id_col: Column, seed: int) -> list[Column]:
    """The first four groups of eight hexadecimal digits of SHA-256 of ``seed:id``, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, keep: int = 90, swap: int = 20) -> DataFrame:
    """``id_col, n, form, prefix_chars, middle_chars, output`` for every row.

    ``n`` counts units. ``keep`` of a hundred texts are transformed, ``swap`` of a hundred of these put the suffix first. The
    hash of the id alone decides, so a row comes out alike on every run and any partitioning. A text that holds a mark stays plain.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            hashes = zip(*(step.column(f"h{i}").to_pylist() for i in range(4)), strict=True)
            texts = step.column("text").cast(pa.binary()).to_pylist()
            n, form, prefix, middle, output = zip(*(transform(t or b"", h, keep, swap) for t, h in zip(texts, hashes, strict=True)), strict=True)
            outputs = pa.array(output, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [step.column("id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), outputs],
                ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = df.schema[id_col].dataType.simpleString()
    parts = [h.alias(f"h{i}") for i, h in enumerate(hash_parts(F.col(id_col), seed))]
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *parts)
    return map_arrow(source, run, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string").withColumnRenamed("id", id_col)


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made from.

    A transformed text holds no mark, and a mark begins with a character that no mark holds elsewhere, so each mark occurs once.
    """
    parts = F.split(output, "<[PSM]>", 4)
    first, second, middle = (F.get(parts, F.lit(i)) for i in (1, 2, 3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)
