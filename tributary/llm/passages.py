"""Repeated passages: bytes covered by a fixed-size string that starts more than once in the corpus.

Every ``SIZE``-byte window has an anchor, the leftmost of its ``GRAM``-byte grams with the smallest hash, and equal windows have
equal anchors. Neighbouring windows with one anchor form a segment. Only segments whose anchor occurs more than once can
hold a repeated window. Equal segments (a 128-bit hash of anchor and content) are merged with a count before any bytes move; where
an anchor has several different segments, each is cut out of one text that has it, and all of an anchor go to one shard. A shard builds run-length indexes over its segments (see ``runindex``) and streams the matching statistics
that mark long matches. Windows, not segments, are what segments of one text have apart, so a match is always a second start.

Copies of a text count, but its bytes move once. An anchor with more than ``VARIANTS`` different segments (a passage
very many documents share, each in surroundings of its own) would be too much for one shard: its windows are told
apart by the hash of what ever smaller blocks of windows have in common, until single windows are left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrow import distinct_texts, map_arrow, text_key
from .runindex import repeated_starts

#: Bytes of a repeated string; bytes of an anchor gram: a segment then has at most 2 * SIZE - GRAM bytes.
SIZE, GRAM = 400, 71
#: Different segments of one anchor that a shard takes; bytes of one index.
VARIANTS, INDEX_BYTES = 4096, 1 << 20
#: Window blocks by which segments of a hot anchor are told apart, coarse to fine.
BLOCKS = (64, 8, 1)
#: Bytes of text that are hashed at once.
SLICE = 1 << 20

_POSITION_BITS = 23
_BYTE_HASH = np.random.Generator(np.random.PCG64(400)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, modulo 2^64."""
    inverse = pow(_BASE, -1, 1 << 64)
    up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every run of ``width`` neighbours."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def segments_of(data: np.ndarray, bounds: np.ndarray, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """Segments of texts that lie one behind another in ``data`` (text t from bounds[t] to bounds[t+1]).

    Per segment: text, first and last window start in ``data``, anchor start, anchor hash, content hash.
    """
    n = len(data)
    if n < size:
        return tuple(np.empty(0, np.uint64 if k > 3 else np.int64) for k in range(6))
    up, down = _powers(max(n, 2 * SLICE + size))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_HASH[data] * up[:n], out=sums[1:])
    grams = _mixed((sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1])
    position = np.uint64((1 << _POSITION_BITS) - 1)
    minima = _window_minima(grams & ~position | np.arange(len(grams), dtype=np.uint64), size - gram + 1)
    anchor = (minima & position).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[: len(anchor)]
    valid = np.arange(len(anchor)) + size <= bounds[1:][text]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new & valid)
    stops = np.flatnonzero(np.append(new[1:], True) & valid | valid & np.append(~valid[1:], True))
    content = _mixed((sums[stops + size] - sums[first]) * down[first]) ^ (stops - first).astype(np.uint64)
    return text[first], first, stops, anchor[first], grams[anchor[first]], content


def _slices(batches: Iterator[pa.RecordBatch], size: int):
    """Keys with a place in the text, and texts as bytes, long ones cut with an overlap, gathered to about one slice."""
    rows, parts, held = [], [], 0
    for batch in batches:
        for key, text in zip(batch.column("key").to_pylist(), batch.column("text"), strict=True):
            data = text.as_py().encode()
            for begin in range(0, max(1, len(data) - size + 1), SLICE):
                part = data[begin : begin + SLICE + size - 1]
                rows.append((key, begin))
                parts.append(part)
                held += len(part)
                if held >= SLICE:
                    yield rows, parts
                    rows, parts, held = [], [], 0
    if rows:
        yield rows, parts


def _anchors(texts: DataFrame, size: int, gram: int) -> DataFrame:
    """One row per text and different segment: ``key, anchor, content, offset`` (of the anchor), ``span`` (windows less one), ``firsts, n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, parts in _slices(batches, size):
            data = np.frombuffer(b"".join(parts), np.uint8)
            bounds = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            text, first, last, at, anchor, content = segments_of(data, bounds, size, gram)
            order = np.lexsort((first, content, anchor, text))
            text, first, last, at, anchor, content = (x[order] for x in (text, first, last, at, anchor, content))
            new = np.ones(len(text), bool)
            new[1:] = (text[1:] != text[:-1]) | (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])
            start = np.flatnonzero(new)
            begin = np.array([r[1] for r in rows], np.int64)
            firsts = first - bounds[text] + begin[text]
            counts = np.diff(np.append(start, len(text)))
            of = text[start]
            keys = pa.array([r[0] for r in rows], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(np.append(start, len(text)).astype(np.int32)), pa.array(firsts, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(of)), pa.array(anchor[start].view(np.int64)), pa.array(content[start].view(np.int64)), pa.array((at - first)[start].astype(np.int32)), pa.array((last - first)[start].astype(np.int32)), lists, pa.array(counts)],
                ["key", "anchor", "content", "offset", "span", "firsts", "n"],
            )

    return map_arrow(texts.select("key", "text"), run, "key binary, anchor bigint, content bigint, offset int, span int, firsts array<bigint>, n bigint")


def _cut(found: DataFrame, size: int) -> DataFrame:
    """The bytes of the segments that are listed for each text: ``anchor, content, offset, n, bytes``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("anchor", pa.int64()), ("content", pa.int64()), ("offset", pa.int32()), ("n", pa.int64()), ("bytes", pa.binary())])
        for batch in batches:
            out: list[dict] = []
            for text, segments in zip(batch.column("text"), batch.column("segments"), strict=True):
                data = text.as_py().encode()
                for s in segments.as_py():
                    first = s.pop("first")
                    out.append(s | {"bytes": data[first : first + s.pop("span") + size]})
                if len(out) > 2000:
                    yield pa.RecordBatch.from_pylist(out, kinds)
                    out = []
            yield pa.RecordBatch.from_pylist(out, kinds)

    return map_arrow(found.select("key", "text", "copies", "segments"), run, "anchor bigint, content bigint, offset int, n bigint, bytes binary")


def spans_of(starts: np.ndarray, size: int) -> list[int]:
    """Covered runs of ``size``-byte strings at sorted ``starts``, as begin, end, begin, end ..."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > size)
    return np.stack([starts[np.append(0, cut + 1)], starts[np.append(cut, len(starts) - 1)] + size], axis=1).ravel().tolist()


def _indexed(variants: DataFrame, size: int, gram: int) -> DataFrame:
    """``anchor, content, spans`` from run-length indexes over whole anchors; rows come sorted by anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            starts = repeated_starts([p for *_, p in held], size, 2 * size - gram)
            # A segment that comes more than once is repeated as a whole.
            spans = [[0, len(p)] if n > 1 else spans_of(s, size) for (_, _, n, p), s in zip(held, starts, strict=True)]
            rows = [(a, c, s) for (a, c, *_), s in zip(held, spans, strict=True) if s]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else ((), (), ()), (pa.int64(), pa.int64(), pa.list_(pa.int32())), strict=True)], ["anchor", "content", "spans"])

        held, total, last = [], 0, None
        for batch in batches:
            for anchor, content, n, piece in zip(*(batch.column(c).to_pylist() for c in ("anchor", "content", "n", "bytes")), strict=True):
                if anchor != last and total >= INDEX_BYTES:
                    yield flush()
                    held, total = [], 0
                held.append((anchor, content, n, piece))
                total, last = total + len(piece) + 1, anchor
        if held:
            yield flush()

    return map_arrow(variants.select("anchor", "content", "n", "bytes"), run, "anchor bigint, content bigint, spans array<int>")


def _block_cores(rows: DataFrame, block: int, size: int) -> DataFrame:
    """Rows cut into blocks of windows by the anchor's offset in the window, with the hash of what a block's windows share.

    Windows of one offset can only be equal when the bytes common to all windows of their block are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("core", pa.binary()), ("anchor", pa.int64()), ("content", pa.int64()), ("offset", pa.int32()), ("n", pa.int64()), ("bytes", pa.binary()), ("low", pa.int32()), ("high", pa.int32())])
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                data, offset = row["bytes"], row["offset"]
                for b in range(row["low"] // block, row["high"] // block + 1):
                    core = data[max(0, offset - b * block) : offset - (b * block + block - 1) + size]
                    mark = hashlib.md5(core + b"%d %d" % (b, row["anchor"])).digest()
                    out.append(row | {"core": mark, "low": max(row["low"], b * block), "high": min(row["high"], b * block + block - 1)})
            yield pa.RecordBatch.from_pylist(out, kinds)

    return map_arrow(rows.select("anchor", "content", "offset", "n", "bytes", "low", "high"), run, "core binary, anchor bigint, content bigint, offset int, n bigint, bytes binary, low int, high int")


def _refined(hot: DataFrame, size: int) -> DataFrame:
    """``anchor, content, spans`` for segments of hot anchors, by ever smaller blocks whose core occurs again."""
    rows = hot.withColumn("high", F.col("offset")).withColumn("low", F.col("offset") - (F.length("bytes") - size))
    for block in [b for b in BLOCKS if b == 1 or 2 * b <= size]:  # a block's windows must have bytes in common
        cores = materialize(_block_cores(rows, block, size), "cores")
        again = cores.groupBy("core").agg(F.sum("n").alias("total")).where("total > 1").select("core")
        rows = cores.join(again, "core", "left_semi")
    starts = rows.groupBy("anchor", "content").agg(F.sort_array(F.collect_set(F.col("offset") - F.col("low"))).alias("starts"))
    return starts.select("anchor", "content", F.flatten(F.transform("starts", lambda s: F.array(s, s + size))).alias("spans"))


def repeated_passages(df: DataFrame, text_col: str = "text", size: int = SIZE, gram: int = GRAM, variants: int = VARIANTS) -> DataFrame:
    """``key, kept (bytes), n_bytes, removed (spans), n_removed`` for each distinct text; ``key`` is ``arrow.text_key``.

    Each byte is removed that a ``size``-byte string covers which also starts anywhere else in the corpus, in the same text
    included. Texts count as often as they come, so a text of at least ``size`` bytes that comes twice goes wholly. Strings
    are judged on the input. Matches never cross rows. A null text is empty; texts shorter than ``size`` stay whole; an
    empty table gives an empty result. Only the text column is read.
    """
    return _removed(_marked(df, text_col, size, gram, variants))


def _marked(df: DataFrame, text_col: str = "text", size: int = SIZE, gram: int = GRAM, variants: int = VARIANTS) -> DataFrame:
    """``key, text, copies, marks`` for each distinct text; the marks are starts of segments with the spans that go."""
    rows = df.select(text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    anchors = materialize(_anchors(rows, size, gram), "anchors")
    again = anchors.groupBy("anchor").agg(F.sum("n").alias("total")).where("total > 1").select("anchor")
    found = materialize(anchors.join(again, "anchor"), "repeated")
    # Two later uses read these texts with the same columns and filter, so that Spark shuffles them once.
    texts = distinct_texts(df, text_col).where("key is not null")

    one = F.min(F.struct("key", F.col("firsts")[0].alias("first"))).alias("one")
    merged = found.groupBy("anchor", "content", "offset", "span").agg(F.sum("n").alias("n"), one)
    kinds = merged.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"))
    merged = materialize(merged.join(kinds, "anchor"), "merged")
    marks = merged.where("kinds = 1").select("anchor", "content", F.array(F.lit(0), F.col("span") + size).alias("spans"))
    marks = marks.unionByName(_indexed(_variants(texts, merged.where((F.col("kinds") > 1) & (F.col("kinds") <= variants)), size).repartition("anchor").sortWithinPartitions("anchor"), size, gram))
    hot = merged.where(F.col("kinds") > variants)
    if not hot.isEmpty():
        marks = marks.unionByName(_refined(_variants(texts, hot, size), size))

    # Once for all copies of a text; each slice of a long text has starts of its own.
    places = found.groupBy("key", "anchor", "content", F.floor(F.col("firsts")[0] / SLICE).alias("slice")).agg(F.first("firsts").alias("firsts"))
    covered = places.join(marks, ["anchor", "content"]).groupBy("key").agg(F.collect_list(F.struct("firsts", "spans")).alias("marks"))
    return texts.select("key", "text", "copies").join(covered, "key", "left")


def _variants(texts: DataFrame, merged: DataFrame, size: int) -> DataFrame:
    """Different segments with their bytes, each cut out of one text that has it."""
    listed = merged.groupBy(F.col("one.key").alias("key")).agg(F.collect_list(F.struct("anchor", "content", "offset", "n", "span", F.col("one.first").alias("first"))).alias("segments"))
    return _cut(texts.select("key", "text", "copies").join(listed, "key"), size)


def _removed(texts: DataFrame, decoded: bool = False) -> DataFrame:
    """What is left of marked texts, as bytes with the removed spans, or ``decoded`` as ``key, clean`` without split characters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, marks in zip(batch.column("text"), batch.column("marks").to_pylist(), strict=True):
                data = text.as_py().encode()
                covered = np.zeros(len(data) + 2, np.int64)
                for mark in marks or ():
                    firsts, spans = np.array(mark["firsts"])[:, None], np.array(mark["spans"])
                    np.add.at(covered, firsts + spans[0::2], 1)
                    np.add.at(covered, firsts + spans[1::2], -1)
                gone = np.cumsum(covered)[: len(data) + 1] > 0
                edges = np.flatnonzero(np.diff(gone, prepend=False)).tolist()
                upto, kept = 0, []
                for begin, end in zip(edges[0::2], edges[1::2], strict=True):
                    kept.append(data[upto:begin])
                    upto = end
                out.append((b"".join([*kept, data[upto:]]), len(data), edges, int(gone.sum())))
            columns = list(zip(*out, strict=True)) if out else [()] * 4
            if decoded:
                clean = [kept.decode("utf-8", "ignore") for kept in columns[0]]
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(clean, pa.string())], ["key", "clean"])
                continue
            kinds = [pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["key", "kept", "n_bytes", "removed", "n_removed"])

    schema = "key binary, clean string" if decoded else "key binary, kept binary, n_bytes bigint, removed array<bigint>, n_removed bigint"
    return map_arrow(texts.select("key", "text", "copies", "marks"), run, schema)


def without_passages(df: DataFrame, text_col: str = "text", **settings) -> DataFrame:
    """Rows of ``df`` with repeated passages cut out of the text, other columns as they were.

    A character of which a cut leaves only some bytes goes as a whole. Rows stay even when nothing is left; a null text stays null.
    Columns travel as one value, so any names may occur.
    """
    names = df.columns
    rows = df.select(text_key(F.col(text_col)).alias("key"), F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    cleaned = _removed(_marked(df, text_col, **settings), decoded=True)  # cut and decoded in one Python worker
    joined = rows.join(cleaned, "key")
    return joined.select(*(F.when(F.col("row")[c].isNotNull(), F.col("clean")).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names))
