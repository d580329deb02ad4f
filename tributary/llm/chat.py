"""Chat formatting at token level: segments encoded apart, reserved ids spliced in, loss masks by prefix sums.

A turn is ``OPEN, mark of its role, ids of its text, CLOSE``. Reserved ids follow those of the tokenizer, so no text can hold one.
Their strings are what the template shows them as; where such a string occurs in a text it is escaped by a backslash before it,
so the written-out template can be parsed as well. Text and role names of other roles are encoded apart from all marks.

Turns are encoded where they lie. Then the turns of a conversation meet in *blocks* of ``BLOCK_TURNS`` turn numbers, so a conversation
that holds a third of all rows is many groups, and each block is streamed into *pieces* of about ``PIECE_TOKENS`` ids. The order of a conversation
is (block, piece).

Nulls: a null text or role counts as empty; rows of a null id are one conversation; null turns come first. Rows of one conversation with equal
turns are ordered by role, then by their ids; repeated rows are turns of their own. A very long text is one row and one
piece. Only the four named columns are read, so others cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .arrow import map_arrow, text_steps
from .bpe import encoder, lists, token_bytes

# The strings of the template, in the order of their reserved ids.
CONTROLS = ("<turn>", "\n</turn>\n", "### System:", "### User:", "### Assistant:", "### Role:", "\n### Text:")
OPEN, CLOSE, SYSTEM, USER, ASSISTANT, OTHER, TEXT = range(len(CONTROLS))
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}

#: What is escaped inside texts: every control string without its line breaks.
CONTROL = r"</?turn>|### (?:System|User|Assistant|Role|Text):"
_CONTROL, _ESCAPED = re.compile(CONTROL), re.compile(rf"\\({CONTROL})")

#: Turn numbers in a block, and ids after which a piece ends.
BLOCK_TURNS, PIECE_TOKENS = 256, 1 << 16


def escape(text: str) -> str:
    """A backslash before every control string, so an escaped one gains a second; ``unescape`` takes one away from each."""
    return _CONTROL.sub(r"\\\g<0>", text) if "turn>" in text or "### " in text else text


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


def splice(roles: list[str], flat: np.ndarray, counts: np.ndarray, reserved: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all turns in a row and how many each has.

    ``flat, counts`` are the ids of the texts of all turns, followed by those of the names of the roles without a mark.
    """
    n = len(roles)
    other = np.array([r not in ROLES for r in roles], bool)
    named = np.zeros(n, np.int64)
    named[other] = counts[n:]
    sizes = counts[:n] + 3 + np.where(other, named + 1, 0)
    starts = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), flat.dtype)
    out[starts] = reserved + OPEN
    out[starts + 1] = reserved + np.array([ROLES.get(r, OTHER) for r in roles], flat.dtype)
    out[starts[other] + 2 + named[other]] = reserved + TEXT
    out[starts + sizes - 1] = reserved + CLOSE
    places = np.concatenate([starts + sizes - 1 - counts[:n], starts[other] + 2])
    out[np.repeat(places - np.cumsum(counts) + counts, counts) + np.arange(len(flat))] = flat
    return out, sizes


def loss_mask(ids: np.ndarray, reserved: int) -> np.ndarray:
    """True on the text ids of assistant turns: the running sum of +1 after each assistant mark and -1 at its turn's end."""
    begins, closes = np.flatnonzero(ids == reserved + ASSISTANT) + 1, np.flatnonzero(ids == reserved + CLOSE)
    steps = np.zeros(len(ids) + 1, np.int8)
    steps[begins] += 1
    steps[closes[np.searchsorted(closes, begins)]] -= 1
    return np.cumsum(steps[:-1], dtype=np.int8) > 0


def format_chats(df: DataFrame, tokenizer_file: str, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", reserved: int | None = None) -> DataFrame:
    """``id_col, block, piece, n_turns, ids, loss_mask`` for every piece of every conversation.

    ``reserved`` is the first reserved id, by default the number of ids of the tokenizer. Ids are shuffled as packed integers of two or four bytes.
    """
    reserved = len(token_bytes(tokenizer_file)) if reserved is None else reserved
    kind = np.dtype("<u2" if reserved + len(CONTROLS) <= 1 << 16 else "<u4")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_file)
        for step in text_steps(batches, "text"):
            roles = step.column("role").to_pylist()
            texts = step.column("text").to_pylist() + [r for r in roles if r not in ROLES]
            flat, sizes = splice(roles, *bpe.encode(list(map(escape, texts))), reserved)
            bounds = np.concatenate([[0], np.cumsum(sizes) * kind.itemsize]).astype(np.int32)
            packed = pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(bounds), pa.py_buffer(flat.astype(kind).tobytes())])
            yield pa.RecordBatch.from_arrays([*(step.column(c) for c in ("id", "block", "turn", "role")), packed], ["id", "block", "turn", "role", "packed"])

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, held, key, number, tokens, filled = [], [], None, 0, 0, 0

        def batch() -> pa.RecordBatch:
            flat = np.concatenate([p[3] for p in done])
            counts = np.array([len(p[3]) for p in done])
            columns = [pa.array([p[i] for p in done], t) for i, t in ((0, id_type), (1, pa.int64()), (2, pa.int64()))]
            turns = pa.array([int((p[3] == reserved + OPEN).sum()) for p in done], pa.int64())
            return pa.RecordBatch.from_arrays([*columns, turns, lists(flat, counts, pa.int32()), lists(loss_mask(flat, reserved), counts, pa.bool_())], ["id", "block", "piece", "n_turns", "ids", "loss_mask"])

        for rows in batches:
            id_type = rows.column("id").type
            for i, block, coded in zip(rows.column("id").to_pylist(), rows.column("block").to_pylist(), rows.column("packed").to_pylist(), strict=True):
                if held and ((i, block) != key or tokens >= PIECE_TOKENS):
                    done.append((*key, number, np.concatenate(held)))
                    filled += tokens
                    number, held, tokens = (number + 1 if (i, block) == key else 0), [], 0
                    if filled >= PIECE_TOKENS:
                        yield batch()
                        done, filled = [], 0
                key = i, block
                held.append(np.frombuffer(coded, kind).astype(np.int32))
                tokens += len(held[-1])
        if held:
            done.append((*key, number, np.concatenate(held)))
            yield batch()

    id_kind, turn_kind = (df.schema[c].dataType.simpleString() for c in (id_col, turn_col))
    empty = F.lit("")
    source = df.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.floor(F.col(turn_col) / BLOCK_TURNS).cast("long"), F.lit(-(1 << 62))).alias("block"),
        F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), empty).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), empty).alias("text"),
    )
    coded = map_arrow(source, encode, f"id {id_kind}, block bigint, turn {turn_kind}, role string, packed binary")
    ordered = coded.repartition("id", "block").sortWithinPartitions("id", "block", "turn", "role", "packed").select("id", "block", "packed")
    pieces = map_arrow(ordered, assemble, f"id {id_kind}, block bigint, piece bigint, n_turns bigint, ids array<int>, loss_mask array<boolean>")
    return pieces.withColumnRenamed("id", id_col)


def write_chats(df: DataFrame, path: str, tokenizer_file: str, **options) -> None:
    format_chats(df, tokenizer_file, **options).write.option("compression", "zstd").parquet(path)


def read_chats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


class _Pieces:
    """Writes out the ids of pieces and finds their turns and the texts under their masks."""

    def __init__(self, tokenizer_file: str, reserved: int | None):
        known = token_bytes(tokenizer_file)
        self.reserved = len(known) if reserved is None else reserved
        known += [b""] * (self.reserved - len(known))
        self.table = np.array(known[: self.reserved] + [c.encode() for c in CONTROLS], dtype=object)
        self.length = np.array(list(map(len, self.table)), np.int64)
        self.names = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}

    def text(self, ids: np.ndarray) -> bytes:
        return b"".join(self.table[ids].tolist())

    def turns(self, ids: np.ndarray, mask: np.ndarray) -> tuple[list[tuple[str, str, str | None]], int]:
        """``(role, text, text under the mask or None)`` of each turn, and the code points of the piece as it is written out."""
        whole, at = self.text(ids), np.concatenate([[0], np.cumsum(self.length[ids])])
        opens = np.flatnonzero(ids == self.reserved + OPEN)
        closes = np.flatnonzero(ids == self.reserved + CLOSE)
        flips = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
        learned = {int(np.searchsorted(opens, b, "right")) - 1: unescape(whole[at[b] : at[e]].decode()) for b, e in zip(flips[0::2], flips[1::2], strict=True)}
        found = []
        for t, (o, c) in enumerate(zip(opens, closes, strict=True)):
            mark, begin = int(ids[o + 1]) - self.reserved, o + 2
            if mark == OTHER:
                middle = begin + int(np.flatnonzero(ids[begin:c] == self.reserved + TEXT)[0])
                role, begin = unescape(whole[at[begin] : at[middle]].decode()), middle + 1
            else:
                role = self.names[mark]
            found.append((role, unescape(whole[at[begin] : at[c]].decode()), learned.get(t)))
        return found, len(whole.decode())


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ids, masks = batch.column("ids"), batch.column("loss_mask")
    for i in range(batch.num_rows):
        yield ids[i].values.to_numpy(), masks[i].values.to_numpy(zero_copy_only=False)


def chat_texts(chats: DataFrame, tokenizer_file: str, id_col: str = "conv_id", reserved: int | None = None) -> DataFrame:
    """``id_col, block, piece, formatted``: the pieces as the template writes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(tokenizer_file, reserved)
        for batch in batches:
            texts = pa.array([pieces.text(ids).decode() for ids, _ in _rows(batch)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("id", "block", "piece")), texts], ["id", "block", "piece", "formatted"])

    kind = chats.schema[id_col].dataType.simpleString()
    source = chats.select(F.col(id_col).alias("id"), "block", "piece", "ids", "loss_mask")
    return map_arrow(source, run, f"id {kind}, block bigint, piece bigint, formatted string").withColumnRenamed("id", id_col)


def read_turns(chats: DataFrame, tokenizer_file: str, id_col: str = "conv_id", reserved: int | None = None) -> DataFrame:
    """``id_col, block, piece, place, role, text, learned, chars``: each turn as it was given, and its text under the loss mask.

    ``chars`` are the code points of the whole written-out piece, on its first turn, else 0. Each piece is read by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(tokenizer_file, reserved)
        for batch in batches:
            for i, (ids, mask) in enumerate(_rows(batch)):
                turns, chars = pieces.turns(ids, mask)
                n = len(turns)
                roles, texts, learned = (pa.array([t[c] for t in turns], pa.string()) for c in range(3))
                where = [pa.repeat(batch.column(c)[i], n) for c in ("id", "block", "piece")]
                yield pa.RecordBatch.from_arrays([*where, pa.array(range(n), pa.int64()), roles, texts, learned, pa.array([chars] + [0] * (n - 1), pa.int64())], ["id", "block", "piece", "place", "role", "text", "learned", "chars"])

    kind = chats.schema[id_col].dataType.simpleString()
    source = chats.select(F.col(id_col).alias("id"), "block", "piece", "ids", "loss_mask")
    return map_arrow(source, run, f"id {kind}, block bigint, piece bigint, place bigint, role string, text string, learned string, chars bigint").withColumnRenamed("id", id_col)


class _Digest:
    """Counts and running hashes of one conversation."""

    def __init__(self):
        self.turns = self.learned = self.chars = 0
        self.hash, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, learned: str | None) -> None:
        self.turns += 1
        self.hash.update(f"{role}\n{text}\n".encode())
        if learned is not None:
            self.learned += len(learned)
            self.loss.update(learned.encode())

    def values(self) -> tuple:
        return self.turns, self.hash.hexdigest(), self.learned, self.loss.hexdigest(), self.chars


_DIGEST = "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
_NAMES = ["id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
_TYPES = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]


def _digests(keys: list, found: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys, kind), *(pa.array([f[i] for f in found], t) for i, t in enumerate(_TYPES))], _NAMES)


def chat_digests(chats: DataFrame, tokenizer_file: str, id_col: str = "conv_id", reserved: int | None = None) -> DataFrame:
    """One row per conversation: ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all from the ids and masks.

    A conversation of one piece is read where it lies. Those of several pieces are decoded piece by piece, and
    their turns then stream through one hash in order: SHA-256 cannot be split, but a task holds no more than a batch of turns.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _Pieces(tokenizer_file, reserved)
        for batch in batches:
            found = []
            for ids, mask in _rows(batch):
                digest = _Digest()
                turns, digest.chars = pieces.turns(ids, mask)
                for turn in turns:
                    digest.add(*turn)
                found.append(digest.values())
            yield _digests(batch.column("id").to_pylist(), found, batch.column("id").type)

    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, key, kind = None, None, None
        for batch in batches:
            kind = batch.column("id").type
            for i, chars, *turn in zip(*(batch.column(c).to_pylist() for c in ("id", "chars", "role", "text", "learned")), strict=True):
                if digest is None or i != key:
                    if digest is not None:
                        yield _digests([key], [digest.values()], kind)
                    digest, key = _Digest(), i
                digest.add(*turn)
                digest.chars += chars
        if digest is not None:
            yield _digests([key], [digest.values()], kind)

    kind = chats.schema[id_col].dataType.simpleString()
    rows = chats.withColumnRenamed(id_col, "id").select("id", "block", "piece", "ids", "loss_mask")
    several = rows.groupBy(F.col("id").alias("long_id")).agg(F.count(F.lit(1)).alias("pieces")).where("pieces > 1").select("long_id")
    same = F.col("id").eqNullSafe(F.col("long_id"))
    alone = map_arrow(rows.join(several, same, "left_anti"), whole, f"id {kind}, {_DIGEST}")
    turns = read_turns(rows.join(several, same, "left_semi"), tokenizer_file, "id", reserved)
    ordered = turns.repartition("id").sortWithinPartitions("id", "block", "piece", "place").select("id", "chars", "role", "text", "learned")
    return alone.unionByName(map_arrow(ordered, streamed, f"id {kind}, {_DIGEST}")).withColumnRenamed("id", id_col)
