"""Byte-level BPE encoding with offsets, and decoding, through the tokenizers library.

The library is called on distinct chunks only. A chunk is a run of white space followed by a run of other
characters; every pre-tokenisation pattern used here starts a new match wherever a chunk starts, so the ids of a text
are the ids of its chunks joined. Chunks repeat heavily, and a worker keeps those it has met in a memo of bounded size.
Where white space is dropped, the memo is asked for whole words between ASCII white space, and only a word that it lacks is cut into chunks.

Nulls: a null text is encoded as the empty text and gives an empty list. Repeated rows and ids are encoded row by
row. Only the id and text columns are read, so other columns cannot clash. A very long text is encoded in one step, as a list of its chunks.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from .arrow import map_arrow, text_steps

# The characters with the Unicode property White_Space.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: White space belongs to the chunk that follows it, as a leading blank belongs to a word in byte-level BPE.
SPACED = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: For tokenizers that lower-case and drop white space: chunks between ASCII white space, parted further where a Latin-1
#: small letter meets an ASCII digit or mark other than the apostrophe. Matches of such a tokenizer's pattern end there too.
UNSPACED = re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+(?=[\t-\r !-&(-@\[-`{-~]|\Z)|[!-&(-@\[-`{-~]+(?=[a-z\xdf-\xf6\xf8-\xff\t-\r ]|\Z)|[^\t-\r ]+")
#: Chunks that normalisation leaves as they are and that are one match of the pattern: these go straight to the model.
ONE_WORD = {SPACED: re.compile(r" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+"), UNSPACED: re.compile(r"[a-z\xdf-\xf6\xf8-\xff]+")}

#: Chunks a memo keeps before it drops those that came once, and the longest chunk it keeps.
MEMO_CHUNKS, MEMO_LENGTH = 250_000, 64
#: Single words that reach the model as one text, the mark between them (in none of them), and other chunks encoded at once.
JOINED, MARK, AT_ONCE = 512, "!", 4096


def byte_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable Latin-1 bytes stand for themselves; the others take the code points from 256 on, in order.
    """
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    table = {chr(b): b for b in plain}
    for shift, b in enumerate(b for b in range(256) if b not in set(plain)):
        table[chr(256 + shift)] = b
    return table


class _Slots(dict):
    """The slot of each chunk; a chunk that is looked up for the first time gets the next one and is listed in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []
        self.given = 0

    def __missing__(self, chunk: str) -> int:
        self[chunk] = slot = self.given
        self.given += 1
        self.new.append(chunk)
        return slot


class ChunkEncoder:
    """Encodes texts chunk by chunk; ids and, if asked, character offsets of known chunks come from flat arrays."""

    def __init__(self, tokenizer_file: str, chunks: re.Pattern = SPACED, offsets: bool = False, memo_chunks: int = MEMO_CHUNKS):
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.tokenizer.encode_special_tokens = True
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.Split(MARK, "isolated")
        mark = self.model.encode(MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.one_word = ONE_WORD[chunks].fullmatch
        self.to_characters = {b: c for c, b in byte_table().items()}
        self.chunks, self.offsets, self.memo_chunks = chunks, offsets, memo_chunks
        self.by_words = chunks == UNSPACED and not offsets
        self.slot = _Slots()
        self.ids, self.begins, self.ends = (np.zeros(1 << 16, np.int32) for _ in range(3))
        self.first, self.count, self.hits = (np.zeros(1 << 14, kind) for kind in (np.int64, np.int32, np.int64))
        self.used = 0

    def _room(self, name: str, upto: int) -> None:
        held = getattr(self, name)
        if upto > len(held):
            setattr(self, name, np.concatenate([held, np.zeros(max(upto - len(held), len(held)), held.dtype)]))

    def _spread(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids per slot, and where in the flat arrays all these ids lie."""
        sizes = self.count[slots].astype(np.int64)
        ends = np.cumsum(sizes)
        return sizes, np.repeat(self.first[slots] - ends + sizes, sizes) + np.arange(int(ends[-1]) if len(ends) else 0)

    def _hit(self, slots: np.ndarray) -> None:
        self._room("hits", self.slot.given)
        self.hits[: self.slot.given] += np.bincount(slots, minlength=self.slot.given)

    def _forget(self) -> None:
        """Keep what came again since the last time, the most frequent first and half a memo at most."""
        again = np.argsort(-self.hits[: self.slot.given], kind="stable")[: self.memo_chunks // 2]
        stays = np.zeros(self.slot.given, bool)
        stays[again[self.hits[again] > 1]] = True
        kept = [(c, s) for c, s in self.slot.items() if stays[s]]
        sizes, at = self._spread(np.fromiter((s for _, s in kept), np.int64, len(kept)))
        self.slot = _Slots()
        self.slot.update((c, i) for i, (c, _) in enumerate(kept))
        self.slot.given, self.used = len(kept), len(at)
        for name in ("ids", "begins", "ends")[: 3 if self.offsets else 1]:
            setattr(self, name, np.append(getattr(self, name)[at], np.zeros(1 << 16, np.int32)))
        self.count, self.first = (np.append(x, np.zeros(1 << 14, x.dtype)) for x in (sizes.astype(np.int32), np.cumsum(sizes) - sizes))
        self.hits = np.append(np.ones(len(kept), np.int64), np.zeros(1 << 14, np.int64))

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of single words in a row, and ids per word. One encoding holds many words; the mark's id parts them."""
        blank = self.to_characters[32]
        mapped = [w.replace(" ", blank) if w.isascii() else w.encode().decode("latin-1").translate(self.to_characters) for w in words]
        joined = [MARK.join([*mapped[i : i + JOINED], ""]) for i in range(0, len(mapped), JOINED)]
        flat = [np.array(e.ids, np.int32) for e in self.model.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate([*flat, np.empty(0, np.int32)])
        ends = np.flatnonzero(ids == self.mark)
        return ids[ids != self.mark], np.diff(ends, prepend=-1) - 1

    def _found(self, new: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The chunks in another order, their ids in a row, and ids per chunk."""
        plain = [] if self.mark is None else [c for c in new if self.one_word(c)]
        rest = list(set(new).difference(plain))
        parts = [self._words(plain)]
        for i in range(0, len(rest), AT_ONCE):
            rows = [e.ids for e in self.tokenizer.encode_batch_fast(rest[i : i + AT_ONCE], add_special_tokens=False)]
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            parts.append((np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum())), sizes))
        ids, sizes = zip(*parts, strict=True)
        return plain + rest, np.concatenate(ids), np.concatenate(sizes)

    def _store(self, new: list, ids: np.ndarray, sizes: np.ndarray) -> None:
        base, total = self.used, len(ids)
        self._room("ids", base + total)
        for name in ("first", "count"):
            self._room(name, self.slot.given)
        self.ids[base : base + total] = ids
        slots = np.fromiter(map(self.slot.__getitem__, new), np.int64, len(new))
        self.count[slots], self.first[slots] = sizes, base + np.cumsum(sizes) - sizes
        self.used += total

    def _learn(self, new: list[str]) -> list[str]:
        if new and not self.offsets:
            self._store(*self._found(new))
        elif new:
            found = self.tokenizer.encode_batch(new, add_special_tokens=False)
            rows, base = [e.ids for e in found], self.used
            sizes = np.fromiter(map(len, rows), np.int64, len(rows))
            self._store(new, np.fromiter(chain.from_iterable(rows), np.int32, int(sizes.sum())), sizes)
            for name in ("begins", "ends"):
                self._room(name, self.used)
            pairs = np.fromiter(chain.from_iterable(chain.from_iterable(e.offsets for e in found)), np.int32, 2 * (self.used - base))
            self.begins[base : self.used], self.ends[base : self.used] = pairs[0::2], pairs[1::2]
        return new

    def _learn_words(self, new: list[str]) -> list[str]:
        """Learn words and their unknown chunks, which are returned. The ids of a word are those of its chunks in a row."""
        single, several, parts, n = [], [], [], []
        for word in new:
            chunks = () if self.one_word(word) else self.chunks.findall(word)
            if len(chunks) > 1:
                several.append(word)
                parts += chunks
                n.append(len(chunks))
            else:
                single.append(word)
        slots = np.fromiter(map(self.slot.__getitem__, parts), np.int64, len(parts))
        single += self.slot.new
        self.slot.new = []
        self._learn(single)
        self._hit(slots)
        sizes, at = self._spread(slots)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        self._store(several, self.ids[at], np.diff(upto[np.concatenate([[0], np.cumsum(n, dtype=np.int64)])]))
        return single + several

    def _cut(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each chunk or word of all texts in a row, and their number per text."""
        if not self.by_words:
            cut = [self.chunks.findall(t) for t in texts]
            n = np.fromiter(map(len, cut), np.int64, len(cut))
            return np.fromiter(map(self.slot.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum())), n
        cut = pa.compute.ascii_split_whitespace(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        words = cut.flatten().dictionary_encode()  # each different word is looked up once
        slots = np.fromiter(map(self.slot.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(words.dictionary))
        return slots[words.indices.to_numpy()], pa.compute.list_value_length(cut).to_numpy().astype(np.int64)

    def encode(self, texts: list[str] | pa.Array) -> tuple[np.ndarray, ...]:
        """Ids of all texts in a row, ids per text, and if asked the character ranges of each id in its text."""
        if self.slot.given > self.memo_chunks:
            self._forget()
        slots, n = self._cut(texts)
        new, self.slot.new = self.slot.new, []
        learn = self._learn_words if self.by_words else self._learn
        learn([c for c in new if len(c) <= MEMO_LENGTH])
        kept = self.used
        passing = learn([c for c in new if len(c) > MEMO_LENGTH])
        self._hit(slots)
        sizes, at = self._spread(slots)
        upto = np.concatenate([[0], np.cumsum(sizes)])
        bounds = upto[np.concatenate([[0], np.cumsum(n)])]
        result = self.ids[at], np.diff(bounds)
        if self.offsets:
            starts = np.fromiter(chain.from_iterable((m.start() for m in self.chunks.finditer(t)) for t in texts), np.int64, len(slots))
            shift = np.repeat(starts, sizes)
            result += ((self.begins[at] + shift).astype(np.int32), (self.ends[at] + shift).astype(np.int32))
        for chunk in passing:  # long ones were added last and seldom come again
            del self.slot[chunk]
        self.used = kept
        return result


_ENCODERS: dict[tuple, ChunkEncoder] = {}


def encoder(tokenizer_file: str, chunks: re.Pattern = SPACED, offsets: bool = False) -> ChunkEncoder:
    """The encoder of this worker process, kept between tasks. A task has one core, so the library's own threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    key = tokenizer_file, chunks.pattern, offsets
    if key not in _ENCODERS:
        _ENCODERS[key] = ChunkEncoder(tokenizer_file, chunks, offsets)
    return _ENCODERS[key]


def lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    bounds = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(flat, kind))


def packed(flat: np.ndarray, counts: np.ndarray) -> pa.Array:
    """One binary value per list: its ids as little-endian unsigned 32-bit integers."""
    bounds = np.concatenate([[0], np.cumsum(counts) * 4]).astype(np.int32)
    data = pa.py_buffer(flat.astype("<u4").tobytes())
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(bounds), data])


def encode_texts(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False, pack: bool = False) -> DataFrame:
    """Token ids of every whole text: ``id_col, n_tokens, ids`` and with ``offsets`` also ``begins, ends``.

    ``begins[i]:ends[i]`` are the characters that token i touches; a character split over several tokens is in the
    range of each. With ``pack`` the ids are one binary value of little-endian 32-bit integers, which moves
    between processes without a copy per element. An empty table gives an empty result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(tokenizer_file, offsets=offsets)
        for step in text_steps(batches, "text"):
            texts = pa.compute.fill_null(step.column("text"), "").to_pylist()
            flat, counts, *ranges = bpe.encode(texts)
            ids = packed(flat, counts) if pack else lists(flat, counts, pa.int32())
            arrays = [step.column("id"), pa.array(counts, pa.int64()), ids, *(lists(r, counts, pa.int32()) for r in ranges)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_tokens", "ids", "begins", "ends"][: len(arrays)])

    kind = df.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids {'binary' if pack else 'array<int>'}" + ", begins array<int>, ends array<int>" * offsets
    source = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_arrow(source, run, schema).withColumnRenamed("id", id_col)


def token_bytes(tokenizer_file: str) -> list[bytes]:
    """The bytes of each id, by the byte table backwards; ids without a token are empty."""
    table = byte_table()
    vocabulary = Tokenizer.from_file(tokenizer_file).get_vocab(with_added_tokens=True)
    found = [b""] * (max(vocabulary.values(), default=-1) + 1)
    for token, i in vocabulary.items():
        found[i] = bytes(map(table.__getitem__, token)) if all(c in table for c in token) else token.encode()
    return found


def decode_ids(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col, bytes, text`` of lists or packed lists of ids.

    The bytes of all tokens are joined before they are read as UTF-8, so a character split over tokens is whole again;
    bytes that are no UTF-8 (a list that begins or ends inside a character) become U+FFFD in ``text``, not in ``bytes``.
    A null list gives nulls; an id outside the vocabulary is an error.
    """
    is_binary = df.schema[ids_col].dataType.typeName() == "binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(tokenizer_file)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                step = batch.slice(begin, 256)
                rows = step.column("ids").to_pylist()
                if is_binary:
                    rows = [None if r is None else np.frombuffer(r, "<u4").tolist() for r in rows]
                joined = [None if r is None else b"".join(map(table.__getitem__, r)) for r in rows]
                texts = [None if b is None else b.decode("utf-8", "replace") for b in joined]
                yield pa.RecordBatch.from_arrays([step.column("id"), pa.array(joined, pa.binary()), pa.array(texts, pa.string())], ["id", "bytes", "text"])

    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))
    return map_arrow(source, run, f"id {kind}, bytes binary, text string").withColumnRenamed("id", id_col)


def round_trip_digests(encoded: DataFrame, tokenizer_file: str, id_col: str = "doc_id") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256`` of packed ids from ``encode_texts``.

    The first digest is of the decimal ids joined by one blank, the second of the bytes that the ids decode to. Both are
    taken next to the decoding, so neither the decimal forms nor the decoded bytes leave the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(token_bytes(tokenizer_file), dtype=object)
        decimal = np.array([str(i) for i in range(len(table))], dtype=object)
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                step = batch.slice(begin, 256)
                rows = [np.frombuffer(r, "<u4") for r in step.column("ids").to_pylist()]
                ids = [hashlib.sha256(" ".join(decimal[r].tolist()).encode()).hexdigest() for r in rows]
                texts = [hashlib.sha256(b"".join(table[r].tolist())).hexdigest() for r in rows]
                yield pa.RecordBatch.from_arrays([step.column("id"), step.column("n_tokens"), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = encoded.schema[id_col].dataType.simpleString()
    source = encoded.withColumnRenamed(id_col, "id").select("id", "n_tokens", "ids")
    return map_arrow(source, run, f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string").withColumnRenamed("id", id_col)
