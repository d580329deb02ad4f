"""Language-model scores by context-tree weighting over bytes.

A byte is eight binary decisions along its bits. Each decision has a context tree of its own over the ``DEPTH`` bytes before; each
node of a tree holds how often the bit was 0 and 1 there, and the Krichevsky-Trofimov estimate of that sequence. The weighted
probability of a node is half its own estimate and half the product of its children, so the share of a node against all
below it follows from the counts. Scoring walks from the root to the deepest context that was seen and mixes the estimates
of all depths by these shares. Texts are scored with A-Z in small letters, from an empty context to an end mark.

Spark deals documents into chunks. A chunk sends its distinct (context, byte) keys with their counts to shards, by the last
two bytes of the context; a shard merges the counts of all chunks, builds the trees below these two bytes, and answers each
chunk with one log-probability per key. The two top levels are summed over all shards; they are at most 256 * 255 nodes, whatever the
corpus. Words for the unigram baseline go the same way, by hash. Nothing that grows with the corpus passes the driver.
"""

from __future__ import annotations

import math
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrow import on_workers

#: Bytes of context, bytes of text in a chunk, positions handled at once, chunks for each shard.
DEPTH, CHUNK_BYTES, STEP, CHUNKS_PER_SHARD = 5, 16 << 20, 1 << 20, 2
#: A byte that UTF-8 never holds: the context before a text, and its end.
EDGE = 0xFF
# What a word is.
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
END_WORD = np.uint64(0)
BYTES, WORDS = 0, 1


def _lgamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for positive x, by Stirling's series from 8 on."""
    shift = np.zeros_like(x)
    x = x.copy()
    for _ in range(8):
        low = x < 8
        shift[low] += np.log(x[low])
        x[low] += 1
    return (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return _lgamma(zeros + 0.5) + _lgamma(ones + 0.5) - _lgamma(zeros + ones + 1) - math.log(math.pi)


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[first], np.add.reduceat(counts, first)


def position_keys(texts: list[bytes], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """(context, byte) keys of all bytes and end marks of the texts, and the number of keys per text."""
    edge = bytes([EDGE])
    data = np.frombuffer(b"".join(chain.from_iterable((edge * depth, t, edge) for t in texts)), np.uint8)
    keys = np.zeros(len(data), np.uint64)
    for back in range(depth + 1):
        keys[back:] |= data[: len(data) - back].astype(np.uint64) << np.uint64(8 * back)
    counts = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    at = np.repeat(np.cumsum(counts) - counts + depth * np.arange(1, len(texts) + 1), counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return keys[at], counts


def key_shard(keys: np.ndarray, kind: int, shards: int) -> np.ndarray:
    """Contexts by their last two bytes, so that a shard has whole trees from depth two on; words by their hash."""
    part = keys if kind == WORDS else (keys >> np.uint64(8)) & np.uint64(0xFFFF)
    return ((part * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % shards


class Level:
    """The binary nodes of one depth and bit: sorted keys (context, bits so far), counts and weights."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray):
        self.keys, self.zeros, self.ones = keys, zeros.astype(float), ones.astype(float)
        self.own = log_kt(self.zeros, self.ones)
        self.estimate = (self.ones + 0.5) / (self.zeros + self.ones + 1)

    def weigh(self, below: np.ndarray | None) -> None:
        """``below``: log-probability of all children together, none at the greatest depth."""
        if below is None:
            self.weighted, self.share = self.own, np.ones(len(self.keys))
        else:
            self.weighted = np.logaddexp(self.own, below) - math.log(2)
            self.share = np.exp(self.own - math.log(2) - self.weighted)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return at, self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)


def _mask(depth: int) -> np.uint64:
    return np.uint64((1 << (8 * (depth + 1))) - 1)


def node_keys(keys: np.ndarray, bit: int) -> np.ndarray:
    """The key's context with the bits that come before ``bit``, behind a leading one."""
    return keys & ~np.uint64(0xFF) | np.uint64(1 << bit) | (keys & np.uint64(0xFF)) >> np.uint64(8 - bit)


def levels_of(keys: np.ndarray, counts: np.ndarray, depth: int) -> list[Level]:
    """The eight bits' nodes at ``depth`` from keys with counts of any greater depth."""
    keys, counts = summed(keys & _mask(depth), counts.astype(float))
    out = []
    for bit in range(8):
        nodes = node_keys(keys, bit)
        ones = (keys >> np.uint64(7 - bit) & np.uint64(1)).astype(float) * counts
        first = np.flatnonzero(np.append(True, nodes[1:] != nodes[:-1])) if len(nodes) else np.empty(0, np.int64)
        total, one = (np.add.reduceat(c, first) if len(first) else np.empty(0) for c in (counts, ones))
        out.append(Level(nodes[first], total - one, one))
    return out


def trees(keys: np.ndarray, counts: np.ndarray, top: int, depth: int = DEPTH) -> dict[int, list[Level]]:
    """Weighted levels from ``depth`` up to ``top`` of the keys that have a count."""
    seen = counts > 0
    keys, counts = keys[seen], counts[seen]
    found = {d: levels_of(keys, counts, d) for d in range(top, depth + 1)}
    for d in range(depth, top - 1, -1):
        for bit, level in enumerate(found[d]):
            below = None
            if d < depth:
                child = found[d + 1][bit]
                at, _ = level.find(child.keys & _mask(d))
                below = np.bincount(at, child.weighted, len(level.keys)) if len(child.keys) else np.zeros(len(level.keys))
            level.weigh(below)
    return found


def log_probabilities(keys: np.ndarray, levels: dict[int, list[Level]], depth: int = DEPTH) -> np.ndarray:
    """log10 of each key's byte in its context, mixed over all depths down to the deepest node that was seen."""
    total = np.zeros(len(keys))
    for bit in range(8):
        nodes = node_keys(keys, bit)
        mixed, left = np.zeros(len(keys)), np.ones(len(keys))
        for d in range(depth + 1):
            level = levels[d][bit]
            if not len(level.keys):
                continue
            at, seen = level.find(nodes & _mask(d))
            mixed += np.where(seen, left * level.share[at] * level.estimate[at], 0.0)
            left = np.where(seen, left * (1 - level.share[at]), left)
        one = mixed + left * 0.5  # below the deepest node nothing was seen: even odds
        total += np.log10(np.where(keys >> np.uint64(7 - bit) & np.uint64(1), one, 1 - one))
    return total


def _words(texts: list[bytes], table: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in ``table`` of all words, new ones added, and the number of words per text."""
    cut = [WORD.findall(t) for t in texts]
    for word in set(chain.from_iterable(cut)).difference(table):
        table[word] = len(table)
    n = np.fromiter(map(len, cut), np.int64, len(cut))
    return np.fromiter(map(table.__getitem__, chain.from_iterable(cut)), np.int64, int(n.sum())), n


def _hashes(table: dict[bytes, int]) -> np.ndarray:
    """Hashes of the words in order of their numbers; 0 is kept for the end mark."""
    return np.fromiter((xxhash.xxh3_64_intdigest(w) or 1 for w in table), np.uint64, len(table))


def _steps(texts: list[bytes]):
    begin = held = 0
    for i, t in enumerate(texts):
        if i > begin and held + len(t) > STEP:
            yield begin, i
            begin, held = i, 0
        held += len(t)
    if begin < len(texts):
        yield begin, len(texts)


def _lowered(rows: pa.Table) -> list[bytes]:
    return [(t or "").encode().lower() for t in rows.column("text").to_pylist()]


def chunk_keys(texts: list[bytes], train: np.ndarray, depth: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Distinct keys of a chunk with their counts in training texts, for bytes and for words."""
    keys, counts, table, tally = [], [], {}, np.zeros(0)
    for a, b in _steps(texts):
        own, n = position_keys(texts[a:b], depth)
        k, c = summed(own, np.repeat(train[a:b], n).astype(np.int64))
        keys.append(k)
        counts.append(c)
        numbers, n = _words(texts[a:b], table)
        grown = np.zeros(len(table))
        grown[: len(tally)] = tally
        tally = grown + np.bincount(numbers, np.repeat(train[a:b], n), len(table))
    k, c = summed(np.concatenate(keys), np.concatenate(counts)) if keys else (np.empty(0, np.uint64), np.empty(0, np.int64))
    words, word_counts = summed(np.append(_hashes(table), END_WORD), np.append(tally, train.sum()).astype(np.int64))
    return {BYTES: (k, c), WORDS: (words, word_counts)}


def dealt(keys: np.ndarray, kind: int, shards: int) -> tuple[np.ndarray, list[int], list[np.ndarray]]:
    """Sorted keys dealt to shards: their order by shard, the shards that get any, and the places of each one's keys."""
    shard = key_shard(keys, kind, shards)
    order = np.argsort(shard, kind="stable")
    if not len(order):
        return order, [], []
    cuts = np.flatnonzero(np.diff(shard[order])) + 1
    parts = np.split(order, cuts)
    return order, [int(shard[p[0]]) for p in parts], parts


BLOB = "chunk bigint, shard bigint, kind int, keys binary, counts binary"


def _requests(chunked: DataFrame, shards: int, depth: int) -> DataFrame:
    def run(rows: pa.Table) -> pa.Table:
        chunk = rows.column("chunk")[0].as_py()
        train = rows.column("train").to_numpy(zero_copy_only=False).astype(float)
        out = []
        for kind, (keys, counts) in chunk_keys(_lowered(rows), train, depth).items():
            _, names, parts = dealt(keys, kind, shards)
            out += [(chunk, shard, kind, keys[p].tobytes(), counts[p].astype(np.int64).tobytes()) for shard, p in zip(names, parts, strict=True)]
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=["chunk", "shard", "kind", "keys", "counts"])

    return chunked.groupBy("chunk").applyInArrow(run, BLOB)


def _merged(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(b"".join(rows.column("keys").to_pylist()), np.uint64)
    return summed(keys, np.frombuffer(b"".join(rows.column("counts").to_pylist()), np.int64))


def _top(requests: DataFrame, depth: int) -> tuple[dict[int, list[Level]], float, float]:
    """The levels of depth 0 and 1, the number of training tokens and of distinct ones, summed over all shards."""

    def run(rows: pa.Table) -> pa.Table:
        keys, counts = _merged(rows)
        if rows.column("kind")[0].as_py() == WORDS:
            out = [(-1, 0, float(counts.sum()), float((counts > 0).sum()), 0.0)]
        else:
            # What depth two adds to each node of depth one.
            out = []
            for bit, level in enumerate(trees(keys, counts, 2, depth)[2]):
                above, at = np.unique(level.keys & _mask(1), return_inverse=True)
                sums = [np.bincount(at, c, len(above)).tolist() for c in (level.zeros, level.ones, level.weighted)]
                out.extend(zip([bit] * len(above), above.tolist(), *sums, strict=True))
        kinds = (pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64())
        columns = zip(*out, strict=True) if out else [()] * 5
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["bit", "node", "zeros", "ones", "below"])

    parts = requests.groupBy("kind", "shard").applyInArrow(run, "bit int, node bigint, zeros double, ones double, below double")
    rows = parts.groupBy("bit", "node").agg(F.sum("zeros"), F.sum("ones"), F.sum("below")).collect()  # at most 256 * 255 nodes and one row
    levels: dict[int, list[Level]] = {0: [], 1: []}
    for bit in range(8):
        own = sorted(tuple(r)[1:] for r in rows if r.bit == bit)
        node, zeros, ones, below = (np.array(c, float) for c in zip(*own, strict=True)) if own else (np.empty(0),) * 4
        one = Level(node.astype(np.uint64), zeros, ones)
        one.weigh(below)
        keys, at = np.unique(one.keys & np.uint64(0xFF), return_inverse=True)
        root = Level(keys, *(np.bincount(at, c, len(keys)) for c in (zeros, ones)))
        root.weigh(np.bincount(at, one.weighted, len(keys)))
        levels[0].append(root)
        levels[1].append(one)
    tokens, distinct = next(((r[2], r[3]) for r in rows if r.bit == -1), (0.0, 0.0))
    return levels, tokens, distinct


def _answers(requests: DataFrame, top: dict[int, list[Level]], depth: int) -> DataFrame:
    """For each request one value per key: log10 of the byte's probability, or the word's count."""

    def run(rows: pa.Table) -> pa.Table:
        keys, counts = _merged(rows)
        kind = rows.column("kind")[0].as_py()
        values = counts.astype(float) if kind == WORDS else log_probabilities(keys, {**top, **trees(keys, counts, 2, depth)}, depth).astype(np.float32)
        found = [values[np.searchsorted(keys, np.frombuffer(k, np.uint64))].tobytes() for k in rows.column("keys").to_pylist()]
        return pa.table([rows.column("chunk"), rows.column("shard"), rows.column("kind"), pa.array(found, pa.binary())], names=["chunk", "shard", "kind", "values"])

    return requests.groupBy("kind", "shard").applyInArrow(run, "chunk bigint, shard bigint, kind int, values binary")


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys, and for each key its number among them."""
    order = np.argsort(keys)
    held = keys[order]
    new = np.append(True, held[1:] != held[:-1])
    numbers = np.empty(len(keys), np.int32)
    numbers[order] = np.cumsum(new) - 1
    return held[new], numbers


def _scored(chunked: DataFrame, answers: DataFrame, id_type: str, shards: int, depth: int) -> DataFrame:
    def run(rows: pa.Table, given: pa.Table) -> pa.Table:
        texts, table, steps = _lowered(rows), {}, []
        for a, b in _steps(texts):
            keys, n = position_keys(texts[a:b], depth)
            steps.append((*_numbered(keys), n, *_words(texts[a:b], table)))
        if not steps:
            none = [pa.array([], pa.int64())] * 3 + [pa.array([], pa.float64())] * 2
            return pa.table([rows.column("id"), *none], names=["id", "n_symbols", "n_tokens", "n_known", "logs", "score"])

        def values_of(kind: int, keys: np.ndarray) -> np.ndarray:
            """The answers, which come by shard, in order of the sorted keys that were asked."""
            own = given.filter(pa.compute.equal(given.column("kind"), kind)).sort_by("shard")
            out = np.empty(len(keys))
            out[dealt(keys, kind, shards)[0]] = np.frombuffer(b"".join(own.column("values").to_pylist()), float if kind == WORDS else np.float32)
            return out

        symbols, _ = _numbered(np.concatenate([s[0] for s in steps]))
        log_p = values_of(BYTES, symbols)
        hashes = np.append(_hashes(table), END_WORD)
        words, at = _numbered(hashes)
        counts = values_of(WORDS, words)[at]
        known, logs = counts > 0, np.log10(counts + 0.5)
        out = []
        for keys, numbers, n, word, w in steps:
            score = np.add.reduceat(log_p[np.searchsorted(symbols, keys)][numbers], np.cumsum(n) - n)
            seen, sums = (np.concatenate([[0.0], np.cumsum(c[word])]) for c in (known, logs))
            upto = np.concatenate([[0], np.cumsum(w)])
            out.append((n, w + 1, np.diff(seen[upto]) + known[-1], np.diff(sums[upto]) + logs[-1], score))
        n, tokens, n_known, base, score = (np.concatenate(c) for c in zip(*out, strict=True))
        arrays = [rows.column("id"), pa.array(n.astype(np.int64)), pa.array(tokens.astype(np.int64)), pa.array(n_known.astype(np.int64)), pa.array(base), pa.array(score)]
        return pa.table(arrays, names=["id", "n_symbols", "n_tokens", "n_known", "logs", "score"])

    schema = f"id {id_type}, n_symbols bigint, n_tokens bigint, n_known bigint, logs double, score double"
    return chunked.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def score_texts(df: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """``id_col, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte`` of every whole text.

    ``train`` is the condition on rows that the model learns from (null counts as false). ``score`` is log10 of the probability of the
    text's bytes and its end mark under the context trees, ``bits_per_byte`` the code length for each of these symbols.
    ``base_score`` adds log10((c + 0.5) / (N + 0.5 (V + 1))) over words and one end mark, by counts in the training rows. A null text
    is empty and scores its end mark only. A very long text is part of one chunk; numpy holds some tens of bytes for each of its bytes at once. Repeated rows count and are scored one by one. An empty table gives an empty result;
    without training rows the byte odds are even.
    """
    on_workers(df.sparkSession)
    source = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(train, F.lit(False)).alias("train"))
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(1, -(-size // CHUNK_BYTES))
    shards = max(4, chunks // CHUNKS_PER_SHARD)
    # Rows, not texts, are dealt out, so copies of one text are spread.
    chunked = source.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(chunks)))
    requests = materialize(_requests(chunked, shards, depth), "requests")
    top, tokens, distinct = _top(requests, depth)
    rows = _scored(chunked, _answers(requests, top, depth), df.schema[id_col].dataType.simpleString(), shards, depth)
    base = F.col("logs") - F.col("n_tokens") * math.log10(tokens + 0.5 * (distinct + 1))
    bits = -F.col("score") * math.log2(10) / F.col("n_symbols")
    return rows.select(F.col("id").alias(id_col), "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), "score", bits.alias("bits_per_byte"))
