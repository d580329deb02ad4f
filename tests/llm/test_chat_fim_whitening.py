"""Chat assembly, fill-in-middle and whitening against brute force, with nulls, ties, repeats, long texts and clashing columns."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
from fractions import Fraction

import numpy as np
import oracle
import pytest
from pyspark.sql import functions as F

from tributary.llm import charpoly, chat, fim, queries, whitening

SF_DIR = "/root/testdata/sf0.001"
MARKED = ["", "ok", "\\", "\\\\", "<turn>", "</turn>", "\\</turn>", "\\\\</turn> x \\", "### Assistant:", "#### User: hi", "a\n</turn>\n", "<|endoftext|>", "é中😀 ### Text: ### Role:", "<turn", "turn>"]


# --- 11: chat


CHAT = "conv_id bigint, turn bigint, role string, text string, block bigint, ids string, id int, packed double"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", 1, 0.5) for r in rows], CHAT).repartition(4)


def chat_rows():
    rng = random.Random(5)
    roles = ["system", "user", "assistant", "Assistant", "tool </turn>", None, ""]
    rows = [(c, t, rng.choice(roles), rng.choice(MARKED) + rng.choice(MARKED)) for c in range(20) for t in range(rng.randrange(1, 6))]
    rows += [(50, t, "assistant" if t % 2 else "user", f"turn {t} \\") for t in range(700)]  # several blocks
    rows += [(51, t, "assistant", " ".join(f"w{i}" for i in range(30_000))) for t in range(3)]  # several pieces
    rows += [(52, 10**15, "user", None), (52, None, "assistant", "first"), (52, -5, "assistant", "second")]
    rows += [(None, 1, "user", "a"), (None, 0, "assistant", "b")]
    rows += [(53, 0, "user", "again")] * 3 + [(54, 7, "assistant", "tie"), (54, 7, "Assistant", "tie")]
    return rows


def wanted_turns(rows):
    found = collections.defaultdict(list)
    for c, t, role, text in rows:
        found[c].append((t is not None, t, role or "", text or ""))
    return {c: [turn[2:] for turn in sorted(turns, key=lambda x: (x[0], x[1] or 0, x[2]))] for c, turns in found.items()}


def shown(role, text):
    mark = lambda s: re.sub(chat.CONTROL, lambda m: "\\" + m[0], s)
    head = {"system": "### System:", "user": "### User:", "assistant": "### Assistant:"}.get(role) or f"### Role:{mark(role)}\n### Text:"
    return f"<turn>{head}{mark(text)}\n</turn>\n"


def test_chats_come_back(spark, tmp_path):
    rows = chat_rows()
    want = wanted_turns(rows)
    path = str(tmp_path / "chats")
    chat.write_chats(chats(spark, rows), path, queries.BYTE_BPE)
    written = chat.read_chats(spark, path)
    assert written.where("conv_id = 50").agg(F.count_distinct("block")).first()[0] == 3 and written.where("conv_id = 51").count() > 1
    turns = sorted(chat.read_turns(written, queries.BYTE_BPE).collect(), key=lambda r: (r.block, r.piece, r.place))
    got = collections.defaultdict(list)
    for r in turns:
        got[r.conv_id].append((r.role, r.text))
        assert (r.learned or "") == (r.text if r.role == "assistant" else "")
    assert got == want
    texts = collections.defaultdict(str)
    for r in sorted(chat.chat_texts(written, queries.BYTE_BPE).collect(), key=lambda r: (r.block, r.piece)):
        texts[r.conv_id] += r.formatted
    assert texts == {c: "".join(shown(*t) for t in turns) for c, turns in want.items()}
    digests = {r.conv_id: r for r in chat.chat_digests(written, queries.BYTE_BPE).collect()}
    assert set(digests) == set(want)
    for c, turns in want.items():
        loss = "".join(text for role, text in turns if role == "assistant")
        r = digests[c]
        assert (r.n_turns, r.loss_chars, r.formatted_chars) == (len(turns), len(loss), len(texts[c]))
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_no_chats(spark):
    none = chat.format_chats(chats(spark, []), queries.BYTE_BPE)
    assert none.count() == 0 and chat.chat_digests(none, queries.BYTE_BPE).count() == 0


def test_reserved_ids_never_come_from_texts(spark):
    pieces = chat.format_chats(chats(spark, [(1, i, "user", t) for i, t in enumerate(MARKED)]), queries.BYTE_BPE).collect()
    reserved = collections.Counter(i for p in pieces for i in p.ids if i >= 50257)
    assert reserved == {50257: len(MARKED), 50258: len(MARKED), 50260: len(MARKED)} and not any(any(p.loss_mask) for p in pieces)
    own = chat.format_chats(chats(spark, [(1, 0, "assistant", "a b")]), queries.BYTE_BPE, reserved=100_000).first()
    assert own.ids[:2] == [100_000, 100_004] and own.ids[-1] == 100_001 and own.loss_mask == [False, False, *[True] * (len(own.ids) - 3), False]


@pytest.mark.parametrize("text", [a + b + c for a in MARKED for b in MARKED for c in ("", "\\", ":")])
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not re.search(rf"(?<!\\)(?:{chat.CONTROL})", chat.escape(text))


# --- 12: fill-in-middle


UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def test_borders_equal_the_pattern():
    rng = random.Random(1)
    for _ in range(400):
        text = "".join(rng.choice("aZz@[`{ é中😀\n09") for _ in range(rng.choice([0, 1, 7, 8, 9, 15, 16, 17, 40])))
        units, found = UNIT.findall(text), fim.Units(text.encode())
        assert found.count == len(units)
        for k in range(len(units) + 1):
            at = found.select(k)
            assert at == len("".join(units[:k]).encode())
            begin = found.select(rng.randrange(k + 1))
            assert found.characters(begin, at) == len(text.encode()[begin:at].decode())


def test_borders_over_several_blocks():
    text = "ab é中z " * 200_000 + "x" * 3_000_000 + "."
    units, found = UNIT.findall(text), fim.Units(text.encode())
    assert found.count == len(units)
    for k in (1, 400_001, 1_000_000, len(units) - 1, len(units)):
        assert found.select(k) == len("".join(units[:k]).encode())
    assert found.characters(0, len(text.encode())) == len(text)


def middle_of(i, text):
    h = [int(hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()[8 * j : 8 * j + 8], 16) for j in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(u) for u in (units[:a], units[a:b], units[b:]))
    if not text or h[2] % 100 >= 90 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return n, "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"


def test_fill_in_middle(spark):
    rng = random.Random(2)
    texts = ["", None, "a", "<P>", "x <M> y", "<S", "<", ">P<S", "<<PS>>", "ab" * 700_000 + " é", *("".join(rng.choice("aZ<>PSM é中😀\n") for _ in range(rng.randrange(60))) for _ in range(300))]
    rows = [(i, t, 5, "psm", "o") for i, t in enumerate(texts)] + [(None, "no id <", 5, None, None), (7, "a repeated id", 1, None, None), (7, "a repeated id", 1, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n int, form string, output string").repartition(3)
    made = fim.fill_in_middle(df).withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    got = collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made)
    assert got == collections.Counter((i, *middle_of(i, t or "")) for i, t, *_ in rows)
    assert collections.Counter((r.doc_id, r.back) for r in made) == collections.Counter((i, t or "") for i, t, *_ in rows)
    assert {r.form for r in made} == {"plain", "psm", "spm"} and fim.fill_in_middle(df.limit(0)).count() == 0


# --- 13: whitening


def determinant_polynomial(matrix):
    """Coefficients of det(x - matrix) by traces of powers, in fractions."""
    d = len(matrix)
    a = [[Fraction(v) for v in row] for row in matrix]
    mul = lambda x, y: [[sum(x[i][k] * y[k][j] for k in range(d)) for j in range(d)] for i in range(d)]
    coefficients, m = [Fraction(1)], [[Fraction(0)] * d for _ in range(d)]
    for k in range(1, d + 1):
        m = mul(a, m)
        for i in range(d):
            m[i][i] += coefficients[-1]
        am = mul(a, m)
        coefficients.append(-sum(am[i][i] for i in range(d)) / k)
    return [int(c) for c in reversed(coefficients)]


def test_polynomial_is_exact():
    rng = random.Random(3)
    for d in (1, 2, 3, 6):
        for zeros in (0.0, 0.6):
            rows = [[0 if rng.random() < zeros else rng.randrange(-(10**12), 10**12) for _ in range(d)] for _ in range(4)]
            matrix = [[sum(r[i] * r[j] for r in rows) for j in range(d)] for i in range(d)]
            primes = charpoly.primes_for(matrix)
            assert charpoly.remainder_lift([charpoly.polynomial_mod(matrix, p) for p in primes], primes) == determinant_polynomial(matrix)


def test_roots_are_counted_and_narrowed():
    wanted = [0, 0, 3, 3, 3, 1000, 1001]
    coefficients = [1]
    for r in wanted:
        coefficients = [a - r * b for a, b in zip([0, *coefficients], [*coefficients, 0], strict=True)]
    assert [charpoly.roots_above(coefficients, a) for a in (-1, 0, 2, 3, 1000, 1001)] == [7, 5, 5, 2, 1, 0]
    roots, bits = charpoly.largest_roots(coefficients, 7)
    assert [(r >> bits, m) for r, m in roots] == [(1001, 1), (1000, 1), (3, 3), (0, 2)] and roots[0][0] == 1001 << bits
    assert sum(m for _, m in charpoly.largest_roots(coefficients, 2)[0]) == 2


VECTORS = "vec_id bigint, embedding array<float>, label int, whitened string, deviation double, component int"


def vectors(spark, values, dtype="float"):
    schema = VECTORS.replace("array<float>", f"array<{dtype}>")
    return spark.createDataFrame([(i, v, 1, "w", 0.5, 2) for i, v in enumerate(values)], schema).repartition(3)


def whiten_by_numpy(kept, k):
    x = np.array([[math.floor(64 * np.float64(np.float32(c))) + 1_000_000 for c in v] for v in kept], object)
    n, s = len(x), x.sum(axis=0)
    centred = n * x - s
    values = (centred / n).astype(float)
    e, u = np.linalg.eigh(values.T @ values / n)
    return n, (centred**2).sum(axis=1), values @ u[:, ::-1][:, :k], e[::-1][:k], e.sum()


@pytest.mark.parametrize("d, k", [(5, 32), (40, 32), (3, 2)])
def test_whitening_equals_numpy(spark, d, k):
    rng = np.random.default_rng(d)
    good = (rng.normal(size=(300, d)) * np.linspace(1, 9, d)).astype(np.float32).tolist()
    bad = [None, [None, *good[0][1:]], [float("nan"), *good[0][1:]], [float("inf"), *good[0][1:]], [], good[0][:-1], [3e38] * d]
    df = vectors(spark, [*good, *bad, good[0]])
    model = whitening.fit(df, components=k)
    rows = {r.vec_id: r for r in whitening.transform(df, model).collect()}
    kept = [*good, good[0]]
    n, deviation, projected, e, trace = whiten_by_numpy(kept, k)
    assert model.n == n == 301 and set(rows) == {*range(300), 300 + len(bad)}
    got = np.array([rows[i].whitened for i in sorted(rows)])
    assert [rows[i].deviation for i in sorted(rows)] == deviation.tolist()
    want = projected / np.sqrt(e)
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-7 and np.allclose(model.explained, e / trace, rtol=1e-10)
    assert whitening.identity_error(df, model) < 1e-9


def test_equal_and_missing_variance(spark):
    rng = np.random.default_rng(1)
    base = rng.integers(-9, 9, (60, 2)).astype(float)
    signs = np.array([[a, b, c] for a in (1, -1) for b in (1, -1) for c in (1, -1)], float)
    for values, live in (([[a, b, b, 4.0] for a, b in base.tolist()], 2), (signs.tolist(), 3), ([[1.0, 2.0]] * 5, 0), ([[0.5]], 0)):
        df = vectors(spark, values, "double")
        model = whitening.fit(df)
        rows = whitening.transform(df, model).collect()
        assert len(rows) == len(values) and all([v is not None for v in r.whitened] == [True] * live + [False] * (len(values[0]) - live) for r in rows)
        assert whitening.identity_error(df, model) < 1e-9 and [s > 0 for s in model.explained].count(True) == live
        assert abs(sum(model.explained) - (live > 0)) < 1e-12


def test_whitening_of_nothing_and_of_large_entries(spark):
    for values in ([], [None], [[]]):
        df = vectors(spark, values)
        model = whitening.fit(df)
        assert model.n == 0 and whitening.transform(df, model).count() == 0 and whitening.identity_error(df, model) == 0.0
    large = [[float(1 << 50) * a, -float(3 << 48) * b, 1.0] for a in range(-3, 4) for b in range(5)]
    df = vectors(spark, large, "double")
    model = whitening.fit(df)
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in large]
    sums = [sum(c) for c in zip(*x, strict=True)]
    exact = [sum((len(x) * a - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    rows = sorted(whitening.transform(df, model).collect(), key=lambda r: r.vec_id)
    assert [r.deviation for r in rows] == [e if e < 1 << 63 else None for e in exact] and whitening.identity_error(df, model) < 1e-9
    _, _, matrix = whitening.scatter(df, "embedding", 3)
    assert matrix == [[len(x) * sum(r[i] * r[j] for r in x) - sums[i] * sums[j] for j in range(3)] for i in range(3)]


# --- registered queries


@pytest.mark.parametrize("name", ["op2_passages", "op5_sorted_passes", "op10_bottom_k", "op11_chat", "op12_middle"])
def test_query_equals_its_sql(spark, name):
    assert oracle.compare(queries.QUERIES[name](spark, SF_DIR), oracle.connect(SF_DIR), queries.ORACLE[name]) is None


def test_whitening_query(spark):
    rows = queries.op13_whitening(spark, SF_DIR).collect()
    given = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    n, deviation, projected, e, trace = whiten_by_numpy(list(given.values()), 32)
    want = dict(zip(given, projected / np.sqrt(e), strict=True))
    exact = dict(zip(given, deviation, strict=True))
    assert len(rows) == 32 * n and {r.n for r in rows} == {n} and rows[0].identity_error < 1e-9
    assert all(r.deviation == exact[r.vec_id] and math.isclose(r.explained, e[r.component - 1] / trace, rel_tol=1e-9) for r in rows)
    sign = {c: math.copysign(1, sum(r.whitened * want[r.vec_id][c - 1] for r in rows if r.component == c)) for c in range(1, 33)}
    assert max(abs(r.whitened - sign[r.component] * want[r.vec_id][r.component - 1]) for r in rows) < 1e-6
