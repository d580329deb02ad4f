"""Training-data operators against brute force on small tables with nulls, repeats, ties and clashing columns."""

from __future__ import annotations

import base64
import collections
import hashlib
import math
import random
import re
import weakref
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tributary.llm import bpe, components, ctw, lexicon, minhash, packing, passages, queries, runindex, sketch, token_files, toxicity, urls, vectors
from tributary.llm.arrow import text_key

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, label int"
LETTERS = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, texts, ids=None):
    """Documents with further columns whose names clash with those of results."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, None, "s", None, 0.5, "k", 7) for i, t in zip(ids, texts, strict=True)], DOCS).repartition(3)


def prose(rng, n):
    return " ".join(rng.choice(["alpha", "Beta", "gamma,", "delta", "épsilon", "zeta.", "eta", "theta", "iota", "Kappa"]) + str(rng.randrange(40)) for _ in range(n))


AWKWARD = ["", None, " ", "\n\n \t", "a", "a b c d", "x" * 3000, "中文　字 é́ 😀", "it's  DON'T 12 34\t\t5 <|endoftext|>", "a b c d", None]


# --- 3, 8: tokenizers


def reference_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def odd_texts():
    rng = random.Random(1)
    signs = list("aZz.,'’“ é\n\t\x0b\xa0\x1c 1½sdlvtr!?-") + ["'s", "́", "ſ", "İ"]
    return AWKWARD + ["".join(rng.choice(signs) for _ in range(30)) for _ in range(600)]


def test_byte_bpe_matches_the_ranks_and_comes_back(spark):
    texts = odd_texts()
    df = docs(spark, texts)
    want = reference_encoding()
    coded = bpe.encode_texts(df, queries.BYTE_BPE, offsets=True)
    back = {r.doc_id: r for r in bpe.decode_ids(coded, queries.BYTE_BPE).collect()}
    for r in coded.collect():
        text = texts[r.doc_id] or ""
        assert r.ids == want.encode_ordinary(text) and r.n_tokens == len(r.ids)
        assert back[r.doc_id].bytes == text.encode() and back[r.doc_id].text == text
        table = bpe.token_bytes(queries.BYTE_BPE)
        for i, b, e in zip(r.ids, r.begins, r.ends, strict=True):
            assert table[i] in text[b:e].encode()
    packed = {r.doc_id: r.ids for r in bpe.encode_texts(df, queries.BYTE_BPE, pack=True).collect()}
    assert all(np.frombuffer(packed[i], "<u4").tolist() == want.encode_ordinary(t or "") for i, t in enumerate(texts))
    assert bpe.encode_texts(df.limit(0), queries.BYTE_BPE).count() == 0


def test_a_list_that_splits_a_character(spark):
    ids = reference_encoding().encode_ordinary("😀")
    assert len(ids) > 1
    row = bpe.decode_ids(spark.createDataFrame([(1, ids[:1]), (2, None)], "doc_id long, ids array<int>"), queries.BYTE_BPE).orderBy("doc_id").collect()
    assert row[0].text == "�" and "😀".encode().startswith(row[0].bytes) and row[1].bytes is None


def test_token_files(spark, tmp_path):
    texts = odd_texts()[:200]
    ids = [i // 2 * 3 for i in range(198)] + [None, None]  # ties and nulls
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs(spark, texts, ids), path, queries.WORD_BPE)
    tokenizer = Tokenizer.from_file(queries.WORD_BPE)
    tokenizer.encode_special_tokens = True
    rows = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: (r.shard, r.seq))
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda i: (i is not None, i or 0))
    want = collections.Counter((i, *tokenizer.encode(t or "", add_special_tokens=False).ids, 1) for i, t in zip(ids, texts, strict=True))
    assert collections.Counter((r.doc_id, *r.ids) for r in rows) == want
    meta = sorted(token_files.read_metadata(spark, path).collect(), key=lambda r: r.start)
    assert [m.start for m in meta] == np.cumsum([0] + [len(r.ids) for r in rows])[:-1].tolist()
    sums = {(r.shard, r.seq): r.ids_crc32 for r in token_files.id_checksums(token_files.read_tokens(spark, path)).collect()}
    assert all(sums[r.shard, r.seq] == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)
    assert [r.doc_id for r in token_files.read_tokens(spark, path, F.col("doc_id") == 30).collect()] == [30, 30]
    import pyarrow.parquet as pq

    group = pq.read_metadata(next(p for p in (tmp_path / "tokens").glob("*.parquet"))).row_group(0)
    columns = {c.path_in_schema.split(".")[0]: c for c in (group.column(i) for i in range(group.num_columns))}
    assert "RLE_DICTIONARY" in columns["ids"].encodings and "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())


# --- 7: URLs


def test_url_rules_with_nesting(spark):
    rng = random.Random(5)
    hosts = ["org", "example.org", "a.example.org", "com", "x.com", "example.com"]
    paths = ["", "/", "/a", "/a/", "/a/b", "/ab", "/b?c"]
    rules = list({(rng.choice(hosts), rng.choice(paths[:-1])): rng.choice(["allow", "block"]) for _ in range(25)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    found = [f"http://{rng.choice(['', 'www.', 'A.'])}{rng.choice(hosts)}{rng.choice(paths)}{rng.choice(['', '#x', '?q=/a', 'é'])}" for _ in range(400)]
    found += [None, "", "no scheme/", "http://", "://org/a", "http://.org/a", "ftp://u@org:80/a", "x" * 5000, "http://" + "a." * 500 + "org/a"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(found)], "page_id long, url string, host string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0].translate(LETTERS)
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h.split(".")), len(p), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        return host, path, best and best[3], best[2] if best else "allow"

    for sweep_rows in (3, 100_000):
        got = {r.page_id: tuple(r)[1:] for r in urls.judge_urls(df, urls.rule_table(spark, rules), id_col="page_id", sweep_rows=sweep_rows).collect()}
        assert got == {i: judge(u) for i, u in enumerate(found)}
    assert {r.verdict for r in urls.judge_urls(df, urls.rule_table(spark, [(None, "/", "block"), ("org", "/", None)])).collect()} == {"allow"}
    assert urls.judge_urls(df.limit(0), urls.rule_table(spark, rules)).count() == 0


# --- 6: sketches


def test_tail_swap_and_sketches(spark):
    rng = random.Random(2)
    texts = [*AWKWARD, *(prose(rng, n) for n in (3, 5, 8, 60, 400, 400))]
    texts.append(texts[-1])
    ids = list(range(100, 100 + len(texts) - 1)) + [None]
    rows = sketch.tail_swapped(docs(spark, texts, ids)).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == len(texts)
    for k, i in enumerate(ids[:-1]):
        text, after = texts[k] or "", texts[(k + 1) % (len(ids) - 1)] or ""
        n = len(text) // 4
        assert by[i].edited == text[: len(text) - n] + after[:n]
    assert by[None].next_sketch is None and by[None].edited == texts[-1][: len(texts[-1]) - len(texts[-1]) // 4]
    same = [r.sketch for r in rows if r.text == texts[-1]]
    assert len(same) == 2 and same[0] == same[1]
    own = {r.text: r.sketch for r in rows}
    long = own[texts[-1]]
    assert all(h <= sketch.threshold(sketch.FRACTION) for h in long) and long == sorted(set(long)) and own[""] == [] and len(own["a"]) == 1
    pair = spark.createDataFrame([(long, own["a"], own[texts[-3]])], "a array<long>, b array<long>, c array<long>")
    r = pair.select(sketch.resemblance(F.col("a"), F.col("c")), sketch.containment(F.col("a"), F.col("a")), sketch.merge(F.col("a"), F.col("c"))).first()
    assert r[0] == len(set(long) & set(own[texts[-3]])) / len(set(long) | set(own[texts[-3]])) and r[1] == 1.0
    assert r[2] == sorted(set(long) | set(own[texts[-3]]))
    assert sketch.tail_swapped(docs(spark, texts).limit(0)).count() == 0


# --- 10: near duplicates


def shingles(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LETTERS)) if w]
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def near_texts(seed=3):
    rng = random.Random(seed)
    out = list(AWKWARD)
    passage = prose(rng, 25)
    for _ in range(8):
        base = prose(rng, rng.choice([6, 40, 60]))
        for _ in range(rng.choice([1, 3, 12])):
            words = base.split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = "new"
            out.append(" ".join(words))
    out += [prose(rng, 40) + " " + passage for _ in range(20)]
    out += [passage + f" {i}" for i in range(20)] + [out[20].upper(), out[21].replace(" ", "\t\n")]
    return out


def brute_groups(texts, ids):
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    groups = collections.defaultdict(list)
    for i in range(len(texts)):
        groups[find(i)].append(ids[i])
    return {ids[i]: (len(sets[i]), min(groups[find(i)])) for i in range(len(texts))}


@pytest.mark.parametrize("listed", [32, 3])
def test_near_duplicates(spark, monkeypatch, listed):
    monkeypatch.setattr(minhash, "LIST", listed)  # 3: nearly every list is hot
    texts = near_texts()
    ids = [7 * i % 1009 for i in range(len(texts))]
    df = docs(spark, texts, ids)
    found = minhash.near_duplicates(df)
    want = brute_groups(texts, ids)
    rows = found.collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in rows} == want and len(rows) == len(texts)
    assert all(r.kept == (r.id == r.component_id) for r in rows)
    kept = minhash.one_of_each(df, found)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if i == c)


def test_near_duplicates_with_repeated_and_missing_ids(spark):
    texts = ["a b c d e f", "A b c d e f", "a b c d e f", "x y", "x  y", None, ""]
    df = docs(spark, texts, [5, 5, 5, None, None, None, 9])
    found = minhash.near_duplicates(df)
    assert {(r.id, r.component_id) for r in found.collect()} == {(5, 5), (None, None), (9, 9)}
    kept = minhash.one_of_each(df, found).collect()
    assert collections.Counter(r.doc_id for r in kept) == {5: 1, None: 2, 9: 1}
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, i) for i in range(2001, 2100)] + [(3, 3), (None, 4)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {n: n for e in edges for n in e if None not in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    linked = {n for a, b in edges if a is not None and a != b for n in (a, b)}
    assert got == {n: label[n] for n in linked}


# --- 2: repeated passages


def brute_passages(texts, size):
    data = [(t or "").encode() for t in texts]
    counts = collections.Counter(d[i : i + size] for d in data for i in range(len(d) - size + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - size + 1):
            if counts[d[i : i + size]] > 1:
                gone[i : i + size] = b"\1" * size
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((bytes(b for b, g in zip(d, gone, strict=True) if not g), [x for s in spans for x in s]))
    return out


@pytest.mark.parametrize(("size", "gram", "variants"), [(40, 11, 4096), (40, 11, 1), (15, 4, 2)])
def test_repeated_passages(spark, size, gram, variants):
    rng = random.Random(size)
    shared = [prose(rng, 14) for _ in range(4)]
    texts = list(AWKWARD) + ["ab" * 200, "The The The The The " * 12, "y" * 90, "y" * 39]
    for _ in range(60):
        parts = [prose(rng, rng.randrange(1, 12)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared)[rng.randrange(5) :])
        texts.append("·".join(parts))
    texts += texts[-3:]
    found = {bytes(r.key): r for r in passages.repeated_passages(docs(spark, texts), size=size, gram=gram, variants=variants).collect()}
    for text, (kept, spans) in zip(texts, brute_passages(texts, size), strict=True):
        r = found[hashlib.sha256((text or "").encode()).digest()[:16]]
        assert (bytes(r.kept), r.removed, r.n_removed) == (kept, spans, sum(spans[1::2]) - sum(spans[0::2]))


def test_without_passages_keeps_rows_and_columns(spark):
    texts = [*AWKWARD, "é" * 300, "é" * 300 + "b"]
    df = docs(spark, texts)
    cut = {r.doc_id: r for r in passages.without_passages(df, size=41, gram=11).collect()}
    assert len(cut) == len(texts) and cut[1].text is None and cut[12].text == "b" and cut[4].source == "s"
    assert passages.without_passages(df.limit(0)).count() == 0


def test_long_texts_in_slices(monkeypatch):
    monkeypatch.setattr(passages, "SLICE", 500)
    data = bytes(random.Random(6).choices(b"abc", k=3000))
    first = []
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([b"k"]), pa.array([data.decode()])], ["key", "text"])
    for rows, parts in passages._slices(iter([batch]), 40):
        arrays = passages.segments_of(np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)]), 40, 11)
        starts = np.cumsum([0, *map(len, parts)])
        for t, a, b in zip(*arrays[:3], strict=True):
            first += range(a - starts[int(t)] + rows[int(t)][1], b - starts[int(t)] + rows[int(t)][1] + 1)
    assert sorted(first) == list(range(3000 - 39))


def test_passages_in_several_slices(spark):
    rng = random.Random(12)
    passage, noise = prose(rng, 250)[:2000].encode("ascii", "replace").decode(), rng.randbytes(1_200_000).hex()
    text = noise[:200_000] + "<" + passage + ">" + noise[200_000:1_500_000] + "(" + passage + ")" + noise[1_500_000:]
    assert len(text) > 2 * passages.SLICE
    n = len(passage)
    spans = [200_001, 200_001 + n, 1_500_003 + n, 1_500_003 + 2 * n]
    for copies in (1, 2):
        other = "a short text" * 3
        (found,) = passages.repeated_passages(docs(spark, [text] * copies + [other])).where(F.col("n_bytes") > 100).collect()
        want = spans if copies == 1 else [0, len(text)]
        assert found.removed == want and found.n_removed == sum(want[1::2]) - sum(want[0::2])


def test_run_index():
    rng = random.Random(3)
    for trial in range(60):
        base = bytes(rng.choices(b"ab" if trial % 3 else b"abcdefgh", k=60))
        pieces = [base[rng.randrange(20) :][: rng.randint(5, 50)] for _ in range(rng.randint(1, 6))] if trial % 5 else [b"ab" * rng.randint(1, 40)]
        for size in (3, 8, 15):
            counts = collections.Counter(p[i : i + size] for p in pieces for i in range(len(p) - size + 1))
            for p, got in zip(pieces, runindex.repeated_starts(pieces, size, 61), strict=True):
                assert got.tolist() == [i for i in range(len(p) - size + 1) if counts[p[i : i + size]] > 1]


# --- 1: toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def _same_start(word, entry):
    """Edits behind a first letter that is right."""
    rest, term = word[1:], entry.term[1:]
    return min(distance(rest[:k], term) for k in range(len(rest) + 1)) if entry.stem else distance(rest, term)


def test_fuzzy_lexicon():
    entries = [lexicon.Entry(t, s) for t, s in (("idiot", False), ("scum", False), ("worthless", False), ("veq", True), ("loweis", True))]
    match = lexicon.FuzzyLexicon(entries)
    rng = random.Random(8)
    for _ in range(4000):
        word = list(rng.choice([e.term for e in entries]) + rng.choice(["", "", "s", "ou", "able"]))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(word) + 1)
            word[i : i + rng.randrange(2)] = rng.choice(["", "x", "e"])
        word = "".join(word)
        best = []
        for n, e in enumerate(entries):
            if word[:1] == e.term[0] and (d := _same_start(word, e)) <= e.edits:
                best.append((d, n))
        got = match.match(word)
        assert (got and got[::-1]) == (min(best) if best else None), word


@pytest.mark.parametrize("listed", [24, 6])
def test_fuzzy_lexicon_any_start(monkeypatch, listed):
    monkeypatch.setattr(lexicon, "LISTED", listed)
    monkeypatch.setattr(lexicon, "NODES", 4000)
    entries = [lexicon.Entry(t, s) for t, s in (("idiot", False), ("scum", False), ("worthless", False), ("veq", True), ("loweis", True), ("x" * 26, False))]
    match = lexicon.FuzzyLexicon(entries, first_letter=False)
    rng = random.Random(9)
    found = collections.Counter()
    for _ in range(4000):
        word = list(rng.choice([e.term for e in entries]) + rng.choice(["", "", "s", "ou", "able"]))
        for _ in range(rng.randrange(4)):
            i = rng.choice([0, 0, 1, rng.randrange(len(word) + 1)])
            word[i : i + rng.randrange(2)] = rng.choice(["", "x", "e", word[0] if word else "o"])
        word = "".join(word)
        best = []
        for n, e in enumerate(entries):
            d = min(distance(word[:k], e.term) for k in range(len(word) + 1)) if e.stem else distance(word, e.term)
            if d <= e.edits:
                best.append((d, n))
        got = match.match(word)
        assert (got and got[::-1]) == (min(best) if best else None), word
        assert not got or match.near(["other", word, "w" * 40])[-2:].count(word), word
        found[got] += 1
    assert all(found[n, e.edits] for n, e in enumerate(entries)) and found[None]


def test_toxic_hits_with_a_wrong_start():
    matcher = toxicity.Matcher([lexicon.Entry("idiot", False), lexicon.Entry("worthless", False)])
    assert matcher.find_all(["udiot diot iidiot ddiot wrothless orthless wurthles idoit fine words"])[0][1] == set("udiot diot iidiot ddiot wrothless orthless wurthles".split())


def toxic_table(spark, n=400):
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(n):
        words, toxic = prose(rng, 40).split(), i % 4 == 0
        if toxic:
            words[rng.randrange(40)] = rng.choice(["villain", "scoundrel", "blackguard"])
        rows.append(" ".join(words))
        labels.append((i, None if i % 17 == 5 else int(toxic)))
    return rows, spark.createDataFrame(labels + labels[:9], "doc_id long, toxic int")


def test_toxicity(spark):
    rows, labels = toxic_table(spark)
    df = docs(spark, rows)
    model = toxicity.fit(df, labels, train=F.col("doc_id") % 5 != 0)
    assert {e.term for e in model.entries} >= {"villain", "scoundrel", "blackguard"}
    score = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    assert all((score[i] >= 0.3) == (i % 4 == 0) for i in range(0, 400, 5))
    text = prose(random.Random(1), 30)
    odd = [*AWKWARD, text, f"{text} vilain", f"{text} sc0undrel", f"{text} blackgard", f'{text} he was called "a villain" there', f"{text} Villain", text.upper()]
    got = {r.doc_id: r.score for r in toxicity.score(docs(spark, odd), model).collect()}
    at = len(AWKWARD)
    assert all(0 <= s <= 1 for s in got.values()) and all(got[i] < 0.3 for i in [*range(at), at, at + 4, at + 6])
    assert all(got[at + k] >= 0.3 for k in (1, 2, 3, 5))
    kept = toxicity.keep_clean(docs(spark, odd), model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(odd)) if got[i] < 0.3]
    empty = toxicity.fit(df, labels.limit(0))
    assert {round(r.score, 6) for r in toxicity.score(df, empty).collect()} == {0.0}
    assert toxicity.score(df.limit(0), model).count() == 0


# --- 4: context trees


def test_context_trees_against_the_recursion(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abA é\n") for _ in range(rng.randrange(1, 12))) for _ in range(14)] + ["", None, "ab", "ab"]
    depth, edge = 2, bytes([255])
    data = [(t or "").encode().lower() for t in texts]
    counts: dict = collections.defaultdict(lambda: [0, 0])

    def decisions(text):
        line = edge * depth + text + edge
        for i in range(depth, len(line)):
            for bit in range(8):
                yield line[i - depth : i], (1 << bit) | line[i] >> (8 - bit), line[i] >> (7 - bit) & 1

    train = [i % 3 != 1 for i in range(len(texts))]
    for text, used in zip(data, train, strict=True):
        for context, node, bit in decisions(text) if used else ():
            for d in range(depth + 1):
                counts[context[depth - d :], node][bit] += 1

    def kt(n):
        return math.exp(math.lgamma(n[0] + 0.5) + math.lgamma(n[1] + 0.5) - math.lgamma(sum(n) + 1)) / math.pi

    def weighted(context, node):
        if len(context) == depth:
            return kt(counts[context, node])
        below = math.prod(weighted(c, n) for c, n in list(counts) if n == node and len(c) == len(context) + 1 and c[1:] == context)
        return (kt(counts[context, node]) + below) / 2

    def mixed(context, node, d=0):
        own = context[depth - d :]
        if (own, node) not in counts:
            return 0.5
        n = counts[own, node]
        estimate = (n[1] + 0.5) / (sum(n) + 1)
        if d == depth:
            return estimate
        share = kt(n) / 2 / weighted(own, node)
        return share * estimate + (1 - share) * mixed(context, node, d + 1)

    df = docs(spark, texts).withColumn("used", F.col("doc_id") % 3 != 1)
    got = {r.doc_id: r for r in ctw.score_texts(df, F.col("used"), depth=depth).collect()}
    words = [[*re.findall(rb"[^\x20\x09-\x0D]+", t), None] for t in data]
    tally = collections.Counter(w for ws, used in zip(words, train, strict=True) if used for w in ws)
    total = sum(tally.values())
    for i, text in enumerate(data):
        want = sum(math.log10(p if bit else 1 - p) for p, bit in ((mixed(c, n), b) for c, n, b in decisions(text)))
        assert got[i].score == pytest.approx(want, rel=1e-5)
        assert got[i].base_score == pytest.approx(sum(math.log10((tally[w] + 0.5) / (total + 0.5 * (len(tally) + 1))) for w in words[i]))
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (len(words[i]), sum(tally[w] > 0 for w in words[i]), total)
    assert ctw.score_texts(df.limit(0), F.col("used")).count() == 0
    assert ctw.score_texts(df, F.lit(None).cast("boolean")).first().train_tokens == 0


# --- 5: vectors


@pytest.mark.parametrize(("block", "shard"), [(256, 32), (8, 2)])
def test_near_vectors(spark, monkeypatch, block, shard):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "SHARD", shard)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 16))
    rows = [(i, (centres[i % 6] + 0.12 * rng.standard_normal(16)).tolist() if i < 160 else rng.standard_normal(16).tolist(), [1, 2, None][min(2, i % 12 // 5)]) for i in range(260)]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(5)] + [(2000, None, 1), (2001, [], 1), (2002, [0.0] * 16, 1), (2003, [None, *[1.0] * 15], 1), (2004, [math.nan] * 16, 1), (2005, [math.inf] * 16, 1), (2006, [1.0, 2.0], 1), (2007, [2.0, 4.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("class", F.lit(1))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_vectors(df).collect()}
    held = {r.vec_id: r for r in df.collect()}
    good = [i for i, r in held.items() if r.label is not None and r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding) and any(r.embedding)]
    links = collections.defaultdict(set)
    for i in good:
        for j in good:
            a, b = np.array(held[i].embedding), np.array(held[j].embedding)
            if i != j and held[i].label == held[j].label and len(a) == len(b) and a @ b / math.sqrt((a @ a) * (b @ b)) >= 0.93:
                links[i].add(j)
    reach = {i: i for i in held}
    for _ in held:
        for i in links:
            reach[i] = min(reach[i], *(reach[j] for j in links[i]))
    assert got == {i: (len(links[i]), reach[i], reach[i] == i) for i in held} and sum(map(len, links.values())) > 500
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_near_vectors_recall_of_large_labels(spark, monkeypatch):
    """Blocks of one class stand for a label 256 times as large."""
    assert [vectors.passes_for(n, 0.93) for n in (0, 256, 10**5, 10**6, 10**7)] == [10, 10, 14, 22, 39]
    monkeypatch.setattr(vectors, "BLOCK", 1)
    rng = np.random.default_rng(4)
    a, b = (x / np.linalg.norm(x, axis=1)[:, None] for x in rng.standard_normal((2, 1500, 64)))
    b -= (a * b).sum(axis=1)[:, None] * a
    b = 0.931 * a + math.sqrt(1 - 0.931**2) * b / np.linalg.norm(b, axis=1)[:, None]
    df = spark.createDataFrame([(i, v, 1) for i, v in enumerate(np.concatenate([a, b]).tolist())], "vec_id long, embedding array<double>, label int")
    found = vectors.near_vectors(df).where("n_links = 1").count() / 2
    assert found >= 0.985 * 1500


# --- 9: packing


def check_packing(rows, lengths, capacities):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.bin, r.capacity].append((r.offset, r.length))
    assert len({b for b, _ in bins}) == len(bins)
    for (_, capacity), held in bins.items():
        held.sort()
        assert [o for o, _ in held] == np.cumsum([0] + [n for _, n in held])[:-1].tolist()
        used = sum(n for _, n in held)
        assert capacity == min(c for c in capacities if c >= used)
    total = collections.Counter()
    for r in rows:
        total[r.doc_id] += r.length
    assert total == {i: n for i, n in lengths.items() if n and n > 0}
    return sum(capacity for _, capacity in bins)


def test_packing(spark):
    rng = random.Random(7)
    lengths = {i: rng.choice([1, 7, 30, 30, 30, rng.randrange(1, 100), 333]) for i in range(500)} | {900: 0, 901: None, 902: 64 * 40}
    df = spark.createDataFrame([(i, n, 1) for i, n in lengths.items()], "doc_id long, length int, bin int")
    rows = packing.pack(df, capacities=(16, 40, 64)).collect()
    spent = check_packing(rows, lengths, (16, 40, 64))
    assert spent <= 1.05 * sum(n or 0 for n in lengths.values())
    for r in rows:
        assert r.begin == r.piece * 64
    assert packing.pack(df.limit(0)).count() == 0
    repeated = packing.pack(spark.createDataFrame([(1, 5), (1, 5), (None, 5), (None, 70)], "doc_id long, length int"), capacities=(64,)).collect()
    assert sorted(r.length for r in repeated) == [5, 5, 5, 6, 64]


# --- queries and the pipeline

SF_DIR = "/root/testdata/sf0.001"


def test_registered_queries(spark):
    import oracle
    from __spark_entry__ import oracle_sql, queries as registered

    names = set(registered())
    assert names >= {*queries.QUERIES, "pipeline"} and {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))
    assert oracle.compare(registered()["op7_url_rules"](spark, SF_DIR), oracle.connect(SF_DIR), oracle_sql()["op7_url_rules"]) is None


def test_pipeline_stages(spark):
    import corpus_pipeline

    df = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    extra = df.limit(1).select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text"), "lang", "source", "n_chars")
    now = df.unionByName(extra).unionByName(df.limit(3))
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stage(spark, now, SF_DIR).cache()
        if name != "packing":
            assert now.dtypes == df.dtypes and 0 < now.count() <= before.count()
        if name == "near_duplicates":
            assert now.count() == len({r.component for r in minhash.near_duplicates(before).collect() if r.component}) + before.where("trim(coalesce(text, '')) = ''").count()
        if name == "passages":
            texts = [r.text for r in before.select("text").collect()]
            want = collections.Counter(k.decode("utf-8", "ignore") for k, _ in brute_passages(texts, 400))
            assert collections.Counter(r.text or "" for r in now.select("text").collect()) == want
    lengths = collections.Counter()
    for r in before.collect():
        lengths[r.doc_id] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) + 1
    check_packing(now.collect(), lengths, packing.CAPACITIES)
    empty = df.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF_DIR)
    assert empty.count() == 0


def test_text_key(spark):
    got = spark.createDataFrame([("é",), (None,)], "text string").select(text_key(F.col("text")).alias("k")).collect()
    assert [bytes(r.k) for r in got] == [hashlib.sha256(t.encode()).digest()[:16] for t in ("é", "")]


def test_one_matcher_at_a_time(monkeypatch):
    alive = weakref.WeakSet()

    class Counted:
        def __init__(self, entries):
            assert not alive, "a worker holds the matcher of an older model while it builds one"
            alive.add(self)

    monkeypatch.setattr(toxicity, "Matcher", Counted)
    for term in ("first", "second"):
        assert toxicity._matcher((lexicon.Entry(term, False),)) is toxicity._matcher((lexicon.Entry(term, False),))


def test_passages_are_cut_and_decoded_by_one_function(spark):
    rows = docs(spark, AWKWARD + [prose(random.Random(3), 200)] * 2)
    plans = [f(rows)._jdf.queryExecution().optimizedPlan().toString() for f in (passages.repeated_passages, passages.without_passages)]
    assert plans[0].count("MapInArrow") == plans[1].count("MapInArrow")


@pytest.mark.parametrize(("file", "chunks"), [(queries.BYTE_BPE, bpe.SPACED), (queries.WORD_BPE, bpe.UNSPACED)])
def test_words_reach_the_model_together(file, chunks):
    words = [f"{a}{b}{c}é"[: 3 + (a > b)] for a in "abcdefghijk" for b in "lmnopqrst" for c in "uvwxyzabé"]
    texts = [" ".join(words[:400]), "", " ! ", " ".join(words[300:]) + "\n\n", "x" * 300 + " ab!cd 12", *words[:5]]
    coder, given = bpe.ChunkEncoder(file, chunks), []
    model = coder.model

    class Counted:
        def encode_batch_fast(self, batch, **settings):
            given.extend(batch)
            return model.encode_batch_fast(batch, **settings)

    coder.model = Counted()
    for _ in range(2):  # the second time from the memo
        ids, counts = coder.encode(texts)
        assert np.split(ids, np.cumsum(counts)[:-1])[3].tolist() == Tokenizer.from_file(file).encode(texts[3], add_special_tokens=False).ids
        assert counts.tolist() == [len(Tokenizer.from_file(file).encode(t, add_special_tokens=False).ids) for t in texts]
    assert 0 < len(given) < 8  # not one for each of 891 words


def test_words_that_come_again_stay_known():
    coder, given = bpe.ChunkEncoder(queries.WORD_BPE, bpe.UNSPACED, memo_chunks=50), collections.Counter()
    model = coder.model

    class Counted:
        def encode_batch_fast(self, batch, **settings):
            given.update(w for joined in batch for w in joined.split(bpe.MARK))
            return model.encode_batch_fast(batch, **settings)

    coder.model, whole = Counted(), Tokenizer.from_file(queries.WORD_BPE)
    for step in range(40):
        rare = "".join("abcdefghij"[int(d)] for d in str(1000 + step))
        texts = ["common words, common words again \x1fé\x0b3.5km", f"{rare}x {rare}y-{rare}z.", "q" * 90 + ",common", "", f" {rare}v {rare}w"]
        ids, counts = coder.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
    assert given["common"] == given["words"] == given["again"] == 1 and given["baaax"] == 1
    assert len(coder.slot) < 100
