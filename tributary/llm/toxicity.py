"""Toxicity scores from a learned lexicon, misspellings included, and the context of each hit.

Terms and stems are learned from labelled texts, by how much oftener toxic texts hold them. A token hits an entry of the
lexicon exactly or as a misspelling (see ``lexicon``); both have a weight of their own per entry, so that a
common word one letter away from a term weighs nothing. Hits inside quotation marks or behind a reporting word are
kept apart from the others, and windows of tokens show how dense the others are. A logistic model over these few
figures gives the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .arrow import map_arrow, text_steps
from .lexicon import Entry, FuzzyLexicon

#: Labelled rows that the model is fitted on at most: those with the smallest hash of the id.
FIT_ROWS = 16_000
#: Entries of the lexicon at most, toxic texts that must hold one, log-odds that it must reach, and how many standard
#: deviations its number of toxic texts must lie above what chance would give.
ENTRIES, SUPPORT, LOG_ODDS, DEVIATIONS = 4_000, 4, 1.5, 5.5
STEM_LENGTHS = range(3, 9)
#: Tokens of a context window, and tokens before a hit in which a reporting word makes it a quotation.
WINDOW, REPORT = 40, 4
#: Tokens whose match a worker keeps.
MEMO = 400_000

# Marks inside words, digits and signs that stand for letters, quotation marks, reporting words.
TOKEN = re.compile(r"[^\W_]+(?:[*@$!][^\W_]+)*")
LEET = str.maketrans("013457@$!", "oieastasi")
QUOTED = re.compile(r"\"[^\"\n]{1,400}\"|“[^”\n]{1,400}”|„[^“”\n]{1,400}[“”]|«[^»\n]{1,400}»")
REPORTING = frozenset("said says called calls wrote writes quoted quote word insult term dijo dice llamó dit appelé sagte nannte".split())

FEATURES = ("hits", "strongest", "distinct", "densest", "quoted")


def fold(token: str) -> str:
    return token if token.isalpha() else token.translate(LEET)


def tokens_of(text: str) -> list[str]:
    return TOKEN.findall(text.lower())


@dataclass
class Model:
    """Entries, their weights as exact and as misspelled hits, and the logistic coefficients (bias first)."""

    entries: list[Entry]
    exact: list[float]
    misspelled: list[float]
    coefficients: list[float] = field(default_factory=lambda: [0.0] * (1 + len(FEATURES)))


class Matcher:
    """Finds hits; keeps the outcome for tokens it has met."""

    def __init__(self, entries: list[Entry]):
        self.lexicon = FuzzyLexicon(entries, first_letter=False)
        self.hits: dict[str, tuple[int, bool]] = {}
        self.clean: set[str] = set()

    def find_all(self, texts: list[str]) -> list[tuple[list[str], set[str]]]:
        """For each text all tokens, and those among them that hit."""
        tokens = [tokens_of(text) for text in texts]
        if len(self.clean) > MEMO:
            self.clean = set()
        if len(self.hits) > MEMO:
            self.hits = {}
        folded = {t: fold(t) for t in set().union(*tokens).difference(self.clean, self.hits)}
        match = {f: self.lexicon.match(f) for f in self.lexicon.near(list(dict.fromkeys(folded.values())))}
        for token, f in folded.items():
            if found := match.get(f):
                self.hits[token] = found[0], found[1] > 0
            else:
                self.clean.add(token)
        return [(t, self.hits.keys() & set(t)) for t in tokens]


_MATCHERS: dict[tuple[Entry, ...], Matcher] = {}


def _matcher(entries: tuple[Entry, ...]) -> Matcher:
    """One matcher for the tasks of a worker that have these entries. The one before goes first, so that never two are held."""
    if entries not in _MATCHERS:
        _MATCHERS.clear()
        _MATCHERS[entries] = Matcher(list(entries))
    return _MATCHERS[entries]


def features(texts: list[str], matcher: Matcher, model: Model) -> list[tuple[list[float], int]]:
    """For each text the figures of ``FEATURES``, and the number of hits that weigh something."""
    return [_figures(text, tokens, hit, matcher, model) for text, (tokens, hit) in zip(texts, matcher.find_all(texts), strict=True)]


def _figures(text: str, tokens: list[str], hit: set[str], matcher: Matcher, model: Model) -> tuple[list[float], int]:
    weight = {}
    for token in hit:
        number, misspelled = matcher.hits[token]
        if (w := (model.misspelled if misspelled else model.exact)[number]) > 0:
            weight[token] = w
    if not weight:
        return [0.0] * len(FEATURES), 0
    lowered = text.lower()
    spans = [m.span() for m in QUOTED.finditer(lowered)]
    spot = [m.start() for m in TOKEN.finditer(lowered)] if spans else []
    quoted_at = np.zeros(len(tokens), bool)
    if spans:
        begin, end = np.searchsorted(spot, np.array(spans).T)
        for a, b in zip(begin, end, strict=True):
            quoted_at[a:b] = True
    at = [i for i, t in enumerate(tokens) if t in weight]
    apart = [bool(quoted_at[i]) or any(t in REPORTING for t in tokens[max(0, i - REPORT) : i]) for i in at]
    plain = [i for i, q in zip(at, apart, strict=True) if not q]
    if not plain:
        return [0.0, 0.0, 0.0, 0.0, math.log1p(len(at))], len(at)
    weights = np.array([weight[tokens[i]] for i in plain])
    upto = np.concatenate([[0.0], np.cumsum(weights)])
    window = upto[np.searchsorted(plain, np.array(plain) + WINDOW)] - upto[:-1]
    terms = {matcher.hits[tokens[i]][0] for i in plain}
    return [math.log1p(len(plain)), float(weights.max()), math.log1p(len(terms)), math.log1p(float(window.max())), math.log1p(len(at) - len(plain))], len(at)


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train: Column | None, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids with their texts, written once. The ids joined by broadcast are bounded by ``rows``.

    Equal hashes are ordered by the id, so the choice has no ties; all rows of a chosen id are taken.
    """
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    own = own if train is None else own.where(train)
    picked = own.groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col)).cast("int").alias("label")).orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return materialize(texts.join(F.broadcast(picked), "id"), "labelled")


def _lexicon(sample: DataFrame, n: dict[int, int]) -> tuple[list[Entry], list[float]]:
    """Entries with the log-odds of a toxic text to hold them; counted over the whole sample by Spark."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            terms = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([t[1:] for t in terms]), pa.array([t[0] == "+" for t in terms]), pa.array([counts[t][0] for t in terms], pa.int64()), pa.array([counts[t][1] for t in terms], pa.int64())], ["term", "stem", "clean", "toxic"])

        counts: dict[str, list[int]] = {}
        for step in text_steps(batches, "text"):
            for text, label in zip(step.column("text").to_pylist(), step.column("label").to_pylist(), strict=True):
                held = {fold(t) for t in set(tokens_of(text))}
                for term in {"=" + t for t in held if len(t) <= 40} | {"+" + t[:k] for t in held for k in STEM_LENGTHS if k < len(t)}:
                    counts.setdefault(term, [0, 0])[label > 0] += 1
            if len(counts) > 400_000:
                yield flush()
                counts = {}
        if counts:
            yield flush()

    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    counted = map_arrow(sample, count, "term string, stem boolean, clean bigint, toxic bigint").groupBy("term", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    share = n[1] / (n[0] + n[1])
    chance = (F.col("toxic") + F.col("clean")) * share
    strong = counted.where((F.col("toxic") >= SUPPORT) & (F.col("toxic") - chance >= DEVIATIONS * F.sqrt(chance * (1 - share)))).withColumn("odds", odds).where(F.col("odds") >= LOG_ODDS)
    rows = strong.orderBy((F.col("odds") * F.col("toxic")).desc(), "term", "stem").limit(4 * ENTRIES).collect()
    toxic = {(r.term, r.stem): r.toxic for r in rows}
    odds_of = {(r.term, r.stem): r.odds for r in rows}
    followers: Counter = Counter()
    for (term, stem), k in toxic.items():
        for cut in range(STEM_LENGTHS.start, len(term) + (not stem)):
            followers[term[:cut]] = max(followers[term[:cut]], k)
    kept = []
    for r in rows:
        if r.stem and followers[r.term] >= 0.9 * r.toxic:
            continue  # one longer entry covers nearly all that begins so
        above = [(r.term[:k], True) for k in range(STEM_LENGTHS.start, len(r.term) + (not r.stem)) if (r.term[:k], True) in toxic]
        if any(odds_of[a] >= r.odds - 0.3 and followers[a[0]] < 0.9 * toxic[a] for a in above):
            continue  # a kept stem says as much
        kept.append((Entry(r.term, r.stem), r.odds))
    kept = kept[:ENTRIES]
    return [e for e, _ in kept], [o for _, o in kept]


def _misspelled(sample: DataFrame, entries: list[Entry], n: dict[int, int]) -> list[float]:
    """Weights of misspelled hits. Without evidence one weighs much; clean texts that hold it take the weight away."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, counts = _matcher(tuple(entries)), Counter()
        for step in text_steps(batches, "text"):
            for (_, hit), label in zip(matcher.find_all(step.column("text").to_pylist()), step.column("label").to_pylist(), strict=True):
                found = {matcher.hits[t] for t in hit}
                counts.update((number, label > 0) for number, misspelled in found if misspelled)
        keys = list(counts)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([counts[k] for k in keys], pa.int64())], ["entry", "toxic", "n"])

    weights = [[0, 0] for _ in entries]
    for r in map_arrow(sample, count, "entry int, toxic boolean, n bigint").groupBy("entry", "toxic").agg(F.sum("n").alias("n")).collect():
        weights[r.entry][r.toxic] = r.n
    return [math.log((toxic + 1) / (n[1] + 2)) - math.log((clean + 0.25) / (n[0] + 2)) for clean, toxic in weights]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> list[float]:
    """Newton steps for a ridge-penalised logistic model with a free bias."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w, penalty = np.zeros(x.shape[1]), ridge * np.diag([1e-6] + [1.0] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def _features(df: DataFrame, model: Model, key: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, w = _matcher(tuple(model.entries)), np.array(model.coefficients)
        for step in text_steps(batches, "text"):
            rows = features([t or "" for t in step.column("text").to_pylist()], matcher, model)
            x = np.array([r for r, _ in rows]).reshape(len(rows), len(FEATURES))
            score = 1 / (1 + np.exp(-np.clip(w[0] + x @ w[1:], -700, 700)))
            yield pa.RecordBatch.from_arrays([step.column(key), *(pa.array(c) for c in x.T), pa.array(score), pa.array([n for _, n in rows], pa.int64())], [key, *FEATURES, "score", "n_hits"])

    kind = df.schema[key].dataType.simpleString()
    return map_arrow(df.select(key, "text"), run, f"{key} {kind}, " + ", ".join(f"{f} double" for f in FEATURES) + ", score double, n_hits bigint")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train: Column | None = None, rows: int = FIT_ROWS) -> Model:
    """Learn a model from the labelled rows that ``train`` (a condition on ``labels``) admits, at most ``rows`` of them.

    Labels that are null or without an id are left out; of several labels of one id the largest counts; null texts are
    empty. Without labels of both kinds every score is the share of toxic ones, or 0 without labels at all.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, train, rows)
    n = {0: 0, 1: 0} | {r.label: r.n for r in sample.groupBy((F.col("label") > 0).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n[0] or not n[1]:
        bias = 30.0 if n[1] else -30.0
        return Model([], [], [], [bias] + [0.0] * len(FEATURES))
    entries, exact = _lexicon(sample, n)
    model = Model(entries, exact, _misspelled(sample, entries, n))
    held = _features(sample.select(F.col("label").alias("key"), "text"), model, "key").toPandas()  # at most `rows` rows of a few numbers
    model.coefficients = _logistic(held[list(FEATURES)].to_numpy(float), (held["key"] > 0).to_numpy(float))
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, score, n_hits`` of every whole text, row by row; a null text counts as empty, repeated rows score alike.

    Only the text enters a score. No other column is read, so others cannot clash. A very long text is scored as a whole, a few Python objects a token.
    """
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    return _features(rows, model, "key").select(F.col("key").alias(id_col), "score", "n_hits")


def keep_clean(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` whose text scores below ``threshold``, all columns as they were and of any names; they are told apart by place."""
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, w = _matcher(tuple(model.entries)), np.array(model.coefficients)
        for batch in text_steps(batches, text_col):
            rows = features([t or "" for t in batch.column(names.index(text_col)).to_pylist()], matcher, model)
            lines = (w[0] + w[1:] @ np.array(r) for r, _ in rows)
            keep = [1 / (1 + math.exp(-max(-700.0, min(700.0, z)))) < threshold for z in lines]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return map_arrow(docs, run, docs.schema)
