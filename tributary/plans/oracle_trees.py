"""DuckDB twins of the tree queries: the whole training as SQL, one row of common table expressions per level of every tree."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

UNIT = 16777216  # gradients are summed as multiples of one over this
LANGS = ("de", "en", "es", "fr")
NAMES = ["n_chars", "n_words", "n_distinct", "n_lines", "n_digits", "n_upper", "word_share", "digit_share", *(f"lang_{c}" for c in LANGS)]


@dataclass(frozen=True)
class Plan:
    """Settings of one training."""

    tag: str
    model: str
    symmetric: bool
    depth: int
    rows: float
    columns: float
    positive: float
    child: float
    l2: float
    step: float = 0.01
    rounds: int = 4
    folds: int = 3
    fold_seed: int = 2018
    seed: int = 27


LEVEL = Plan("x", "xgb", False, 4, 0.8, 0.8, 2.0, 5.0, 1.0)
SHARED = Plan("c", "cat", True, 6, 0.7, 1.0, 5.0, 0.0, 40.0)

SPACE = r"'[ \t\n\x0B\f\r]+'"
SOURCE = f"""
words AS (
  SELECT d.doc_id, d.text, d.lang, d.n_chars, l.quality AS y, regexp_split_to_array(trim(d.text, ' '), {SPACE}) AS w
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
counts AS (
  SELECT doc_id, y, lang, n_chars::DOUBLE AS a0, len(w)::DOUBLE AS a1, len(list_distinct(w))::DOUBLE AS a2, len(string_split(text, chr(10)))::DOUBLE AS a3,
         length(regexp_replace(text, '[^0-9]', '', 'g'))::DOUBLE AS a4, length(regexp_replace(text, '[^A-Z]', '', 'g'))::DOUBLE AS a5 FROM words),
source AS MATERIALIZED (
  SELECT doc_id, y, [a0, a1, a2, a3, a4, a5, a2 / nullif(a1, 0), a4 / nullif(a0, 0), {', '.join(f"(lang = '{c}')::INT::DOUBLE" for c in LANGS)}] AS xs FROM counts)"""


def chosen(p: Plan, count: int, tree: int) -> list[int]:
    by_hash = sorted(range(count), key=lambda j: hashlib.md5(f"{p.seed}_{tree}_{j}".encode()).hexdigest())
    return sorted(by_hash[: max(1, round(p.columns * count))])


def training(p: Plan, source: str, count: int) -> str:
    """Expressions that end in ``<tag>_all(doc_id, y, fold, m, round, z)``, ``<tag>_split_*`` and ``<tag>_leaf_*``."""
    t = p.tag
    parts = [f"""
{t}_long AS MATERIALIZED (SELECT doc_id, unnest(range({count})) AS f, unnest(xs) AS x FROM {source}),
{t}_sorted AS (SELECT f, list_sort(list(x)) AS s, count(*) AS n FROM {t}_long WHERE x IS NOT NULL GROUP BY f),
{t}_rank AS (SELECT f, s, n, (k * (n - 1)) // 254 AS lo, (k * (n - 1)) % 254 AS rem FROM {t}_sorted, range(255) AS r(k)),
{t}_edge AS (SELECT DISTINCT f, s[lo + 1] + (s[least(lo + 2, n)] - s[lo + 1]) * (rem / 254.0::DOUBLE) AS q FROM {t}_rank),
{t}_cut AS MATERIALIZED (SELECT * FROM (SELECT f, q, row_number() OVER (PARTITION BY f ORDER BY q) AS i, count(*) OVER (PARTITION BY f) AS c FROM {t}_edge) WHERE i < c),
{t}_code AS (SELECT doc_id, l.f, CASE WHEN any_value(x) IS NULL THEN 0 ELSE 1 + count(q) END AS code FROM {t}_long l LEFT JOIN {t}_cut e ON e.f = l.f AND e.q < x GROUP BY doc_id, l.f),
{t}_coded AS (SELECT doc_id, list(code ORDER BY f) AS a FROM {t}_code GROUP BY doc_id),
{t}_row AS MATERIALIZED (
  SELECT s.doc_id, y, a, CASE WHEN y IS NULL THEN -1 ELSE (('0x' || substr(md5('{p.fold_seed}_' || s.doc_id), 1, 8))::BIGINT % {p.folds})::INT END AS fold
  FROM {source} s JOIN {t}_coded USING (doc_id)),
{t}_z0 AS MATERIALIZED (SELECT r.*, m::INT AS m, 0.0::DOUBLE AS z FROM {t}_row r, range({p.folds}) AS k(m))"""]
    quality = lambda g, h: f"if({h} + {p.l2 * UNIT}::DOUBLE > 0, {g}::DOUBLE * {g}::DOUBLE / ({h}::DOUBLE + {p.l2 * UNIT}::DOUBLE) / {UNIT}.0::DOUBLE, 0.0)"
    for r in range(p.rounds):
        v, features = f"{t}_{r}", chosen(p, count, r)
        parts.append(f"""
{v}_grad AS MATERIALIZED (
  SELECT doc_id, m, a, round_even(w * (c - y) * {UNIT}, 0)::BIGINT AS g, round_even(w * c * (1.0 - c) * {UNIT}, 0)::BIGINT AS h
  FROM (SELECT *, 1.0 / (1.0 + exp(-z)) AS c, CASE WHEN y = 1 THEN {p.positive}::DOUBLE ELSE 1.0::DOUBLE END AS w FROM {t}_z{r}
        WHERE fold >= 0 AND fold <> m AND ('0x' || substr(md5('{p.seed}_{r}_' || doc_id), 1, 13))::BIGINT < {int(p.rows * 2**52)})),
{v}_at0 AS (SELECT doc_id, m, a, 1 AS node FROM {t}_z{r})""")
        for level in range(p.depth):
            n = f"{v}_{level}"
            parts.append(f"""
{n}_hist AS MATERIALIZED (
  SELECT m, node, f, a[f + 1] AS code, sum(g)::BIGINT AS g, sum(h)::BIGINT AS h, count(*) AS n
  FROM (SELECT g.*, node, unnest({features}) AS f FROM {v}_grad g JOIN {v}_at{level} USING (doc_id, m) WHERE node >= {1 << level}) GROUP BY ALL)""")
            cells = f"{n}_hist"
            if p.symmetric:
                parts.append(f"""
{n}_grid AS (
  SELECT m, node, f, code, coalesce(g, 0) AS g, coalesce(h, 0) AS h, coalesce(n, 0) AS n
  FROM (SELECT DISTINCT m, node FROM {n}_hist) k CROSS JOIN (SELECT f, unnest(range(max(i) + 2)) AS code FROM {t}_cut GROUP BY f) c
  LEFT JOIN {n}_hist USING (m, node, f, code))""")
                cells = f"{n}_grid"
            sums = ", ".join(f"sum(if(code > 0, {c}, 0)) OVER u AS b{c}, sum(if(code = 0, {c}, 0)) OVER w AS z{c}, sum({c}) OVER w AS t{c}" for c in "ghn")
            light = "TRUE" if p.symmetric else f"ln > 0 AND ln < tn AND lh >= {p.child * UNIT} AND th - lh >= {p.child * UNIT}"
            parts.append(f"""
{n}_run AS (SELECT m, node, f, code, {sums} FROM {cells} WINDOW w AS (PARTITION BY m, node, f), u AS (PARTITION BY m, node, f ORDER BY code ROWS UNBOUNDED PRECEDING)),
{n}_side AS (
  SELECT m, node, f, code, FALSE AS ml, bg AS lg, bh AS lh, bn AS ln, tg, th, tn FROM {n}_run WHERE code > 0
  UNION ALL SELECT m, node, f, code, TRUE, bg + zg, bh + zh, bn + zn, tg, th, tn FROM {n}_run WHERE code > 0 AND zn > 0),
{n}_gain AS (SELECT *, {quality('lg', 'lh')} + {quality('(tg - lg)', '(th - lh)')} - {quality('tg', 'th')} AS gain FROM {n}_side WHERE {light})""")
            if p.symmetric:
                parts.append(f"""
{n}_total AS (SELECT m, f, code, ml, sum(round(gain * 1048576)::HUGEINT)::DOUBLE / 1048576 AS gain FROM {n}_gain GROUP BY ALL),
{n}_pick AS (SELECT * FROM {n}_total WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY m ORDER BY gain DESC, f, code, ml) = 1),
{n}_best AS MATERIALIZED (SELECT m, node::INT AS node, f, code, ml, gain, 0::BIGINT AS tn, 0::HUGEINT AS th FROM {n}_pick CROSS JOIN range({1 << level}, {2 << level}) AS k(node))""")
            else:
                parts.append(f"""
{n}_best AS MATERIALIZED (SELECT m, node, f, code, ml, gain, tn, th FROM {n}_gain WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY m, node ORDER BY gain DESC, f, code, ml) = 1)""")
            parts.append(f"""
{v}_at{level + 1} AS MATERIALIZED (
  SELECT doc_id, x.m, a, CASE WHEN b.f IS NULL THEN x.node ELSE 2 * x.node + CASE WHEN a[b.f + 1] = 0 THEN (NOT ml)::INT ELSE (a[b.f + 1] > b.code)::INT END END AS node
  FROM {v}_at{level} x LEFT JOIN {n}_best b ON b.m = x.m AND b.node = x.node)""")
        parts.append(f"""
{v}_leaf AS MATERIALIZED (
  SELECT m, node, -sum(g)::DOUBLE / (sum(h)::DOUBLE + {p.l2 * UNIT}::DOUBLE) * {p.step}::DOUBLE AS value, count(*) AS tn, sum(h) AS th FROM {v}_grad JOIN {v}_at{p.depth} USING (doc_id, m) GROUP BY m, node),
{t}_z{r + 1} AS MATERIALIZED (
  SELECT z.doc_id, z.y, z.a, z.fold, z.m, z.z + coalesce(value, 0.0) AS z FROM {t}_z{r} z JOIN {v}_at{p.depth} n ON n.doc_id = z.doc_id AND n.m = z.m LEFT JOIN {v}_leaf l ON l.m = z.m AND l.node = n.node)""")
    parts.append(f"""
{t}_all AS MATERIALIZED ({' UNION ALL '.join(f"SELECT doc_id, y, fold, m, {r} AS round, z FROM {t}_z{r + 1}" for r in range(p.rounds))}),
{t}_place AS (SELECT *, rank() OVER (PARTITION BY fold, round ORDER BY z) + (count(*) OVER (PARTITION BY fold, round, z) - 1) / 2.0::DOUBLE AS place FROM {t}_all WHERE m = fold),
{t}_auc AS MATERIALIZED (
  SELECT fold, round, (rs - pos * (pos + 1) / 2.0::DOUBLE) / nullif(pos * neg, 0) AS auc
  FROM (SELECT fold, round, sum(y)::DOUBLE AS pos, (count(*) - sum(y))::DOUBLE AS neg, sum(CASE WHEN y = 1 THEN place END) AS rs FROM {t}_place GROUP BY fold, round)),
{t}_kept AS MATERIALIZED (SELECT fold, round FROM {t}_auc QUALIFY row_number() OVER (PARTITION BY fold ORDER BY auc DESC NULLS LAST, round) = 1),
{t}_score AS MATERIALIZED (SELECT a.doc_id, a.y, a.fold, a.m, 1.0 / (1.0 + exp(-z)) AS score FROM {t}_all a JOIN {t}_kept k ON k.fold = a.m AND k.round = a.round),
{t}_oof AS (SELECT doc_id, fold, y AS label, '{p.model}' AS model, score FROM {t}_score WHERE m = fold),
{t}_test AS (SELECT doc_id, '{p.model}' AS model, sum(score ORDER BY m) / {p.folds} AS score FROM {t}_score WHERE fold = -1 GROUP BY doc_id),
{t}_split AS MATERIALIZED (SELECT s.* FROM ({' UNION ALL '.join(f"SELECT m, {r} AS tree, node, f, code, ml, gain, tn, th FROM {t}_{r}_{level}_best" for r in range(p.rounds) for level in range(p.depth))}) s JOIN {t}_kept k ON k.fold = s.m AND s.tree <= k.round),
{t}_end AS (SELECT s.* FROM ({' UNION ALL '.join(f"SELECT m, {r} AS tree, node, value, tn, th FROM {t}_{r}_leaf" for r in range(p.rounds))}) s JOIN {t}_kept k ON k.fold = s.m AND s.tree <= k.round)""")
    return ",".join(parts)


def rd(expr: str, digits: int) -> str:
    return f"round(({expr}) + 1.23e-{digits + 2}, {digits}) + 0.0"


X = f"WITH {SOURCE},{training(LEVEL, 'source', len(NAMES))}"
NAMED = f"{NAMES}[f + 1]"
STACKED = Plan("s", "xgb", False, 4, 0.8, 0.8, 2.0, 5.0, 1.0)
STACK_SOURCE = """
l1 AS (SELECT doc_id, model, score FROM x_oof UNION ALL SELECT doc_id, model, score FROM x_test UNION ALL SELECT doc_id, model, score FROM c_oof UNION ALL SELECT doc_id, model, score FROM c_test),
wide AS (SELECT doc_id, max(score) FILTER (WHERE model = 'xgb') AS xgb, max(score) FILTER (WHERE model = 'cat') AS cat FROM l1 GROUP BY doc_id),
source2 AS MATERIALIZED (SELECT doc_id, y, list_concat(xs, [xgb, cat]) AS xs FROM source LEFT JOIN wide USING (doc_id))"""
SCORES = f"doc_id, fold, label, model, {rd('score', 8)} AS score"

TREE_ORACLE = {
    "oof_gbt": f"{X} SELECT {SCORES} FROM x_oof",
    "oof_symmetric": f"WITH {SOURCE},{training(SHARED, 'source', len(NAMES))} SELECT {SCORES} FROM c_oof",
    "test_scores": f"{X} SELECT doc_id, model, {rd('score', 8)} AS score FROM x_test",
    "staged_auc": f"{X} SELECT fold, round, {rd('auc', 8)} AS auc FROM x_auc",
    "tree_nodes": f"""{X}
SELECT m AS fold, tree, node, {NAMES}[s.f + 1] AS feature, ml AS missing_left, tn AS rows, {rd('coalesce(q, CAST(NULL AS DOUBLE))', 6)} AS cut,
  CAST(NULL AS DOUBLE) AS value, {rd('gain', 4)} AS gain, {rd(f'th / {UNIT}.0::DOUBLE', 4)} AS cover
FROM x_split s LEFT JOIN x_cut c ON c.f = s.f AND c.i = s.code
UNION ALL SELECT m, tree, node, NULL, NULL, tn, NULL, {rd('value', 8)}, NULL, {rd(f'th / {UNIT}.0::DOUBLE', 4)} FROM x_end""",
    "importance_long": f"""{X},
every AS (SELECT f, m FROM range({len(NAMES)}) AS a(f), range(3) AS b(m)),
sums AS (SELECT m, f, sum(gain) AS gain, count(*)::DOUBLE AS splits FROM x_split GROUP BY m, f)
SELECT 'xgb' AS model, {NAMED} AS feature, m::INT AS fold, {rd('coalesce(gain / sum(gain) OVER (PARTITION BY m), 0)', 6)} AS importance, coalesce(splits, 0) AS splits
FROM every LEFT JOIN sums USING (m, f)""",
    "tree_interactions": f"""{X},
s AS (SELECT m, tree, node, {NAMED} AS name, gain, tn FROM x_split),
runs AS (
  SELECT m, tree, [name] AS names, gain, tn FROM s
  UNION ALL SELECT a.m, a.tree, [a.name, b.name], a.gain + b.gain, a.tn FROM s a JOIN s b ON a.m = b.m AND a.tree = b.tree AND b.node = a.node // 2
  UNION ALL SELECT a.m, a.tree, [a.name, b.name, c.name], a.gain + b.gain + c.gain, a.tn
  FROM s a JOIN s b ON a.m = b.m AND a.tree = b.tree AND b.node = a.node // 2 JOIN s c ON a.m = c.m AND a.tree = c.tree AND c.node = a.node // 4),
sums AS (
  SELECT r.m, len(names) AS k, array_to_string(list_sort(names), '|') AS features, sum(r.gain) AS gain, count(*) AS times, sum(r.tn / root.tn) AS weighted, sum(r.tn) AS rows
  FROM runs r JOIN (SELECT m, tree, tn FROM s WHERE node = 1) root USING (m, tree) GROUP BY ALL)
SELECT m AS fold, CAST(k AS INT) AS "order", features, {rd('gain', 4)} AS gain, times, {rd('weighted', 6)} AS weighted_times, CAST(rows AS BIGINT) AS rows,
  CAST(row_number() OVER (PARTITION BY m, k ORDER BY gain DESC, features) AS INT) AS place FROM sums QUALIFY place <= 300""",
    "stacked_oof": f"{X},{training(SHARED, 'source', len(NAMES))},{STACK_SOURCE},{training(STACKED, 'source2', len(NAMES) + 2)} SELECT {SCORES} FROM s_oof",
}
