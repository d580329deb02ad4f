"""DuckDB twins of the registered queries, written independently of the library."""

from __future__ import annotations

from .oracle_trees import TREE_ORACLE

ORDERS = """
orders_h AS (
  SELECT *, datediff('day', DATE '2001-08-02', CAST(o_orderdate AS DATE)) AS DAYS_CREDIT FROM orders)"""

LINES = """
lines_h AS (
  SELECT l.*, o.o_custkey, o.o_totalprice,
         datediff('day', DATE '2001-08-02', CAST(o.o_orderdate AS DATE)) + 30 AS due_day,
         datediff('day', DATE '2001-08-02', CAST(l.l_shipdate AS DATE)) AS paid_day,
         l.l_extendedprice AS inst, l.l_extendedprice * (1 - l.l_discount) AS paid
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
paid_h AS (
  SELECT *, paid / nullif(inst, 0) AS perc, inst - paid AS diff,
         greatest(paid_day - due_day, 0) AS dpd, greatest(due_day - paid_day, 0) AS dbd
  FROM lines_h)"""

EVENTS = """
events_h AS (
  SELECT *, datediff('day', DATE '2024-01-31', CAST(ts AS DATE)) AS DAYS_EVENT FROM events)"""

DOCS = """
docs AS (
  SELECT d.*, l.quality AS TARGET FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

LINE_ID = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


def windows(limits: tuple[int, ...], unlimited: bool = True) -> str:
    rows = [f"('{n}', {n})" for n in limits] + (["('False', CAST(NULL AS INTEGER))"] if unlimited else [])
    return f"win(w, lim) AS (VALUES {', '.join(rows)})"


def rd(expr: str, digits: int) -> str:
    """The same rounding as the Spark side: ties are nudged upwards."""
    return f"round(({expr}) + 1.23e-{digits + 2}, {digits}) + 0.0"


def fold(key: str, folds: int, seed: int) -> str:
    return f"CAST((('0x' || substr(md5('{seed}_' || {key}), 1, 8))::BIGINT) % {folds} AS INTEGER)"


def hash_order(key: str, seed: int) -> str:
    return f"(('0x' || substr(md5('{seed}_' || {key}), 1, 13))::BIGINT)"


def all6(col: str, prefix: str = "", where: str = "TRUE") -> str:
    f = f"FILTER (WHERE {where})"
    name = f"{prefix}{col}"
    return f"""
  {rd(f"max({col}) {f}", 4)} AS "{name}_MAX", {rd(f"avg({col}) {f}", 4)} AS "{name}_MEAN",
  {rd(f"sum({col}) {f}", 2)} AS "{name}_SUM", {rd(f"min({col}) {f}", 4)} AS "{name}_MIN",
  {rd(f"var_samp({col}) {f} / 1e6", 4)} AS "{name}_VAR", count({col}) {f} AS "{name}_COUNT" """


def auc(group: str | None) -> str:
    part = f"PARTITION BY {group}" if group else ""
    sel = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    return f"""
WITH {DOCS},
scored AS (SELECT TARGET AS y, n_chars AS s, {fold('doc_id', 3, 1001)} AS fold FROM docs WHERE TARGET IS NOT NULL),
ranked AS (
  SELECT *, rank() OVER ({part} ORDER BY s)
         + (count(*) OVER ({part + (', s' if group else 'PARTITION BY s')}) - 1) / 2.0 AS r FROM scored),
sums AS (
  SELECT {sel} sum(y) AS p, count(*) - sum(y) AS n, sum(CASE WHEN y = 1 THEN r END) AS rs, count(*) AS c
  FROM ranked {by})
SELECT {sel} CAST(c AS BIGINT) AS rows, {rd('(rs - p * (p + 1) / 2.0) / nullif(p * n, 0)', 8)} AS auc FROM sums"""


def sliced(col: str, fns: list[tuple[str, str, int]], where: str, name: str) -> str:
    return ", ".join(
        f"{rd(f'{fn}({col}) FILTER (WHERE {where})', d) if d >= 0 else f'{fn}({col}) FILTER (WHERE {where})'}"
        f' AS "{name}_{tag}"'
        for fn, tag, d in fns
    )


def bins(col: str, out: str) -> str:
    """100 quantile bins: distinct edges, right-closed, minimum included."""
    return f"""
{out}_e AS (
  SELECT DISTINCT e FROM (
    SELECT unnest(quantile_cont({col}, [i / 100.0 FOR i IN range(0, 101)])) AS e FROM lineitem)),
{out}_v AS (
  SELECT v.x, CAST(greatest(count(e.e), 1) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT {col} AS x FROM lineitem) v LEFT JOIN {out}_e e ON e.e < v.x GROUP BY v.x)"""


IMPORTANCE = """
imp AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS feature, l_linenumber AS fold, avg(l_extendedprice) / 1000 AS importance
  FROM lineitem GROUP BY ALL),
means AS (SELECT feature, avg(importance) AS m FROM imp GROUP BY feature)"""

TTEST = """
imp AS (
  SELECT CASE WHEN l_linestatus = 'F' THEN 'a' ELSE 'n' END AS run, CAST(l_suppkey AS VARCHAR) AS feature,
         l_linenumber AS fold,
         avg(CASE WHEN l_linestatus = 'F' THEN l_extendedprice * (1 + l_discount * (l_suppkey % 7))
                  ELSE l_extendedprice END) / 1000 AS importance
  FROM lineitem GROUP BY ALL),
st AS (
  SELECT feature,
         count(*) FILTER (WHERE run = 'a') AS na, count(*) FILTER (WHERE run = 'n') AS n0,
         avg(importance) FILTER (WHERE run = 'a') AS ma, avg(importance) FILTER (WHERE run = 'n') AS m0,
         var_samp(importance) FILTER (WHERE run = 'a') AS va, var_samp(importance) FILTER (WHERE run = 'n') AS v0
  FROM imp GROUP BY feature),
tt AS (
  SELECT *, na + n0 - 2 AS dof,
         (ma - m0) / sqrt(((na - 1) * va + (n0 - 1) * v0) / (na + n0 - 2) * (1.0 / na + 1.0 / n0)) AS t
  FROM st),
an AS (SELECT *, atan(abs(t) / sqrt(dof)) AS th FROM tt),
pv AS (
  SELECT *, CASE
    WHEN dof % 2 = 0 THEN 1 - sin(th) * list_sum([
       list_product([(2.0 * i - 1) / (2.0 * i) FOR i IN range(1, CAST(j AS BIGINT) + 1)] || [1.0]) * pow(cos(th), 2 * j)
       FOR j IN range(0, CAST(dof / 2 AS BIGINT))])
    ELSE 1 - 2 / pi() * (th + sin(th) * list_sum([
       list_product([(2.0 * i) / (2.0 * i + 1) FOR i IN range(1, CAST(j AS BIGINT) + 1)] || [1.0]) * pow(cos(th), 2 * j + 1)
       FOR j IN range(0, CAST((dof - 1) / 2 AS BIGINT))])) END AS p
  FROM an),
sel AS (
  SELECT feature, t, p AS pvalues, ma / m0 AS fc, log2(ma / m0) AS log2fc, -log10(p) AS log10pvalues,
         least(1.0, p * count(*) OVER ()) AS padj FROM pv)"""

_DUMMY = ["click", "error", "purchase", "signup", "view", "nan"]


def _blanket() -> str:
    cols = {"value": "value", "DAYS_EVENT": "DAYS_EVENT"}
    for v in _DUMMY:
        test = "event_type IS NULL" if v == "nan" else f"event_type = '{v}'"
        cols[f"event_type_{v}"] = f"CAST(({test}) AS INTEGER)"
    out = []
    for name, e in cols.items():
        double = name == "value"
        for fn, tag in (("min", "MIN"), ("max", "MAX"), ("avg", "MEAN"), ("sum", "SUM"), ("var_samp", "VAR")):
            x = f"{fn}({e})"
            x = rd(x, 4) if double or tag in ("MEAN", "VAR") else f"CAST({x} AS BIGINT)"
            out.append(f'{x} AS "CC_{name}_{tag}"')
    return ", ".join(out)


def _bb(limit: int | None, slice_: str, fns: list[tuple[str, str, int]]) -> str:
    where = {"BURO": "TRUE", "ACTIVE": "o_orderstatus = 'F'", "CLOSED": "o_orderstatus = 'O'"}[slice_]
    if limit:
        where += f" AND DAYS_CREDIT >= -{limit}"
    label = str(limit) if limit else "False"
    out = []
    for fn, tag, d in fns:
        x = f"{fn}(o_totalprice) FILTER (WHERE {where})"
        if tag == "VAR":
            x = f"{x} / 1e6"
        if tag == "COUNT":
            x = f"nullif({x}, 0)"
        out.append(f'{rd(x, d) if d >= 0 else x} AS "{label}_bb_{slice_}_o_totalprice_{tag}"')
    return ", ".join(out)


_ALL6 = [("max", "MAX", 4), ("avg", "MEAN", 4), ("sum", "SUM", 2), ("min", "MIN", 4), ("var_samp", "VAR", 4), ("count", "COUNT", -1)]


def _window_block(table: str, key: str, alias: str, columns: list[tuple[str, str]], day: str, limits: list[int | None], name: str, size: str) -> str:
    """All functions of the columns in each window, and the rows of each."""
    out = []
    for limit in limits:
        where, label = (f"{day} >= -{limit}", str(limit)) if limit else ("TRUE", "False")
        for column, shown in columns:
            for fn, tag, d in _ALL6:
                x = f"{fn}({column}) FILTER (WHERE {where})"
                x = f"nullif({x}, 0)" if tag == "COUNT" else rd(f"{x} / 1e6" if tag == "VAR" else x, d)
                out.append(f'{x} AS "{label}_{name}_{shown}_{tag}"')
        out.append(f'nullif(count(*) FILTER (WHERE {where}), 0) AS "{label}_{name}_{size}"')
    return f"{alias} AS (SELECT {key} AS {alias}_key, {', '.join(out)} FROM {table} GROUP BY 1)"


_COUNT_MEAN_SUM = [("count", "COUNT", -1), ("avg", "MEAN", 4), ("sum", "SUM", 2)]
_WITH_VAR = _COUNT_MEAN_SUM + [("var_samp", "VAR", 4)]

ORACLE = {
    "scan_entity": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
    "scan_limit": "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10",
    "union_train_test": f"""WITH {DOCS}
SELECT doc_id, lang, source, n_chars, TARGET, CAST(TARGET IS NOT NULL AS INTEGER) AS is_train FROM docs""",
    "split_counts": f"""WITH {DOCS}
SELECT CASE WHEN TARGET IS NOT NULL THEN 'train' ELSE 'test' END AS side, count(*) AS n,
       CAST(sum(n_chars) AS BIGINT) AS chars FROM docs GROUP BY 1""",
    "filter_invalid": """SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer
WHERE c_mktsegment IS DISTINCT FROM 'MACHINERY'""",
    "sentinel_to_null": f"""SELECT l_returnflag, count(nullif(l_quantity, 50)) AS n_present, count(*) AS n_rows,
{rd('avg(nullif(l_quantity, 50))', 6)} AS q_mean FROM lineitem GROUP BY 1""",
    "recency_orders": f"""WITH {ORDERS} SELECT o_orderkey, o_custkey, CAST(DAYS_CREDIT AS INTEGER) AS DAYS_CREDIT, o_totalprice
FROM orders_h WHERE DAYS_CREDIT >= -360""",
    "recency_events": f"""WITH {EVENTS} SELECT event_id, user_id, CAST(DAYS_EVENT AS INTEGER) AS DAYS_EVENT, value
FROM events_h WHERE DAYS_EVENT >= -14""",
    "recency_prev": f"""WITH {LINES} SELECT {LINE_ID}, CAST(due_day AS INTEGER) AS DAYS_INSTALMENT, l_extendedprice
FROM lines_h WHERE due_day > -90""",
    "ratio_features": f"""WITH {LINES} SELECT {LINE_ID},
{rd('l_extendedprice / nullif(o_totalprice, 0)', 8)} AS price_share,
{rd('l_extendedprice / (1 + l_quantity)', 4)} AS price_per_unit,
{rd('l_extendedprice / (o_totalprice + l_quantity)', 8)} AS price_over_sum,
{rd('l_tax / nullif(l_discount, 0)', 6)} AS tax_to_discount,
{rd('l_discount / nullif(l_tax, 0)', 6)} AS discount_to_tax,
{rd('l_quantity * l_discount * l_tax', 8)} AS three_way_product,
{rd('log10(log10(l_extendedprice)) / nullif(log10(log10(o_totalprice)), 0)', 8)} AS loglog_ratio,
{rd('(l_tax / nullif(l_discount, 0)) * (l_discount / nullif(l_tax, 0))', 6)} AS ratio_product
FROM lines_h""",
    "row_kurtosis": f"""WITH v AS (
  SELECT *, [l_quantity, CAST(l_linenumber AS DOUBLE), l_discount, l_tax] AS xs FROM lineitem),
m AS (SELECT *, list_avg(xs) AS mu FROM v),
q AS (SELECT *, list_sum([pow(x - mu, 2) FOR x IN xs]) AS m2, list_sum([pow(x - mu, 4) FOR x IN xs]) AS m4 FROM m)
SELECT {LINE_ID}, l_extendedprice,
  {rd('CASE WHEN m2 = 0 THEN 0.0 ELSE 3.0 / 2.0 * (5.0 * (4.0 * m4 / (m2 * m2) - 3.0) + 6.0) END', 6)} AS kurt FROM q""",
    "row_stats": f"""WITH v AS (
  SELECT *, list_filter([nullif(l_quantity, 50.0), nullif(l_discount, 0.0), nullif(l_tax, 0.0)], lambda x: x IS NOT NULL) AS xs
  FROM lineitem),
s AS (SELECT *, CASE WHEN len(xs) > 1 THEN list_stddev_samp(xs) END AS sd FROM v)
SELECT {LINE_ID}, l_extendedprice, {rd('coalesce(list_sum(xs), 0.0)', 6)} AS row_sum, {rd('list_avg(xs)', 6)} AS row_mean,
  {rd('coalesce(sd, avg(sd) OVER ())', 6)} AS row_std FROM s""",
    "shifted_ratio": f"""SELECT c_custkey,
{rd('c_custkey / nullif(c_acctbal + abs((SELECT min(c_acctbal) FROM customer)), 0)', 6)} AS shifted FROM customer""",
    "log_features": f"""WITH l AS (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END AS a FROM customer)
SELECT c_custkey, {rd('a', 8)} AS log_once, {rd('CASE WHEN a > 0 THEN log10(a) END', 8)} AS log_twice FROM l""",
    "median_impute": f"""WITH t AS (SELECT user_id, sum(value) AS total FROM events GROUP BY 1)
SELECT c_custkey, {rd('coalesce(t.total, (SELECT median(total) FROM t))', 4)} AS total
FROM customer LEFT JOIN t ON c_custkey = user_id""",
    "payment_features": f"""WITH {LINES} SELECT {LINE_ID}, {rd('perc', 6)} AS PAYMENT_PERC, {rd('diff', 4)} AS PAYMENT_DIFF,
CAST(dpd AS BIGINT) AS DPD, CAST(dbd AS BIGINT) AS DBD FROM paid_h""",
    "quantile_bins": f"""WITH {bins('l_discount', 'd')}, {bins('l_extendedprice', 'p')}, {bins('l_quantity', 'q')}
SELECT {LINE_ID}, l_extendedprice, d_v.code AS discount_bin, p_v.code AS price_bin, q_v.code AS quantity_bin,
  {rd('(d_v.code + p_v.code + q_v.code) / 3.0', 6)} AS mean_bin
FROM lineitem JOIN d_v ON d_v.x = l_discount JOIN p_v ON p_v.x = l_extendedprice JOIN q_v ON q_v.x = l_quantity""",
    "ordinal_encode": """SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS c_mktsegment
FROM customer""",
    "one_hot_clash": """SELECT o_orderkey, CAST(p = 'A_b' AS INTEGER) AS "p_A_b", CAST(p = 'a.b' AS INTEGER) AS "p_a_b__2",
  CAST(p = 'a_b' AS INTEGER) AS "p_a_b__3", CAST(p = 'nan' AS INTEGER) AS "p_nan__2", CAST(p = '' AS INTEGER) AS p_nan
FROM (SELECT o_orderkey, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'a.b' WHEN '2' THEN 'a_b' WHEN '3' THEN 'nan' WHEN '5' THEN 'A_b' ELSE '' END AS p
  FROM orders)""",
    "one_hot": "SELECT o_orderkey, "
    + ", ".join(
        f"CAST(coalesce({c} = '{v}', FALSE) AS INTEGER) AS \"{c}_{v}\""
        for c, vs in (
            ("o_orderstatus", ["F", "O", "P"]),
            ("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]),
        )
        for v in vs
    )
    + ", CAST(o_orderstatus IS NULL AS INTEGER) AS o_orderstatus_nan"
    + ", CAST(o_orderpriority IS NULL AS INTEGER) AS o_orderpriority_nan FROM orders",
    "narrow_types": """SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, CAST(p_size AS TINYINT) AS p_size, p_retailprice
FROM part""",
    "hist_agg": f"""SELECT o_custkey, {all6('o_totalprice', 'HIST_')}, count(*) AS "HIST_ROWS" FROM orders GROUP BY 1""",
    "windowed_agg": f"""WITH {ORDERS}, {windows((90, 180, 270, 360))}
SELECT o_custkey, w AS "window", {all6('o_totalprice')}
FROM orders_h JOIN win ON lim IS NULL OR DAYS_CREDIT >= -lim GROUP BY 1, 2""",
    "trend_ratio": f"""WITH {ORDERS}, a AS (
  SELECT o_custkey, max(o_totalprice) mx, avg(o_totalprice) me, sum(o_totalprice) su, min(o_totalprice) mi,
         count(o_totalprice) ct, var_samp(o_totalprice) va FROM orders_h GROUP BY 1),
r AS (
  SELECT o_custkey, max(o_totalprice) mx, avg(o_totalprice) me, sum(o_totalprice) su, min(o_totalprice) mi,
         count(o_totalprice) ct, var_samp(o_totalprice) va FROM orders_h WHERE DAYS_CREDIT >= -90 GROUP BY 1)
SELECT a.o_custkey, {rd('r.mx / a.mx', 6)} AS fc_o_totalprice_MAX, {rd('r.me / a.me', 6)} AS fc_o_totalprice_MEAN,
  {rd('r.su / a.su', 6)} AS fc_o_totalprice_SUM, {rd('r.mi / a.mi', 6)} AS fc_o_totalprice_MIN,
  {rd('r.ct / a.ct', 6)} AS fc_o_totalprice_COUNT, {rd('r.va / nullif(a.va, 0)', 6)} AS fc_o_totalprice_VAR
FROM a LEFT JOIN r ON a.o_custkey = r.o_custkey""",
    "two_level_agg": f"""WITH bb AS (
  SELECT l_orderkey, min(l_linenumber) mn, max(l_linenumber) mx, count(*) sz,
         avg(CAST(l_returnflag = 'A' AS INTEGER)) fa, avg(CAST(l_returnflag = 'N' AS INTEGER)) fn,
         avg(CAST(l_returnflag = 'R' AS INTEGER)) fr
  FROM lineitem GROUP BY 1)
SELECT o_custkey, {rd('avg(mn)', 6)} AS "BURO_l_linenumber_MIN_MEAN", min(mn) AS "BURO_l_linenumber_MIN_MIN",
  {rd('avg(mx)', 6)} AS "BURO_l_linenumber_MAX_MEAN", max(mx) AS "BURO_l_linenumber_MAX_MAX",
  {rd('avg(sz)', 6)} AS "BURO_l_linenumber_SIZE_MEAN", CAST(coalesce(sum(sz), 0) AS BIGINT) AS "BURO_l_linenumber_SIZE_SUM",
  {rd('avg(fa)', 6)} AS "BURO_l_returnflag_A_MEAN_MEAN", {rd('avg(fn)', 6)} AS "BURO_l_returnflag_N_MEAN_MEAN",
  {rd('avg(fr)', 6)} AS "BURO_l_returnflag_R_MEAN_MEAN"
FROM orders LEFT JOIN bb ON o_orderkey = l_orderkey GROUP BY 1""",
    "status_split_agg": f"""WITH {ORDERS} SELECT o_custkey, """
    + ", ".join(
        f"""{rd(f"avg(DAYS_CREDIT) FILTER (WHERE {w})", 4)} AS "{s}_DAYS_CREDIT_MEAN",
  {rd(f"max(DAYS_CREDIT) FILTER (WHERE {w})", 4)} AS "{s}_DAYS_CREDIT_MAX",
  {rd(f"avg(o_totalprice) FILTER (WHERE {w})", 4)} AS "{s}_o_totalprice_MEAN",
  {rd(f"sum(o_totalprice) FILTER (WHERE {w})", 2)} AS "{s}_o_totalprice_SUM",
  nullif(count(o_totalprice) FILTER (WHERE {w}), 0) AS "{s}_o_totalprice_COUNT" """
        for s, w in (("BURO", "TRUE"), ("ACTIVE", "o_orderstatus = 'F'"), ("CLOSED", "o_orderstatus = 'O'"))
    )
    + " FROM orders_h GROUP BY 1",
    "prev_agg": f"""WITH {LINES} SELECT o_custkey, """
    + ", ".join(
        sliced("l_extendedprice", [("min", "MIN", 4), ("max", "MAX", 4), ("avg", "MEAN", 4), ("sum", "SUM", 2)], w, f"{lab}_prevapp_{s}_l_extendedprice")
        + ", "
        + sliced("l_extendedprice / nullif(o_totalprice, 0) * 100", [("min", "MIN", 4), ("max", "MAX", 4), ("avg", "MEAN", 4)], w, f"{lab}_prevapp_{s}_APP_CREDIT_PERC")
        + ", "
        + sliced("l_quantity", [("avg", "MEAN", 4), ("sum", "SUM", 2)], w, f"{lab}_prevapp_{s}_l_quantity")
        for lab, lw in (("False", "TRUE"), ("360", "due_day > -360"))
        for s, sw in (("PREV", "TRUE"), ("APPROVED", "l_linestatus = 'F'"), ("REFUSED", "l_linestatus = 'O'"))
        for w in [f"{lw} AND {sw}"]
    )
    + " FROM lines_h GROUP BY 1",
    "pos_agg": f"""WITH {EVENTS}, {windows((7, 14, 21))}
SELECT user_id, w AS "window", {rd('max(DAYS_EVENT)', 2)} AS "POS_DAYS_EVENT_MAX", {rd('avg(DAYS_EVENT)', 4)} AS "POS_DAYS_EVENT_MEAN",
  {rd('max(value)', 2)} AS "POS_value_MAX", {rd('avg(value)', 4)} AS "POS_value_MEAN", {rd('sum(value)', 2)} AS "POS_value_SUM",
  {rd('min(value)', 2)} AS "POS_value_MIN", {rd('var_samp(value)', 4)} AS "POS_value_VAR", count(value) AS "POS_value_COUNT",
  count(*) AS "POS_COUNT"
FROM events_h JOIN win ON lim IS NULL OR DAYS_EVENT >= -lim GROUP BY 1, 2""",
    "instalment_agg": f"""WITH {LINES}, {windows((90, 180, 270, 360))}
SELECT o_custkey, w AS "window", count(DISTINCT l_suppkey) AS "INSTAL_l_suppkey_NUNIQUE",
  CAST(max(dpd) AS BIGINT) AS "INSTAL_DPD_MAX", {rd('avg(dpd)', 4)} AS "INSTAL_DPD_MEAN", CAST(sum(dpd) AS BIGINT) AS "INSTAL_DPD_SUM",
  CAST(max(dbd) AS BIGINT) AS "INSTAL_DBD_MAX", {rd('avg(dbd)', 4)} AS "INSTAL_DBD_MEAN", CAST(sum(dbd) AS BIGINT) AS "INSTAL_DBD_SUM",
  {rd('avg(perc)', 4)} AS "INSTAL_PAYMENT_PERC_MEAN", {rd('var_samp(perc)', 4)} AS "INSTAL_PAYMENT_PERC_VAR",
  {rd('avg(diff)', 4)} AS "INSTAL_PAYMENT_DIFF_MEAN", {rd('sum(diff)', 2)} AS "INSTAL_PAYMENT_DIFF_SUM",
  {rd('var_samp(diff) / 1e6', 4)} AS "INSTAL_PAYMENT_DIFF_VAR",
  {rd('max(inst)', 4)} AS "INSTAL_AMT_INSTALMENT_MAX", {rd('avg(inst)', 4)} AS "INSTAL_AMT_INSTALMENT_MEAN",
  {rd('sum(inst)', 2)} AS "INSTAL_AMT_INSTALMENT_SUM", {rd('min(paid)', 4)} AS "INSTAL_AMT_PAYMENT_MIN",
  {rd('avg(paid)', 4)} AS "INSTAL_AMT_PAYMENT_MEAN", {rd('sum(paid)', 2)} AS "INSTAL_AMT_PAYMENT_SUM",
  count(*) AS "INSTAL_COUNT"
FROM paid_h JOIN win ON lim IS NULL OR due_day >= -lim GROUP BY 1, 2""",
    "blanket_agg": f"""WITH {EVENTS} SELECT user_id, {_blanket()}, count(*) AS "CC_COUNT" FROM events_h GROUP BY 1""",
    "category_share": "SELECT user_id, "
    + ", ".join(
        f"""{rd(f"avg(CAST(event_type = '{v}' AS INTEGER))", 6)} AS "POS_event_type_{v}_MEAN" """ for v in _DUMMY[:-1]
    )
    + " FROM events GROUP BY 1",
    "group_stat_map": f"""SELECT c_custkey,
{rd('avg(c_acctbal) OVER (PARTITION BY c_mktsegment)', 6)} AS "c_mktsegment_c_acctbal_f1_mean",
{rd('stddev_samp(c_acctbal) OVER (PARTITION BY c_mktsegment)', 6)} AS "c_mktsegment_c_acctbal_f1_std",
{rd('avg(c_acctbal) OVER (PARTITION BY c_nationkey)', 6)} AS "nation_c_acctbal_f1_mean",
{rd('stddev_samp(c_acctbal) OVER (PARTITION BY c_nationkey)', 6)} AS "nation_c_acctbal_f1_std" FROM customer""",
    "group_median": f"""WITH m AS (SELECT c_mktsegment, median(c_acctbal) AS v FROM customer GROUP BY 1)
SELECT c_custkey, c_mktsegment, {rd('v', 4)} AS acctbal_by_segment FROM customer LEFT JOIN m USING (c_mktsegment)""",
    "max_then_sum": f"""WITH {LINES}, g AS (SELECT o_custkey, l_orderkey, max(l_linenumber) v FROM lines_h GROUP BY 1, 2)
SELECT o_custkey, CAST(sum(v) AS BIGINT) AS "CC2_TOTAL_INSTALMENTS" FROM g GROUP BY 1""",
    "nonzero_then_mean": f"""WITH {LINES}, g AS (
  SELECT o_custkey, l_orderkey, count(*) FILTER (WHERE dpd <> 0) v FROM paid_h GROUP BY 1, 2)
SELECT o_custkey, {rd('avg(v)', 6)} AS "CC3_DPD_COUNT" FROM g GROUP BY 1""",
    "missed_payment_pct": f"""WITH {LINES} SELECT o_custkey,
{rd('100.0 * count(*) FILTER (WHERE paid < inst * 0.955) / count(*)', 6)} AS "CC3_PERCENTAGE_MISSED_PAYMENTS"
FROM lines_h GROUP BY 1""",
    "trend_slope": f"""WITH p AS (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos FROM events)
SELECT user_id, {rd('regr_slope(pos, value)', 8)} AS slope FROM p GROUP BY 1""",
    "target_encode": f"""WITH {DOCS}, f AS (
  SELECT doc_id, source, TARGET, CASE WHEN TARGET IS NOT NULL THEN {fold('doc_id', 5, 1001)} END AS fold FROM docs),
k AS (SELECT unnest(range(-1, 5)) AS held),
s AS (
  SELECT f.source, k.held, avg(TARGET) AS m, stddev_samp(TARGET) AS sd
  FROM f JOIN k ON f.fold <> k.held WHERE TARGET IS NOT NULL GROUP BY 1, 2)
SELECT f.doc_id, f.fold, {rd('s.m', 6)} AS "source_TARGET_avg", {rd('s.sd', 6)} AS "source_TARGET_std"
FROM f LEFT JOIN s ON s.source = f.source AND s.held = coalesce(f.fold, -1)""",
    "flagship": f"""WITH {ORDERS}, b AS (
  SELECT o_custkey, {", ".join(_bb(l, s, _WITH_VAR) for l in (90, 360, None) for s in ("BURO", "ACTIVE", "CLOSED"))}
  FROM orders_h GROUP BY 1)
SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment, b.* EXCLUDE (o_custkey)
FROM customer LEFT JOIN b ON c_custkey = o_custkey""",
    "feature_matrix": f"""WITH {ORDERS}, {LINES}, {EVENTS}, b AS (
  SELECT o_custkey AS bk, {", ".join(_bb(l, s, _COUNT_MEAN_SUM) for l in (90, 360, None) for s in ("BURO", "ACTIVE"))}
  FROM orders_h GROUP BY 1),
i AS (
  SELECT o_custkey AS ik,
    {rd('min(paid) FILTER (WHERE due_day >= -360)', 4)} AS "360_instpay_INSTAL_AMT_PAYMENT_MIN",
    {rd('avg(paid) FILTER (WHERE due_day >= -360)', 4)} AS "360_instpay_INSTAL_AMT_PAYMENT_MEAN",
    {rd('sum(paid) FILTER (WHERE due_day >= -360)', 2)} AS "360_instpay_INSTAL_AMT_PAYMENT_SUM",
    nullif(count(*) FILTER (WHERE due_day >= -360), 0) AS "360_instpay_INSTAL_COUNT",
    {rd('max(dpd)', 4)} AS "False_instpay_INSTAL_DPD_MAX", {rd('avg(dpd)', 4)} AS "False_instpay_INSTAL_DPD_MEAN",
    {rd('min(paid)', 4)} AS "False_instpay_INSTAL_AMT_PAYMENT_MIN", {rd('avg(paid)', 4)} AS "False_instpay_INSTAL_AMT_PAYMENT_MEAN",
    {rd('sum(paid)', 2)} AS "False_instpay_INSTAL_AMT_PAYMENT_SUM", count(*) AS "False_instpay_INSTAL_COUNT"
  FROM paid_h GROUP BY 1),
e AS (
  SELECT user_id AS ek, {rd('avg(value) FILTER (WHERE DAYS_EVENT >= -7)', 4)} AS "7_poscash_POS_value_MEAN",
    nullif(count(*) FILTER (WHERE DAYS_EVENT >= -7), 0) AS "7_poscash_POS_COUNT",
    {rd('avg(value)', 4)} AS "False_poscash_POS_value_MEAN", count(*) AS "False_poscash_POS_COUNT"
  FROM events_h GROUP BY 1)
SELECT c_custkey, c_acctbal, b.* EXCLUDE (bk), i.* EXCLUDE (ik), e.* EXCLUDE (ek)
FROM customer LEFT JOIN b ON c_custkey = bk LEFT JOIN i ON c_custkey = ik LEFT JOIN e ON c_custkey = ek""",
    "level1_blocks": f"""WITH {ORDERS}, {LINES}, {EVENTS}, b AS (
  SELECT o_custkey AS b_key, {", ".join(_bb(l, s, _ALL6) for l in (90, 180, 270, 360, None) for s in ("BURO", "ACTIVE", "CLOSED"))}
  FROM orders_h GROUP BY 1),
{_window_block("paid_h", "o_custkey", "i", [("dpd", "INSTAL_DPD"), ("paid", "INSTAL_AMT_PAYMENT")], "due_day", [90, 180, 270, 360, None], "instpay", "INSTAL_COUNT")},
{_window_block("events_h", "user_id", "e", [("value", "POS_value")], "DAYS_EVENT", [7, 14, 21, None], "poscash", "POS_COUNT")}
SELECT c_custkey, b.* EXCLUDE (b_key), i.* EXCLUDE (i_key), e.* EXCLUDE (e_key)
FROM customer LEFT JOIN b ON c_custkey = b_key LEFT JOIN i ON c_custkey = i_key LEFT JOIN e ON c_custkey = e_key""",
    "stack_features": f"""WITH {DOCS} SELECT doc_id, TARGET, {rd('n_chars / 1000.0', 6)} AS length,
{rd('CASE WHEN TARGET IS NOT NULL THEN (doc_id % 7 + doc_id % 11) / 2.0 END', 6)} AS parity FROM docs""",
    "kfold_assign": f"SELECT doc_id, {fold('doc_id', 5, 1001)} AS fold5, {fold('doc_id', 12, 2018)} AS fold12 FROM labels",
    "kfold_exact": f"""SELECT doc_id,
CAST((row_number() OVER (ORDER BY {hash_order('doc_id', 1001)}, doc_id) - 1) % 12 AS INTEGER) AS fold FROM labels""",
    "kfold_stratified": f"""SELECT doc_id, quality,
CAST((row_number() OVER (PARTITION BY quality ORDER BY {hash_order('doc_id', 1001)}, doc_id) - 1) % 5 AS INTEGER) AS fold
FROM labels""",
    "kfold_names": f"""SELECT c_name, c_mktsegment,
CAST((row_number() OVER (PARTITION BY c_mktsegment ORDER BY {hash_order('c_name', 1001)}, c_name) - 1) % 5 AS INTEGER) AS fold
FROM customer""",
    "permute_names": f"""WITH a AS (SELECT c_name, row_number() OVER (ORDER BY c_name) AS r FROM customer),
{", ".join(f"b{i} AS (SELECT c_mktsegment AS segment{i}, row_number() OVER (ORDER BY {hash_order('c_name', 1001 + i)}, c_name) AS r FROM customer)" for i in range(3))}
SELECT c_name, segment0, segment1, segment2 FROM a JOIN b0 USING (r) JOIN b1 USING (r) JOIN b2 USING (r)""",
    "trend_by_time": f"""WITH p AS (
  SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, lpad(event_id::VARCHAR, 12, '0')) - 1 AS pos FROM events)
SELECT event_type, {rd('regr_slope(pos, value)', 6)} AS slope FROM p GROUP BY 1""",
    "auc_by_fold": auc("fold"),
    "auc_full": auc(None),
    "permute_label": f"""WITH a AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r FROM labels),
b AS (SELECT quality, row_number() OVER (ORDER BY {hash_order('doc_id', 1001)}, doc_id) AS r FROM labels)
SELECT doc_id, quality FROM a JOIN b USING (r)""",
    "test_score_mean": f"""WITH {DOCS}, k AS (SELECT unnest(range(1, 6)) AS fold)
SELECT doc_id, {rd('avg((n_chars % (fold * 7)) / (fold * 7.0))', 8)} AS TARGET
FROM docs CROSS JOIN k WHERE TARGET IS NULL GROUP BY 1""",
    "importance_mean": f"WITH {IMPORTANCE} SELECT feature, {rd('m', 6)} AS importance FROM means",
    "topk_importance": f"""WITH {IMPORTANCE}, top AS (SELECT feature FROM means ORDER BY m DESC, feature LIMIT 40)
SELECT feature, fold, {rd('importance', 6)} AS importance FROM imp WHERE feature IN (SELECT feature FROM top)""",
    "importance_threshold": f"WITH {IMPORTANCE} SELECT feature, {rd('m', 6)} AS importance FROM means WHERE m > 53",
    "importance_ttest": f"""WITH {TTEST} SELECT feature, {rd('t', 6)} AS t, {rd('pvalues', 6)} AS pvalues, {rd('fc', 6)} AS fc,
{rd('log2fc', 6)} AS log2fc, {rd('log10pvalues', 4)} AS log10pvalues, {rd('padj', 6)} AS padj FROM sel""",
    "select_features": f"WITH {TTEST} SELECT feature, {rd('padj', 6)} AS padj FROM sel WHERE padj < 0.05",
}

ORACLE.update(TREE_ORACLE)
