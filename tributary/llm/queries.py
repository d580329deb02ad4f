"""The registered queries of the subpackage: each operator over its whole table."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir
from ..sources.tables import table
from . import bpe, chat, ctw, fim, minhash, packing, passages, sketch, token_files, toxicity, urls, vectors, whitening
from .arrow import text_key

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def fold(parts: int) -> Column:
    """The remainder that parts documents into those learned from and those held out."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), train=fold(4) != 2)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold(4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op2_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = passages.repeated_passages(docs).select(
        "key", "n_bytes", "n_removed", F.floor(F.size("removed") / 2).alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )
    return docs.select("doc_id", text_key(F.col("text")).alias("key")).join(found, "key").drop("key")


OP2_SQL = """
WITH docs AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents), sized AS (SELECT *, CAST(length(h) // 2 AS BIGINT) AS n FROM docs),
hashed AS MATERIALIZED (SELECT doc_id, unnest(range(n - 399)) AS p, unnest(list_transform(range(n - 399), lambda p: hash(substr(h, 2 * p + 1, 800)))) AS k FROM sized WHERE n >= 400),
again AS (SELECT k FROM hashed GROUP BY k HAVING count(*) > 1),
hits AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS q FROM hashed SEMI JOIN again USING (k)),
runs AS (SELECT doc_id, p, sum(CASE WHEN q IS NULL OR p > q + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM hits),
spans AS (SELECT doc_id, run, min(p) AS a, max(p) + 400 AS b FROM runs GROUP BY doc_id, run),
sums AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed FROM spans GROUP BY doc_id),
pieces AS (
  SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans
  UNION ALL SELECT doc_id, 0, min(a) FROM spans GROUP BY doc_id
  UNION ALL SELECT doc_id, 0, NULL FROM sized ANTI JOIN spans USING (doc_id)),
kept AS (SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, n) - a)), '' ORDER BY a) AS h FROM pieces JOIN sized USING (doc_id) GROUP BY doc_id)
SELECT s.doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(from_hex(k.h)) AS kept_sha256
FROM sized s JOIN kept k ON k.doc_id = s.doc_id LEFT JOIN sums m ON m.doc_id = s.doc_id
"""


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_texts(table(spark, sf_dir, "documents"), BYTE_BPE, pack=True)
    return bpe.round_trip_digests(encoded, BYTE_BPE)


# The rules of the query.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(table(spark, sf_dir, "pages"), urls.rule_table(spark, URL_RULES), id_col="page_id")


OP7_SQL = """
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts
), rules(rule_host, rule_path, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fits AS (
  SELECT page_id, host, path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS place
  FROM split LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
"""


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/tributary/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, WORD_BPE, end_id=1)
    sums = token_files.id_checksums(token_files.read_tokens(spark, path))
    return token_files.read_metadata(spark, path).join(sums, ["shard", "seq"]).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw.score_texts(table(spark, sf_dir, "documents"), train=fold(5) != 1)
    return scored.select("doc_id", (fold(5) == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op5_sorted_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


OP5_SQL = """
WITH RECURSIVE rows AS (
  SELECT vec_id, label, CASE WHEN len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 THEN embedding::DOUBLE[] END AS v FROM embeddings),
units AS (SELECT vec_id, label, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS size FROM rows WHERE label IS NOT NULL AND len(v) > 0),
links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM units a JOIN units b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.size > 0 AND b.size > 0 AND list_inner_product(a.v, b.v) / (a.size * b.size) >= 0.93),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node), counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(other, vec_id)) AS component_id, vec_id <= coalesce(other, vec_id) AS kept
FROM embeddings LEFT JOIN least ON node = vec_id LEFT JOIN counts ON a = vec_id
"""


def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = sketch.tail_swapped(table(spark, sf_dir, "documents"))
    return pairs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        sketch.as_text(F.col("sketch")).alias("fingerprint"),
        sketch.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        sketch.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        F.coalesce(sketch.resemblance(F.col("sketch"), F.col("next_sketch")), F.lit(0.0)).alias("near_next"),
    )


def op9_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    lengths = table(spark, sf_dir, "documents").select("doc_id", packing.word_length().alias("length"))
    return packing.pack(lengths)


def op10_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


OP10_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
least AS (SELECT node, min(other) AS other FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(other, d.doc_id)) AS component_id, d.doc_id <= coalesce(other, d.doc_id) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least ON node = d.doc_id
"""


# The conversation that the query adds, whose texts hold control strings.
EXTRA_CHAT = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op11_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(EXTRA_CHAT, "conv_id bigint, turn bigint, role string, text string")
    path = f"{shared_dir(spark)}/tributary/chats-{uuid.uuid4().hex}"
    chat.write_chats(given.unionByName(extra), path, BYTE_BPE)
    return chat.chat_digests(chat.read_chats(spark, path), BYTE_BPE)


OP11_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown AS (
  SELECT *, regexp_replace(text, '(</?turn>|### (System|User|Assistant|Role|Text):)', '\\\1', 'g') AS escaped,
         regexp_replace(role, '(</?turn>|### (System|User|Assistant|Role|Text):)', '\\\1', 'g') AS escaped_role FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(escaped) + 15 + CASE role WHEN 'system' THEN 11 WHEN 'user' THEN 9 WHEN 'assistant' THEN 14 ELSE 19 + length(escaped_role) END) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""


def op12_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    restored = F.sha2(fim.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), restored)


OP12_SQL = """
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units,
         sha256('1:' || doc_id) AS digest FROM documents
), parts AS (
  SELECT doc_id, text, units, len(units) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM hashed
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM parts
), pieces AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS prefix, coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:], ''), '') AS suffix FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM pieces
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    model = whitening.fit(rows)
    error = whitening.identity_error(rows, model)
    shares = F.array(*map(F.lit, model.explained)).cast("array<double>")
    each = whitening.transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_passages": op2_passages,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_context_trees": op4_context_trees,
    "op5_sorted_passes": op5_sorted_passes,
    "op6_scaled_sketch": op6_scaled_sketch,
    "op7_url_rules": op7_url_rules,
    "op8_token_files": op8_token_files,
    "op9_best_fit": op9_best_fit,
    "op10_bottom_k": op10_bottom_k,
    "op11_chat": op11_chat,
    "op12_middle": op12_middle,
    "op13_whitening": op13_whitening,
}
ORACLE = {
    "op2_passages": OP2_SQL,
    "op5_sorted_passes": OP5_SQL,
    "op7_url_rules": OP7_SQL,
    "op10_bottom_k": OP10_SQL,
    "op11_chat": OP11_SQL,
    "op12_middle": OP12_SQL,
}
