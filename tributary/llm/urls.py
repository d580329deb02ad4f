"""URL rules as a sort-merge range join on reversed-host keys; DataFrame functions only.

A rule (host, path, verdict) fits its host and every subdomain of it when the URL's path starts with the rule's path. The
fitting rule with the longest host wins, then the one with the longest path, then ``block`` before ``allow``.

A URL is probed once for each host suffix that some rule names. For one reversed host, the paths that start with a
rule's path are one interval of the sorted paths, and two intervals are nested or apart. So one sorted sweep over
rule starts and URL paths is enough: the last rule start before a path carries the stack of rules that were open
there, and the deepest of the stack that still covers the path is the answer.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize

# The letters that hosts are lower-cased by.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULE_SCHEMA = "rule_host string, rule_path string, verdict string"


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    return F.when(at > 0, text.substr(at + 3, F.length(text))).otherwise("")


def _reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULE_SCHEMA)


def _stacked(rules: DataFrame) -> DataFrame:
    """Distinct rules with the reversed host, their depth in labels and the stack of rules open at their start.

    The stack holds the rule itself and those of its host whose path is a prefix of its own, shortest first. Prefixes are
    matched by equality at each path length that the host's rules have.
    """
    own = (
        rules.select(F.translate("rule_host", UPPER, LOWER).alias("rule_host"), F.coalesce("rule_path", F.lit("")).alias("rule_path"), "verdict")
        .where("rule_host is not null and verdict is not null")
        .groupBy("rule_host", "rule_path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("labels", _reversed_labels(F.col("rule_host")))
        .select(F.array_join("labels", ".").alias("key"), F.size("labels").alias("depth"), "rule_host", "rule_path", "verdict")
    )
    lengths = own.groupBy("key").agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    prefixes = own.join(lengths, "key").select("key", "rule_path", F.explode(F.filter("lengths", lambda n: n <= F.length("rule_path"))).alias("n"))
    open_rules = prefixes.select("key", F.col("rule_path").alias("of"), F.expr("left(rule_path, n)").alias("rule_path")).join(own, ["key", "rule_path"])
    entry = F.struct(F.length("rule_path").alias("n"), "rule_path", "verdict", F.concat("rule_host", "rule_path").alias("rule"), "depth")
    stacks = open_rules.groupBy("key", "of").agg(F.sort_array(F.collect_list(entry)).alias("stack"))
    return stacks.withColumnRenamed("of", "path")


def best_rules(urls: DataFrame, rules: DataFrame, sweep_rows: int = 100_000) -> DataFrame:
    """``url, rule, verdict`` for each distinct URL (columns url, host, path) that some rule fits.

    A host that a large share of all URLs falls under is swept in several lanes of about ``sweep_rows`` probes,
    each with a copy of that host's rules.
    """
    stacked = materialize(_stacked(rules), "rules")
    hosts = stacked.groupBy("key").agg(F.max(F.col("stack")[0]["depth"]).alias("depth"))
    deepest = hosts.agg(F.max("depth").alias("deepest"))
    levels = (
        urls.where("host <> ''")
        .crossJoin(F.broadcast(deepest))  # one row
        .withColumn("labels", _reversed_labels(F.col("host")))
        .select("url", "path", "labels", F.explode(F.sequence(F.lit(1), F.least(F.size("labels"), "deepest"))).alias("depth"))
        .select("url", "path", F.array_join(F.slice("labels", F.lit(1), F.col("depth")), ".").alias("key"))
        .where("key <> ''")
    )
    probes = levels.join(hosts.select("key"), "key", "left_semi")
    lanes = probes.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / sweep_rows).cast("int").alias("lanes"))
    lane_of = F.pmod(F.xxhash64("url"), F.col("lanes")).cast("int")
    events = (
        probes.join(lanes, "key").select("key", lane_of.alias("lane"), "path", "url", F.lit(None).cast(stacked.schema["stack"].dataType).alias("stack"))
    ).unionByName(
        stacked.join(lanes, "key").select("key", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)).alias("lane"), "path", F.lit(None).cast("string").alias("url"), "stack")
    )
    # Where a path equals a rule's, the rule starts first.
    sweep = Window.partitionBy("key", "lane").orderBy("path", F.col("url").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The joins dealt the rows by key alone; only an exchange by lane spreads a hot host.
    swept = events.repartition("key", "lane").withColumn("stack", F.last("stack", ignorenulls=True).over(sweep)).where("url is not null")
    covering = F.filter("stack", lambda r: F.col("path").startswith(r["rule_path"]))
    fits = swept.withColumn("hit", F.try_element_at(covering, F.lit(-1))).where("hit is not null")
    best = fits.groupBy("url").agg(F.max(F.struct(F.col("hit.depth").alias("depth"), F.col("hit.n").alias("n"), F.col("hit.verdict").alias("verdict"), F.col("hit.rule").alias("rule"))).alias("best"))
    return best.select("url", "best.rule", "best.verdict")


def judge_urls(df: DataFrame, rules: DataFrame, url_col: str = "url", id_col: str | None = None, default: str = "allow", sweep_rows: int = 100_000) -> DataFrame:
    """``id_col, host, path, rule, verdict`` for every row; without a fitting rule ``rule`` is null and ``default`` holds.

    A null URL or one without ``://`` has an empty host and path and no rule. Rules without a host or verdict are
    ignored; a rule without a path fits every path. Repeated rows are judged once and returned as often as
    they come. Only the id and URL columns are read. An empty table gives an empty result, no rules give the default.
    """
    pages = df.select(*([F.col(id_col).alias("id")] if id_col else []), F.col(url_col).cast("string").alias("url"))
    urls = pages.select("url").where("url is not null").distinct()
    judged = best_rules(urls.select("url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")), rules, sweep_rows)
    return pages.join(judged, "url", "left").select(
        *([F.col("id").alias(id_col)] if id_col else []), url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )
