"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's set is its distinct word shingles as 64-bit hashes. Equal sets are one class from the start, so exact
copies never meet again. The smallest values of each class are its sketch; the first of them go into inverted
lists. Classes that share values there are candidates; the bottom of the union of the two sketches estimates their
Jaccard similarity and filters; full sets confirm.

Lists. For two sets above the threshold each of the smallest values of their union is in both with a probability of
at least the threshold, so sharing fewer than ``SHARED`` of ``INDEX`` values has a chance of about 4e-6. Order the values of
each class by the length of their lists, rarest first. Two classes that share at least s of their values share one that is among the first
k - s + 1 of both, so only those stay indexed: a value that many documents have in common stays for a class only if most of its values are such.

In each list all classes first meet one picked member, which is linear in the lists. Then only pairs between different components are left to try:
all of them in lists of at most ``LIST`` classes. The classes of longer lists that hold several components are indexed again, by ``SKETCH`` values, of which
``SHARED_WIDE`` must be shared (missed with about 5e-6), rarest among themselves first. Classes that are joined by such lists are a family, as edited copies of one text are that are too unlike to be
linked: a family is compared on full sets, block by block, and a pair of blocks gives a forest of links only. So no list is cut, and neither a common passage nor
a family gives all its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrow import on_workers, text_key
from .components import components
from .sketch import SHINGLE_WORDS, shingle_hashes

#: Values in a sketch, values of it that are indexed, classes in a list from which it is long.
SKETCH, INDEX, LIST = 64, 16, 32
#: Indexed values, and values of whole sketches, that a pair shares at least.
SHARED, SHARED_WIDE = 4, 32
#: Classes of a family in one block.
BLOCK = 512
#: Estimates below the threshold by more than this many standard deviations of the estimate are dropped.
DEVIATIONS = 4.5


def _sets(df: DataFrame, text: str, size: int) -> DataFrame:
    """Add ``hashes``, the sorted distinct shingle hashes."""
    return shingle_hashes(df, text, "hashes", size).withColumn("hashes", F.sort_array(F.array_distinct("hashes")))


def _signatures(df: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``id, key (of the text), n, class, sketch`` per row, written once; no class for an empty set."""
    rows = _sets(df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "text", size)
    digits = [F.lpad(F.hex(F.xxhash64("hashes", *seed)), 16, "0") for seed in ((), (F.lit(1),))]
    return materialize(
        rows.select(
            "id",
            text_key(F.col("text")).alias("key"),
            F.size("hashes").alias("n"),
            F.when(F.size("hashes") > 0, F.unhex(F.concat(*digits))).alias("class"),
            F.slice("hashes", 1, SKETCH).alias("sketch"),
        ),
        "signatures",
    )


def _sizes_fit(a: str, b: str, part: int, whole: int):
    """Sets of these sizes can reach the threshold."""
    return (F.col(a) * whole >= F.col(b) * part) & (F.col(b) * whole >= F.col(a) * part)


def _lists(classes: DataFrame, k: int, shared: int, part: int, whole: int) -> DataFrame:
    """``value, class, n, listed, picked``: inverted lists of the rarest values of each class, and a member of each list.

    Of ``k`` values those stay whose list is among the shortest; a list with one class that kept it is dropped.
    """
    values = classes.select("class", "n", F.explode(F.slice("sketch", 1, k)).alias("value"))
    lengths = values.groupBy("value").agg(F.count(F.lit(1)).alias("length"))
    rank = F.row_number().over(Window.partitionBy("class").orderBy("length", "value"))
    enough = F.least(F.lit(shared), F.ceil(F.col("n") * part / whole))  # a small set is indexed whole
    kept = values.join(lengths, "value").withColumn("rank", rank).where((F.col("rank") <= F.least(F.lit(k), "n") - enough + 1) & (F.col("length") > 1))
    # One and the same member is picked in lists of the same classes.
    listed = kept.groupBy("value").agg(F.count(F.lit(1)).alias("listed"), F.min(F.struct(F.xxhash64("class"), "class"))["class"].alias("picked")).where("listed > 1")
    return kept.select("value", "class", "n").join(listed, "value")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _between(lists: DataFrame, groups: DataFrame, part: int, whole: int) -> DataFrame:
    """Distinct pairs of classes that share a list but no component, of fitting sizes."""
    rows = _with_components(lists, groups).select("value", "class", "n", "component")
    other = rows.select("value", F.col("class").alias("y"), F.col("n").alias("m"), F.col("component").alias("y_of"))
    met = rows.join(other, "value").where((F.col("class") < F.col("y")) & (F.col("component") != F.col("y_of")) & _sizes_fit("n", "m", part, whole))
    return met.select(F.col("class").alias("a"), F.col("y").alias("b")).distinct()


def _estimated(pairs: DataFrame, classes: DataFrame, part: int, whole: int) -> DataFrame:
    """Keep pairs whose union sketch does not rule the threshold out."""
    least = part / whole - DEVIATIONS * (part / whole * (1 - part / whole) / SKETCH) ** 0.5
    left = classes.select(F.col("class").alias("a"), F.col("sketch").alias("s"), F.col("n").alias("m"))
    right = classes.select(F.col("class").alias("b"), F.col("sketch").alias("t"), F.col("n").alias("k"))
    joined = pairs.join(left, "a").join(right, "b").where(_sizes_fit("m", "k", part, whole))
    union = F.slice(F.sort_array(F.array_union("s", "t")), 1, SKETCH)
    both = F.size(F.array_intersect(F.array_intersect("s", "t"), union))
    # Whole small sets are in their sketches: for them this is the similarity itself.
    return joined.where(both >= F.size(union) * F.lit(least)).select(*pairs.columns)


def _verified(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs whose full sets have ``whole * intersection >= part * union``. Only sets of these pairs are moved."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    own = sets.join(ends, "class", "left_semi")
    left = own.select(F.col("class").alias("a"), F.col("hashes").alias("s"))
    right = own.select(F.col("class").alias("b"), F.col("hashes").alias("t"))
    joined = pairs.select("a", "b").join(left, "a").join(right, "b").withColumn("common", F.size(F.array_intersect("s", "t")))
    return joined.where(F.col("common") * whole >= (F.size("s") + F.size("t") - F.col("common")) * part).select("a", "b")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", part: int = 75, whole: int = 100, size: int = SHINGLE_WORDS) -> DataFrame:
    """``id, key, n_shingles, component, component_id, kept`` for every row of ``df``.

    Links join sets with ``whole * intersection >= part * union``. ``component_id`` is the smallest id reachable, ``kept``
    marks the rows with that id, ``component`` names the group and ``key`` the text. Null and empty texts
    have an empty set and a group of their own. Rows without an id join groups but never name one, so a group of them alone has a null
    ``component_id``. Repeated rows are links like any copies. Only two columns are read, so others cannot clash. A very long text is one row, whose
    set takes eight bytes a word. An empty table gives an empty result.
    """
    signed = _signatures(df, id_col, text_col, size)
    # Classes get numbers when they are written; joins and minima over numbers are cheap.
    found = signed.where("class is not null").groupBy("class", "n").agg(F.min("key").alias("key"), F.first("sketch").alias("sketch"))
    classes = materialize(found.withColumnRenamed("class", "digest").withColumn("class", F.monotonically_increasing_id()), "classes")
    lists = materialize(_lists(classes, INDEX, SHARED, part, whole), "lists")

    wanted = classes.select("key", "class").join(lists.select("class").distinct(), "class", "left_semi")
    texts = df.select(text_key(F.col(text_col)).alias("key"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).groupBy("key").agg(F.first("text").alias("text"))
    sets = materialize(_sets(texts.join(wanted, "key"), "text", size).select("class", "hashes"), "sets")

    groups = lists.select(F.col("class").alias("node"), F.col("class").alias("component")).limit(0)

    def joined(groups: DataFrame, pairs: DataFrame) -> DataFrame:
        """Components after the pairs that the full sets confirm."""
        tried = materialize(_estimated(pairs, classes, part, whole), "candidates")
        if tried.isEmpty():
            return groups
        more = materialize(_verified(tried, sets, part, whole), "links")
        # What is known of the groups stands for the links that made them.
        return components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    groups = joined(groups, lists.where("class <> picked").select(*_pair("class", "picked")).distinct())
    groups = joined(groups, _between(lists.where(F.col("listed") <= LIST), groups, part, whole))
    left = _parted(lists.where(F.col("listed") > LIST), groups).select("class").distinct()
    wide = materialize(_lists(classes.join(left, "class", "left_semi"), SKETCH, SHARED_WIDE, part, whole), "lists")
    if not wide.isEmpty():
        more = materialize(_within_families(_families(wide, groups), sets, groups, part, whole), "links")
        groups = components(groups.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more))

    of = classes.select("digest", "class").join(groups.select(F.col("node").alias("class"), "component"), "class").select(F.col("digest").alias("class"), "component")
    named = signed.join(of, "class", "left").withColumn("component", F.coalesce(F.hex(F.col("component")), F.hex("class")))
    least = named.where("component is not null").groupBy("component").agg(F.min("id").alias("least"))
    ids = named.join(least, "component", "left").withColumn("component_id", F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least")))
    return ids.select("id", "key", F.col("n").cast("long").alias("n_shingles"), "component", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _with_components(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of lists with the component of their class; a class without links is one of its own."""
    return lists.join(groups.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))


def _parted(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of lists that hold several components, with the component of each class."""
    rows = _with_components(lists, groups)
    parted = rows.groupBy("value").agg((F.min("component") < F.max("component")).alias("parted")).where("parted").select("value")
    return rows.join(parted, "value", "left_semi")


def _families(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """``class, family, size``: classes joined by lists that hold several components."""
    found = components(_parted(lists, groups).where("class <> picked").select(*_pair("class", "picked")))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    return found.join(sizes, "component").select(F.col("node").alias("class"), F.col("component").alias("family"), "size")


def _within_families(families: DataFrame, sets: DataFrame, groups: DataFrame, part: int, whole: int) -> DataFrame:
    """Links ``a, b`` between components of one family that its full sets confirm; of each pair of blocks a spanning forest."""

    def compare(table: pa.Table) -> pa.Table:
        column = table.column("hashes").combine_chunks()
        flat, sizes = column.flatten().to_numpy(), np.diff(column.offsets.to_numpy())
        classes, of = table.column("class").to_numpy(), table.column("component").to_numpy()
        _, place, often = np.unique(flat, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sizes)), sizes)[often[place] > 1]  # a value of one class is in no intersection
        place = (np.cumsum(often > 1) - 1)[place][often[place] > 1]
        common = np.zeros((len(sizes),) * 2, np.float32)
        for a in range(0, int(place.max(initial=-1)) + 1, 8192):
            held = np.zeros((len(sizes), 8192), np.float32)
            here = (place >= a) & (place < a + 8192)
            held[row[here], place[here] - a] = 1
            common += held @ held.T
        x, y = np.nonzero(np.triu(common * whole >= (sizes[:, None] + sizes - common) * part, 1) & (of[:, None] != of))
        roots, links = {c: c for c in of.tolist()}, []

        def root(c: int) -> int:
            while roots[c] != c:
                roots[c] = c = roots[roots[c]]
            return c

        for i, j in zip(x.tolist(), y.tolist(), strict=True):
            p, q = root(int(of[i])), root(int(of[j]))
            if p != q:
                roots[p] = q
                links.append((int(classes[i]), int(classes[j])))
        return pa.table({"a": pa.array([min(k) for k in links], pa.int64()), "b": pa.array([max(k) for k in links], pa.int64())})

    on_workers(families.sparkSession)
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = _with_components(families.select("class", "family", blocks.alias("blocks")), groups).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = placed.join(sets, "class").select("class", "family", "component", "hashes", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    pairs = met.select("class", "component", "hashes", "family", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    return pairs.groupBy("family", "i", "j").applyInArrow(compare, "a bigint, b bigint")


def one_of_each(df: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``df``, one for each component of ``near_duplicates`` and all with an empty set, columns unchanged.

    The row with the smallest id stays, of several with that id the one with the smallest text key. Columns travel as one value, so
    any names may occur.
    """
    own = groups.where("component is not null").groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key")).alias("kept")).select("kept.id", "kept.key")
    keyed = df.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias("key"), F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))
    empty = groups.where("component is null").select("id", "key").distinct()
    rows = keyed.groupBy("id", "key").agg(F.first("row").alias("row"))
    chosen = rows.join(own, (rows["id"].eqNullSafe(own["id"])) & (rows["key"] == own["key"]), "left_semi").select("row.*")
    free = keyed.join(empty, (keyed["id"].eqNullSafe(empty["id"])) & (keyed["key"] == empty["key"]), "left_semi").select("row.*")
    return chosen.unionByName(free)
