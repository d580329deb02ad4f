"""Near-duplicate vectors by sorted projection passes.

Equal vectors of one label are one class with a count. In each pass every class gets a code of random hyperplane signs;
classes are sorted by label and code and cut into blocks of equal size. A class is compared with all classes of
its own and the two neighbouring blocks. Where more neighbours than that share the first bits of the code (as many bits as
would part random vectors into blocks), as in a dense cluster, all blocks of that run are compared pair by pair
in tasks of their own, so a dense cluster is not cut at the window. A pair that several passes compare counts in
the first: each class carries its block and run in every pass. Tasks return counts and a spanning forest of the links they
verified, never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .arrow import map_arrow
from .components import components

#: Sorted passes at least, bits of a code, classes in a block, blocks that one task streams over.
PASSES, BITS, BLOCK, SHARD = 10, 48, 256, 32
#: Chance at most that no pass compares a pair whose cosine is the least that links.
MISS = 0.005


def passes_for(classes: int, least: float) -> int:
    """Passes that a label of so many classes needs for ``MISS``.

    A pass surely compares a pair whose codes agree in the first bits, as many as part random vectors into blocks. One bit
    agrees with a chance of 1 - angle / pi, whatever the other vectors are.
    """
    bits = min(BITS, max(0, math.ceil(math.log2(max(1, classes) / BLOCK))))
    agree = (1 - math.acos(max(-1.0, min(1.0, least))) / math.pi) ** bits
    return PASSES if agree == 1 or agree == 0 else max(PASSES, math.ceil(math.log(MISS) / math.log1p(-agree)))


def _codes(classes: DataFrame, passes: int) -> DataFrame:
    """``class, label, size, pass, code`` for every pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            dims = np.diff(vectors.offsets.to_numpy())
            flat = vectors.values.to_numpy(zero_copy_only=False)[vectors.offsets[0].as_py() :].astype(np.float64)
            starts = np.cumsum(dims) - dims
            codes = np.zeros((batch.num_rows, passes), np.int64)
            for d in np.unique(dims).tolist():
                if d not in planes:
                    planes[d] = np.random.Generator(np.random.PCG64(d)).standard_normal((d, passes * BITS))
                rows = np.flatnonzero(dims == d)
                x = flat[starts[rows][:, None] + np.arange(d)]
                codes[rows] = ((x @ planes[d]) > 0).reshape(len(rows), passes, BITS) @ weights
            n = batch.num_rows
            take = pa.array(np.repeat(np.arange(n), passes))
            yield pa.RecordBatch.from_arrays(
                [batch.column("class").take(take), batch.column("label").take(take), pa.array(np.repeat(dims, passes).astype(np.int32)), pa.array(np.tile(np.arange(passes, dtype=np.int32), n)), pa.array(codes.ravel())],
                ["class", "label", "dim", "pass", "code"],
            )

    kind = classes.schema["label"].dataType.simpleString()
    return map_arrow(classes.select("class", "label", "vector"), run, f"class bigint, label {kind}, dim int, pass int, code bigint")


def _ranked(codes: DataFrame) -> DataFrame:
    """``class, label, dim, pass, code, block``: blocks of equal size along the order by pass, label and code."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n))], [*batch.schema.names, "part", "at"])
            at += n

    order = ["pass", "label", "dim", "code", "class"]
    ordered = codes.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in codes.schema) + ", part int, at bigint"
    numbered = materialize(map_arrow(ordered, number, schema), "order")
    parts = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row for each range
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return numbered.join(before, "part").select("class", "label", "dim", "pass", "code", F.floor((F.col("before") + F.col("at")) / BLOCK).alias("block"))


def _placed(codes: DataFrame, classes: DataFrame) -> DataFrame:
    """Each class with its vector and, in pass order, its blocks and runs."""
    sizes = codes.where("pass = 0").groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = sizes.select("label", "dim", F.least(F.lit(BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK)))).cast("int").alias("bits"))
    ranked = _ranked(codes).join(bits, ["label", "dim"]).withColumn("run", F.expr(f"shiftright(code, {BITS} - bits)"))
    by_pass = F.sort_array(F.collect_list(F.struct("pass", "block", "run")))
    places = ranked.groupBy("class").agg(by_pass.alias("p"))
    return classes.join(places.select("class", F.col("p.block").alias("blocks"), F.col("p.run").alias("runs")), "class")


def _compare(rows: DataFrame, least: float, passes: int) -> DataFrame:
    """``class, other, links`` from sorted rows (task, step, role): classes of one step are compared with each other or over roles.

    ``links`` counts the rows of classes linked to ``class`` by pairs that this pass is the first to compare; ``other`` is the
    smallest class of the links' component within the comparison.
    """

    def verified(t: int, a: dict, b: dict | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Classes, their new links and their components, for pairs within a or between a and b."""
        x, y = a, a if b is None else b
        near = x["unit"] @ y["unit"].T >= least
        near &= (x["label"][:, None] == y["label"]) & (x["dim"][:, None] == y["dim"])
        if b is None:
            np.fill_diagonal(near, False)
        new = near.copy()
        i, j = np.nonzero(near)
        for s in range(t):  # only pairs that no earlier pass has compared stay
            apart = (np.abs(x["blocks"][i, s] - y["blocks"][j, s]) > 1) & (x["runs"][i, s] != y["runs"][j, s])
            new[i[~apart], j[~apart]] = False
            i, j = i[apart], j[apart]
        forward, back = new @ y["copies"], (x["copies"] @ new if b is not None else None)
        ids = x["class"] if b is None else np.concatenate([x["class"], y["class"]])
        labels, n = ids.copy(), len(x["class"])
        big = np.iinfo(np.int64).max
        while True:  # smallest class along the links, until nothing changes
            if b is None:
                least_id = np.minimum(labels, np.where(near, labels, big).min(axis=1, initial=big))
            else:
                least_id = np.minimum(labels, np.concatenate([np.where(near, labels[n:], big).min(axis=1, initial=big), np.where(near, labels[:n, None], big).min(axis=0, initial=big)]))
            if (least_id == labels).all():
                break
            labels = least_id
        return ids, forward if b is None else np.concatenate([forward, back]), labels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block_of(rows: list[dict]) -> dict | None:
            if not rows:
                return None
            dims = np.array([len(r["vector"]) for r in rows])
            vectors = np.zeros((len(rows), dims.max()))
            for k, r in enumerate(rows):
                vectors[k, : dims[k]] = r["vector"]
            codes = {}
            label = np.array([codes.setdefault(r["label"], len(codes)) for r in rows])
            unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
            return {"unit": unit, "dim": dims, "label": label, "raw": [r["label"] for r in rows], **{c: np.array([r[c] for r in rows], np.int64) for c in ("class", "copies", "blocks", "runs")}}

        def aligned(a: dict, b: dict) -> tuple[dict, dict]:
            """Both blocks with labels numbered alike and vectors of one width."""
            codes: dict = {}
            out = []
            width = max(a["unit"].shape[1], b["unit"].shape[1])
            for x in (a, b):
                out.append(x | {"label": np.array([codes.setdefault(v, len(codes)) for v in x["raw"]]), "unit": np.pad(x["unit"], ((0, 0), (0, width - x["unit"].shape[1])))})
            return out[0], out[1]

        def results(found: list) -> pa.RecordBatch:
            ids, links, labels = (np.concatenate(c) if found else np.empty(0, np.int64) for c in (zip(*found, strict=True) if found else ((), (), ())))
            keep = (links > 0) | (labels != ids)
            return pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.array(labels[keep]), pa.array(links[keep].astype(np.int64))], ["class", "other", "links"])

        def finish(key: tuple, rows: list[dict], before: tuple | None) -> tuple[list, dict]:
            """Compare a finished block with itself and with the one before it, unless it is only there to be compared with."""
            task, t, step, role = key
            block = block_of(rows)
            found = []
            if role >= 0:  # 0: a block of its own; 1, 2: the two sides of a pair of blocks
                if role == 0:
                    found.append(verified(t, block, None))
                if before and before[0][:2] == key[:2] and (role != 1) and (before[0][2] == step - (role == 0)):
                    a, b = aligned(before[1], block)
                    found.append(verified(t, a, b))
            return found, block

        key, rows, before = None, [], None
        for batch in batches:
            found = []
            for r in batch.to_pylist():
                now = (r["task"], r["pass"], r["step"], r["role"])
                if now != key and rows:
                    more, block = finish(key, rows, before)
                    found += more
                    before, rows = (key, block), []
                key = now
                rows.append(r)
            if found:
                yield results(found)
        if rows:
            yield results(finish(key, rows, before)[0])

    return map_arrow(rows, run, "class bigint, other bigint, links bigint")


def _tasks(placed: DataFrame, passes: int) -> DataFrame:
    """Rows dealt to comparisons: streams of neighbouring blocks, and pairs of blocks further apart in one run."""
    every = placed.select("*", F.posexplode("blocks").alias("pass", "block")).withColumn("run", F.col("runs")[F.col("pass")])
    columns = ["task", "pass", "step", "role", "class", "label", "vector", "copies", "blocks", "runs"]
    shard = F.floor(F.col("block") / SHARD)
    streams = every.select("*", F.concat(F.lit("s"), shard).alias("task"), F.col("block").alias("step"), F.lit(0).alias("role")).select(columns)
    # The last block of a stream is there again before the first of the next one.
    carried = every.where(F.col("block") % SHARD == SHARD - 1).select("*", F.concat(F.lit("s"), shard + 1).alias("task"), F.col("block").alias("step"), F.lit(-1).alias("role")).select(columns)
    runs = every.groupBy("pass", "label", F.size("vector").alias("dim"), "run").agg(F.min("block").alias("from"), F.max("block").alias("upto")).where(F.col("upto") - F.col("from") > 1)
    long = every.withColumn("dim", F.size("vector")).join(runs, ["pass", "label", "dim", "run"])
    spread = long.withColumn("other", F.explode(F.sequence("from", "upto"))).where(F.abs(F.col("other") - F.col("block")) > 1)
    low, high = F.least("block", "other"), F.greatest("block", "other")
    # The run is part of the name: blocks at the ends of a run also hold rows of other runs, which stay away here.
    pairs = spread.select("*", F.concat_ws("-", F.lit("p"), "label", "dim", "run", low, high).alias("task"), F.lit(0).cast("long").alias("step"), F.when(F.col("block") < F.col("other"), 1).otherwise(2).alias("role")).select(columns)
    return streams.unionByName(carried).unionByName(pairs)


def near_vectors(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = 0.93, passes: int = PASSES) -> DataFrame:
    """``id_col, n_links, component_id, kept`` for every row.

    Rows link when their labels are equal and not null and the cosine of their vectors, in double precision, is at least ``least``.
    Vectors that are null, empty or zero, hold a null or a non-finite component, or differ in length link with nothing. ``n_links`` counts
    other rows, copies included; ``component_id`` is the smallest id reachable and ``kept`` marks the row with that id. Null ids take part but
    never name a component. An empty table gives an empty result. Found pairs are exact; a linked pair is missed if no pass
    brings it together, which has a chance of at most ``MISS``: ``passes`` is raised to what the largest label needs for that.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), F.col(label_col).alias("label"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists("vector", lambda v: v != 0), F.lit(False))
    keys = [F.xxhash64("vector").alias("k"), F.xxhash64("vector", F.lit(1)).alias("l")]
    good = rows.where(usable).select("id", "vector", "label", *keys)
    grouped = good.groupBy("label", "k", "l").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    classes = materialize(grouped.withColumn("class", F.monotonically_increasing_id()), "vectors")

    largest = classes.groupBy("label", F.size("vector")).count().agg(F.max("count")).first()[0] or 0
    passes = max(passes, passes_for(largest, least))
    codes = materialize(_codes(classes, passes), "codes")
    placed = materialize(_placed(codes, classes).select("class", "label", "vector", "copies", "blocks", "runs"), "placed")
    tasks = _tasks(placed, passes).repartition("task").sortWithinPartitions("task", "pass", "step", "role")
    found = materialize(_compare(tasks, least, passes), "found")

    groups = components(found.where("class <> other"), "class", "other")
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    of = classes.select("label", "k", "l", "class", "copies", "least").join(groups.withColumnRenamed("node", "class"), "class", "left").join(links, "class", "left")
    of = of.withColumn("component", F.coalesce("component", "class"))
    names = of.groupBy("component").agg(F.min("least").alias("component_id"))
    of = of.join(names, "component").select("label", "k", "l", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    linked = good.select("id", "label", "k", "l").join(of, ["label", "k", "l"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))
