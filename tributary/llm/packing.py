"""Best-fit packing of documents into sequences of several permitted lengths.

Lengths are at most the largest capacity, so the whole corpus is summed up in a histogram of that many entries. Best fit
runs over the histogram, long items first: all bins with equal room are one group, and one step places as many equal items
as the tightest group takes. When no open bin has room, each capacity is tried on the remaining items: a bin is filled with the longest that fit, as
many as there are for each new bin, and the capacity that then costs least per token is opened. At the end each bin is cut down to the smallest permitted capacity that holds its
contents. Every step is one *placement*: so many items of one length, so many to a bin, into consecutive bins.
Items are then numbered within their length, and the number finds the placement: no item ever passes the driver.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .sketch import words

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Lanes in which the items of one length are numbered.
LANES = 64

PLACEMENT = "length int, first long, items long, per_bin long, bin long, offset int, capacity int, used int"


def default_cost(capacity: int) -> float:
    """Padding is paid for by the token, and every sequence has a fixed price."""
    return capacity + 16.0


def plan(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = default_cost) -> list[tuple]:
    """Placements ``(length, first item, items, items per bin, first bin, offset, capacity, used)``.

    A placement fills consecutive bins that end up with the same capacity and the same contents. The histogram holds lengths from 1 to the largest capacity. Groups of open bins have equal room; of several such groups
    the one opened first is filled first.
    """
    sizes = sorted(capacities)
    lengths = sorted((n for n in histogram if histogram[n] > 0), reverse=True)
    rising = lengths[::-1]
    rooms: list[int] = []  # sorted distinct rooms of open groups
    groups: dict[int, list[list[int]]] = defaultdict(list)  # room -> [first bin, bins, capacity]
    placements, done, opened = [], [], 0

    def put_back(room: int, group: list[int]) -> None:
        if not group[1]:
            return
        if room < (lengths[-1] if lengths else 0):
            done.append((*group[:2], group[2], group[2] - room))
            return
        if room not in groups or not groups[room]:
            insort(rooms, room)
        groups[room].append(group)

    for length in lengths:
        item, count = 0, histogram[length]
        while count:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = groups[room].pop(0)
                if not groups[room]:
                    del groups[room]
                    rooms.pop(at)
            else:
                capacity = min((c for c in sizes if c >= length), key=lambda c: (_filled_cost(c, length, count, histogram, rising, sizes, cost), -c))
                per_bin = min(capacity // length, count)
                group, room = [opened, max(1, count // per_bin), capacity], capacity
                opened += group[1]
            per_bin = min(room // length, count)
            bins = min(group[1], count // per_bin)
            placements.append((length, item, bins * per_bin, per_bin, group[0], group[2] - room))
            item, count = item + bins * per_bin, count - bins * per_bin
            put_back(room - per_bin * length, [group[0], bins, group[2]])
            put_back(room, [group[0] + bins, group[1] - bins, group[2]])
    for room in list(rooms):
        done.extend((*g[:2], g[2], g[2] - room) for g in groups[room])
    return _by_final_bin(placements, sorted((first, bins, next(c for c in sizes if c >= used), used) for first, bins, _, used in done))


def _filled_cost(capacity: int, length: int, count: int, histogram: dict[int, int], rising: list[int], sizes: Sequence[int], cost: Callable[[int], float]) -> float:
    """Cost per token of a bin of this capacity that ``count`` items of ``length`` open and shorter ones fill up.

    The bins opened together share the shorter items evenly; the bin is paid for as it is cut down in the end.
    """
    per_bin = min(capacity // length, count)
    bins, used = max(1, count // per_bin), per_bin * length
    at = bisect_right(rising, min(length - 1, capacity - used)) - 1
    while at >= 0:
        n = rising[at]
        used += min((capacity - used) // n, histogram[n] // bins) * n
        at = min(at, bisect_right(rising, capacity - used)) - 1
    return cost(next(c for c in sizes if c >= used)) / used


def _by_final_bin(placements: list[tuple], finals: list[tuple]) -> list[tuple]:
    """Cut placements where their bins ended up different, and add what the bins ended up as."""
    starts = [f[0] for f in finals]
    out = []
    for length, item, items, per_bin, first, offset in placements:
        stop, at = first + items // per_bin, bisect_right(starts, first) - 1
        while first < stop:
            begin, bins, capacity, used = finals[at]
            count = min(stop, begin + bins) - first
            out.append((length, item, count * per_bin, per_bin, first, offset, capacity, used))
            first, item, at = first + count, item + count * per_bin, at + 1
    return out


def pieces(df: DataFrame, id_col: str, length_col: str, largest: int) -> DataFrame:
    """``id, piece, begin, length``: an item longer than the largest capacity becomes full pieces and a rest.

    A null or non-positive length has no piece.
    """
    rows = df.select(F.col(id_col).alias("id"), F.col(length_col).cast("long").alias("total")).where("total > 0")
    cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("total") - 1) / largest))))
    return cut.select("id", "piece", (F.col("piece") * largest).alias("begin"), F.least(F.lit(largest), F.col("total") - F.col("piece") * largest).cast("int").alias("length"))


def _numbered(items: DataFrame) -> DataFrame:
    """Add ``item``, a number from 0 within the length. A length that many items have is numbered in lanes."""
    laned = items.withColumn("lane", F.pmod(F.xxhash64("id", "piece"), F.lit(LANES)).cast("int"))
    own = laned.withColumn("place", F.row_number().over(Window.partitionBy("length", "lane").orderBy("id", "piece")) - 1)
    totals = laned.groupBy("length", "lane").agg(F.count(F.lit(1)).alias("n"))
    before = totals.select("length", "lane", (F.sum("n").over(Window.partitionBy("length").orderBy("lane")) - F.col("n")).alias("before"))
    return own.join(before, ["length", "lane"]).select("id", "piece", "begin", "length", (F.col("before") + F.col("place")).alias("item"))


def pack(df: DataFrame, id_col: str = "doc_id", length_col: str = "length", capacities: Sequence[int] = CAPACITIES, cost: Callable[[int], float] = default_cost) -> DataFrame:
    """``id_col, piece, begin, length, bin, offset, capacity`` for every piece of every row.

    ``begin`` is the piece's place in its document, ``offset`` its place in the sequence ``bin``, whose permitted length is ``capacity``.
    Rows of one id are items of their own; null ids are items like any other; rows without a positive
    length have no piece; an empty table gives an empty result. The driver holds the histogram and the placements, which
    the largest capacity bounds and not the rows.
    """
    items = materialize(pieces(df, id_col, length_col, max(capacities)), "pieces")  # a length may cost a pass over the texts
    histogram = {r.length: r.n for r in items.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    steps = df.sparkSession.createDataFrame(plan(histogram, capacities, cost), PLACEMENT)
    inside = (F.col("item") >= F.col("first")) & (F.col("item") < F.col("first") + F.col("items"))
    placed = _numbered(items).join(F.broadcast(steps), "length").where(inside)
    at = F.col("item") - F.col("first")
    return placed.select(
        F.col("id").alias(id_col),
        "piece",
        "begin",
        "length",
        (F.col("bin") + F.floor(at / F.col("per_bin"))).alias("bin"),
        (F.col("offset") + at % F.col("per_bin") * F.col("length")).cast("int").alias("offset"),
        "capacity",
    )


def word_length(text_col: str = "text"):
    """Words of a text and one end mark: the length that the queries pack by."""
    return F.size(words(F.col(text_col))) + 1
