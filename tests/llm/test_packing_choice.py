"""The choice among several capacities against single capacities and a plain best fit, item by item."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tributary.llm import packing


def bins_of(steps):
    """Contents and capacity of every bin."""
    held = {}
    for length, _, items, per_bin, first, offset, capacity, used in steps:
        for k in range(items // per_bin):
            contents, *_ = held.setdefault(first + k, ([], capacity, used))
            contents += [length] * per_bin
    return held


def cost_of(steps, cost=packing.default_cost):
    return sum(cost(capacity) for _, capacity, _ in bins_of(steps).values())


def plain_best_fit(lengths, capacity, sizes, cost=packing.default_cost):
    """Longest item first into the fullest bin that has room; every bin opens at one capacity and is cut down at the end."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(capacity - n)
    return sum(cost(min(c for c in sizes if c >= capacity - room)) for room in rooms)


CASES = {
    "one length that wastes the largest": ({3000: 100}, (512, 3000, 8192)),
    "two lengths, one for each capacity": ({700: 90, 2000: 60}, (700, 2048)),
    "long ones with fillers": ({5000: 40, 3000: 40, 100: 30}, (512, 1024, 2048, 4096, 8192)),
    "few short ones": ({10: 3, 40: 1}, (64, 512)),
}


@pytest.mark.parametrize("case", CASES)
def test_no_single_capacity_is_cheaper(case):
    histogram, sizes = CASES[case]
    lengths = [n for n, k in histogram.items() for _ in range(k)]
    steps = packing.plan(histogram, sizes)
    got = cost_of(steps)
    assert sorted(n for contents, _, _ in bins_of(steps).values() for n in contents) == sorted(lengths)
    assert all(sum(contents) == used <= capacity for contents, capacity, used in bins_of(steps).values())
    singles = [plain_best_fit(lengths, c, sizes) for c in sizes if c >= max(lengths)]
    assert got <= min(singles) + 1e-9
    if case.startswith(("one length", "two lengths")):
        largest = cost_of(packing.plan(histogram, (max(sizes),)))
        assert got < largest
    if case.startswith("two lengths"):
        assert {capacity for _, capacity, _ in bins_of(steps).values()} == set(sizes)


def test_random_lengths_stay_near_the_best_single_capacity():
    rng = random.Random(3)
    for _ in range(20):
        sizes = sorted(rng.sample(range(200, 1200), 3))
        lengths = [min(sizes[-1], int(rng.paretovariate(1.0) * 20)) for _ in range(400)]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        steps = packing.plan(histogram, sizes)
        assert sorted(n for contents, _, _ in bins_of(steps).values() for n in contents) == sorted(lengths)
        assert cost_of(steps) <= 1.03 * plain_best_fit(lengths, sizes[-1], sizes)


def test_lengths_are_worked_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def length(n):
        seen.add(1)
        return n % 7 + 1

    rows = spark.range(40).select(F.col("id").alias("doc_id"), length.asNondeterministic()("id").alias("length"))
    assert len(packing.pack(rows, capacities=(8, 16)).collect()) == 40
    assert seen.value == 40
