"""Pair counts against brute force, on baskets that are narrow, wide, flat, tied and dominated by one basket."""

import random
from collections import Counter
from itertools import combinations

import pytest

from tillstar.operators.affinity import top_pairs


def brute(lines, k):
    baskets = {}
    for basket, item in lines:
        baskets.setdefault(basket, []).append(item)
    scores = Counter()
    for items in baskets.values():
        for a, b in combinations(items, 2):
            if a != b:
                scores[min(a, b), max(a, b)] += 1
    best = sorted(scores.items(), key=lambda s: (-s[1], s[0]))[:k]
    return [(p, q, n) for (p, q), n in best]


def case(seed):
    rnd = random.Random(seed)
    lines = [(rnd.randrange(30), rnd.randrange(25)) for _ in range(150)]
    shape = seed % 5
    if shape == 0:  # one basket holds a third of all lines
        lines += [(100, rnd.randrange(25)) for _ in range(75)]
    elif shape == 1:  # flat wide baskets: every item once, so all pairs tie
        lines += [(b, i) for b in (100, 101) for i in range(25)]
    elif shape == 2:  # an item that is everywhere
        lines += [(rnd.randrange(30), 7) for _ in range(100)]
    elif shape == 3:  # wide baskets over items the narrow ones do not have
        lines += [(b, 50 + rnd.randrange(12)) for b in (100, 101, 102) for _ in range(20)]
    else:  # only one wide basket, nothing else
        lines = [(1, rnd.randrange(9)) for _ in range(60)]
    return lines


@pytest.mark.parametrize("seed, wide", [*[(s, 8) for s in range(10)], (0, 1), (1, 1), (4, 1), (2, 1000)])
def test_matches_brute_force(spark, seed, wide):
    lines = case(seed)
    df = spark.createDataFrame(lines, "o bigint, p bigint")
    k = 5 if seed % 2 else 3
    assert [tuple(r) for r in top_pairs(df, "o", "p", k, wide).collect()] == brute(lines, k)


def test_fewer_pairs_than_asked_for(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (2, None)], "o bigint, p bigint")
    for wide in (1, 100):
        assert [tuple(r) for r in top_pairs(df, "o", "p", 5, wide).collect()] == [(1, 2, 2)]


def test_a_flat_basket_of_many_items(spark):
    """Its 5 * 10^9 pairs are never formed, whether the best pairs tie with them or beat them."""
    flat = spark.range(100_000).selectExpr("0L AS o", "id AS p")
    assert [tuple(r) for r in top_pairs(flat, "o", "p", 3).collect()] == [(0, 1, 1), (0, 2, 1), (0, 3, 1)]
    some = [(1, 70_000), (1, 70_001), (2, 70_001), (2, 70_002), (2, 70_000), (3, 5), (3, 99_999)]
    lines = flat.union(spark.createDataFrame(some, "o bigint, p bigint"))
    # 70000 and 70001 meet in three baskets, the others in two
    assert [tuple(r) for r in top_pairs(lines, "o", "p", 4).collect()] == [
        (70_000, 70_001, 3), (5, 99_999, 2), (70_000, 70_002, 2), (70_001, 70_002, 2)]
    assert [tuple(r) for r in top_pairs(lines, "o", "p", 6).collect()][4:] == [(0, 1, 1), (0, 2, 1)]


def test_many_flat_baskets(spark):
    """Wide baskets over the same items: only pairs that beat the usual score are looked at."""
    rnd = random.Random(3)
    lines = [(b, i) for b in range(40) for i in rnd.sample(range(2000), 300)]
    lines += [(b, i) for b in range(40, 52) for i in (17, 1234)]
    df = spark.createDataFrame(lines, "o bigint, p bigint")
    assert [tuple(r) for r in top_pairs(df, "o", "p", 5, wide_basket=100).collect()] == brute(lines, 5)
