"""Odd sketches lose no similar pair, and filters of fixed size no key."""

import numpy as np
import pytest

from repopulse.llm import sketches
from repopulse.llm.common import KeyFilter, ship
from repopulse.llm.sketches import Sketches, near_members, near_rows, odd_sketch, spanning


def random_set(rng, size):
    return np.unique(rng.integers(0, 2**63, size).astype(np.uint64))


def test_sketches_differ_in_no_more_bits_than_sets():
    rng = np.random.default_rng(1)
    for size in (1, 5, 43, 300, 2000, 120_000):
        a = random_set(rng, size)
        for less, more in ((0, 0), (size // 9, size // 9), (0, size // 4), (size - 1, size)):
            b = np.unique(np.concatenate([np.delete(a, slice(less)), random_set(rng, more)]))
            found = Sketches([odd_sketch(a), odd_sketch(b)])
            differ = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
            for pair in ((0, 1), (1, 0)):
                distance = int(found.distances(np.array(pair[:1]), np.array(pair[1:]))[0])
                assert distance <= differ and distance % 2 == differ % 2
                assert distance or not differ or differ < 30


def test_unrelated_sets_are_told_apart():
    rng = np.random.default_rng(2)
    sizes = np.sort(rng.integers(100, 3000, 80))
    raw = [odd_sketch(random_set(rng, size)) for size in sizes]
    one, other = near_rows((80, 100), np.zeros(80, int), np.full(80, -1), sizes, Sketches(raw))
    assert not len(one)


def test_long_sets_have_bounded_sketches():
    assert len(odd_sketch(random_set(np.random.default_rng(3), 300_000))) == sketches.MOST_BITS // 8


def test_spanning():
    rng = np.random.default_rng(4)
    for _ in range(100):
        one, other = np.sort(rng.integers(0, 30, (2, rng.integers(1, 40))), axis=0)
        one, other = one[one < other], other[one < other]
        row, first = spanning(30, one, other)
        assert (first < row).all()

        def parts(a, b):
            label = list(range(30))
            for i, j in zip(a.tolist(), b.tolist()):
                old, new = label[j], label[i]
                label = [new if x == old else x for x in label]
            return {frozenset(k for k in range(30) if label[k] == x) for x in label}

        assert parts(one, other) == parts(first, row)


@pytest.mark.parametrize("block", [1024, 7])
def test_all_near_pairs_are_connected(spark, monkeypatch, block):
    """Through groups larger than a block, and groups with equal members."""
    monkeypatch.setattr(sketches, "BLOCK", block)
    ship(spark)
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(6):
        base = random_set(rng, int(rng.integers(60, 200)))
        sets += [np.unique(np.concatenate([rng.permutation(base)[k:], random_set(rng, k)])) for k in rng.integers(0, 12, 8)]
    nodes = [(n, len(own), odd_sketch(own)) for n, own in enumerate(sets)]
    shared = [(s, n) for s in range(3) for n in range(len(sets))] + [(9, n) for n in range(4)]
    frames = (spark.createDataFrame(rows, schema) for rows, schema in ((shared, "signature long, node long"), (nodes, "node long, size long, sketch binary")))
    found = {(row.node, row.first) for row in near_members(*frames, (80, 100), "test").collect()}
    label = list(range(len(sets)))
    for a, b in found:
        old, new = label[a], label[b]
        label = [new if x == old else x for x in label]
    for a in range(len(sets)):
        for b in range(a):
            both = len(np.intersect1d(sets[a], sets[b]))
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                assert label[a] == label[b]
    assert len(set(label)) >= 6


def test_key_filter_loses_none(spark):
    ship(spark)
    keys = spark.range(-300, 3000, 7)
    rows = spark.range(-300, 60_000)
    passed = {row.id for row in rows.where(KeyFilter(keys, "id").passes(rows.id)).collect()}
    assert set(range(-300, 3000, 7)) <= passed and len(passed) < 500
    nothing = KeyFilter(keys.where("false"), "id")
    assert rows.where(nothing.passes(rows.id)).count() == 0
