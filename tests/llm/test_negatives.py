import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from palaver.llm import negatives

SCHEMA = "vec_id long, label int, embedding array<float>, part long, home string, score int, rank int"


def plain(rows, every=50, positives=5, least=3, change=True):
    """By the definition: all rows against every anchor."""
    kept = []
    for number, (vec_id, label, vector) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        if change and vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        kept.append((number, vec_id, label, [math.floor(256 * x) for x in vector]))

    def order(item):
        score, vec_id = item
        return -score, vec_id is not None, vec_id or 0

    out = []
    for number, anchor_id, label, a in kept:
        if anchor_id is None or anchor_id % every:
            continue
        scored = [(sum(x * y for x, y in zip(a, v)), i, lab) for n, i, lab, v in kept if n != number]
        same = sorted(((s, i) for s, i, lab in scored if lab == label), key=order)[:positives]
        other = sorted(((s, i) for s, i, lab in scored if lab != label), key=order)
        for score, positive in same:
            inside = [(s, i) for s, i in other if 50 * score <= 100 * s <= 95 * score][:least]
            out += [(anchor_id, positive, rank + 1, i, score, s) for rank, (s, i) in enumerate(inside)]
    return sorted(out, key=repr)


def rows(frame):
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert frame.columns == columns
    return sorted(map(tuple, frame.collect()), key=repr)


def table(spark, found, parts=5):
    return spark.createDataFrame([(*row, 3, "clash", 1, 2) for row in found], SCHEMA).repartition(parts)


def float32(vector):
    return [float(np.float32(x)) for x in vector]


def vectors(seed, count, dims=6, spread=0.15, labels=4):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dims)] for _ in range(labels * 2)]
    out = []
    for i in range(count):
        label = 0 if rng.random() < 0.34 else rng.randrange(labels)
        centre = centres[rng.randrange(2) * labels + label]
        out.append((i, label, float32(c + rng.gauss(0, spread) for c in centre)))
    return out


@pytest.fixture
def small_blocks(monkeypatch):
    """Many blocks, parts and chunks of zone maps from few rows."""
    monkeypatch.setattr(negatives, "BLOCK", 8)
    monkeypatch.setattr(negatives, "PART_BLOCKS", 3)
    monkeypatch.setattr(negatives, "CHUNK_PARTS", 4)
    monkeypatch.setattr(negatives, "BATCH", 4)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(spark, small_blocks, seed):
    found = vectors(seed, 700)
    assert rows(negatives.hard_negatives(table(spark, found), every=10)) == plain(found, every=10)


def test_ties_copies_and_repeated_rows(spark, small_blocks):
    """Equal vectors in both labels, equal ids, and scores that meet a window's ends exactly."""
    found = [(i, i % 3, [float(i % 4), 1.0]) for i in range(160)]
    found += [(50, 1, [1.0, 1.0]), (50, 1, [1.0, 1.0]), (100, 2, [0.5, 0.5]), (None, 1, [2.0, 1.0]), (None, 2, [1.0, 1.0])]
    found += [(900, 1, [20.0, 0.0]), (901, 1, [20.0, 0.0]), (902, 2, [19.0, 0.0]), (903, 2, [10.0, 0.0]), (904, 2, [9.99, 0.0])]
    found = [(a, b, float32(v)) for a, b, v in found]
    got = rows(negatives.hard_negatives(table(spark, found)))
    assert got == plain(found) and any(r[0] == 900 and r[3] == 902 for r in got)


def test_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    found = vectors(9, 120)
    found += [
        (200, None, [1.0] * 6), (250, 1, None), (300, 1, [nan] + [1.0] * 5), (350, 1, [inf] * 6), (400, 1, [None] * 6),
        (450, 1, []), (500, 2, [0.5]), (550, 2, [-5.0] * 6), (600, 99, [9.0] * 6), (650, 1, [0.3] * 6 + [0.2]),
    ]
    assert rows(negatives.hard_negatives(table(spark, found))) == plain(found)


def test_large_components_stay_exact(spark):
    """Sums beyond the narrow float are taken in wider numbers."""
    rng = random.Random(1)
    for size in (40.0, 3000.0, 90_000.0):
        found = [(i, i % 2, float32(rng.uniform(-size, size) for _ in range(8))) for i in range(150)]
        assert rows(negatives.hard_negatives(table(spark, found))) == plain(found)


def test_empty_and_lonely(spark):
    assert rows(negatives.hard_negatives(table(spark, []))) == []
    assert rows(negatives.hard_negatives(table(spark, [(0, 1, [1.0])]))) == []
    assert rows(negatives.hard_negatives(table(spark, [(None, 1, [1.0]), (1, 1, [1.0])]))) == []
    assert rows(negatives.hard_negatives(table(spark, [(0, None, None)]))) == []


def test_bounds_hold_and_are_reached():
    rng = np.random.default_rng(3)
    a, v = rng.integers(-300, 300, (40, 5)), rng.integers(-300, 300, (60, 5))
    least, most = negatives.bounds(a.astype(np.int32), v.min(0, keepdims=True), v.max(0, keepdims=True))
    scores = negatives.products(a, v)
    assert (least <= scores).all() and (scores <= most).all()
    low, high = v.min(0), v.max(0)
    corners = np.array(list(itertools.product(*zip(low, high))))
    assert (negatives.products(a, corners).max(1, keepdims=True) == most).all()
    assert (negatives.products(a, corners).min(1, keepdims=True) == least).all()


@pytest.mark.parametrize("dims, bits", [(2, 4), (3, 3), (5, 2), (4, 1)])
def test_hilbert_curve_visits_neighbours(dims, bits):
    """Every cell has its own place, and cells that follow each other differ by one step."""
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    index = negatives.hilbert_index(cells, bits).astype(np.int64)
    assert sorted(index.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(index)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_zone_maps_spare_clustered_anchors_most_parts(spark, small_blocks, monkeypatch):
    """Groups reach a small share of the parts, and the result is the same."""
    found = vectors(4, 1500, dims=12, spread=0.01, labels=8)
    frame = negatives.prepared(table(spark, found))
    curve = negatives.Curve(frame)
    blocks = negatives.candidate_blocks(frame, curve, 10, 5)
    parts = blocks.filter("block = 0").count()
    groups = blocks.filter("block = 0 and octet_length(places) > 0").select(
        F.col("part").alias("home"), *(field.split()[0] for field in negatives._GROUP_FIELDS.split(", "))
    )
    routed = negatives._routed(groups, blocks, parts, curve.dims, negatives._needs_for_positives)
    assert routed.count() < 0.25 * parts * groups.count()
    assert rows(negatives.hard_negatives(table(spark, found), every=10)) == plain(found, every=10)
