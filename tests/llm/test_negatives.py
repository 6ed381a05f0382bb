"""Hard negatives against all pairs, with like vectors, ties, huge numbers and rows that take no part."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.llm import negatives

SCHEMA = "ident long, label int, vector array<double>, anchor boolean, block string, slot int, cell string"


def _plain(rows, scale=256, positives=5, negatives_=5):
    good = []
    for ident, label, vector, anchor in rows:
        if None in (ident, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        good.append((ident, label, tuple(math.floor(scale * x) for x in vector), anchor))

    def score(a, b):
        return max(-(1 << 63), min((1 << 63) - 1, sum(x * y for x, y in zip(a, b))))

    out = []
    for ident, label, vector in {(g[0], g[1], tuple(np.trim_zeros(g[2], "b"))) for g in good if g[3]}:
        ranked = sorted((-score(vector, g[2]), g[0], g[1]) for g in good if g[0] != ident)
        for s, positive, _ in [r for r in ranked if r[2] == label][:positives]:
            fit = [r for r in ranked if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s]
            out += [(ident, positive, k, r[1], -s, -r[0]) for k, r in enumerate(fit[:negatives_], 1)]
    return sorted(out)


def _mined(spark, rows, monkeypatch=None):
    frame = spark.createDataFrame([(*r, "b", 1, "c") for r in rows], SCHEMA).repartition(3)
    return sorted(map(tuple, negatives.hard_negatives(negatives.rows_to_mine(frame, "ident", "label", "vector", F.col("anchor"))).collect()))


def _cloud(seed, n, spread, dims=8, centres=6):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dims))
    at = rng.integers(0, centres, n)
    vectors = middle[at] + spread * rng.normal(size=(n, dims))
    return [(int(k), int(rng.integers(0, 4)), vectors[k].tolist(), k % 9 == 0) for k in range(n)]


@pytest.mark.parametrize("spread", [0.01, 0.3, 3.0])
def test_clouds(spark, spread):
    rows = _cloud(1, 400, spread)
    assert _mined(spark, rows) == _plain(rows)


def test_edges(spark):
    rows = _cloud(2, 60, 0.5, dims=3, centres=2)
    rows += [(100, None, [1.0, 2.0], True), (None, 1, [1.0], True), (101, 1, None, True), (102, 1, [1.0, None], True), (103, 1, [math.nan], True),
             (104, 1, [math.inf, 0.0], False), (105, 2, [], True), (106, 2, [0.5], True), (107, 3, [0.5, 0.0, 0.0], True), (108, 2, [0.1] * 5, False)]
    rows += [(200, 0, [0.3, 0.3, 0.3], True)] * 3 + [(201, 1, [0.3, 0.3, 0.3], False)] * 8 + [(202, 0, [0.3, 0.3, 0.3], False)] * 7
    rows += [(300, 1, [0.2, 0.1, 0.0], True), (300, 2, [0.2, 0.1, 0.0], True)]
    assert _mined(spark, rows) == _plain(rows)


@pytest.mark.parametrize("size", [1e7, 1e12, 1e17])
def test_huge_components(spark, size):
    rng = random.Random(4)
    rows = [(k, k % 3, [size * rng.uniform(-0.2, 1) for _ in range(3)], k % 5 == 0) for k in range(60)]
    assert _mined(spark, rows) == _plain(rows)


def test_no_anchors_and_no_rows(spark):
    rows = [(k, k % 2, [1.0, float(k)], False) for k in range(9)]
    assert _mined(spark, rows) == []
    frame = spark.createDataFrame([], SCHEMA)
    assert negatives.hard_negatives(negatives.rows_to_mine(frame, "ident", "label", "vector", F.col("anchor"))).count() == 0


def test_far_rows_are_not_scored(monkeypatch):
    """Like anchors around a point: a block of candidates on the other side is told off by the bounds of the tree."""
    rng = np.random.default_rng(0)
    anchors = np.floor(1000 + 5 * rng.normal(size=(200, 16)))
    parent, depth = negatives.spanning_tree(anchors)
    assert (depth[np.arange(200) != depth.argmin()] == depth[parent[np.arange(200) != depth.argmin()]] + 1).all()
    data = negatives.boxed((np.arange(200), np.zeros(200, np.int64), anchors, parent, depth))
    tree = negatives.Tree((0, data, []), 1, 5, True)
    tree.take(negatives.Candidates(np.arange(1000, 1100), np.zeros(100, np.int64), np.floor(1000 + 5 * rng.normal(size=(100, 16)))))
    scored = []
    monkeypatch.setattr(negatives, "_cut", lambda s: scored.append(s.size) or s)
    tree.take(negatives.Candidates(np.arange(2000, 2500), np.zeros(500, np.int64), np.floor(-1000 + 5 * rng.normal(size=(500, 16)))))
    assert sum(scored) == 500  # the root's scores alone
