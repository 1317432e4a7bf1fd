"""Hard negatives against a plain version: windows, ties, odd rows, deep trees."""

import math
import random

import numpy as np
from conftest import SF_SMALL
from pyspark.sql import functions as F

from terrace.llm import cover_tree

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, is_anchor, positives=5, negatives=10):
    """(anchor, positive, rank, negative, scores) of rows (id, vector, label)."""
    held = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            held[i] = ([math.floor(256 * x) for x in v], label)
    out = []
    for a, (q, mine) in held.items():
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, label) for i, (v, label) in held.items() if i != a)
        for s, i, label in [r for r in scored if r[2] == mine][:positives]:
            p = -s
            hard = [(j, -t) for t, j, other in scored if other != mine and 30 * p <= -100 * t <= 90 * p][:negatives]
            out += [(a, i, n + 1, j, p, t) for n, (j, t) in enumerate(hard)]
    return sorted(out)


def same(spark, rows, is_anchor=lambda i: i % 100 == 0, condition="vec_id % 100 = 0"):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS v", "2 AS node", "'x' AS rank", "3 AS score").repartition(3)
    got = cover_tree.mine(df, df.where(condition))
    assert sorted(map(tuple, got.collect())) == plain(rows, is_anchor)


def shapes(monkeypatch):
    for name, value in (("LEAF", 32), ("FANOUT", 8), ("LEAST", 3), ("SAMPLE", 64), ("PART", 32), ("ASKING", 4)):
        monkeypatch.setattr(cover_tree, name, value)


def test_embeddings(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    moved = cover_tree.relabelled(table).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), "label")
    same(spark, [tuple(r) for r in moved.collect()])


def test_deep_tree_of_clusters(spark, monkeypatch):
    """Nodes outside the windows are left out and the rows stay whole."""
    shapes(monkeypatch)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=8) * 0.1).tolist(), int(rng.integers(0, 3))) for i in range(600)]
    visited = []
    verify = cover_tree.verify
    monkeypatch.setattr(cover_tree, "verify", lambda front, placed, *a: visited.append(
        (front.join(placed.select("node"), "node").count(), front.select("qid").distinct().count())) or verify(front, placed, *a))
    same(spark, rows)
    seen, asked = visited[1]  # the second walk for positives
    assert seen < 0.5 * asked * len(rows)


def test_hot_vectors_ties_and_repeats(spark, monkeypatch):
    shapes(monkeypatch)
    rng = random.Random(1)
    few = [[1.0, 0.0, 0.5], [0.9, 0.1, 0.5], [0.0, 1.0, 0.0], [-1.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
    rows = [(i, rng.choice(few[:1] * 5 + few), rng.randrange(3)) for i in range(400)]
    same(spark, rows + rows[:50])


def test_odd_rows(spark):
    good = [(i, [0.1 * (i % 7), 0.2 * (i % 5), -0.1 * (i % 3), 0.5], i % 2) for i in range(0, 400, 10)]
    odd = [(1000, None, 1), (1100, [0.1, None, 0.1, 0.1], 1), (1200, [float("nan")] * 4, 1), (1300, [float("inf")] * 4, 0),
           (None, [1.0] * 4, 1), (1400, [1.0] * 4, None)]
    same(spark, good + odd)
    # Vectors of another length and those too long for 64-bit scores take no part.
    df = spark.createDataFrame(good + odd + [(1500, [1.0], 1), (1600, [1e7] * 4, 1), (1700, [1e300] * 4, 1)], SCHEMA)
    got = cover_tree.mine(df, df.where("vec_id % 100 = 0"))
    assert sorted(map(tuple, got.collect())) == plain(good, lambda i: i % 100 == 0)
    empty = spark.createDataFrame([], SCHEMA)
    assert cover_tree.mine(empty, empty).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0], 1)], SCHEMA)
    assert cover_tree.mine(one, one).count() == 0
    # Whole numbers beyond a double's 53 bits stay exact.
    large = [(i, [2.0 ** 19 + i, 2.0 ** 18 - i / 256], i % 2) for i in range(40)]
    same(spark, large, lambda i: i % 10 == 0, "vec_id % 10 = 0")


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = np.floor(rng.normal(size=(500, 6)) * 100)
    norm2 = float((x ** 2).sum(1).max())
    lifted = cover_tree._lifted(x, norm2)
    centres = lifted[cover_tree.net(lifted)]
    far = cover_tree._distance(lifted, centres)
    part = far.argmin(1)
    radius = np.array([far[part == c, c].max() for c in range(len(centres))])
    q = np.floor(rng.normal(size=(50, 6)) * 100)
    least, largest = cover_tree._bounds(q, centres, radius, norm2)
    true = q @ x.T
    assert (true <= largest[:, part]).all() and (true >= least[:, part]).all()
    apart = cover_tree._distance(centres, centres) + np.eye(len(centres)) * 1e9
    assert cover_tree.LEAST <= len(centres) <= cover_tree.FANOUT and apart.min() > 0
