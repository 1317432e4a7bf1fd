"""Nearest neighbours: recall, order, odd vectors, hot vectors."""

import numpy as np
from conftest import SF_SMALL
from pyspark.sql import functions as F

from terrace.llm import ann

SCHEMA = "vec_id long, embedding array<float>"


def check(rows, ids, vectors, k=20):
    """Share of true neighbours found; order, scores and ranks must hold."""
    at = {i: n for n, i in enumerate(ids)}
    by_query = {}
    for r in rows:
        by_query.setdefault(r.query_id, []).append(r)
    hit = total = 0
    for q, found in by_query.items():
        scores = vectors @ vectors[at[q]]
        scores[np.array(ids) == q] = -np.inf
        order = [n for n in np.lexsort((ids, -scores)) if np.isfinite(scores[n])][:k]
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, len(order) + 1))
        assert all(abs(r.score - scores[at[r.vec_id]]) < 1e-12 for r in found)
        assert all((-a.score, a.vec_id) < (-b.score, b.vec_id) for a, b in zip(found, found[1:]))
        hit += len({ids[n] for n in order} & {r.vec_id for r in found})
        total += len(order)
    return len(by_query), hit / max(total, 1)


def test_recall_and_odd_vectors(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").select("vec_id", "embedding")
    rows = [(r.vec_id, list(r.embedding)) for r in table.collect()]
    width = len(rows[0][1])
    odd = [(10_000, None), (10_020, [0.0] * width), (10_040, [float("nan")] * width), (10_060, [1.0, 2.0]),
           (10_080, [float("inf")] * width), (10_100, [None] + [1.0] * (width - 1)), (None, [1.0] * width)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).withColumn("v", F.lit(1)).withColumn("rank", F.lit("x"))
    got = ann.search(docs, docs.where("vec_id % 20 = 0")).collect()
    ids, vectors = [i for i, _ in rows], np.array([v for _, v in rows], dtype=np.float64)
    queries, recall = check(got, ids, vectors)
    assert queries == sum(i % 20 == 0 for i in ids) and recall >= 0.9


def test_recall_over_a_deep_tree(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF_ROWS", 32)
    monkeypatch.setattr(ann, "CHUNK", 16)
    monkeypatch.setattr(ann, "QUERY_CHUNK", 8)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 16))
    vectors = (centres[rng.integers(0, 20, 2000)] + rng.normal(size=(2000, 16)) * 0.4).astype(np.float32)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA).repartition(4)
    got = ann.search(docs, docs.where("vec_id % 20 = 0")).collect()
    queries, recall = check(got, list(range(2000)), vectors.astype(np.float64))
    assert queries == 100 and recall >= 0.9


def test_far_outliers_find_all_their_neighbours(spark, monkeypatch):
    """Leaves of a few rows: the visits that serve most queries hold too few."""
    monkeypatch.setattr(ann, "LEAF_ROWS", 32)
    monkeypatch.setattr(ann, "calibrate", lambda *args: 1)
    rng = np.random.default_rng(2)
    vectors = (rng.normal(size=(8, 16))[rng.integers(0, 8, 800)] + rng.normal(size=(800, 16)) * 0.05).astype(np.float32)
    vectors[[0, 20, 40, 60, 80]] = np.float32(50) * np.eye(16, dtype=np.float32)[0] + vectors[[0, 20, 40, 60, 80]]
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], SCHEMA)
    got = ann.search(docs, docs.where("vec_id % 20 = 0")).collect()
    queries, _ = check(got, list(range(800)), vectors.astype(np.float64))
    assert queries == 40 and len(got) == 40 * 20


def test_ties_at_the_edge_go_to_the_smallest_ids(spark):
    """Different vectors of one score: whole numbers, one component that tells them apart."""
    rng = np.random.default_rng(4)
    vectors = np.zeros((400, 10), dtype=np.float32)
    vectors[:, 0] = 1
    vectors[np.arange(400) % 20 != 0, 1:] = ((np.arange(400)[:, None] >> np.arange(9)) & 1)[np.arange(400) % 20 != 0]
    ids = rng.permutation(400)
    docs = spark.createDataFrame([(int(i), vectors[i].tolist()) for i in ids], SCHEMA)
    got = {}
    for r in ann.search(docs, docs.where("vec_id = 0")).collect():
        got[r.rank] = (r.vec_id, r.score)
    assert [got[n] for n in range(1, 21)] == [(i, 1.0) for i in range(1, 21)]


def test_hot_vector_ties_and_few_rows(spark):
    rows = [(i, [1.0, 2.0]) for i in range(0, 300)] + [(1000, [-1.0, 0.5]), (1001, [-1.0, 0.5]), (1000, [-1.0, 0.5])]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = ann.search(docs, docs.where("vec_id % 20 = 0")).collect()
    mine = sorted((r.rank, r.vec_id) for r in got if r.query_id == 0)
    assert mine == [(n, n) for n in range(1, 21)]
    assert len(got) == 20 * (15 + 1)
    few = spark.createDataFrame(rows[:3], SCHEMA)
    assert [(r.rank, r.vec_id) for r in ann.search(few, few.where("vec_id % 20 = 0")).orderBy("rank").collect()] == [(1, 1), (2, 2)]
    assert ann.search(few.limit(0), few.limit(0)).count() == 0
    one = few.limit(1)
    assert ann.search(one, one).count() == 0
