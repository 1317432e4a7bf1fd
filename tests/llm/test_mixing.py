"""Mixing: targets, permutations, draws."""

from collections import Counter

import brute
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from terrace.llm import mixing


def test_digest(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "source")
    odd = spark.createDataFrame([(9001, None, "src0"), (9002, "a b c " * 400, None), (9003, "", "zzz"), (9003, "", "zzz"),
                                 (None, "x " * 300, "é"), (None, "x " * 300, "é")], docs.schema)
    docs = docs.union(odd).withColumn("size", F.lit("x")).withColumn("row", F.lit(1)).withColumn("taken", F.lit(2))
    rows = mixing.digest(docs).collect()
    texts = {r.doc_id: r for r in docs.collect()}
    size = brute.by_source((r.source, len(brute.words(r.text))) for r in docs.collect())
    target = brute.targets(size)
    taken = Counter()
    for r in rows:
        source = texts[r.doc_id].source
        assert r["size"] == len(brute.words(texts[r.doc_id].text)) and r.source_size == size[source]
        assert r.target == pytest.approx(target[source], rel=1e-9) and 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
    for source, t in target.items():
        assert abs(taken[source] - t) <= 2 * mixing.BLOCK_WORDS + 0.02 * t
    again = mixing.digest(docs.repartition(5)).collect()
    assert Counter(map(str, again)) == Counter(map(str, rows))


def test_mixed_documents_hold_the_words_that_are_taken(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").withColumn("size", F.lit("x")).withColumn("found", F.lit(1))
    want = Counter({r.doc_id: r.taken for r in mixing.digest(docs).collect() if r.taken})
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    got, texts = Counter(), {r.doc_id: r.text for r in docs.collect()}
    for r in out.collect():
        got[r.doc_id] += len(brute.words(r.text))
        assert r.text in texts[r.doc_id] and r.n_chars == len(r.text) and r["size"] == "x"
    assert got == want
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_nothing_to_mix(spark):
    docs = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.digest(docs).collect()] == [(0, 0.0)] * 2
    assert mixing.digest(docs.limit(0)).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 64, 1000, 4097])
def test_permutation(n):
    got = mixing.permute(np.arange(n), n, 12345)
    assert sorted(got) == list(range(n))
    assert n < 64 or (got != mixing.permute(np.arange(n), n, 54321)).any()


def test_slots_take_each_block_before_any_again(spark):
    plan = spark.createDataFrame([(0, 10, 17), (1, 5, 0), (2, 300, 300)], "src long, blocks long, slots long")
    rows = mixing.draw(plan, slots_per_shard=10).collect()
    assert Counter(r.src for r in rows) == {0: 17, 2: 300}
    times = Counter((r.src, r.block) for r in rows)
    assert all(1 <= times[0, b] <= 2 for b in range(10)) and all(times[2, b] == 1 for b in range(300))
    assert len({r.shard for r in rows}) > 8
