"""Repeated 200-byte strings against a count of all of them."""

import random

import brute
import pytest
from conftest import SF_SMALL
from tools.compare import compare as compare_sql
from tools.compare import duck

from terrace.llm import queries, suffix_dedup


def odd_texts():
    rng = random.Random(3)

    def noise(n):
        return "".join(rng.choice("abcdé \n\U0001F600") for _ in range(n))

    p, q = noise(260), noise(140)
    return [None, "", "x" * 1000, "ab" * 300, p, noise(50) + p[20:240] + noise(90), noise(300) + p + noise(10) + p[:205],
            q, q + "z", q + "zz", noise(500), "x" * 199, "x" * 200, "y" * 199, "y" * 199,
            *[noise(30) + p + noise(40) for _ in range(8)]]


def compare(spark, texts, **options):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    docs = docs.selectExpr("*", "1 AS `row`", "2 AS n_bytes", "3 AS places")
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.digest(docs, **options).collect()}
    want = brute.suffixes(texts)
    assert len(got) == len(texts)
    for i, w in enumerate(want):
        assert got[i] == w, (i, texts[i])
    return want


@pytest.mark.parametrize("hot", [suffix_dedup.HOT, 2])
def test_odd_texts(spark, hot):
    assert sum(w[1] for w in compare(spark, odd_texts(), hot=hot)) > 3000


def test_long_documents_in_overlapping_parts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 150)
    compare(spark, odd_texts())


def test_buckets_across_batches(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", 3)
    compare(spark, odd_texts())


def test_sample(spark):
    texts = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    compare(spark, texts)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = " ".join(map(str, range(200)))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (None, None)], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffix_dedup.digest(docs).collect()) == [0] + [len(text)] * 3
    assert suffix_dedup.digest(docs.limit(0)).count() == 0


def test_spans_are_the_removed_bytes(spark):
    texts = odd_texts()[4:7]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in suffix_dedup.deduplicate(docs).collect():
        raw = texts[r.doc_id].encode()
        at, left = 0, b""
        for s in r.spans:
            left += raw[at:s.start]
            at = s.end
        assert left + raw[at:] == bytes(r.kept)


def test_query_matches_sql(spark):
    r = compare_sql(spark, "op4", queries.op4_suffix_dedup, queries.oracle_sql()["op4_suffix_dedup"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "MATCH" and not r["types"], r
