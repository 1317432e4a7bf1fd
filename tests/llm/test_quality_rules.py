"""Quality rules: counts, exact bounds, certified cutoffs."""

import math

import brute
import pytest
from conftest import SF_MID, SF_SMALL
from pyspark.sql import functions as F
from tools.compare import compare, duck

from terrace.llm import quality, queries

ODD = ["", None, " \n\t ", "a b " * 5000, "x\ny\nx\n \n x\nx", "a b c d e f g h a b c d e f g h i \u00e9 \x0b z", "w" * 100_000]


def test_counts(spark):
    sample = [r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    texts = ODD + sample
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.digest(docs, labels).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute.quality(texts[r.doc_id])
        failed = want[0] < 20 or 100 * want[4] > 30 * want[0]
        assert want == (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        # Without labels nothing is certified, so only the base rule rejects.
        assert (r.base_failed, r.kept) == (failed, not failed)


@pytest.mark.parametrize("n,limit,alpha", [(0, 0.01, 0.05), (100, 0.01, 0.05), (600, 0.01, 0.0025), (5000, 0.01, 0.001),
                                           (300, 0.2, 0.01)])
def test_most_allowed_is_the_exact_binomial_bound(spark, n, limit, alpha):
    got = spark.range(1).select(quality.most_allowed(F.lit(n), limit, F.lit(alpha)).alias("k")).first()["k"]
    total, best = 0.0, -1
    for k in range(n + 1):
        total += math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
                          + k * math.log(limit) + (n - k) * math.log1p(-limit))
        if total > alpha:
            break
        best = k
    assert got == best


def test_most_allowed_for_many_labels(spark):
    got = spark.range(1).select(quality.most_allowed(F.lit(2_000_000), 0.01, F.lit(1e-4)).alias("k")).first()["k"]
    sd = math.sqrt(2_000_000 * 0.01 * 0.99)
    assert 20_000 - 4.2 * sd < got < 20_000 - 3.3 * sd


def labelled(spark, good, lang="en"):
    clean = " ".join(f"w{i}" for i in range(30))
    return spark.createDataFrame([(i, f"{clean} {i}", lang) for i in range(good)], "doc_id long, text string, lang string")


def test_certified_cutoffs_reject_junk_and_keep_clean(spark):
    docs = labelled(spark, 900)
    junk = spark.createDataFrame([(10_000 + i, " ".join(f"{j}$$$###" for j in range(40 + i)), "en") for i in range(5)],
                                 docs.schema)
    few = spark.createDataFrame([(20_000, " ".join(f"{j}$$$###" for j in range(40)), "xx"),
                                 (20_001, " ".join(f"{j}$$$###" for j in range(40)), None)], docs.schema)
    labels = docs.select("doc_id", F.lit(1).alias("quality")).union(docs.limit(3).select("doc_id", F.lit(1)))
    out = {r.doc_id: r.kept for r in quality.digest(docs.union(junk).union(few), labels).collect()}
    assert all(out[i] for i in range(900))
    assert not any(out[10_000 + i] for i in range(5))
    # A stratum without labels has no bound of its own: the base rule alone rejects.
    assert out[20_000] and out[20_001]


def test_a_small_stratum_beyond_the_large_ones_cutoffs_is_kept(spark):
    """Good documents of a small stratum that all look like another's junk."""
    docs = labelled(spark, 900)
    small = spark.createDataFrame([(30_000 + i, " ".join(f"{j}$$$###" for j in range(40 + i)), "xx") for i in range(30)],
                                  docs.schema)
    labels = docs.union(small).select("doc_id", F.lit(1).alias("quality"))
    out = quality.digest(docs.union(small), labels).collect()
    assert all(r.kept for r in out)


def test_cutoffs_bound_the_rejected_share(spark):
    """Good documents with symbols: a cutoff that would reject many is not used."""
    docs = labelled(spark, 900).withColumn(
        "text", F.when(F.col("doc_id") % 10 == 0, F.concat("text", F.lit(" $$$$$$$$$$$$$$$$$$"))).otherwise(F.col("text")))
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    rows = quality.digest(docs, labels).collect()
    assert sum(not r.kept for r in rows) <= 9


def test_keep_returns_the_columns(spark):
    docs = labelled(spark, 30).withColumn("_kept", F.lit(False)).withColumn("n_words", F.lit("x"))
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    out = quality.keep(docs, labels)
    assert out.columns == docs.columns and out.count() == 30
    assert quality.keep(docs.limit(0), labels).count() == 0


@pytest.mark.parametrize("sf_dir", [SF_SMALL, SF_MID])
def test_query_matches_sql(spark, sf_dir):
    r = compare(spark, "op7", queries.op7_quality_rules, queries.oracle_sql()["op7_quality_rules"], sf_dir, duck(sf_dir))
    assert r["status"] == "MATCH" and not r["types"], r
