"""Shingle-set links and components against all pairs."""

import random

import brute
import pytest
from conftest import SF_SMALL
from tools.compare import compare, duck

from terrace.llm import jaccard, queries
from terrace.llm.components import components


def near_copies(seed=5):
    """Clusters of near copies around the limit, shared passages, odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(3))
    passage = " ".join(word() for _ in range(60))
    out = [None, "", " \n", "One two", "one TWO", "one two three", "a b c d", "A b  c\nd", "a b c d e", "a " * 500]
    for n, size in ((40, 120), (12, 300), (6, 30), (3, 1500)):
        base = [word() for _ in range(size)]
        for _ in range(n):
            copy = list(base)
            for _ in range(rng.randrange(0, max(2, size // 40))):
                copy[rng.randrange(size)] = word()
            out.append(" ".join(copy[:size - rng.randrange(0, size // 20 + 1)]))
    out += [" ".join(word() for _ in range(rng.randrange(5, 80))) + " " + passage for _ in range(60)]
    out += [passage, passage + " x", out[20], out[20].upper()]
    rng.shuffle(out)
    return out


def check(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    docs = docs.selectExpr("*", "1 AS `row`", "2 AS n", "3 AS component")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.digest(docs).collect()}
    assert got == dict(enumerate(brute.components(texts)))


def test_near_copies(spark):
    check(spark, near_copies())


@pytest.mark.parametrize("settings", [dict(PIVOTS=0), dict(FREQUENT=3), dict(FREQUENT=2, MAX_FREQUENT=10, GROUP_PART=2),
                                      dict(GATHERING_PART=2, GROUP_PART=3, PIVOTS=1)])
def test_no_link_depends_on_the_settings(spark, monkeypatch, settings):
    """Pivots, frequency limits and part sizes only steer the work."""
    for name, value in settings.items():
        monkeypatch.setattr(jaccard, name, value)
    check(spark, near_copies(9))


def test_query_matches_sql(spark):
    r = compare(spark, "op10", queries.op10_ngram_jaccard, queries.oracle_sql()["op10_ngram_jaccard"], SF_SMALL, duck(SF_SMALL))
    assert r["status"] == "MATCH" and not r["types"], r


def test_keep_one(spark):
    texts = near_copies(2)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS `row`", "2 AS component", "true AS `_doc`")
    out = jaccard.keep_one(docs)
    assert out.columns == docs.columns
    want = {i for i, (_, c) in enumerate(brute.components(texts)) if c == i}
    assert {r.doc_id for r in out.collect()} == want
    same = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "A b c d"), (None, None), (None, None)],
                                 "doc_id long, text string")
    assert sorted(str(tuple(r)) for r in jaccard.keep_one(same).collect())[:2] == ["(3, 'a b c d')", "(None, None)"] or \
        sorted(str(tuple(r)) for r in jaccard.keep_one(same).collect())[0].startswith("(3,")
    assert jaccard.keep_one(same).count() == 3
    assert jaccard.digest(same.limit(0)).count() == 0


def plain_kept(texts, words, share):
    """Positions of the first text of each component, by all pairs."""
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= share * (len(a) + len(sets[j]) - both) and root[i] != root[j]:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {i for i, r in enumerate(root) if r == i}


@pytest.mark.parametrize("words,share", [(5, 80), (4, 85)])
def test_keep_one_with_words_and_share(spark, words, share):
    texts = near_copies(4)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r.doc_id for r in jaccard.keep_one(docs, words, share).collect()} == plain_kept(texts, words, share)


def test_pipeline_drops_copies_with_two_percent_of_edits(spark):
    """Similarity 0.80 over five words, 0.84 over four."""
    import corpus_pipeline
    base = [f"w{i}" for i in range(1000)]
    copy = [f"x{i}" if i % 46 == 20 else w for i, w in enumerate(base)]
    texts = [" ".join(base), " ".join(copy)]
    assert (len(plain_kept(texts, 5, 80)), len(plain_kept(texts, 4, 85))) == (1, 2)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, SF_SMALL).collect()] == [0]
    assert jaccard.keep_one(docs).count() == 2


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + rng.randrange(80), 100 + rng.randrange(80)) for _ in range(60)]
    edges += [(500, 500 + i) for i in range(1, 200)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in nodes}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
