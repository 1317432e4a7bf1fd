"""Ranked search against a plain version: order, ties, odd rows, many turns."""

import math
import random
import re

from conftest import SF_SMALL

from terrace.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"


def cut(text):
    return re.findall(TERM, (text or "").translate(LOWER))


def plain(docs, items, k=50):
    """(item, rank, doc, score) of docs and items given as (id, text)."""
    held = [(i, w) for i, w in ((i, cut(t)) for i, t in docs) if w]
    n_docs, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for term in set(w):
            df[term] = df.get(term, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(cut(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for place, (doc, w) in enumerate(held):
            m = 50 + (50 * len(w) * n_docs) // total
            score = 0
            for term in wanted & set(w):
                tf = w.count(term)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1))) * (
                    (1_000_000_000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, place, doc))
        out += [(item, n + 1, f[4], -f[0]) for n, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def same(spark, docs, items, k=50):
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS rank", "'x' AS tid", "2 AS m", "3 AS key")
    q = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS iid", "'y' AS doc_id")
    got = lexical.search(d.repartition(3), q, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain(docs, items, k)


def test_documents_and_benchmark(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    same(spark, docs, items)


def test_many_turns_blocks_and_parts(spark, monkeypatch):
    """Every item stops and goes on; hot strata are cut into several blocks."""
    monkeypatch.setattr(lexical, "WIDTHS", (10, 40, 80))
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 16)
    monkeypatch.setattr(lexical, "ITEM_PART", 2)
    rng = random.Random(3)
    names = [f"w{i}" for i in range(40)]
    docs = [(i, " ".join(rng.choices(names, [1 / (n + 1) for n in range(40)], k=rng.choice([5, 5, 5, 9, 30, 200]))))
            for i in range(300)]
    items = [(i, " ".join(rng.choices(names, k=6))) for i in range(9)]
    same(spark, docs, items, k=5)


def test_bounds_leave_bundles_out(spark, monkeypatch):
    """Bundles whose bound is below the last wanted score are not scored."""
    monkeypatch.setattr(lexical, "WIDTHS", (10,))
    monkeypatch.setattr(lexical, "BLOCK_DOCS", 8)
    seen = []
    visit = lexical._visit
    monkeypatch.setattr(lexical, "_visit", lambda v, *a: seen.append(v.count()) or visit(v, *a))
    docs = [(i, "rare " * 3 + "x " * (i % 5)) for i in range(20)] + [(i, "rare " + "y " * 50) for i in range(20, 200)]
    same(spark, docs, [(1, "rare")], k=5)
    assert len(seen) == 2 and seen[1] < 22


def test_odd_rows(spark):
    docs = [(5, None), (6, ""), (7, " \n-;"), (None, "alpha beta"), (None, "alpha beta"), (3, "alpha beta"), (3, "alpha beta"),
            (1, "alpha beta"), (9, "ALPHA Été K 1½"), (10, "zz " * 60_000), (11, "b" * 200_000 + " alpha"), (12, "alphabeta")]
    items = [(1, "Alpha"), (1, "beta alpha"), (None, "zz"), (2, None), (3, "..."), (4, "nowhere"), (5, "ÉTÉ"), (6, "Été k"),
             (7, "b" * 200_000)]
    same(spark, docs, items)
    same(spark, docs[:3], items)
    same(spark, docs, items[3:5])
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert lexical.search(empty, spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                          empty.withColumnRenamed("doc_id", "item_id")).count() == 0
