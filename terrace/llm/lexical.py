"""Ranked lexical search over a length-stratified index.

1. Every whole text is cut into terms; a document keeps its length and the
   counts of those terms that some item asks for.
2. Documents of one normaliser ``m`` form a stratum.  Small neighbouring
   strata share a bundle; a bundle is cut into blocks of bounded size, and a
   block holds the postings of each term by stratum and ``tf``.
3. A term's impact depends on ``m`` and ``tf`` alone, so it is computed once
   for each ``tf`` of a stratum.  The largest ``tf`` of each term bounds what a
   document of the stratum can score for an item.
4. Items visit bundles in the order of their strata's largest bound, a widening
   number of documents at a time (``WIDTHS``).  A bundle whose bound is below
   the last wanted score found so far is never visited, so the ranking is exact.

Odd input: null texts and texts without terms have no rank and do not count
in ``N``; each row of the documents is a document of its own, also where ids
repeat, and a null ``doc_id`` comes last among equals; rows of items with one
``item_id`` (null too) are one item with the terms of all; an item without
terms gets no rows; empty tables give none; further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import tables

BLOCK_DOCS = 4096
ITEM_PART = 1024
# Documents that an item may visit in each turn; the last turn takes all that
# its bounds allow.
WIDTHS = (2_000, 60_000)

LENGTH = b" "
# Letters and digits of ASCII stay (A-Z lower-cased), all bytes above it too.
_KEEP = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 97 <= b <= 122 or 48 <= b <= 57 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """Terms of a text as UTF-8, in order."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_KEEP).split()


# --- documents and items --------------------------------------------------------

def item_terms(items: DataFrame) -> DataFrame:
    """(iid, item_id, term): the distinct terms of each item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(dict.fromkeys(terms(t))) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["item_id"], pa.array(found, pa.list_(pa.binary()))], ["item_id", "terms"])

    named = items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(
        cut, "item_id long, terms array<binary>")
    return (named.select("item_id", F.explode("terms").alias("term")).distinct()
            .withColumn("iid", F.coalesce(F.col("item_id").cast("string"), F.lit(""))))


def counted(docs: DataFrame) -> DataFrame:
    """(key, doc_id, n, term, tf): the terms of each document.  ``LENGTH``,
    which is no term, stands for all ``n`` of them together."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                names, counts = [], []
                for text in part["text"].to_pylist():
                    held = terms(text)
                    found = Counter(held)
                    if held:
                        found[LENGTH] = len(held)  # the last one
                    names.append(list(found))
                    counts.append(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(names, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))],
                    ["doc_id", "terms", "tfs"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        count, "doc_id long, terms array<binary>, tfs array<long>")
    return (rows.withColumn("key", F.monotonically_increasing_id())
            .select("key", "doc_id", F.element_at("tfs", -1).alias("n"),
                    F.explode(F.arrays_zip("terms", "tfs")).alias("_t"))
            .select("key", "doc_id", "n", F.col("_t.terms").alias("term"), F.col("_t.tfs").alias("tf")))


# --- the index --------------------------------------------------------------------

def strata(hits: DataFrame) -> DataFrame:
    """(m, bundle, blocks) for each normaliser: strata in order of ``m``, about
    ``BLOCK_DOCS`` documents a bundle, and how many blocks a bundle is cut into.

    One row per stratum is ordered in one task; their number depends on how
    texts' lengths differ, not on how many texts there are.
    """
    before = F.sum("docs").over(Window.orderBy("m").rowsBetween(Window.unboundedPreceding, -1))
    counts = hits.where("tid = -1").groupBy("m").agg(F.count("*").alias("docs"))
    return (counts.withColumn("bundle", F.floor(F.coalesce(before, F.lit(0)) / BLOCK_DOCS))
            .withColumn("docs", F.sum("docs").over(Window.partitionBy("bundle")))
            .withColumn("blocks", F.ceil(F.col("docs") / BLOCK_DOCS)))


def index(hits: DataFrame, levels: DataFrame) -> DataFrame:
    """Postings (bundle, block, tid, runs, places) of hits (m, key, doc_id,
    tid, tf) whose strata are ``levels``.

    ``places`` are places among the block's documents, ascending by id, and
    ``runs`` says (m, tf, how many) of them in order, all packed as 64-bit
    integers.  The ids themselves are the row of ``tid`` -1, whose run counts
    the null ids at their end.
    """
    dealt = (hits.join(levels, "m")
             .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
             .select("bundle", "block", "m", "key", "doc_id", "tid", "tf"))

    def invert(rows: pa.Table) -> pa.Table:
        docs = rows.filter(pc.equal(rows["tid"], -1)).sort_by([("doc_id", "ascending"), ("key", "ascending")])
        keys = docs["key"].to_numpy()  # nulls of doc_id come last
        by_key = np.argsort(keys)
        rows = rows.filter(pc.greater_equal(rows["tid"], 0))
        m, tid, tf, key = (rows[c].to_numpy() for c in ("m", "tid", "tf", "key"))
        place = by_key[np.searchsorted(keys[by_key], key)]
        order = np.lexsort((place, tf, m, tid))
        m, tid, tf, place = m[order], tid[order], tf[order], place[order].astype("<i8")
        run = np.flatnonzero(np.r_[True, (np.diff(tid) != 0) | (np.diff(m) != 0) | (np.diff(tf) != 0)][:len(tid)])
        many = np.diff(np.r_[run, len(tid)])
        runs = np.column_stack([m[run], tf[run], many]).astype("<i8")
        term = np.flatnonzero(np.r_[True, np.diff(tid[run]) != 0][:len(run)])
        edges = np.r_[term, len(run)]
        cut = np.r_[run[term], len(tid)]
        ids = docs["doc_id"].fill_null(0).to_numpy().astype("<i8").tobytes()
        nulls = np.array([docs["doc_id"].null_count], "<i8").tobytes()
        first = docs.slice(0, 1)
        return pa.table({
            "bundle": pa.array(np.repeat(first["bundle"].to_numpy(), len(term) + 1)),
            "block": pa.array(np.repeat(first["block"].to_numpy(), len(term) + 1)),
            "tid": pa.array(np.r_[-1, tid[run[term]]].astype(np.int64)),
            "runs": pa.array([nulls] + [runs[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()),
            "places": pa.array([ids] + [place[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())})

    return dealt.groupBy("bundle", "block").applyInArrow(
        invert, "bundle long, block int, tid long, runs binary, places binary")


def impact(tf, m):
    """What each unit of weight adds, in whole numbers (columns or arrays)."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


def score(postings: pd.DataFrame, visitors: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` best documents of one block for each visiting item.

    ``postings`` are the block's rows of ``index``; ``visitors`` have iid, tids
    and weights (packed 64-bit integers) and ``least``, the score to reach.
    """
    out = []
    if len(postings) and len(visitors):
        lists = {}
        ids, nulls = np.zeros(0, np.int64), 0
        for tid, runs, places in zip(postings["tid"], postings["runs"], postings["places"]):
            if tid < 0:
                ids, nulls = np.frombuffer(places, "<i8"), int(np.frombuffer(runs, "<i8")[0])
            else:
                m, tf, many = np.frombuffer(runs, "<i8").reshape(-1, 3).T
                lists[tid] = np.frombuffer(places, "<i8"), np.repeat(impact(tf, m), many)
        for iid, tids, weights, least in zip(visitors["iid"], visitors["tids"], visitors["weights"], visitors["least"]):
            total = np.zeros(len(ids), np.int64)
            for tid, weight in zip(np.frombuffer(tids, "<i8").tolist(), np.frombuffer(weights, "<i8").tolist()):
                if tid in lists:
                    places, gain = lists[tid]
                    total[places] += weight * gain
            good = np.flatnonzero(total >= max(int(least), 1))
            good = good[np.argsort(-total[good], kind="stable")][:k]  # places ascend by id
            found = ids[good].astype(object)
            found[good >= len(ids) - nulls] = None
            out.append((np.full(len(good), iid, object), found, total[good]))
    columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, object)] * 2 + [np.zeros(0, np.int64)]
    return pd.DataFrame({name: pd.Series(c, dtype=c.dtype) for name, c in zip(("iid", "doc_id", "score"), columns)})


# --- the search ---------------------------------------------------------------------

def search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` best documents (``doc_id, text``) for each item (``item_id,
    text``): item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    empty = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    asked = tables.materialize(item_terms(items), "asked")
    words = tables.materialize(
        asked.select("term").distinct().withColumn("tid", F.monotonically_increasing_id())
        .unionByName(spark.createDataFrame([(LENGTH, -1)], "term binary, tid long")), "vocabulary")
    # Spark broadcasts the vocabulary while it is small and shuffles both sides beyond that.
    written = tables.materialize(counted(docs).join(words, "term").select("key", "doc_id", "n", "tid", "tf"), "hits")
    totals = written.where("tid = -1").agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    n_docs, length = totals["n"], totals["l"]
    if not n_docs:
        return empty
    stratum = F.expr(f"50L + (50L * n * {n_docs}L) div {length}L")
    hits = written.withColumn("m", stratum)
    levels = tables.materialize(strata(hits), "strata")
    postings = tables.materialize(index(hits, levels), "postings")

    df = hits.where("tid >= 0").groupBy("tid").agg(F.count("*").alias("df"))
    weight = F.floor(F.lit(1000) * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1))).cast("long")
    weighed = tables.materialize(asked.join(words, "term").join(df, "tid")
                                 .select("iid", "tid", weight.alias("w")).where("w > 0"), "weighed")
    held = hits.where("tid >= 0").groupBy("m", "tid").agg(F.max("tf").alias("tf"))
    gain = F.expr("(1000000000L * tf) div (1000L * tf + 20L * m)")
    bounds = (held.join(weighed, "tid").groupBy("iid", "m").agg(F.sum(F.col("w") * gain).alias("bound"))
              .join(levels, "m").groupBy("iid", "bundle", "docs", "blocks").agg(F.max("bound").alias("bound")))
    in_order = Window.partitionBy("iid").orderBy(F.desc("bound"), "bundle").rowsBetween(Window.unboundedPreceding, -1)
    visits = tables.materialize(
        bounds.withColumn("before", F.coalesce(F.sum("docs").over(in_order), F.lit(0))), "bounds")
    tables.discard(written)
    queries = weighed.groupBy("iid").agg(F.array_sort(F.collect_list(F.struct("tid", "w"))).alias("terms"))
    queries = tables.materialize(_bytes(queries), "queries")
    items_parts = -(-queries.count() // ITEM_PART)

    ranked = Window.partitionBy("iid").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = None
    low = 0
    for high in (*WIDTHS, None):
        now = visits.where(F.col("before") >= low)
        if high is not None:
            now = now.where(F.col("before") < high)
        if best is None:
            now = now.withColumn("least", F.lit(1).cast("long"))
        else:
            floor = best.where(F.col("rank") == k).select("iid", F.col("score").alias("least"))
            now = (now.join(floor, "iid", "left").withColumn("least", F.coalesce("least", F.lit(1)))
                   .where(F.col("bound") >= F.col("least")))
        found = _visit(now, postings, queries, items_parts, k)
        both = found if best is None else found.unionByName(best.select("iid", "doc_id", "score"))
        before, best = best, tables.materialize(
            both.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "best")
        if before is not None:
            tables.discard(before)
        low = high
    tables.discard(words, levels, postings, weighed, visits, queries)
    names = asked.select("iid", "item_id").distinct()
    return best.join(names, "iid").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _bytes(queries: DataFrame) -> DataFrame:
    """(iid, tids, weights) with the numbers packed for numpy."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch["terms"].to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch["iid"]] + [pa.array([np.array([t[name] for t in row], "<i8").tobytes() for row in rows], pa.binary())
                                  for name in ("tid", "w")], ["iid", "tids", "weights"])

    return queries.mapInArrow(pack, "iid string, tids binary, weights binary")


def _visit(visits: DataFrame, postings: DataFrame, queries: DataFrame, parts: int, k: int) -> DataFrame:
    """Documents (iid, doc_id, score) that the visits (iid, bundle, blocks, least) find."""
    key = ["bundle", "block", "part"]
    part = F.pmod(F.xxhash64("iid"), F.lit(parts)).cast("int").alias("part")
    asking = (visits.join(queries, "iid").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
              .select("bundle", "block", part, "iid", "tids", "weights", "least"))
    held = (postings.join(visits.select("bundle", part).distinct(), "bundle")
            .select(*key, "tid", "runs", "places"))
    return held.groupBy(*key).cogroup(asking.groupBy(*key)).applyInPandas(
        lambda mine, theirs: score(mine, theirs, k), "iid string, doc_id long, score long")


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS key, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents),
t AS (SELECT key, term, count(*) AS tf FROM (SELECT key, unnest(words) AS term FROM d) GROUP BY key, term),
q AS (
  SELECT DISTINCT item_id, unnest(
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
  FROM benchmark),
s AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(words)) AS BIGINT) AS total FROM d WHERE len(words) > 0),
v AS (SELECT term, count(*) AS df FROM t GROUP BY term),
w AS (SELECT item_id, term, CAST(floor(1000 * ln((2.0::DOUBLE * n_docs + 2) / (2 * df + 1))) AS BIGINT) AS weight
      FROM q JOIN v USING (term), s),
m AS (SELECT key, doc_id, 50 + (50 * len(words) * n_docs) // total AS m FROM d, s WHERE len(words) > 0),
r AS (SELECT item_id, key, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
      FROM w JOIN t USING (term) JOIN m USING (key) GROUP BY item_id, key, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM r WHERE score > 0)
WHERE rank <= 50
"""
