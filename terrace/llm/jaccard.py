"""Shingle-set similarity join through a token-group matrix.

Documents with the same shingle set are one class.  Two classes link when the
Jaccard similarity of their sets is at least ``share`` percent; shingles have
``words`` words.  The defaults ``WORDS`` and ``SHARE`` are those of the op10 query.

1. Tokens (hashes of shingles) are ordered, frequent ones last.  A link's sets
   share a token among each other's first ``n - ceil(n * share / 100) + 1``:
   the prefix.
2. Similar classes are gathered by two minimum hashes and compared with a few
   pivots, the most central of their gathering; verified links make the first
   groups.  Members
   of a group are connected, so a cluster of near copies counts as one.
3. The token-group matrix holds, per prefix token, the groups whose union has
   it.  A class asks it with its own prefix, the smaller group asking the
   larger, and so gets its overlap with each group.
4. Overlap and sizes bound the similarity that a member could reach; only
   groups that qualify are opened, in parts of ``GROUP_PART`` members, and
   compared set by set until a link is found.
5. Links and groups give the components.

Pivots only decide what is a group early; no link is missed without them.

Odd input: a null or empty text (or one of blanks) has the empty set and is
linked with nothing; fewer words than a shingle make one shingle of all;
repeated rows and null ids are documents like others; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.components import components
from terrace.llm.tables import text_or_empty
from terrace.operators.joins import checked_broadcast

WORDS = 4
SHARE = 85
# A token in the prefixes of so many documents is frequent; so is one beyond
# the prefixes that is found as often, counting only where CROWDED of a slice
# of documents have it.  The limit doubles until the frequent tokens, which
# every task holds, are at most MAX_FREQUENT.  Any order gives the same links.
FREQUENT = 100
CROWDED = 3
MAX_FREQUENT = 1_000_000
HASHES = 3
PIVOTS = 8
GATHERING_PART = 4096
GATHERING_TOKENS = 4_000_000
GROUP_PART = 256
CACHE_WORDS = 500_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURNS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


# --- sets ------------------------------------------------------------------------

class _WordIds(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def token_set(text: str, ids: dict, words: int) -> np.ndarray:
    """Sorted distinct shingle hashes (62 bits) of a text."""
    found = text.encode().translate(_LOWER).split()
    if not found:
        return np.zeros(0, np.int64)
    word = np.fromiter(map(ids.__getitem__, found), np.uint64, len(found))
    size = min(words, len(word))
    # A short text's single shingle must differ from all longer ones.
    h = word[:len(word) - size + 1] ^ np.uint64(words - size)
    for k in range(1, size):
        h = h * _MIX
        h ^= h >> np.uint64(29)
        h += word[k:len(word) - size + 1 + k]
    h *= _MIX
    h ^= h >> np.uint64(32)
    return np.unique((h >> np.uint64(2)).astype(np.int64))


def _prefix_size(n: np.ndarray | int, share: int):
    return n - (share * n + 99) // 100 + 1


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches with the token set of each row's text."""
    ids = _WordIds()
    for batch in batches:
        for at in range(0, len(batch), 1000):
            part = batch.slice(at, 1000)
            if len(ids) > CACHE_WORDS:
                ids.clear()
            yield part, [token_set(t, ids, words) for t in part["text"].to_pylist()]


def frequent_tokens(texts: DataFrame, words: int, share: int) -> np.ndarray:
    """The tokens that come last in the order.

    Without those beyond the prefixes, moving a frequent token back would let
    the next one of the same passage into the prefix.
    """

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, sets in _sets(batches, words):
            sizes = [_prefix_size(len(s), share) for s in sets]
            none = [np.zeros(0, np.int64)]
            token, n = np.unique(np.concatenate(none + [s[:k] for s, k in zip(sets, sizes)]), return_counts=True)
            later, m = np.unique(np.concatenate(none + [s[k:] for s, k in zip(sets, sizes)]), return_counts=True)
            crowded = m >= CROWDED
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([token, later[crowded]])),
                 pa.array(np.concatenate([n, m[crowded]]).astype(np.int64))], ["token", "n"])

    counted = tables.materialize(
        texts.select("text").mapInArrow(counts, "token long, n long").groupBy("token")
        .agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT), "frequent")
    limit = FREQUENT
    while counted.where(F.col("n") >= limit).count() > MAX_FREQUENT:
        limit *= 2
    found = counted.where(F.col("n") >= limit).select("token").toPandas()["token"].to_numpy()
    tables.discard(counted)
    return np.sort(found.astype(np.int64))


def signatures(texts: DataFrame, words: int, share: int) -> DataFrame:
    """Per document: class key, set size, prefix (in order), place of the last
    prefix token in the order, minimum hashes."""
    # At most MAX_FREQUENT.
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_tokens(texts, words, share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, words):
            rows = []
            for tokens in sets:
                n = len(tokens)
                if not n:
                    rows.append((None, None, 0, [], None, []))
                    continue
                common = np.isin(tokens, frequent.value, assume_unique=True)
                order = np.concatenate([tokens[~common], tokens[common]])[:_prefix_size(n, share)]
                rare = n - int(common.sum())
                last = int(order[-1]) | (1 << 62 if len(order) > rare else 0)
                raw = tokens.tobytes()
                turned = tokens.view(np.uint64)[None, :] * _TURNS[:HASHES, None]
                turned ^= turned >> np.uint64(31)
                least = (turned * _MIX).min(axis=1)
                rows.append((xxhash.xxh3_64_intdigest(raw) - (1 << 63), xxhash.xxh64_intdigest(raw) - (1 << 63),
                             n, order, last, least.view(np.int64)))
            k1, k2, n, prefix, last, least = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [part["row"], part["doc_id"], pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(n, pa.int64()), pa.array(prefix, pa.list_(pa.int64())), pa.array(last, pa.int64()),
                 pa.array(least, pa.list_(pa.int64()))],
                ["row", "doc_id", "k1", "k2", "n", "prefix", "last", "least"])

    return tables.materialize(texts.select("row", "doc_id", "text").mapInArrow(
        run, "row long, doc_id long, k1 long, k2 long, n long, prefix array<long>, last long, least array<long>"),
        "signatures")


def with_tokens(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``wanted`` (cid: distinct) with the token sets of those rows, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, words):
            yield pa.RecordBatch.from_arrays(
                [part["cid"], pa.array([s.tobytes() for s in sets], pa.binary())], ["cid", "tokens"])

    # Ids measured to be few go to the texts; else both sides are shuffled.
    side, _ = checked_broadcast(wanted)
    return tables.materialize(
        texts.select(F.col("row").alias("cid"), "text").join(side, "cid").mapInArrow(run, "cid long, tokens binary"),
        "tokens")


def _linked(a: np.ndarray, b: np.ndarray, share: int) -> bool:
    small, large = sorted((len(a), len(b)))
    if 100 * small < share * large:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= share * (len(a) + len(b) - both)


def _groups(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[bool, dict]]:
    """Rows one by one, each with whether it begins a new group of a sorted table."""
    last = None
    for batch in batches:
        for row in batch.to_pylist():
            now = tuple(row[k] for k in key)
            yield now != last, row
            last = now


# --- groups ----------------------------------------------------------------------

def _pivots(cids: list[int], sets: list[np.ndarray], share: int) -> list[tuple[int, int]]:
    """Links to pivots: of the sets that are left, the one whose tokens most of
    the others hold is compared with all of them, a few times over."""
    cid = np.array(cids)
    links = []
    for _ in range(PIVOTS):
        if len(sets) < 2:
            break
        size = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), size)
        tokens = np.concatenate(sets)
        _, where, held = np.unique(tokens, return_inverse=True, return_counts=True)
        pivot = int((np.bincount(owner, held[where]) / size).argmax())
        both = np.bincount(owner[np.isin(tokens, sets[pivot])], minlength=len(sets))
        linked = 100 * both >= share * (size + size[pivot] - both)
        links += [(int(c), int(cid[pivot])) for c in cid[linked] if c != cid[pivot]]
        linked[pivot] = True
        sets = [s for s, gone in zip(sets, linked) if not gone]
        cid = cid[~linked]
    return links


def pivot_links(texts: DataFrame, classes: DataFrame, words: int, share: int) -> DataFrame:
    """Verified links (a, b) of classes to a pivot of their gathering.

    A gathering is taken in parts of bounded numbers of members and tokens.
    """
    turns = [F.struct(F.lit(t).alias("turn"), F.col("least")[t].alias("one"), F.col("least")[t + 1].alias("two"))
             for t in range(HASHES - 1)]
    keyed = classes.select("cid", F.inline(F.array(*turns)))
    sizes = (keyed.groupBy("turn", "one", "two").agg(F.count("*").alias("members")).where("members > 1"))
    gathered = tables.materialize(
        keyed.join(sizes, ["turn", "one", "two"])
        .withColumn("part", F.pmod(F.xxhash64("cid"), F.ceil(F.col("members") / GATHERING_PART)))
        .select("turn", "one", "two", "part", "cid"), "gatherings")
    tokens = with_tokens(texts, gathered.select("cid").distinct(), words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cids: list[int] = []
        sets: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            links = _pivots(cids, sets, share)
            cids.clear()
            sets.clear()
            a, b = zip(*links) if links else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for new, row in _groups(batches, ["turn", "one", "two", "part"]):
            if new or sum(map(len, sets)) > GATHERING_TOKENS:
                yield flush()
            cids.append(row["cid"])
            sets.append(np.frombuffer(row["tokens"], np.int64))
        yield flush()

    key = ["turn", "one", "two", "part"]
    found = tables.materialize(
        gathered.join(tokens, "cid").repartition(*key).sortWithinPartitions(*key, "cid")
        .mapInArrow(run, "a long, b long"), "pivot-links")
    tables.discard(gathered, tokens)
    return found


def _qualifies(share: int):
    """Whether a class could link with a member of the group it overlaps.

    Sizes must fit some member.  For a group of one, all of the shorter-lasting
    prefix is known, so its unshared tokens must not exceed what a link allows.
    """
    nx, ny, held = F.col("n"), F.col("n_least"), F.col("held")
    fits = (100 * F.col("n_most") >= share * nx) & (100 * nx >= share * ny)
    overlap = F.ceil(share * (nx + ny) / (100.0 + share) - 1e-9)
    need = lambda n: n - F.ceil(share * n / 100.0 - 1e-9) + 1 - n + overlap
    least = (F.when(F.col("last") < F.col("last_least"), need(nx))
             .when(F.col("last") > F.col("last_least"), need(ny)).otherwise(F.least(need(nx), need(ny))))
    return fits & ((F.col("size") > 1) | (held >= least))


def qualifying(classes: DataFrame, share: int) -> DataFrame:
    """(cid, group): the groups that each class has to be compared with.

    ``classes`` holds cid, n, prefix, last, group.
    """
    about = classes.groupBy("group").agg(
        F.count("*").alias("size"), F.min("n").alias("n_least"), F.max("n").alias("n_most"),
        F.min("last").alias("last_least"))
    postings = classes.select("cid", "group", F.explode("prefix").alias("token"))
    shared = (postings.groupBy("token").agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
              .where("lo < hi").select("token"))
    asking = tables.materialize(
        postings.join(shared, "token").join(classes.select("cid", "n", "last"), "cid")
        .join(about.select("group", "size"), "group"), "postings")
    matrix = asking.select("token", F.col("group").alias("other")).distinct().join(
        about.withColumnRenamed("group", "other").withColumnRenamed("size", "other_size"), "other")
    ranks = F.struct(F.col("other_size"), F.col("other")) > F.struct(F.col("size"), F.col("group"))
    fits = (100 * F.col("n_most") >= share * F.col("n")) & (100 * F.col("n") >= share * F.col("n_least"))
    held = (asking.join(matrix, "token").where(ranks & fits)
            .groupBy("cid", "n", "last", "other", "other_size", "n_least", "n_most", "last_least")
            .agg(F.count("*").alias("held")))
    return held.withColumn("size", F.col("other_size")).where(_qualifies(share)).select("cid", F.col("other").alias("group"))


def group_links(texts: DataFrame, classes: DataFrame, asked: DataFrame, words: int, share: int) -> DataFrame:
    """Links (a, b) found by opening the qualifying groups."""
    asked = tables.materialize(asked, "qualifying")
    parts = classes.join(asked.select("group").distinct(), "group").select("group", "cid")
    sizes = parts.groupBy("group").agg(F.ceil(F.count("*") / GROUP_PART).alias("parts"))
    members = (parts.join(sizes, "group").withColumn("part", F.pmod(F.xxhash64("cid"), F.col("parts")))
               .select("group", "part", F.lit(0).alias("visits"), "cid"))
    visitors = (asked.join(sizes, "group")
                .select("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
                        F.lit(1).alias("visits"), "cid"))
    rows = members.unionByName(visitors)
    tokens = with_tokens(texts, rows.select("cid").distinct(), words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: list[tuple[int, np.ndarray]] = []
        for new, row in _groups(batches, ["group", "part"]):
            mine = np.frombuffer(row["tokens"], np.int64)
            if new:
                inside = []
            if not row["visits"]:
                inside.append((row["cid"], mine))
                continue
            other = next((c for c, t in inside if _linked(mine, t, share)), None)
            if other is not None:
                yield pa.RecordBatch.from_pydict({"a": pa.array([row["cid"]]), "b": pa.array([other])})

    found = tables.materialize(
        rows.join(tokens, "cid").repartition("group", "part")
        .sortWithinPartitions("group", "part", "visits", "cid").mapInArrow(run, "a long, b long"), "group-links")
    tables.discard(asked, tokens)
    return found


def _grouped(classes: DataFrame, edges: DataFrame, name: str) -> DataFrame:
    """``classes`` with column ``name``: the component of their edges, or themselves."""
    found = components(edges).withColumnRenamed("component", "_component")
    return (classes.join(found, F.col("cid") == F.col("node"), "left")
            .withColumn(name, F.coalesce("_component", "cid")).drop("node", "_component"))


# --- the operator ----------------------------------------------------------------

def link(texts: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """``row, doc_id, n_shingles, component, component_id`` of every document.

    ``texts`` is a written table with ``row`` (an id that tells documents with
    one ``doc_id`` apart), ``doc_id`` and ``text`` (not null); ``component`` is
    a ``row`` of the component.
    """
    signed = signatures(texts, words, share)
    filled = signed.where("n > 0")
    classes = tables.materialize(
        filled.groupBy("k1", "k2").agg(
            F.min("row").alias("cid"), F.min("doc_id").alias("least_doc"), F.first("n").alias("n"),
            F.first("prefix").alias("prefix"), F.first("last").alias("last"), F.first("least").alias("least")),
        "classes")
    docs = tables.materialize(signed.select("row", "doc_id", "n", "k1", "k2"), "classes-of-documents")
    tables.discard(signed)
    first = pivot_links(texts, classes, words, share)
    grouped = tables.materialize(_grouped(classes.select("cid", "n", "prefix", "last"), first, "group"), "groups")
    second = group_links(texts, grouped, qualifying(grouped, share), words, share)
    tables.discard(grouped)
    final = _grouped(classes.select("k1", "k2", "cid", "least_doc"), first.unionByName(second), "component")
    named = final.groupBy("component").agg(F.min("least_doc").alias("component_id"))
    by_class = tables.materialize(
        final.join(named, "component").select("k1", "k2", "component", "component_id"), "components")
    tables.discard(classes)
    with_set = docs.where("n > 0").join(by_class, ["k1", "k2"])
    alone = docs.where("n = 0").withColumn("component", F.col("row")).withColumn("component_id", F.col("doc_id"))
    columns = ["row", "doc_id", F.col("n").alias("n_shingles"), "component", "component_id"]
    return with_set.select(*columns).unionByName(alone.select(*columns))


def _numbered(docs: DataFrame) -> DataFrame:
    return tables.materialize(docs.withColumn("row", F.monotonically_increasing_id()), "texts")


def digest(docs: DataFrame) -> DataFrame:
    """Per document: the size of its set and the smallest id of its component."""
    texts = _numbered(docs.select("doc_id", text_or_empty().alias("text")))
    return link(texts).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, share: int = SHARE) -> DataFrame:
    """``docs`` with one document of each component: the smallest id's (null last)."""
    rows = _numbered(tables.packed(docs))
    linked = link(rows.select("row", F.col("_doc.doc_id").alias("doc_id"),
                              F.coalesce("_doc.text", F.lit("")).alias("text")), words, share)
    kept = linked.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"].alias("row"))
    return rows.join(kept.select("row"), "row", "left_semi").select("_doc.*")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS sh FROM w),
n AS (SELECT doc_id, len(sh) AS n FROM s),
k AS MATERIALIZED (SELECT min(doc_id) AS cid, list(doc_id) AS docs, len(any_value(sh)) AS n, any_value(sh) AS sh
      FROM (SELECT doc_id, list_sort(sh) AS sh FROM s WHERE len(sh) > 0) GROUP BY sh),
t AS MATERIALIZED (SELECT cid, n, unnest(sh) AS x FROM k),
p AS (SELECT a.cid AS a, b.cid AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
      FROM t a JOIN t b ON a.x = b.x AND a.cid <> b.cid GROUP BY 1, 2),
e AS MATERIALIZED (SELECT a, b FROM p WHERE 100 * c >= 85 * (na + nb - c)),
r(cid, root) AS (SELECT cid, cid FROM k UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.cid),
c AS (SELECT cid, min(root) AS root FROM r GROUP BY cid),
m AS (SELECT unnest(k.docs) AS doc_id, c.root FROM k JOIN c USING (cid))
SELECT n.doc_id, n.n AS n_shingles, coalesce(m.root, n.doc_id) AS component_id FROM n LEFT JOIN m USING (doc_id)
"""
