"""Repeated substrings by bucket-pointer refinement over all suffixes.

A suffix's bucket at depth ``q`` is named by an identifier of its first ``q``
bytes.  Buckets are refined by the identifiers of later offsets: the one of
depth ``2q`` at ``p`` combines those of depth ``q`` at ``p`` and ``p + q``, and
each round uses the identifiers that the round before refined.  Two places
hold the same ``LENGTH`` bytes when their identifiers of that depth agree.

Shuffling an identifier per byte would move many times the corpus, so places
are sorted out in steps:

1. Every ``LENGTH``-byte string has an anchor: the place within it whose
   identifier of depth ``Q`` is smallest.  Equal strings have their anchors at
   equal places, so the anchor's bucket is a first bucket for the whole string.
   Neighbouring strings share anchors: a run of starts with one anchor is a
   segment, about a fiftieth as many as there are bytes.
2. Segments fall into buckets by anchor.  Segments alone in their bucket hold
   nothing repeated; equal segments (their identifiers of depth ``LENGTH`` at
   both ends agree) are repeated throughout.
3. Only buckets that hold different segments are refined further: one segment
   of each kind sends its bytes, and its starts are sorted by identifiers of
   depth ``LENGTH`` (128 bits).  Buckets with more than ``HOT`` kinds do this
   as rows that are counted with partial sums, not as one group.

All strings are judged on the input.  Every step keeps whole texts; documents
longer than ``CHUNK`` bytes are read in overlapping parts.

Odd input: a null text counts as empty; texts shorter than ``LENGTH`` are kept
whole; repeated rows are documents of their own (and so remove each other);
null ids are allowed; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.tables import text_or_empty

LENGTH = 200
Q = 64
# Places of depth-Q buckets within a string of LENGTH bytes.
WINDOW = LENGTH - Q + 1
CHUNK = 1 << 20
HOT = 20_000
GROUP_ROWS = 4096

_LOW = (1 << 24) - 1
_BYTE_IDS = np.random.default_rng(20240521).integers(0, 2 ** 64, (2, 256), dtype=np.uint64)


# --- bucket identifiers -----------------------------------------------------------

def _combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Identifiers of two adjoining (or overlapping) stretches made one."""
    h = a * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h += b
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    return h


def refine(raw: np.ndarray, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers of depth ``Q`` and of depth ``LENGTH`` at every place."""
    ids, depth = _BYTE_IDS[lane][raw], 1
    first = ids
    while 2 * depth <= LENGTH:
        ids = _combine(ids[:-depth], ids[depth:])
        depth *= 2
        if depth == Q:
            first = ids
    ahead = LENGTH - depth
    return first, _combine(ids[:-ahead], ids[ahead:])


def _anchors(first: np.ndarray, n: int) -> np.ndarray:
    """For each of n starts the place of the smallest identifier within it
    (the leftmost of equal ones)."""
    low = (first & np.uint64(0xFFFFFFFFFFFFFFFF ^ _LOW)) | np.arange(len(first), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOW:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[WINDOW - width:][:n])
    return (low & np.uint64(_LOW)).astype(np.int64)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string column and where each value begins."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def _parts(offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Work units of about CHUNK bytes: (document, begin, end) of each stretch.

    A longer document is cut into stretches that overlap by LENGTH - 1, so
    each start lies in exactly one.
    """
    begin, end = offsets[:-1], offsets[1:]
    held, size = [], 0
    for doc in np.flatnonzero(end - begin >= LENGTH):
        for at in range(begin[doc], end[doc] - LENGTH + 1, CHUNK):
            stop = min(end[doc], at + CHUNK + LENGTH - 1)
            held.append((doc, at, stop))
            size += stop - at
            if size >= CHUNK:
                yield tuple(np.array(x) for x in zip(*held))
                held, size = [], 0
    if held:
        yield tuple(np.array(x) for x in zip(*held))


def segments(texts: DataFrame) -> DataFrame:
    """(bucket, kind, row, place) of all segments; ``place`` holds the first
    start and, in the last eight bits, the number of starts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _bytes_of(batch["text"])
            rows = batch["row"].to_numpy()
            for doc, begin, end in _parts(offsets):
                size = end - begin
                raw = np.concatenate([data[a:b] for a, b in zip(begin, end)])
                first, whole = refine(raw)
                anchor = _anchors(first, len(whole))
                stops = np.cumsum(size)
                part = np.repeat(np.arange(len(doc)), size)[:len(whole)]
                inside = np.arange(len(whole)) + LENGTH <= stops[part]
                change = np.r_[True, (np.diff(anchor) != 0) | (np.diff(part) != 0)]
                lo = np.flatnonzero(change & inside)
                after = np.flatnonzero(np.r_[change[1:] | ~inside[1:], True] & inside)
                n = after - lo + 1
                kind = _combine(_combine(whole[lo], whole[after]),
                                (n.astype(np.uint64) << np.uint64(8)) | (anchor[lo] - lo).astype(np.uint64))
                place = begin[part[lo]] - offsets[doc[part[lo]]] + lo - (stops - size)[part[lo]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(first[anchor[lo]].view(np.int64)), pa.array(kind.view(np.int64)),
                     pa.array(rows[doc[part[lo]]]), pa.array(place << 8 | n)],
                    ["bucket", "kind", "row", "place"])

    return texts.select("row", "text").mapInArrow(cut, "bucket long, kind long, row long, place long")


def kinds(found: DataFrame) -> DataFrame:
    """Kinds of segment that occur twice or share their bucket with another
    kind: (bucket, kind, n, row, place, kinds), one occurrence standing for all."""
    by_kind = found.groupBy("bucket", "kind").agg(
        F.count("*").alias("n"), F.min(F.struct("row", "place")).alias("one"))
    crowded = by_kind.groupBy("bucket").agg(F.count("*").alias("kinds")).where("kinds > 1")
    return (by_kind.join(crowded, "bucket", "left").where("n > 1 or kinds > 1")
            .select("bucket", "kind", "n", "one.row", "one.place", F.coalesce("kinds", F.lit(1)).alias("kinds")))


# --- refining crowded buckets -------------------------------------------------------

_CONTEXT = "bucket long, n long, kinds long, row long, place long, bytes binary"


def contexts(texts: DataFrame, undecided: DataFrame) -> DataFrame:
    """The bytes that the starts of each undecided segment cover."""
    wanted = undecided.groupBy("row").agg(F.collect_list(F.struct("bucket", "n", "kinds", "place")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], [], []]
            for row, text, wanted in zip(batch["row"].to_pylist(), batch["text"].to_pylist(),
                                         batch["wanted"].to_pylist()):
                raw = text.encode()
                for w in wanted:
                    lo, n = w["place"] >> 8, w["place"] & 255
                    for column, value in zip(out, (w["bucket"], w["n"], w["kinds"], row, w["place"],
                                                   raw[lo:lo + n + LENGTH - 1])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*[pa.array(c, pa.int64()) for c in out[:5]], pa.array(out[5], pa.binary())],
                ["bucket", "n", "kinds", "row", "place", "bytes"])

    return texts.select("row", "text").join(wanted, "row").mapInArrow(cut, _CONTEXT)


def _starts(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all starts in the contexts: segment, offset and both identifiers."""
    data = rows["bytes"].combine_chunks()
    if isinstance(data, pa.ChunkedArray):
        data = pa.concat_arrays(data.chunks)
    sizes = np.array([len(b) for b in data.to_pylist()])
    raw = np.frombuffer(b"".join(data.to_pylist()), np.uint8)
    n = sizes - LENGTH + 1
    segment = np.repeat(np.arange(len(n)), n)
    offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = np.repeat(np.cumsum(sizes) - sizes, n) + offset
    return segment, offset, refine(raw, 0)[1][at], refine(raw, 1)[1][at]


def _repeated(rows: pa.Table) -> pa.RecordBatch:
    """Runs of starts of single segments that another kind holds too."""
    segment, offset, a, b = _starts(rows)
    order = np.lexsort((b, a))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    twice = np.zeros(len(a), dtype=bool)
    twice[order] = np.r_[same, False] | np.r_[False, same]
    twice &= rows["n"].to_numpy()[segment] == 1
    hit = np.flatnonzero(twice)
    new = np.r_[True, (np.diff(hit) != 1) | (np.diff(segment[hit]) != 0)][:len(hit)]
    first = hit[new]
    count = np.diff(np.r_[np.flatnonzero(new), len(hit)])
    place = (rows["place"].to_numpy() >> 8)[segment[first]] + offset[first]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["row"].to_numpy()[segment[first]]), pa.array(place << 8 | count)], ["row", "place"])


def refine_groups(bytes_rows: DataFrame) -> DataFrame:
    """(row, place) of repeated starts, buckets taken as groups of at most HOT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if len(batch):
                held.append(batch)
            if sum(map(len, held)) < GROUP_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            bucket = rows["bucket"].to_numpy()
            whole = int(np.searchsorted(bucket, bucket[-1]))  # the last bucket may go on
            if whole:
                yield _repeated(rows.slice(0, whole))
                held = rows.slice(whole).to_batches()
        if held:
            yield _repeated(pa.Table.from_batches(held))

    return (bytes_rows.repartition("bucket").sortWithinPartitions("bucket")
            .mapInArrow(run, "row long, place long"))


def refine_rows(bytes_rows: DataFrame) -> DataFrame:
    """The same for buckets of any size: a row per start, counted by identifier."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), GROUP_ROWS):
                rows = pa.Table.from_batches([batch.slice(at, GROUP_ROWS)])
                segment, offset, a, b = _starts(rows)
                place = (rows["place"].to_numpy() >> 8)[segment] + offset
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(rows["n"].to_numpy()[segment]),
                     pa.array(rows["row"].to_numpy()[segment]), pa.array(place << 8 | 1)],
                    ["a", "b", "n", "row", "place"])

    starts = bytes_rows.mapInArrow(run, "a long, b long, n long, row long, place long")
    twice = starts.groupBy("a", "b").agg(F.count("*").alias("times")).where("times > 1").select("a", "b")
    return starts.where("n = 1").join(twice, ["a", "b"]).select("row", "place")


# --- the operator -------------------------------------------------------------------

def repeated(texts: DataFrame, hot: int = HOT) -> DataFrame:
    """(row, places): the starts of all strings that occur elsewhere too."""
    found = segments(texts)
    judged = tables.materialize(kinds(found), "kinds")
    equal = found.join(judged.where("n > 1").select("bucket", "kind"), ["bucket", "kind"]).select("row", "place")
    equal = tables.materialize(equal, "equal-segments")
    bytes_rows = tables.materialize(contexts(texts, judged.where("kinds > 1")), "contexts")
    partly = refine_groups(bytes_rows.where(F.col("kinds") <= hot)).unionByName(
        refine_rows(bytes_rows.where(F.col("kinds") > hot)))
    places = equal.unionByName(partly).groupBy("row").agg(F.collect_list("place").alias("places"))
    return tables.materialize(places, "places")


def deduplicate(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, spans, kept``: the removed byte spans and what is left."""
    texts = tables.materialize(docs.select("doc_id", text_or_empty().alias("text"))
                               .withColumn("row", F.monotonically_increasing_id()), "texts")
    rows = texts.join(repeated(texts, hot), "row", "left").select("doc_id", "text", "places")
    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, kept, lists, starts, ends = [], [], [0], [], []
            for text, places in zip(batch["text"].to_pylist(), batch["places"]):
                raw = text.encode()
                sizes.append(len(raw))
                if places.as_py() is None:
                    kept.append(raw)
                else:
                    place = np.sort(places.values.to_numpy())
                    lo = place >> 8
                    hi = np.maximum.accumulate(lo + (place & 255) - 1 + LENGTH)
                    new = np.r_[True, lo[1:] > hi[:-1]]
                    begin, end = lo[new], hi[np.r_[new[1:], True]]
                    starts += begin.tolist()
                    ends += end.tolist()
                    kept.append(b"".join(raw[a:b] for a, b in zip([0, *end.tolist()], [*begin.tolist(), len(raw)])))
                lists.append(len(starts))
            spans = pa.StructArray.from_arrays([pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                                               ["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(sizes, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), spans), pa.array(kept, pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    return rows.mapInArrow(strip, schema)


def digest(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """Per document: its size, the bytes and runs removed, digest of the rest."""
    return deduplicate(docs, hot).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


# Every string of LENGTH bytes as two hexadecimal digits a byte, counted.
ORACLE = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS MATERIALIZED (SELECT r, i, md5(substr(h, 2 * i + 1, 400)) AS m
      FROM (SELECT r, h, unnest(range(length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400) t),
hit AS (SELECT r, i FROM w QUALIFY count(*) OVER (PARTITION BY m) > 1),
edge AS (SELECT *, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM hit),
run AS (SELECT r, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END)
                     OVER (PARTITION BY r ORDER BY i) AS n FROM edge),
span AS (SELECT r, n, min(i) AS a, max(i) + 200 AS b FROM run GROUP BY r, n),
piece AS (SELECT d.r, n, a, b, substr(h, 2 * lag(b, 1, 0) OVER (PARTITION BY d.r ORDER BY n) + 1,
                                      2 * (a - lag(b, 1, 0) OVER (PARTITION BY d.r ORDER BY n))) AS part
          FROM span JOIN d USING (r)),
kept AS (SELECT r, string_agg(part, '' ORDER BY n) AS part, max(b) AS last, count(*) AS n, sum(b - a) AS gone FROM piece GROUP BY r)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0) AS n_spans,
       sha256(unhex(CASE WHEN n IS NULL THEN h ELSE concat(part, substr(h, 2 * last + 1)) END)) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
