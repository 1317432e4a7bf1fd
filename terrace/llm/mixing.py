"""Mix sources to target weights by drawing fixed-length blocks.

The words of a source, document after document, are packed into blocks of
``block_words``.  Each source's number of slots follows from its target; a
multinomial draw deals the slots to the output shards.  Slot ``j`` of a source
takes the block at ``permutation(j mod blocks)``, a keyed pseudorandom
permutation of the block indices, so every block is taken once before any is
taken again.  Slots and the documents' pieces meet in a join on block index.

All draws depend on ``seed`` and the source only, so reruns agree.

Odd input: a null text has size 0 and is never taken; null sources form one
source, ranked last; repeated rows are separate documents; an empty table
gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.offsets import with_offsets
from terrace.llm.quality import BLANK, BLANKS
from terrace.llm.tables import text_or_empty

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2
BLOCK_WORDS = 64
SLOTS_PER_SHARD = 1 << 20
SEED = 20240607


def word_count(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANK))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, f"{BLANKS}+"))).cast("long")


def targets(sized: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: rank, size, target words, blocks and slots.

    Sorted by how soon a source reaches its cap, the sources before the first
    one that stays below it are capped, and what is left is shared by weight
    among the others.  The windows run over one row per source.
    """
    sources = (sized.groupBy("source").agg(F.sum("size").alias("source_size"))
               .withColumn("src", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
               .withColumn("_weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), F.col("src") % len(WEIGHTS) + 1))
               .withColumn("_cap", MAX_REPEATS * F.col("source_size").cast("double")))
    order = Window.orderBy(F.col("_cap") / F.col("_weight"), "src")
    everything = Window.partitionBy()
    level = ((TOTAL_SHARE * F.sum("source_size").over(everything)
              - F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
             / F.sum("_weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
    free = sources.withColumn("_level", level).withColumn(
        "_below", F.col("_level") * F.col("_weight") <= F.col("_cap"))
    shared = F.min(F.when(F.col("_below"), F.struct(F.col("_cap") / F.col("_weight"), "src", "_level"))).over(everything)
    blocks = F.ceil(F.col("source_size") / block_words)
    slots = F.least(MAX_REPEATS * F.col("blocks"), F.round(F.col("target") * F.col("blocks") / F.col("source_size")))
    return (free.withColumn("_shared", shared["_level"])
            .withColumn("target", F.when(F.col("_cap") / F.col("_weight") < F.col("_shared"), F.col("_cap"))
                        .otherwise(F.col("_shared") * F.col("_weight")))
            .withColumn("blocks", blocks)
            .withColumn("slots", F.when(F.col("source_size") > 0, slots).otherwise(F.lit(0)).cast("long"))
            .select("src", "source", "source_size", "target", "blocks", "slots"))


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Place of each index under a pseudorandom permutation of range(n).

    A four-round Feistel network permutes the next even power of two; values
    beyond n walk on until they fall inside.
    """
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    out = index.astype(np.uint64)
    todo = np.ones(len(out), dtype=bool)
    while todo.any():
        x = out[todo]
        left, right = x >> shift, x & mask
        for turn in range(4):
            step = np.uint64((key * 4 + turn) & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (_mix64(right ^ _mix64(np.array([step]))) & mask)
        out[todo] = (left << shift) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def draw(plan: DataFrame, seed: int = SEED, slots_per_shard: int = SLOTS_PER_SHARD) -> DataFrame:
    """The mixture: a row (shard, src, slot, block, epoch) per slot."""
    total = plan.agg(F.sum("slots")).first()[0] or 0
    shards = max(16, -(-total // slots_per_shard))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for sources in batches:
            for src, blocks, slots in zip(sources["src"], sources["blocks"], sources["slots"]):
                rng = np.random.Generator(np.random.Philox(key=[seed, int(src)]))
                counts = rng.multinomial(int(slots), np.full(shards, 1.0 / shards))
                yield pd.DataFrame({"src": int(src), "blocks": int(blocks), "shard": np.arange(shards),
                                    "first": np.cumsum(counts) - counts, "count": counts})

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for row in rows.itertuples():
                slot = np.arange(row.first, row.first + row.count, dtype=np.int64)
                if len(slot):
                    yield pd.DataFrame({"shard": row.shard, "src": row.src, "slot": slot,
                                        "block": permute(slot % row.blocks, row.blocks, seed * 1_000_003 + row.src),
                                        "epoch": slot // row.blocks})

    counts = plan.where("slots > 0").select("src", "blocks", "slots").mapInPandas(
        deal, "src long, blocks long, shard long, first long, count long")
    return (counts.repartition(shards, "src", "shard")
            .mapInPandas(fill, "shard long, src long, slot long, block long, epoch long"))


def pieces(sized: DataFrame, plan: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents' parts in each block: (src, block, row, start, length)."""
    ranked = sized.where("size > 0").join(plan.select("src", F.col("source").alias("_source")),
                                          F.col("source").eqNullSafe(F.col("_source")))
    placed = with_offsets(ranked.select("src", "row", "doc_id", "size", "text_hash"), ["src"], "size",
                          ["doc_id", "size", "text_hash"], "at")
    first, last = F.floor(F.col("at") / block_words), F.floor((F.col("at") + F.col("size") - 1) / block_words)
    cut = placed.withColumn("block", F.explode(F.sequence(first, last)))
    begin = F.greatest(F.col("block") * block_words, F.col("at"))
    end = F.least((F.col("block") + 1) * block_words, F.col("at") + F.col("size"))
    return cut.select("src", "block", "row", (begin - F.col("at")).alias("start"), (end - begin).alias("length"))


def with_size(docs: DataFrame) -> DataFrame:
    """Documents with ``size``, ``text_hash`` and ``row``, an id that is fixed
    by writing them, instead of ``text``.  Draws depend on the former two and
    the document's id only, so on no row order."""
    return tables.materialize(docs.withColumn("size", word_count(text_or_empty()))
                              .withColumn("text_hash", F.xxhash64(text_or_empty()))
                              .withColumn("row", F.monotonically_increasing_id()).drop("text"), "sized")


def mix(sized: DataFrame, plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixture in pieces: (shard, src, slot, block, epoch, row, start, length)."""
    # Spark takes the drawn slots for as few as the sources they come from.
    return draw(plan, seed).hint("merge").join(pieces(sized, plan), ["src", "block"])


def digest(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document: its size, its source's size and target, the words taken."""
    sized = with_size(docs.select("doc_id", "source", "text"))
    plan = targets(sized)
    taken = mix(sized, plan, seed).groupBy("row").agg(F.sum("length").alias("taken"))
    return (sized.join(plan.withColumnRenamed("source", "_source"),
                       F.col("source").eqNullSafe(F.col("_source")))
            .join(taken, "row", "left")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(found: list[dict]) -> list[tuple[int, int]]:
    """Runs (start, length) of consecutive words per epoch, from sorted pieces."""
    out: list[list[int]] = []
    for p in found:
        if out and out[-1][0] == p["epoch"] and out[-1][1] + out[-1][2] == p["start"]:
            out[-1][2] += p["length"]
        else:
            out.append([p["epoch"], p["start"], p["length"]])
    return [(start, length) for _, start, length in out]


def _cut(text: str, size: int, runs: list[tuple[int, int]]) -> list[str]:
    """The runs' texts; a text that is taken whole stays as it is."""
    places = None
    out = []
    for start, length in runs:
        if length == size:
            out.append(text)
            continue
        places = places or [m.span() for m in _WORD.finditer(text)]
        out.append(text[places[start][0]:places[start + length - 1][1]])
    return out


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mixture as documents: a row per epoch and run of consecutive words
    that the mix takes, with the columns of ``docs`` (``n_chars`` is the new length)."""
    sized = with_size(tables.packed(docs, "doc_id", "source", "text"))
    got = (mix(sized.drop("_doc"), targets(sized), seed).groupBy("row")
           .agg(F.array_sort(F.collect_list(F.struct("epoch", "start", "length"))).alias("found")))
    columns = docs.columns

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc = batch["_doc"]
            index, texts = [], []
            for i, (text, size, found) in enumerate(zip(
                    doc.field("text").to_pylist(), batch["size"].to_pylist(), batch["found"].to_pylist())):
                parts = _cut(text, size, _runs(found))
                index += [i] * len(parts)
                texts += parts
            for at in range(0, len(index), 2000):
                part = doc.take(pa.array(index[at:at + 2000], pa.int64()))
                new = {"text": texts[at:at + 2000], "n_chars": [len(t) for t in texts[at:at + 2000]]}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new[c], part.field(c).type) if c in new else part.field(c) for c in columns], columns)

    return sized.join(got, "row").select("_doc", "size", "found").mapInArrow(take, docs.schema)
