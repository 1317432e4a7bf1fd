"""Pack token sequences by cutting-stock column generation.

1. Texts become ids; a document longer than a sequence is cut at multiples of
   its capacity, so all but its last piece fill a sequence each.
2. Lengths are counted in classes of ``STEP`` tokens (rounded up): a histogram
   of at most ``capacity / STEP`` rows.
3. A linear program chooses how often each pattern of classes is used; a
   knapsack dynamic program prices new patterns until none improves.
4. Uses are rounded down, what remains is packed first-fit decreasing, and the
   pieces, ranked within their class, take the patterns' slots by arithmetic.

Only the histogram reaches the driver.

Odd input: a null or empty text is the closing id alone; repeated rows and
null ids are packed one by one; an empty table gives no pieces; further
columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm import tables
from terrace.llm.offsets import with_offsets

CAPACITY = 2048
STEP = 8
CLOSING_ID = 1
MAX_PIVOTS = 5000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# --- token ids ----------------------------------------------------------------

def _byte_of() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary:
    printable ones for themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return {chr(b) if b in plain else chr(next(others)): b for b in range(0x100)}


class Encoder:
    """Ids of texts by a byte-level BPE file of ``tokenizers``.

    Plain texts go through tiktoken's matcher, loaded with the same file's
    vocabulary, which gives the same ids several times as fast.  Texts with
    characters beyond the ranges below, where the two libraries' tables of
    letters and blanks might differ, and texts that hold an added token (such
    as the end of a text) are encoded by ``tokenizers`` itself.
    """

    NOT_PLAIN = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa0-\\u024f\\u1e00-\\u1eff\\u2010-\\u2027\\u20ac]")
    # How the file's byte-level splitter cuts a text (a fixed value).
    SPLITTER = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        byte_of = _byte_of()
        special = self.tokenizer.get_added_tokens_decoder()
        self.added = tuple(token.content for token in special.values())
        ranks = {bytes(map(byte_of.__getitem__, token)): rank
                 for token, rank in self.tokenizer.get_vocab(with_added_tokens=False).items() if rank not in special}
        self.fast = tiktoken.Encoding("bytes", pat_str=self.SPLITTER, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit values."""
        if self.NOT_PLAIN.search(text) or any(token in text for token in self.added):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def tokenize(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` ids: place, length and checksum of each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer_path)
        closing = np.array([CLOSING_ID], "<u4").tobytes()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                out: list[list] = [[], [], [], [], []]
                for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                    ids = encoder.encode(text or "") + closing
                    n = len(ids) // 4
                    for start in range(0, n, capacity):
                        piece = ids[4 * start:4 * (start + capacity)]
                        for column, value in zip(out, (doc, start, len(piece) // 4, zlib.crc32(piece), n)):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in out],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


# --- patterns -------------------------------------------------------------------

def _best_pattern(value: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of largest value, by dynamic programming."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(size)
    sizes, values = size[order], value[order]
    for room in range(1, capacity + 1):
        fit = np.searchsorted(sizes, room, side="right")
        best[room], choice[room] = best[room - 1], -2
        if fit:
            gain = best[room - sizes[:fit]] + values[:fit]
            k = int(gain.argmax())
            if gain[k] > best[room] + 1e-12:
                best[room], choice[room] = gain[k], order[k]
    pattern = np.zeros(len(size), dtype=np.int64)
    room = capacity
    while room > 0 and choice[room] != -1:
        if choice[room] == -2:
            room -= 1
        else:
            pattern[choice[room]] += 1
            room -= size[choice[room]]
    return best[capacity], pattern


def solve_patterns(size: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and their (fractional) uses that meet ``demand`` with few sequences.

    Revised simplex; the columns are never listed, only priced.
    """
    m = len(size)
    columns = [np.where(np.arange(m) == i, capacity // size[i], 0) for i in range(m)]
    inverse = np.diag(1.0 / np.array([c.max() for c in columns]))
    uses = inverse @ demand
    for _ in range(MAX_PIVOTS):
        gain, pattern = _best_pattern(inverse.sum(axis=0), size, capacity)
        if gain <= 1 + 1e-7:
            break
        step = inverse @ pattern
        ratio = np.where(step > 1e-9, np.maximum(uses, 0) / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        if not np.isfinite(ratio[leave]):
            break
        uses = uses - ratio[leave] * step
        uses[leave] = ratio[leave]
        inverse[leave] /= step[leave]
        others = np.arange(m) != leave
        inverse[others] -= np.outer(step[others], inverse[leave])
        columns[leave] = pattern
    return list(zip(columns, uses))


def choose_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (class size -> pieces) with whole numbers of uses that hold
    every piece of the histogram exactly once."""
    size = np.array(sorted(histogram), dtype=np.int64)
    demand = np.array([histogram[s] for s in size], dtype=np.int64)
    out: list[tuple[dict[int, int], int]] = []
    left = demand.copy()
    if len(size):
        for pattern, use in solve_patterns(size, demand.astype(float), capacity):
            held = pattern > 0
            n = min(int(np.floor(use + 1e-6)), *(int(x) for x in left[held] // pattern[held]))
            if n > 0:
                out.append(({int(s): int(a) for s, a in zip(size[held], pattern[held])}, n))
                left -= n * pattern
    rest = {int(s): int(n) for s, n in zip(size, left) if n}
    while rest:
        room, pattern = capacity, {}
        for s in sorted(rest, reverse=True):
            take = min(rest[s], room // s)
            if take:
                pattern[s] = take
                room -= take * s
        uses = min(rest[s] // n for s, n in pattern.items())
        out.append((pattern, uses))
        rest = {s: n - uses * pattern.get(s, 0) for s, n in rest.items() if n > uses * pattern.get(s, 0)}
    return out


def assign(pieces: DataFrame, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``."""
    classed = pieces.withColumn("_class", F.ceil(F.col("length") / step))
    histogram = {r["_class"]: r["n"] for r in classed.groupBy("_class").agg(F.count("*").alias("n")).collect()}
    chosen = choose_patterns(histogram, capacity // step)
    first = np.cumsum([0, *[n for _, n in chosen]])
    # Per class: which patterns hold it, how often, and the slots before each.
    holders = {c: [(j, p[c]) for j, (p, _) in enumerate(chosen) if c in p] for c in histogram}
    before = {c: np.cumsum([0, *[a * chosen[j][1] for j, a in held]]) for c, held in holders.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, ranks = batch["_class"].to_numpy(), batch["_rank"].to_numpy()
            sequence = np.zeros(len(batch), dtype=np.int64)
            for c in np.unique(classes):
                mine = classes == c
                held = np.searchsorted(before[c], ranks[mine], side="right") - 1
                pattern, pieces_each = np.array(holders[c]).T[:, held]
                sequence[mine] = first[pattern] + (ranks[mine] - before[c][held]) // pieces_each
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays([*[batch[n] for n in names], pa.array(sequence)], [*names, "sequence_id"])

    ranked = with_offsets(classed.withColumn("_one", F.lit(1)), ["_class"], "_one",
                          ["doc_id", "start", "ids_crc32"], "_rank").drop("_one")
    placed = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "_class", "_rank").mapInArrow(
        place, f"{PIECES}, _class long, sequence_id long")
    inside = (Window.partitionBy("sequence_id").orderBy(F.desc("_class"), "doc_id", "start", "ids_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0))).drop("_class")


def pack(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Every document's pieces with the sequence and offset that hold them."""
    pieces = tables.materialize(tokenize(docs, tokenizer_path or default_tokenizer()), "pieces")
    return assign(pieces)
