"""URL filter by a Bloom filter cascade: exact membership without a join.

Keys are tagged with the list they are looked up in (``allow``, ``block`` for
rules, ``host`` for listed hosts).  The key universe is every key that any url
of the corpus asks for.  Level 1 is a Bloom filter of the listed keys; level 2
holds the keys of the universe that level 1 lets through wrongly (only what
level 1 lets through is compared with the list); level 3 the listed keys that
level 2 lets through, and so on until a level lets nothing through.  A key of
the universe is listed if and only if the first level that does not hold it
has an even number, or no level is left after an odd number of them.

Level sizes follow from the numbers of keys.  Keys are parted by hash into as
many cascades as keep each below ``max_bytes``; urls are judged by one after
the other, so no more than one is sent to the tasks at a time.

Odd input: a null url or one without ``://`` has an empty host and path, no
rule, and the verdict of the empty host; repeated rows and null ids are
returned as they come; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import tables

MAX_BYTES = 64 << 20

# (verdict, host, path) of the rules.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"),
         ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
# A host is listed when one of its labels is made of these words.
LISTED_WORDS = ("adult", "casino", "malware", "phish", "porn", "spam", "warez", "xxx")


# --- the cascade ----------------------------------------------------------------

# Filter words (uint64), size in bits, number of hashes.
Level = tuple[np.ndarray, int, int]


def _places(h1: np.ndarray, h2: np.ndarray, level: int, size: int, hashes: int) -> np.ndarray:
    """Bit places (hashes x keys) from two 64-bit hashes, other ones per level."""
    a, b = h1.view(np.uint64), h2.view(np.uint64) | np.uint64(1)
    salt = np.uint64((level * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    a = (a ^ salt) * np.uint64(0xBF58476D1CE4E5B9)
    a ^= a >> np.uint64(31)
    steps = np.arange(hashes, dtype=np.uint64)[:, None]
    x = a + steps * b
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) % np.uint64(size)


def _holds(level: Level, number: int, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    bits, size, hashes = level
    at = _places(h1, h2, number, size, hashes)
    return ((bits[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)).all(axis=0)


def member(levels: Sequence[Level], h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Whether keys of the universe are listed."""
    out = np.full(len(h1), len(levels) % 2 == 1)
    open_ = np.arange(len(h1))
    for number, level in enumerate(levels):
        held = _holds(level, number, h1[open_], h2[open_])
        out[open_[~held]] = number % 2 == 1
        open_ = open_[held]
    return out


def _shape(keys: int, others: int, number: int) -> tuple[int, int]:
    """Bits and hashes of a level: the first lets few others through, later
    ones half of them."""
    rate = min(0.5, keys * math.sqrt(0.5) / max(others, 1)) if number == 0 else 0.5
    bits = max(64, math.ceil(keys * -math.log(rate) / math.log(2) ** 2))
    return -(-bits // 64) * 64, max(1, round(-math.log2(rate)))


def parts_of(listed: int, universe: int, max_bytes: int) -> int:
    """Cascades needed: the levels after the first take under four bits a listed
    key; a quarter is left for parts and levels that come out larger."""
    bits = _shape(listed, universe, 0)[0] + 4 * listed if listed else 0
    return max(1, math.ceil(bits * 1.25 / 8 / max_bytes))


def _fill(keys: DataFrame, number: int, size: int, hashes: int) -> Level:
    """The Bloom filter of ``keys``; only its words reach the driver."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            at = np.unique(_places(rows["h1"].to_numpy(), rows["h2"].to_numpy(), number, size, hashes))
            word, start = np.unique(at >> np.uint64(6), return_index=True)
            bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), start) if len(at) else at
            yield pd.DataFrame({"word": word.astype(np.int64), "bits": bits.view(np.int64)})

    found = (keys.select("h1", "h2").mapInPandas(words, "word long, bits long")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas())
    filled = np.zeros(size // 64, dtype=np.uint64)
    filled[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return filled, size, hashes


def _counts(keys: DataFrame) -> dict[bool, int]:
    return {r["listed"]: r["n"] for r in keys.groupBy("listed").agg(F.count("*").alias("n")).collect()}


def build(universe: DataFrame, listed: DataFrame) -> list[Level]:
    """Levels over the keys of ``universe`` and ``listed`` (key, h1, h2: distinct)."""
    keys = listed.count()
    if not keys:
        return []
    levels = [_fill(listed, 0, *_shape(keys, universe.count(), 0))]
    spark = universe.sparkSession

    def passed(rows: DataFrame, level: Level, number: int, spared: bool | None) -> DataFrame:
        """Rows that the level holds, and those whose ``listed`` is ``spared``."""
        shared = spark.sparkContext.broadcast(level)  # of one cascade, within max_bytes

        def still(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for part in batches:
                held = _holds(shared.value, number, part["h1"].to_numpy(), part["h2"].to_numpy())
                yield part[held if spared is None else (part["listed"].to_numpy() == spared) | held]

        return rows.mapInPandas(still, rows.schema)

    survivors = passed(universe.select("key", "h1", "h2"), levels[0], 0, None)
    alive = tables.materialize(
        survivors.join(listed.select("key", F.lit(True).alias("_on")), "key", "left")
        .select("h1", "h2", F.coalesce("_on", F.lit(False)).alias("listed")), "cascade")
    while True:
        number = len(levels)
        side = number % 2 == 0
        counts = _counts(alive)
        if not counts.get(side):
            tables.discard(alive)
            return levels
        level = _fill(alive.where(F.col("listed") == side), number,
                      *_shape(counts[side], counts.get(not side, 0), number))
        levels.append(level)
        rest = tables.materialize(passed(alive, level, number, side), "cascade")
        tables.discard(alive)
        alive = rest


# --- urls -----------------------------------------------------------------------

def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def rule_keys(rules: Sequence[tuple[str, str, str]]) -> Column:
    """The ``host/path`` keys that a url could match a rule by, longest first.

    A rule fits the last labels of a host and the beginning of a path, so the
    rules' numbers of labels and lengths of paths give all possible keys.
    """
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules}, key=lambda s: (-sum(s), s))
    keys = [F.when((F.size(F.split("host", r"\.")) >= labels) & (F.length("path") >= length) & (F.col("host") != ""),
                   F.concat(F.substring_index("host", ".", -labels), F.substring("path", 1, length)))
            for labels, length in shapes]
    found = F.array_distinct(F.array_compact(F.array(*keys)))
    return F.array_sort(found, lambda a, b: F.length(b) - F.length(a))


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(1), key).alias("h1"), F.xxhash64(F.lit(2), key).alias("h2")


def _asked(pages: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Pages with ``asked``: the tagged keys that decide their verdict, in order."""
    tags = F.flatten(F.transform(rule_keys(rules), lambda k: F.array(F.concat(F.lit("allow "), k),
                                                                     F.concat(F.lit("block "), k))))
    return pages.withColumn("asked", F.concat(tags, F.array(F.concat(F.lit("host "), F.col("host")))))


def listed_hosts(hosts: DataFrame, words: Sequence[str] = LISTED_WORDS) -> DataFrame:
    """The host list: hosts with a label made of a listed word and hyphens."""
    pattern = rf"(^|[.-])({'|'.join(words)})([.-]|$)"
    return hosts.where(F.rlike("host", F.lit(pattern)))


def _first_listed(spark: SparkSession, levels: Sequence[Level], part: int, parts: int):
    """Place of the first of a row's keys that lies in ``part`` and is listed."""
    shared = spark.sparkContext.broadcast(levels)  # one cascade, within max_bytes

    @F.pandas_udf("int")
    def first_listed(h1: pd.Series, h2: pd.Series) -> pd.Series:
        sizes = h1.str.len().to_numpy()
        a, b = (np.concatenate([np.asarray(v, dtype=np.int64) for v in x]) for x in (h1, h2))
        held = np.flatnonzero(a % parts == part)
        held = held[member(shared.value, a[held], b[held])]
        row = np.repeat(np.arange(len(sizes)), sizes)[held]
        place = held - (np.cumsum(sizes) - sizes)[row]
        first, at = np.unique(row, return_index=True)
        return pd.Series(place[at], index=first).reindex(range(len(sizes))).astype("Int32")

    return first_listed


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          listed: DataFrame | None = None, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every page.

    ``listed`` holds the blocked hosts (column ``host``); by default those of
    ``listed_hosts`` among the pages.
    """
    host, path = split_url(F.col("url"))
    rows = _asked(pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path")), rules)
    keys = rows.select(F.explode("asked").alias("key")).distinct()
    if listed is None:
        listed = listed_hosts(rows.select("host").distinct())
    rule_rows = rows.sparkSession.createDataFrame([(f"{verdict} {h}{p}",) for verdict, h, p in rules], "key string")
    wanted = (listed.where("host is not null").select(F.concat(F.lit("host "), F.col("host")).alias("key"))
              .unionByName(rule_rows).distinct())
    universe = tables.materialize(keys.select("key", *_hashes(F.col("key"))), "url-keys")
    on_list = tables.materialize(wanted.select("key", *_hashes(F.col("key"))), "url-list")
    parts = parts_of(on_list.count(), universe.count(), max_bytes)
    answered = rows.withColumn("at", F.lit(None).cast("int"))
    for part in range(parts):
        mine = F.pmod("h1", F.lit(parts)) == part
        levels = build(universe.where(mine), on_list.where(mine))
        h1 = F.transform("asked", lambda k: F.xxhash64(F.lit(1), k))
        h2 = F.transform("asked", lambda k: F.xxhash64(F.lit(2), k))
        before = answered
        answered = answered.withColumn("at", F.least("at", _first_listed(rows.sparkSession, levels, part, parts)(h1, h2)))
        if part < parts - 1:
            answered = tables.materialize(answered, "url-rows")
            if part:
                tables.discard(before)
    tables.discard(universe, on_list)
    answered = answered.withColumn("hit", F.get("asked", F.col("at")))
    kind, key = F.substring_index("hit", " ", 1), F.regexp_replace("hit", "^[a-z]+ ", "")
    rule = F.when(kind != "host", key)
    verdict = F.when(kind == "allow", F.lit("allow")).when(kind.isin("block", "host"), F.lit("block")).otherwise(F.lit("allow"))
    return answered.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))


ORACLE = r"""
WITH a AS (SELECT page_id, CASE WHEN position('://' IN url) > 0
                                THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, coalesce(rest, '') AS rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS raw FROM a),
c AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM b),
r(verdict, h, p) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                            ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fit AS (SELECT c.*, r.verdict AS said, r.h || r.p AS rule FROM c LEFT JOIN r
        ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        QUALIFY row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(r.h || r.p) DESC NULLS LAST) = 1)
SELECT page_id, host, path, rule, coalesce(said,
       CASE WHEN regexp_matches(host, '(^|[.-])(adult|casino|malware|phish|porn|spam|warez|xxx)([.-]|$)')
            THEN 'block' ELSE 'allow' END) AS verdict
FROM fit
"""
