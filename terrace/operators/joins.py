"""Join helpers: size-checked broadcast and the validity-interval join.

Broadcast is used only for a side whose size is proven small: either bounded
by construction (``bounded_rows``) or measured by one aggregation over the
projected columns.  Anything larger is joined by shuffle (sort-merge on the
equality key); adaptive execution then splits skewed key partitions.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default ceiling for a broadcast side (bytes held in memory per executor).
DEFAULT_BROADCAST_LIMIT = 128 * 1024 * 1024
_CONF_KEY = "terrace.broadcast.maxBytes"
# Keys that facts without a postcode are spread over in a shuffled join.
BLANK_SALTS = 1024
# Opt-in up-front split of hot keys in shuffled validity joins (adaptive
# execution already splits skewed partitions at run time).
_SPLIT_CONF = "terrace.join.splitHotKeys"

_FIXED_WIDTH = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8,
    T.FloatType: 4, T.DoubleType: 8, T.DateType: 4, T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


@dataclass(frozen=True)
class SideSize:
    rows: int
    bytes: int
    broadcast: bool


def broadcast_limit(df: DataFrame) -> int:
    value = df.sparkSession.conf.get(_CONF_KEY, None)
    return int(value) if value else DEFAULT_BROADCAST_LIMIT


def measure(df: DataFrame) -> tuple[int, int]:
    """Rows and in-memory bytes of ``df`` (one aggregation job, no collect of rows).

    Bytes = fixed-width fields + actual string/binary lengths + a per-field
    row overhead, which bounds what a broadcast of these columns holds.
    """
    fields = df.schema.fields
    var = [F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
           for f in fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    other = [f for f in fields if not isinstance(f.dataType, (T.StringType, T.BinaryType))]
    per_row = 16 + 8 * len(fields) + sum(
        _FIXED_WIDTH.get(type(f.dataType), 16) for f in other)
    var_sum = F.sum(sum(var[1:], var[0])) if var else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), var_sum.cast("long").alias("v")).first()
    n, v = int(row["n"]), int(row["v"] or 0)
    return n, n * per_row + v


def checked_broadcast(df: DataFrame, limit: int | None = None,
                      bounded_rows: int | None = None, memo: dict | None = None,
                      memo_key: str | None = None,
                      bound_by: DataFrame | None = None) -> tuple[DataFrame, SideSize]:
    """Return ``broadcast(df)`` if its size is within ``limit``, else ``df``.

    ``bounded_rows`` is a row count known by construction (a generated date
    spine); then the size follows from the schema without a job.  ``bound_by``
    is measured instead of ``df`` when given: a superset of its rows and
    columns (the whole dimension), so one measurement bounds every narrower
    projection or filter of it.  ``memo`` (with ``memo_key``) keeps a
    measurement for repeated uses within one set of tables.
    """
    limit = broadcast_limit(df) if limit is None else limit
    if memo is not None and memo_key is not None and memo_key in memo:
        rows, nbytes = memo[memo_key]
        size = SideSize(rows, nbytes, nbytes <= limit)
        return (F.broadcast(df) if size.broadcast else df), size
    if bounded_rows is not None:
        width = 16 + 8 * len(df.columns) + sum(
            _FIXED_WIDTH.get(type(f.dataType), 32) for f in df.schema.fields)
        size = SideSize(bounded_rows, bounded_rows * width, bounded_rows * width <= limit)
    else:
        rows, nbytes = measure(df if bound_by is None else bound_by)
        size = SideSize(rows, nbytes, nbytes <= limit)
        if memo is not None and memo_key is not None:
            memo[memo_key] = (rows, nbytes)
    return (F.broadcast(df) if size.broadcast else df), size


def hot_keys(df: DataFrame, key: str, share: float = 0.01, fraction: float = 0.01,
             seed: int = 17) -> list:
    """Keys holding more than ``share`` of ``df``'s rows, estimated on a
    ``fraction`` sample.  At most ``1 / share`` keys qualify, so the list
    (and anything keyed by it) has a proven size bound."""
    counts = df.select(key).sample(fraction=fraction, seed=seed).groupBy(key).count()
    total = counts.agg(F.sum("count")).first()[0] or 0
    if total == 0:
        return []
    top = counts.orderBy(F.desc("count")).limit(int(1 / share)).collect()
    return [r[key] for r in top if r["count"] > share * total]


def _interval(facts: DataFrame, side: DataFrame, fact_key: str, version_key: str, fact_date: str,
              valid_from: str, valid_to: str) -> Column:
    return ((facts[fact_key] == side[version_key])
            & (facts[fact_date] >= side[valid_from])
            & (facts[fact_date] <= side[valid_to]))


def salted_key(facts: DataFrame, fact_key: str) -> Column:
    """The join key of facts.  A blank or missing one matches no version, but
    shuffled or bucketed as it is, it would bring all such facts to one task;
    so it becomes one of many keys that no version has (normalised postcodes
    hold neither space nor small letter)."""
    return F.when(F.length(fact_key) > 0, F.col(fact_key)).otherwise(
        F.concat(F.lit("~blank "), F.pmod(F.xxhash64(*facts.columns), F.lit(BLANK_SALTS)).cast("string")))


def bucketed(df: DataFrame, key: str, path: str, buckets: int) -> DataFrame:
    """``df`` as a catalog table at ``path``, hashed into ``buckets`` by ``key``
    and sorted by it.  Tables of one bucket count join on their keys without an
    exchange, each time they are joined again."""
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    # One task a bucket, so that a bucket is one file and its order is kept.
    (df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).sortBy(key)
     .format("parquet").saveAsTable(name))
    return spark.table(name)


def bucketed_validity_join(facts: DataFrame, versions: DataFrame, key: str, fact_date: str,
                           valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "left") -> DataFrame:
    """``validity_join`` of two ``bucketed`` tables on their common bucket column:
    a merge of sorted buckets, with the interval as residual condition."""
    f, v = facts.alias("f"), versions.hint("merge").alias("v")
    on = ((F.col(f"f.{key}") == F.col(f"v.{key}")) & (F.col(f"f.{fact_date}") >= F.col(f"v.{valid_from}"))
          & (F.col(f"f.{fact_date}") <= F.col(f"v.{valid_to}")))
    return f.join(v, on, how).select("f.*", *[F.col(f"v.{c}").alias(c) for c in versions.columns if c != key])


def validity_join(facts: DataFrame, versions: DataFrame, fact_key: str, version_key: str,
                  fact_date: str, valid_from: str = "valid_from", valid_to: str = "valid_to",
                  how: str = "left", limit: int | None = None, memo: dict | None = None,
                  memo_key: str | None = None, split_hot_keys: bool | None = None,
                  hot_share: float = 0.01, hot_limit: int | None = None,
                  bound_by: DataFrame | None = None) -> DataFrame:
    """Join each fact to the versions of its key valid on the fact's date.

    Equality on the key plus ``valid_from <= date <= valid_to`` (both ends
    inclusive).  Overlapping versions fan out; facts with no valid version keep
    NULLs on a left join.  The key equality stays the hash/sort key and the
    interval is a residual condition, so the join never degenerates into a
    range or nested-loop join.

    The versions side is broadcast only when its measured size is under
    ``limit``.  Otherwise both sides are shuffled on the key; adaptive
    execution splits a skewed key partition at run time, and with
    ``split_hot_keys`` keys holding more than ``hot_share`` of the facts are
    split off up front: their facts join a broadcast of their (size-checked)
    versions without any shuffle, and only the remaining keys are shuffled.
    """
    if split_hot_keys is None:
        split_hot_keys = facts.sparkSession.conf.get(_SPLIT_CONF, "false").lower() == "true"
    side, size = checked_broadcast(versions, limit, memo=memo, memo_key=memo_key, bound_by=bound_by)
    if size.broadcast:
        return facts.join(side, _interval(facts, side, fact_key, version_key, fact_date, valid_from, valid_to), how)
    salted = facts.withColumn("_key", salted_key(facts, fact_key))
    plain = salted.join(side, _interval(salted, side, "_key", version_key, fact_date, valid_from, valid_to),
                        how).drop("_key")
    if not split_hot_keys or how not in ("left", "inner"):
        return plain
    hot = hot_keys(facts, fact_key, hot_share)
    if not hot:
        return plain
    hot_versions = versions.where(F.col(version_key).isin(hot))
    hv_side, hv_size = checked_broadcast(hot_versions, hot_limit)
    if not hv_size.broadcast:
        return plain
    is_hot = F.col(fact_key).isin(hot)
    hot_facts = facts.where(is_hot)
    cold_facts = facts.where(~is_hot | F.col(fact_key).isNull())
    cold_versions = versions.where(~F.col(version_key).isin(hot) | F.col(version_key).isNull())
    hot_part = hot_facts.join(hv_side, _interval(hot_facts, hv_side, fact_key, version_key, fact_date,
                                                 valid_from, valid_to), how)
    cold_part = cold_facts.join(cold_versions, _interval(cold_facts, cold_versions, fact_key, version_key,
                                                         fact_date, valid_from, valid_to), how)
    return hot_part.unionByName(cold_part)


def interval_lists(versions: DataFrame, version_key: str, valid_from: str = "valid_from",
                   valid_to: str = "valid_to") -> DataFrame:
    """One row per key: ``_versions``, its versions in order of their interval.

    A list holds one key's versions (of a postcode, a handful); the key must be
    one whose versions fit a row, whatever the number of facts that ask for it.
    """
    rest = [c for c in versions.columns if c not in (version_key, valid_from, valid_to)]
    return (versions.where(F.col(version_key).isNotNull()).groupBy(version_key)
            .agg(F.array_sort(F.collect_list(F.struct(valid_from, valid_to, *rest))).alias("_versions")))


def interval_list_join(facts: DataFrame, lists: DataFrame, fact_key: str, version_key: str, fact_date: str,
                       valid_from: str = "valid_from", valid_to: str = "valid_to", how: str = "left") -> DataFrame:
    """``validity_join`` over ``interval_lists``.

    Each fact meets at most one row, so no key fans out in the join, however hot
    it is; the versions valid on the fact's date unfold from the list afterwards.
    """
    joined = facts.join(lists, F.col(fact_key) == F.col(version_key), "left" if how == "left" else "inner")
    valid = F.filter("_versions", lambda v: (v[valid_from] <= F.col(fact_date)) & (F.col(fact_date) <= v[valid_to]))
    unfold = F.explode_outer if how == "left" else F.explode
    names = lists.schema["_versions"].dataType.elementType.names
    return (joined.select(*facts.columns, version_key, unfold(valid).alias("_version"))
            .select(*facts.columns, F.when(F.col("_version").isNotNull(), F.col(version_key)).alias(version_key),
                    *[F.col(f"_version.{n}").alias(n) for n in names]))


def unresolved_count(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """How many ``rows`` find no ``lookup`` row on ``key`` (NULL keys never do).

    The lookup keys are de-duplicated first (one row per key), then broadcast
    under the size check, so the rows side is not shuffled.
    """
    keys = lookup.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_hit", F.lit(True))
    side, _ = checked_broadcast(keys)
    flagged = rows.select(key).join(side, key, "left")
    return flagged.agg(F.count(F.lit(1)).alias("postcodes"),
                       F.count_if(F.col("_hit").isNull()).alias("unmatched_postcodes"))
