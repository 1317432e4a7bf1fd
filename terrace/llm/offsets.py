"""Running sums over all rows of a group, without one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024


def with_offsets(rows: DataFrame, group: Sequence[str], size: str, order: Sequence[str],
                 name: str = "start", buckets: int = BUCKETS) -> DataFrame:
    """``rows`` with ``name``: the sum of ``size`` over the rows before it in its group.

    The order within a group is that of a hash bucket of ``order``, then of
    ``order``.  Sums run within (group, bucket), which splits a hot group over
    ``buckets`` tasks, and the buckets' totals (at most ``buckets`` rows a
    group) give each bucket's beginning.  Rows that agree in all of ``order``
    take their places in any order.  ``group`` columns must not be null.
    """
    keyed = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    key = [*group, "_bucket"]
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = (keyed.groupBy(*key).agg(F.sum(size).alias("_total"))
            .withColumn("_base", F.coalesce(F.sum("_total").over(before), F.lit(0))).drop("_total"))
    within = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (keyed.withColumn("_within", F.coalesce(F.sum(size).over(within), F.lit(0)))
            .join(base, key)
            .withColumn(name, (F.col("_base") + F.col("_within")).cast("long"))
            .drop("_bucket", "_base", "_within"))
