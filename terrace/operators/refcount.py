"""Distinct dimensions maintained from reference counts.

A distinct dimension (addresses, property attribute combinations) equals the
set of attribute combinations with at least one row in silver.  Keeping, per
combination, the number of silver rows that carry it lets an incremental run
update the dimension from the run's delta alone: add the counts of the
incoming rows, subtract the counts of the rows they replace, keep positive
counts.  The result is exactly the full rebuild, without rescanning silver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COUNT = "_rows"


def counts(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Rows per attribute combination (partial aggregation before the shuffle)."""
    return rows.groupBy(*cols).agg(F.count(F.lit(1)).alias(COUNT))


def apply_delta(current: DataFrame, added: DataFrame, removed: DataFrame, cols: list[str]) -> DataFrame:
    """New counts = current + counts(added) - counts(removed), positive only.

    Attribute columns may be NULL, so combinations are matched null-safely
    (still an equi-join on every column, no nested loop).  In a matched pair
    both sides are equal, so coalescing them yields the combination.
    """
    delta = counts(added, cols).unionByName(
        counts(removed, cols).withColumn(COUNT, -F.col(COUNT)))
    delta = delta.groupBy(*cols).agg(F.sum(COUNT).alias("_d"))
    d = delta.select(*[F.col(c).alias(f"_d_{c}") for c in cols], "_d")
    cond: Column = reduce(lambda a, b: a & b, [current[c].eqNullSafe(d[f"_d_{c}"]) for c in cols])
    j = current.join(d, cond, "full_outer")
    return j.select(
        *[F.coalesce(F.col(c), F.col(f"_d_{c}")).alias(c) for c in cols],
        (F.coalesce(F.col(COUNT), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0))).alias(COUNT),
    ).where(F.col(COUNT) > 0)
