"""Incremental loads: high-water marks, keyed replacement, late rows.

The high-water mark is computed first (one scalar aggregation) and applied as
a literal filter, so it is pushed into the Parquet scan of the source.  The
keyed replacement joins the existing table only against the increment's keys;
when the increment is small (a monthly update) those keys are broadcast and
the existing table is never shuffled.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.operators.joins import checked_broadcast
from terrace.plans import gold, silver

DEFAULT_DATE_MARK = _dt.date(1900, 1, 1)
DEFAULT_TS_MARK = _dt.datetime(1900, 1, 1)


def high_water_mark(current: DataFrame | None, column: str, default):
    """``COALESCE(MAX(column), default)`` over the current table (NULL table -> default)."""
    if current is None:
        return default
    value = current.agg(F.max(column).alias("m")).first()["m"]
    return default if value is None else value


def past_mark(source: DataFrame, path: str, column: str, default) -> DataFrame:
    """Rows strictly past the newest ``column`` of the Parquet table at ``path``.

    The mark is a scalar subquery of the plan, not a round trip through the
    driver; with ``spark.sql.parquet.aggregatePushdown`` the maximum comes from
    the files' footers alone.
    """
    spark = source.sparkSession
    lists = spark.conf.get("spark.sql.sources.useV1SourceList")
    # Only the newer file reader answers aggregates from footers.
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in lists.split(",") if x != "parquet"))
    try:
        current = spark.read.parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", lists)
    mark = current.agg(F.max(column).alias("m")).scalar()
    return source.where(F.col(column) > F.coalesce(mark, F.lit(default)))


def newer_than(source: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly past the mark."""
    return source.where(F.col(column) > F.lit(mark))


def replace_by_key(current: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``current`` whose key is not in ``new``, plus all of ``new``."""
    keys, _ = checked_broadcast(new.select(key).distinct())
    kept = current.join(keys, key, "left_anti")
    return kept.unionByName(new.select(*current.columns))


def late_rows(source: DataFrame, current: DataFrame, column: str, mark, key: str) -> DataFrame:
    """Source rows at or before the mark whose key the table lacks: a strict
    ``>`` high-water filter never picks them up."""
    old = source.where(F.col(column) <= F.lit(mark))
    return old.join(current.select(key), key, "left_anti")


def incremental_silver(raw: DataFrame, current: DataFrame | None,
                       run_ts: _dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Silver sales load.  First run (no table): every raw row.  Later runs:
    raw rows with ``transfer_date`` past the table's newest date, replacing
    rows with the same ``transaction_id``.  Returns (new table, increment)."""
    if current is None:
        s = silver.silver_ppd(raw, run_ts)
        return s, s
    mark = high_water_mark(current, "transfer_date", DEFAULT_DATE_MARK)
    inc = silver.silver_ppd(newer_than(raw, "transfer_date", mark), run_ts)
    return replace_by_key(current, inc, "transaction_id"), inc


def incremental_fact(silver_now: DataFrame, current: DataFrame | None,
                     run_ts: _dt.datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Fact load from silver rows updated after the fact's newest silver
    timestamp, replacing facts with the same ``transaction_id``."""
    if current is None:
        f = gold.fact_sales(silver_now, run_ts)
        return f, f
    mark = high_water_mark(current, "silver_updated_at", DEFAULT_TS_MARK)
    inc = gold.fact_sales(newer_than(silver_now, "dbt_updated_at", mark), run_ts)
    return replace_by_key(current, inc, "transaction_id"), inc
