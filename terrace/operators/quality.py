"""Data-quality checks, contract metrics and the pass/fail gate.

Checks return either the failing rows (as the warehouse tests do) or one
summary row per check.  In the report all checks of one table that count rows
come from a single aggregation; only ``unique`` reads the table a second time,
for its (partially aggregated) shuffle on the key.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace.functions import ACCEPTED_PROPERTY_TYPES, pct

# Thresholds of the warehouse tests and contract metrics.
MIN_FACT_ROWS = 29_000_000
FRESHNESS_MAX_DAYS = 40
SOURCE_WARN_DAYS = 35
SOURCE_ERROR_DAYS = 40
M2_MIN_COMPLETENESS = 99.5

SUMMARY = T.StructType([
    T.StructField("model", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("failures", T.LongType()),
])


@dataclass(frozen=True)
class ColumnCheck:
    model: str
    column: str
    test: str          # not_null | accepted_values | unique
    severity: str = "error"
    values: tuple[str, ...] = ()


def _lit_row(model: str, column: str, test: str, severity: str, failures: Column) -> Column:
    return F.struct(F.lit(model).alias("model"), F.lit(column).alias("column_name"),
                    F.lit(test).alias("test"), F.lit(severity).alias("severity"),
                    failures.cast("long").alias("failures"))


def _one_pass(df: DataFrame, model: str, checks: list[ColumnCheck],
              singular: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Evaluate not_null and accepted_values checks of one table in one scan.

    accepted_values counts distinct offending non-null values (one failing
    row per value), not offending rows.  ``singular`` adds named aggregates
    that count failures themselves.  One aggregation computes every count;
    ``stack`` unfolds them into one summary row per check.
    """
    counts, rows = [], []
    for i, c in enumerate(checks):
        col = F.col(c.column)
        if c.test == "not_null":
            counts.append(F.count_if(col.isNull()).cast("long").alias(f"_f{i}"))
        elif c.test == "accepted_values":
            bad = F.when(col.isNotNull() & ~col.isin(*c.values), col)
            counts.append(F.count_distinct(bad).cast("long").alias(f"_f{i}"))
        else:
            raise ValueError(c.test)
        rows.append(", ".join([_text(model), _text(c.column), _text(c.test), _text(c.severity), f"`_f{i}`"]))
    for test, failures in singular or []:
        counts.append(failures.cast("long").alias(f"_f{len(rows)}"))
        rows.append(", ".join([_text(model), "''", _text(test), "'error'", f"`_f{len(rows)}`"]))
    stack = f"stack({len(rows)}, {', '.join(rows)}) AS (model, column_name, test, severity, failures)"
    return df.agg(*counts).select(F.expr(stack))


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Key values that occur more than once (NULL keys ignored)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
              .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def unique_summary(df: DataFrame, model: str, column: str, severity: str = "error") -> DataFrame:
    fails = unique_failures(df, column)
    return fails.agg(_lit_row(model, column, "unique", severity, F.count(F.lit(1))).alias("r")).select("r.*")


def not_null_summary(df: DataFrame, model: str, columns: list[tuple[str, str]]) -> DataFrame:
    return _one_pass(df, model, [ColumnCheck(model, c, "not_null", sev) for c, sev in columns])


def accepted_summary(df: DataFrame, model: str, column: str, values: list[str],
                     severity: str = "error") -> DataFrame:
    return _one_pass(df, model, [ColumnCheck(model, column, "accepted_values", severity, tuple(values))])


def price_failures(fact: DataFrame) -> DataFrame:
    """Sales whose price is missing or not positive."""
    return fact.where(F.col("price").isNull() | (F.col("price") <= 0)).select("transaction_id", "price")


def min_rows_failure(fact: DataFrame, threshold: int = MIN_FACT_ROWS) -> DataFrame:
    """One row ``failure_flag = 1`` when the table has fewer than ``threshold`` rows."""
    return (fact.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") < threshold)
                .select(F.lit(1).alias("failure_flag")))


def _newest_sale() -> Column:
    """Newest sale date as an aggregate: keys are YYYYMMDD, so the largest key
    is the newest day, whether or not the calendar reaches that far."""
    return F.to_date(F.max("date_key").cast("string"), "yyyyMMdd")


def _stale(as_of: _dt.date, max_days: int) -> Column:
    bound = F.date_sub(F.lit(as_of.isoformat()).cast("date"), max_days)
    return F.coalesce(_newest_sale() < bound, F.lit(False))


def freshness_failure(fact: DataFrame, as_of: _dt.date, max_days: int = FRESHNESS_MAX_DAYS) -> DataFrame:
    """One row when the newest sale is more than ``max_days`` before ``as_of``."""
    return fact.agg(_stale(as_of, max_days).alias("stale")).where("stale").select(F.lit(1).alias("failure_flag"))


def source_freshness(raw: DataFrame, snapshot_at: _dt.datetime, loaded_at: str = "_ingested_at",
                     warn_days: int = SOURCE_WARN_DAYS, error_days: int = SOURCE_ERROR_DAYS) -> DataFrame:
    """Age of the newest load: ``pass``, ``warn`` (> warn_days) or ``error`` (> error_days)."""
    snap = F.lit(snapshot_at).cast("timestamp")
    age = F.col("age_seconds")
    return (raw.agg(F.max(loaded_at).alias("max_loaded_at"))
               .select("max_loaded_at", snap.alias("snapshotted_at"),
                       (F.unix_timestamp(snap) - F.unix_timestamp("max_loaded_at")).alias("age_seconds"))
               .withColumn("status",
                           F.when(age.isNull(), F.lit("error"))
                            .when(age > error_days * 86400, F.lit("error"))
                            .when(age > warn_days * 86400, F.lit("warn"))
                            .otherwise(F.lit("pass"))))


# --- contract metrics --------------------------------------------------------

def _metric(df: DataFrame, metric_id: str, value: Column, passed) -> DataFrame:
    out = df.agg(value.cast("double").alias("metric_value"))
    return out.select(F.lit(metric_id).alias("metric_id"), "metric_value",
                      passed(F.col("metric_value")).alias("passed"))


def metric_uniqueness(fact: DataFrame) -> DataFrame:
    """M1: distinct transaction ids as % of rows (= 100)."""
    return _metric(fact, "M1", pct(F.count_distinct("transaction_id"), F.count(F.lit(1))),
                   lambda v: v == 100.0)


def metric_completeness(raw: DataFrame) -> DataFrame:
    """M2: rows with a non-empty postcode as % of rows (> 99.5)."""
    ok = F.count_if(F.col("postcode").isNotNull() & (F.col("postcode") != ""))
    return _metric(raw, "M2", pct(ok, F.count(F.lit(1))), lambda v: v > M2_MIN_COMPLETENESS)


def metric_validity(fact: DataFrame) -> DataFrame:
    """M3: rows with price > 0 as % of rows (= 100)."""
    return _metric(fact, "M3", pct(F.count_if(F.col("price") > 0), F.count(F.lit(1))),
                   lambda v: v == 100.0)


def metric_consistency(silver: DataFrame) -> DataFrame:
    """M4: rows with an accepted property type as % of rows (= 100)."""
    ok = F.count_if(F.col("property_type").isin(*ACCEPTED_PROPERTY_TYPES))
    return _metric(silver, "M4", pct(ok, F.count(F.lit(1))), lambda v: v == 100.0)


def metric_row_count(fact: DataFrame, threshold: int = MIN_FACT_ROWS) -> DataFrame:
    """M5: fact row count (> threshold)."""
    return _metric(fact, "M5", F.count(F.lit(1)), lambda v: v > threshold)


def metric_freshness(fact: DataFrame, as_of: _dt.date, max_days: int = FRESHNESS_MAX_DAYS) -> DataFrame:
    """M6: days from the newest sale to ``as_of`` (< max_days)."""
    return _metric(fact, "M6", F.datediff(F.lit(as_of.isoformat()).cast("date"), _newest_sale()),
                   lambda v: v < max_days)


# --- whole-warehouse run and gate -------------------------------------------

def quality_report(silver: DataFrame, fact: DataFrame, dim_date: DataFrame, mart: DataFrame,
                   as_of: _dt.date, min_rows: int = MIN_FACT_ROWS) -> DataFrame:
    """Every column test and singular test as (model, column, test, severity, failures)."""
    parts = [
        unique_summary(silver, "silver_ppd", "transaction_id"),
        _one_pass(silver, "silver_ppd", [
            ColumnCheck("silver_ppd", "transaction_id", "not_null"),
            ColumnCheck("silver_ppd", "raw_postcode", "not_null", "warn"),
            ColumnCheck("silver_ppd", "property_type", "accepted_values", "error",
                        tuple(ACCEPTED_PROPERTY_TYPES)),
        ]),
        unique_summary(fact, "fact_sales", "transaction_id"),
        _one_pass(fact, "fact_sales", [
            ColumnCheck("fact_sales", c, "not_null")
            for c in ("transaction_id", "location_key", "property_key", "date_key")
        ], [
            ("price_positive", F.count_if(F.col("price").isNull() | (F.col("price") <= 0))),
            ("min_row_count", (F.count(F.lit(1)) < min_rows).cast("int")),
            ("freshness", _stale(as_of, FRESHNESS_MAX_DAYS).cast("int")),
        ]),
        unique_summary(dim_date, "dim_date", "date_key"),
        not_null_summary(dim_date, "dim_date", [("date_key", "error")]),
        not_null_summary(mart, "mart_rural_urban_stats", [("sale_year", "error")]),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


class QualityGateError(RuntimeError):
    pass


def gate(report: DataFrame, max_failed: int = 0) -> list[dict]:
    """Raise when more than ``max_failed`` error-severity checks fail.

    The report has one row per check (a few dozen), so collecting it is bounded.
    """
    rows = [r.asDict() for r in report.collect()]
    failed = [r for r in rows if r["severity"] == "error" and (r["failures"] or 0) > 0]
    if len(failed) > max_failed:
        raise QualityGateError(f"{len(failed)} failing checks: {failed}")
    return rows
