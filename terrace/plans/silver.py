"""Silver layer: cleansed, typed, renamed copies of the bronze tables."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace import schemas
from terrace.functions import (
    is_present,
    month_end,
    month_start,
    normalize_postcode,
    version_key,
)


def _run_ts(run_ts: _dt.datetime | None):
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def silver_ppd(raw: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """Cleansed sales: normalised postcode plus a row-update timestamp.

    The incremental variant (rows newer than the current high-water mark,
    replacing rows with the same key) lives in ``terrace.operators.incremental``.
    """
    return raw.select(
        "transaction_id",
        "price",
        "transfer_date",
        F.col("postcode").alias("raw_postcode"),
        normalize_postcode("postcode", empty_for_null=True).alias("normalized_postcode"),
        "property_type",
        "new_build",
        "tenure",
        *schemas.ADDRESS_COLUMNS,
        "category_type",
        "record_status",
        _run_ts(run_ts).alias("dbt_updated_at"),
    )


def silver_onspd(raw: DataFrame) -> DataFrame:
    """Postcode directory as validity intervals (one row per postcode version).

    A missing introduction month means "valid since 1900-01-01"; a missing
    termination month means "valid until 2099-12-31"; a termination month is
    valid through its last day.
    """
    return raw.where(is_present("pcds")).select(
        version_key("pcds", "dointr").alias("onspd_key"),
        F.col("pcds").alias("raw_postcode"),
        normalize_postcode("pcds", empty_for_null=False).alias("normalized_postcode"),
        "lsoa21cd",
        "lsoa11cd",
        "msoa21cd",
        F.col("lad25cd").alias("lad_code"),
        F.col("lat").alias("latitude"),
        F.col("long").alias("longitude"),
        month_start("dointr").alias("valid_from"),
        month_end("doterm").alias("valid_to"),
    )


def _pick(raw: DataFrame, *names: str) -> str:
    """First of ``names`` present in ``raw`` (original header or snake form)."""
    lowered = {c.lower(): c for c in raw.columns}
    for name in names:
        if name in raw.columns:
            return name
        if name.lower() in lowered:
            return lowered[name.lower()]
    raise KeyError(f"none of {names} in {raw.columns}")


def silver_ruc(raw: DataFrame) -> DataFrame:
    """Rural/urban classification with trimmed text (codes kept as is)."""
    col = lambda n: F.col(f"`{_pick(raw, n)}`")
    return raw.select(
        col("LSOA21CD").alias("lsoa21cd"),
        F.trim(col("LSOA21NM")).alias("lsoa21nm"),
        F.trim(col("RUC21CD")).alias("ruc21cd"),
        F.trim(col("RUC21NM")).alias("ruc21nm"),
        F.trim(col("Urban_rural_flag")).alias("urban_rural_flag"),
    )


def silver_imd(raw: DataFrame) -> DataFrame:
    """Deprivation scores as DECIMAL(10,3) and deciles as INTEGER.

    A malformed number fails the job (ANSI cast), as the source warehouse does.
    """
    cols = [F.col(f"`{_pick(raw, orig, snake)}`").alias(name)
            for name, orig, snake in schemas.IMD_ID_COLUMNS]
    for prefix, score_orig, decile_orig, score_snake, decile_snake in schemas.IMD_DOMAINS:
        cols.append(F.col(f"`{_pick(raw, score_orig, score_snake)}`").cast("decimal(10,3)")
                    .alias(f"{prefix}_score"))
        cols.append(F.col(f"`{_pick(raw, decile_orig, decile_snake)}`").cast("int")
                    .alias(f"{prefix}_decile"))
    return raw.select(*cols)
