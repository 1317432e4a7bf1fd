"""Gold layer: star-schema dimensions and the sales fact."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.functions import (
    CATEGORY_TYPE_DESC,
    PROPERTY_TYPE_DESC,
    TENURE_DESC,
    date_key,
    day_name,
    describe,
    iso_day_of_week,
    is_weekend,
    md5_key,
    month_name,
)

# First and last day of the calendar dimension.
DATE_SPINE_START = "1990-01-01"
DATE_SPINE_END = "2030-12-31"
# Rows in that spine (inclusive), the proven bound used to broadcast it.
DATE_SPINE_ROWS = (_dt.date(2030, 12, 31) - _dt.date(1990, 1, 1)).days + 1

GEOGRAPHY_COLUMNS = [
    "geography_key", "normalized_postcode", "raw_postcode", "valid_from", "valid_to",
    "lsoa21cd", "lsoa11cd", "msoa21cd", "lad_code",
    "ruc21cd", "ruc21nm", "urban_rural_flag",
    *[f"{p}_{k}" for p, *_ in schemas.IMD_DOMAINS for k in ("score", "decile")],
    "latitude", "longitude",
]


def dim_geography(onspd: DataFrame, ruc: DataFrame, imd: DataFrame) -> DataFrame:
    """Postcode versions enriched with rural/urban class (2021 areas) and
    deprivation scores (2011 areas); both lookups are left joins.

    The two lookups are keyed by small-area code (one row per area, a few
    tens of thousands nationally).  Each is broadcast after its measured size
    passes the check, so the postcode side is never shuffled for them;
    otherwise they are joined by shuffle on the area code.
    """
    from terrace.operators.joins import checked_broadcast
    o = onspd.alias("o")
    r = checked_broadcast(ruc)[0].alias("r")
    i = checked_broadcast(imd)[0].alias("i")
    j = (o.join(r, F.col("o.lsoa21cd") == F.col("r.lsoa21cd"), "left")
          .join(i, F.col("o.lsoa11cd") == F.col("i.lsoa11cd"), "left"))
    cols = [F.col("o.onspd_key").alias("geography_key")]
    for name in GEOGRAPHY_COLUMNS[1:]:
        if name in ("ruc21cd", "ruc21nm", "urban_rural_flag"):
            cols.append(F.col(f"r.{name}"))
        elif name.endswith("_score") or name.endswith("_decile"):
            cols.append(F.col(f"i.{name}"))
        else:
            cols.append(F.col(f"o.{name}"))
    return j.select(*cols)


# The folder column of a fact table written by year of sale.
YEAR_FOLDER = "sale_year_folder"


def write_by_year(fact: DataFrame, path: str) -> DataFrame:
    """``fact`` written to ``path`` in one folder per year of sale, and read back.

    A year is dealt over tasks by its keys' hash, so that a year that holds a
    third of the rows is no single task's.
    """
    year = F.floor(F.col("date_key") / 10000).cast("int")
    (fact.withColumn(YEAR_FOLDER, year)
     .repartition(F.col(YEAR_FOLDER), F.pmod(F.xxhash64("transaction_id"), F.lit(16)))
     .write.partitionBy(YEAR_FOLDER).parquet(path))
    return fact.sparkSession.read.parquet(path)


def property_key():
    """MD5 key of the four property attributes (dimension and fact agree)."""
    return md5_key(*schemas.PROPERTY_COLUMNS)


def location_key():
    """MD5 key of the seven address parts (dimension and fact agree)."""
    return md5_key(*schemas.ADDRESS_COLUMNS)


def dim_property(silver: DataFrame) -> DataFrame:
    """Distinct property attribute combinations with a hashed key and labels."""
    return property_rows(silver.select(*schemas.PROPERTY_COLUMNS).distinct())


def property_rows(u: DataFrame) -> DataFrame:
    """Dimension rows from distinct property attribute combinations."""
    return u.select(
        property_key().alias("property_key"),
        "property_type",
        describe("property_type", PROPERTY_TYPE_DESC).alias("property_type_desc"),
        "new_build",
        "tenure",
        describe("tenure", TENURE_DESC).alias("tenure_desc"),
        "category_type",
        describe("category_type", CATEGORY_TYPE_DESC).alias("category_type_desc"),
    )


def dim_location(silver: DataFrame) -> DataFrame:
    """Distinct addresses with a hashed key."""
    return location_rows(silver.select(*schemas.ADDRESS_COLUMNS).distinct())


def location_rows(u: DataFrame) -> DataFrame:
    """Dimension rows from distinct addresses."""
    return u.select(location_key().alias("location_key"), *schemas.ADDRESS_COLUMNS)


def dim_date(spark: SparkSession, pad_names: bool = False) -> DataFrame:
    """Daily calendar 1990-01-01 .. 2030-12-31 (14,975 rows)."""
    spine = spark.range(1).select(F.explode(F.sequence(
        F.lit(DATE_SPINE_START).cast("date"), F.lit(DATE_SPINE_END).cast("date"),
        F.expr("INTERVAL 1 DAY"))).alias("d"))
    d = F.col("d")
    return spine.select(
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_name(d, pad_names).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("day_of_week"),
        day_name(d, pad_names).alias("day_name"),
        is_weekend(d).alias("is_weekend"),
    )


def fact_sales(silver: DataFrame, run_ts: _dt.datetime | None = None) -> DataFrame:
    """One row per sale: price, date key, postcode and dimension keys.

    The incremental variant lives in ``terrace.operators.incremental``.
    """
    ts = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return silver.select(
        "transaction_id",
        "price",
        date_key("transfer_date").alias("date_key"),
        "normalized_postcode",
        property_key().alias("property_key"),
        location_key().alias("location_key"),
        F.col("dbt_updated_at").alias("silver_updated_at"),
        ts.alias("gold_updated_at"),
    )
