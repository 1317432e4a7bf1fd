"""Reporting mart and the declared example queries over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions import mean, round_half_up
from terrace.operators.joins import checked_broadcast, validity_join
from terrace.plans import gold
from terrace.plans.gold import DATE_SPINE_ROWS


def _date_side(dim_date: DataFrame, *cols: str | Column) -> DataFrame:
    """The calendar is bounded by construction (a fixed spine): broadcast it."""
    side, _ = checked_broadcast(dim_date.select(*cols), bounded_rows=DATE_SPINE_ROWS)
    return side


# Superset projections measured once per set of tables: every side the
# reports broadcast is a projection (and possibly a filter) of one of them.
GEO_BOUND_COLUMNS = ["normalized_postcode", "geography_key", "valid_from", "valid_to", "urban_rural_flag",
                     "lad_code", "ruc21nm", "imd_score", "crime_score", "education_score"]
PROPERTY_BOUND_COLUMNS = ["property_key", "property_type_desc", "tenure_desc", "new_build"]


def geo_bound(dim_geo: DataFrame) -> DataFrame:
    return dim_geo.select(*[c for c in GEO_BOUND_COLUMNS if c in dim_geo.columns])


def property_bound(dim_prop: DataFrame) -> DataFrame:
    return dim_prop.select(*[c for c in PROPERTY_BOUND_COLUMNS if c in dim_prop.columns])


def _year_key_range(year_from: int, year_to: int) -> Column:
    """Date-key range implied by a year range (keys are YYYYMMDD), so a year
    filter on the calendar also prunes the fact scan (Parquet statistics)."""
    return F.col("date_key").between(year_from * 10000 + 101, year_to * 10000 + 1231)


def _sold_in(fact: DataFrame, dim_date: DataFrame, year: int, *cols: str) -> DataFrame:
    """Sales of ``year`` with their ``date_key`` and ``full_date``.

    A fact table in folders by year also joins the folder to the calendar's
    year, so Spark prunes the folders by the filtered calendar at run time;
    any other is pruned by the range of its date keys.
    """
    days = dim_date.where(F.col("full_date").between(F.make_date(F.lit(year), F.lit(1), F.lit(1)),
                                                     F.make_date(F.lit(year), F.lit(12), F.lit(31))))
    if gold.YEAR_FOLDER in fact.columns:
        d = _date_side(days, "date_key", "full_date", F.col("year").alias(gold.YEAR_FOLDER))
        return fact.select(*cols, "date_key", gold.YEAR_FOLDER).join(d, ["date_key", gold.YEAR_FOLDER]).drop(gold.YEAR_FOLDER)
    d = _date_side(days, "date_key", "full_date")
    return fact.where(_year_key_range(year, year)).select(*cols, "date_key").join(d, "date_key")


def mart_rural_urban(fact: DataFrame, dim_date: DataFrame, dim_geo: DataFrame,
                     dim_prop: DataFrame, memo: dict | None = None) -> DataFrame:
    """Sales by year, rural/urban class, property type and new-build flag.

    fact -> calendar (broadcast, bounded), -> postcode version valid on the
    sale date (size-checked broadcast, else shuffle on postcode), -> property
    (size-checked broadcast); then a partial + final hash aggregate over
    roughly a thousand groups.  Facts without a calendar day or postcode
    version keep NULL group keys, and overlapping versions count twice, as in
    the source warehouse.
    """
    f = fact.select("transaction_id", "price", "date_key", "normalized_postcode", "property_key")
    fd = f.join(_date_side(dim_date, "date_key", "year", "full_date"), "date_key", "left")
    g = dim_geo.select(
        F.col("normalized_postcode").alias("g_postcode"), "valid_from", "valid_to",
        "urban_rural_flag", "imd_score", "crime_score", "education_score")
    fdg = validity_join(fd, g, "normalized_postcode", "g_postcode", "full_date", how="left",
                        memo=memo, memo_key="geo", bound_by=geo_bound(dim_geo))
    p, _ = checked_broadcast(dim_prop.select(
        F.col("property_key").alias("p_key"), "property_type_desc", "new_build"),
        memo=memo, memo_key="property", bound_by=property_bound(dim_prop))
    j = fdg.join(p, fdg["property_key"] == p["p_key"], "left")
    return j.groupBy(
        F.col("year").alias("sale_year"),
        "urban_rural_flag",
        F.col("property_type_desc").alias("property_type"),
        "new_build",
    ).agg(
        F.count("transaction_id").alias("total_transactions"),
        F.sum("price").alias("total_sales_volume"),
        mean("price").alias("average_price"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        mean("imd_score").alias("avg_imd_score"),
        mean("crime_score").alias("avg_crime_score"),
        mean("education_score").alias("avg_education_score"),
    )


def avg_price_by_year(mart: DataFrame, year_from: int, year_to: int) -> DataFrame:
    """Average price (rounded to pounds) by class and type per year."""
    return (mart
            .where(F.col("sale_year").between(year_from, year_to) & F.col("urban_rural_flag").isNotNull())
            .select("sale_year", "urban_rural_flag", "property_type",
                    round_half_up("average_price", 0).alias("avg_price_gbp"), "total_transactions")
            .orderBy(F.asc_nulls_last("sale_year"), F.asc_nulls_last("urban_rural_flag"),
                     F.asc_nulls_last("property_type")))


def top_deprived_areas(fact: DataFrame, dim_geo: DataFrame, dim_date: DataFrame, year: int,
                       max_decile: int = 2, k: int = 10, memo: dict | None = None) -> DataFrame:
    """Top-k districts/classes by mean deprivation score among the most
    deprived postcodes, for sales in ``year`` (inner validity join)."""
    fd = _sold_in(fact, dim_date, year, "transaction_id", "price", "normalized_postcode")
    g = dim_geo.where(F.col("imd_decile") <= max_decile).select(
        F.col("normalized_postcode").alias("g_postcode"), "valid_from", "valid_to",
        "lad_code", "ruc21nm", "imd_score")
    j = validity_join(fd, g, "normalized_postcode", "g_postcode", "full_date", how="inner",
                      memo=memo, memo_key="geo", bound_by=geo_bound(dim_geo))
    agg = j.groupBy("lad_code", "ruc21nm").agg(
        round_half_up(mean("imd_score"), 2).alias("avg_imd_score"),
        round_half_up(mean("price"), 0).alias("avg_sale_price_gbp"),
        F.count("transaction_id").alias("num_transactions"))
    # Group keys break ties so the top-k is the same in every engine.
    return agg.orderBy(F.desc_nulls_first("avg_imd_score"), F.asc_nulls_last("lad_code"),
                       F.asc_nulls_last("ruc21nm")).limit(k)


def detached_new_builds(fact: DataFrame, dim_date: DataFrame, dim_prop: DataFrame, year: int,
                        property_type_desc: str = "Detached", tenure_desc: str = "Freehold",
                        new_build: bool = True, k: int = 50, memo: dict | None = None) -> DataFrame:
    """Top-k sales by price of one property kind in ``year``."""
    fd = _sold_in(fact, dim_date, year, "transaction_id", "price", "property_key")
    p, _ = checked_broadcast(dim_prop.where(
        (F.col("property_type_desc") == property_type_desc) & (F.col("tenure_desc") == tenure_desc)
        & (F.col("new_build") == F.lit(new_build))).select(
        F.col("property_key").alias("p_key"), "property_type_desc", "tenure_desc"),
        memo=memo, memo_key="property", bound_by=property_bound(dim_prop))
    j = fd.join(p, F.col("property_key") == F.col("p_key"), "inner")
    return (j.select("transaction_id", "price", F.col("full_date").alias("sale_date"),
                     "property_type_desc", "tenure_desc")
             .orderBy(F.desc_nulls_first("price"), F.asc("transaction_id"))
             .limit(k))


def mart_since(mart: DataFrame, year_from: int, ordered: bool = True) -> DataFrame:
    """Mart rows from ``year_from`` on, average rounded to pounds."""
    out = (mart.where(F.col("sale_year") >= year_from)
               .select("sale_year", "urban_rural_flag", "property_type",
                       round_half_up("average_price", 0).alias("avg_price_gbp"), "total_transactions"))
    return out.orderBy(F.asc_nulls_last("sale_year"), F.asc_nulls_last("urban_rural_flag")) if ordered else out


def mart_group_mean(since: DataFrame) -> DataFrame:
    """Mean of the rounded average price per class and type.

    Mirrors a pandas ``groupby(...).mean()``: groups with a missing key are
    dropped and missing values are skipped.
    """
    return (since.where(F.col("urban_rural_flag").isNotNull() & F.col("property_type").isNotNull())
                 .groupBy("urban_rural_flag", "property_type")
                 .agg(F.avg("avg_price_gbp").alias("avg_price_gbp")))
