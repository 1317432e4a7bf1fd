"""Bronze inputs derived from the driver's TPC-H-style tables.

The derivation is deterministic and row-for-row reproducible in any SQL
engine (see ``terrace.oracles``), so every layer built on top of it can be
checked against an independent implementation.  All of it is ordinary
DataFrame work: joins of ``orders`` to its customer/nation/region, and
projections of ``customer`` for the postcode, rural/urban and deprivation
reference tables.  Their sizes grow with the input tables.
"""

from __future__ import annotations

import datetime as _dt
import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators.joins import checked_broadcast

# Fixed load timestamp of the fixtures, so results are repeatable.
FIXTURE_INGESTED_AT = _dt.datetime(2026, 1, 25, 6, 0, 0)
# Nations of the TPC-H schema (fixed by its specification).
NATIONS = 25
# Small areas: customers per 2021 area, per 2011 area and per middle area.
# Area counts therefore grow with the customer table.
PER_AREA_2021 = 10
PER_AREA_2011 = 12
PER_AREA_MIDDLE = 50
# Reference rows are one per area; areas with number % 10 == 9 (2021) or
# number % 7 == 3 (2011) get a code that no postcode carries, as do the
# directory's postcodes of customers with key % 20 == 0, so some rows on
# either side of a lookup stay unmatched.


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _s(col: Column) -> Column:
    return col.cast("string")


def _area(prefix: str, num: Column) -> Column:
    return F.concat(F.lit(prefix), F.lpad(_s(num), 6, "0"))


def _div(col: Column, n: int) -> Column:
    """Integer division of a non-negative key."""
    return (col / n).cast("bigint")


def raw_ppd(spark: SparkSession, sf_dir: str, ingested_at: _dt.datetime = FIXTURE_INGESTED_AT,
            source_mode: str = "full") -> DataFrame:
    """``raw.ppd``: one sale per order, address from the ordering customer."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation/region have 25 and 5 rows whatever the scale: broadcast is bounded.
    geo, _ = checked_broadcast(n.join(r, n.n_regionkey == r.r_regionkey).select("n_nationkey", "n_name", "r_name"),
                               bounded_rows=NATIONS)
    cust = c.join(geo, c.c_nationkey == geo.n_nationkey).select(
        "c_custkey", "c_mktsegment", "n_name", "r_name")
    # No hint: Spark broadcasts the customers while they are small and shuffles
    # both sides on the key beyond that, so planning runs no job.
    j = o.join(cust, o.o_custkey == cust.c_custkey)
    k = F.col("o_orderkey")
    ck = F.col("o_custkey")
    return j.select(
        _s(k).alias("transaction_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.col("o_orderdate").cast("date").alias("transfer_date"),
        F.when(k % 500 == 0, F.lit(None).cast("string"))
         .when(k % 500 == 1, F.lit(""))
         .otherwise(F.concat(F.lit("ab"), _s(ck), F.lit(" 1xy"))).alias("postcode"),
        F.substring(F.lit("DSTFO"), (k % 5).cast("int") + 1, 1).alias("property_type"),
        (k % 7 == 0).alias("new_build"),
        F.when(k % 211 == 0, F.lit(None).cast("string"))
         .when(k % 2 == 0, F.lit("F")).otherwise(F.lit("L")).alias("tenure"),
        _s(ck % 90).alias("paon"),
        F.when(k % 4 == 0, F.concat(F.lit("FLAT "), _s(k % 9))).alias("saon"),
        F.concat(F.lit("STREET "), _s(ck % 50)).alias("street"),
        F.lit(None).cast("string").alias("locality"),
        F.col("n_name").alias("town"),
        F.col("c_mktsegment").alias("district"),
        F.col("r_name").alias("county"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("B")).otherwise(F.lit("A")).alias("category_type"),
        F.when(F.col("o_orderstatus") == "O", F.lit("A"))
         .when(F.col("o_orderstatus") == "F", F.lit("C"))
         .when(F.col("o_orderstatus") == "P", F.lit("D")).alias("record_status"),
        F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
        F.lit(source_mode).alias("_source_mode"),
    )


def raw_onspd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.onspd``: one postcode per customer (one in twenty that no sale has), a
    re-introduced second version for one in eight (some overlapping), and a
    blank-postcode row that the silver model must drop."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ck = F.col("c_custkey")
    common = [
        F.concat(F.when(ck % 20 == 0, F.lit("QQ")).otherwise(F.lit("AB")), _s(ck), F.lit(" 1XY")).alias("pcds"),
        _area("E01", _div(ck, PER_AREA_2021)).alias("lsoa21cd"),
        _area("E11", _div(ck, PER_AREA_2011)).alias("lsoa11cd"),
        _area("E02", _div(ck, PER_AREA_MIDDLE)).alias("msoa21cd"),
        F.concat(F.lit("L"), _s(F.col("c_nationkey"))).alias("lad25cd"),
        (F.lit(50.0) + (ck % 100) / F.lit(10.0)).alias("lat"),
        (F.lit(-1.0) * (ck % 50) / F.lit(10.0)).alias("long"),
    ]
    first = c.select(
        *common,
        F.when(ck % 3 == 0, F.lit(""))
         .when(ck % 3 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("1996"), F.lpad(_s(ck % 12 + 1), 2, "0"))).alias("dointr"),
        F.when(ck % 4 == 0, F.lit("199806")).alias("doterm"),
    )
    second = c.where(ck % 8 == 0).select(
        *common,
        F.when(ck % 40 == 8, F.lit("199801")).otherwise(F.lit("199807")).alias("dointr"),
        F.lit("").alias("doterm"),
    )
    # One blank-postcode row (a global aggregate always yields one row).
    blank = c.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("").alias("pcds"),
        *[F.lit(None).cast("string").alias(n) for n in ("lsoa21cd", "lsoa11cd", "msoa21cd", "lad25cd")],
        F.lit(None).cast("double").alias("lat"), F.lit(None).cast("double").alias("long"),
        F.lit(None).cast("string").alias("dointr"), F.lit(None).cast("string").alias("doterm"),
    )
    cols = ["pcds", "dointr", "doterm", "lsoa21cd", "lsoa11cd", "msoa21cd", "lad25cd", "lat", "long"]
    return first.select(cols).unionByName(second.select(cols)).unionByName(blank.select(cols))


def raw_ruc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.ruc_lsoa_2021``, one row per 2021 area of all customers (original
    file headers, padded text)."""
    c = (table(spark, sf_dir, "customer").groupBy(_div(F.col("c_custkey"), PER_AREA_2021).alias("area"))
         .agg(F.min("c_name").alias("c_name")))
    area = F.col("area")
    rural = area % 4 == 0
    return c.select(
        F.when(area % 10 == 9, _area("X01", area)).otherwise(_area("E01", area)).alias("LSOA21CD"),
        F.concat(F.col("c_name"), F.lit(" ")).alias("LSOA21NM"),
        F.lit(None).cast("string").alias("LSOA21NMW"),
        F.concat(F.when(rural, F.lit("R")).otherwise(F.lit("U")), _s(area % 3), F.lit(" ")).alias("RUC21CD"),
        F.when(rural, F.lit(" Rural town")).otherwise(F.lit(" Urban city")).alias("RUC21NM"),
        F.when(rural, F.lit("Rural ")).otherwise(F.lit("Urban ")).alias("Urban_rural_flag"),
        area.cast("int").alias("ObjectId"),
    )


def raw_imd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``raw.imd``, one row per 2011 area of all customers in the all-text,
    snake-header bootstrap form."""
    c = (table(spark, sf_dir, "customer").groupBy(_div(F.col("c_custkey"), PER_AREA_2011).alias("area"))
         .agg(F.min("c_name").alias("c_name"), F.min("c_mktsegment").alias("c_mktsegment")))
    area = F.col("area")
    cols = [
        F.when(area % 7 == 3, _area("X11", area)).otherwise(_area("E11", area)).alias("lsoa_code_2011"),
        F.col("c_name").alias("lsoa_name_2011"),
        F.col("c_mktsegment").alias("local_authority_district_name_2019"),
    ]
    for i, (_, _, _, score_snake, decile_snake) in enumerate(schemas.IMD_DOMAINS):
        score = ((area * (i + 3)) % 1000) / F.lit(7.0)
        cols.append(_s(score.cast("decimal(12,5)")).alias(score_snake))
        cols.append(_s((area * (i + 1)) % 10 + 1).alias(decile_snake))
    return c.select(*cols)


def dirty(raw: DataFrame) -> DataFrame:
    """Sales with every kind of fault that the checks look for: missing, zero
    and negative prices, unknown and missing types, missing dates, dates past
    the calendar, and repeated transactions."""
    k = F.col("transaction_id").cast("bigint")
    price = F.col("price")
    faults = {
        "price": F.when(k % 97 == 0, F.lit(None)).when(k % 97 == 1, F.lit(0)).when(k % 97 == 2, -price)
                  .otherwise(price).cast("decimal(12,2)"),
        "property_type": F.when(k % 89 == 0, F.lit("X")).when(k % 89 == 1, F.lit("?"))
                          .when(k % 89 == 2, F.lit(None)).otherwise(F.col("property_type")),
        "transfer_date": F.when(k % 83 == 0, F.lit(None)).when(k % 83 == 1, F.lit("2035-06-01").cast("date"))
                          .otherwise(F.col("transfer_date")),
    }
    out = raw.select(*[faults[c].alias(c) if c in faults else F.col(c) for c in raw.columns])
    return out.unionByName(out.where(k % 79 == 0))


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All four bronze tables."""
    return {
        "ppd": raw_ppd(spark, sf_dir),
        "onspd": raw_onspd(spark, sf_dir),
        "ruc_lsoa_2021": raw_ruc(spark, sf_dir),
        "imd": raw_imd(spark, sf_dir),
    }
