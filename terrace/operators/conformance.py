"""Contract conformance: declared column types versus a DataFrame.

Schema level: each declared column present, with a compatible type.  Data
level (one aggregation over the whole table): rows whose value would not fit
the declared type, e.g. a price with pence in a column declared INTEGER.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared column types of the data contract, per dataset.
_TEXT, _INT, _BIG, _NUM, _DATE, _TS, _BOOL = "TEXT", "INTEGER", "BIGINT", "NUMERIC", "DATE", "TIMESTAMP", "BOOLEAN"
CONTRACT: dict[str, list[tuple[str, str]]] = {
    "raw.ppd": [("transaction_id", _TEXT), ("price", _INT), ("transfer_date", _DATE), ("postcode", _TEXT),
                ("property_type", _TEXT), ("new_build", _BOOL), ("tenure", _TEXT), ("paon", _TEXT),
                ("saon", _TEXT), ("street", _TEXT), ("locality", _TEXT), ("town", _TEXT),
                ("district", _TEXT), ("county", _TEXT), ("category_type", _TEXT),
                ("record_status", _TEXT), ("_ingested_at", _TS)],
    "silver.silver_ppd": [("transaction_id", _TEXT), ("price", _INT), ("transfer_date", _DATE),
                          ("raw_postcode", _TEXT), ("normalized_postcode", _TEXT), ("property_type", _TEXT),
                          ("new_build", _BOOL), ("tenure", _TEXT), ("paon", _TEXT), ("saon", _TEXT),
                          ("street", _TEXT), ("locality", _TEXT), ("town", _TEXT), ("district", _TEXT),
                          ("county", _TEXT), ("category_type", _TEXT), ("record_status", _TEXT),
                          ("dbt_updated_at", _TS)],
    "gold.fact_sales": [("transaction_id", _TEXT), ("price", _INT), ("date_key", _INT),
                        ("normalized_postcode", _TEXT), ("property_key", _TEXT), ("location_key", _TEXT),
                        ("silver_updated_at", _TS), ("gold_updated_at", _TS)],
    "gold.dim_date": [("date_key", _INT), ("full_date", _DATE), ("year", _INT), ("quarter", _INT),
                      ("month", _INT), ("month_name", _TEXT), ("day_of_month", _INT), ("day_of_week", _INT),
                      ("day_name", _TEXT), ("is_weekend", _BOOL)],
    "gold.dim_property": [("property_key", _TEXT), ("property_type", _TEXT), ("property_type_desc", _TEXT),
                          ("new_build", _BOOL), ("tenure", _TEXT), ("tenure_desc", _TEXT),
                          ("category_type", _TEXT), ("category_type_desc", _TEXT)],
    "gold.dim_location": [("location_key", _TEXT), ("paon", _TEXT), ("saon", _TEXT), ("street", _TEXT),
                          ("locality", _TEXT), ("town", _TEXT), ("district", _TEXT), ("county", _TEXT)],
    "gold.dim_geography": [("geography_key", _TEXT), ("normalized_postcode", _TEXT), ("raw_postcode", _TEXT),
                           ("valid_from", _DATE), ("valid_to", _DATE), ("lsoa21cd", _TEXT),
                           ("lsoa11cd", _TEXT), ("msoa21cd", _TEXT), ("lad_code", _TEXT),
                           ("ruc21cd", _TEXT), ("ruc21nm", _TEXT), ("urban_rural_flag", _TEXT),
                           ("imd_score", _NUM), ("imd_decile", _INT), ("income_score", _NUM),
                           ("income_decile", _INT), ("employment_score", _NUM), ("employment_decile", _INT),
                           ("education_score", _NUM), ("education_decile", _INT), ("health_score", _NUM),
                           ("health_decile", _INT), ("crime_score", _NUM), ("crime_decile", _INT),
                           ("housing_barriers_score", _NUM), ("housing_barriers_decile", _INT),
                           ("living_environment_score", _NUM), ("living_environment_decile", _INT),
                           ("latitude", _NUM), ("longitude", _NUM)],
    "gold.mart_rural_urban_stats": [("sale_year", _INT), ("urban_rural_flag", _TEXT),
                                    ("property_type", _TEXT), ("new_build", _BOOL),
                                    ("total_transactions", _INT), ("total_sales_volume", _BIG),
                                    ("average_price", _NUM), ("min_price", _INT), ("max_price", _INT),
                                    ("avg_imd_score", _NUM), ("avg_crime_score", _NUM),
                                    ("avg_education_score", _NUM)],
}

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMERIC = _INTEGRAL + (T.DecimalType, T.DoubleType, T.FloatType)


def type_compatible(declared: str, actual: T.DataType) -> bool:
    if declared == _TEXT:
        return isinstance(actual, T.StringType)
    if declared == _INT:
        return isinstance(actual, (T.ByteType, T.ShortType, T.IntegerType))
    if declared == _BIG:
        return isinstance(actual, _INTEGRAL)
    if declared == _NUM:
        return isinstance(actual, _NUMERIC)
    if declared == _DATE:
        return isinstance(actual, T.DateType)
    if declared == _TS:
        return isinstance(actual, (T.TimestampType, T.TimestampNTZType))
    if declared == _BOOL:
        return isinstance(actual, T.BooleanType)
    return False


def _misfit(declared: str, col: Column, actual: T.DataType) -> Column:
    """Rows whose non-null value cannot be held by the declared type."""
    if declared in (_INT, _BIG) and isinstance(actual, _NUMERIC):
        lo, hi = (-(2 ** 31), 2 ** 31 - 1) if declared == _INT else (-(2 ** 63), 2 ** 63 - 1)
        dec = col.cast("decimal(38,6)")
        bad = (dec != F.floor(dec)) | (dec < F.lit(lo)) | (dec > F.lit(hi))
        return F.count_if(col.isNotNull() & bad)
    if type_compatible(declared, actual):
        return F.lit(0)
    if declared == _TEXT:
        return F.lit(0)  # every value has a text form
    return F.count_if(col.isNotNull())


def _sql_text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"


def conformance(df: DataFrame, dataset: str) -> DataFrame:
    """One row per declared or actual column: declared and actual type,
    whether they match, and how many rows do not fit the declared type.

    The data checks are one narrow aggregation (only the columns that need
    one); the per-column rows are then unfolded with ``stack``.
    """
    declared = dict(CONTRACT[dataset])
    actual = {f.name: f.dataType for f in df.schema.fields}
    counts, rows = [], []
    for name in list(declared) + [c for c in actual if c not in declared]:
        d, a = declared.get(name), actual.get(name)
        misfit = _misfit(d, F.col(f"`{name}`"), a) if (d and a is not None) else None
        if misfit is not None and not _is_zero(d, a):
            alias = f"_m{len(counts)}"
            counts.append(misfit.cast("long").alias(alias))
            value = f"`{alias}`"
        else:
            value = "CAST(0 AS BIGINT)"
        ok = "true" if (d and a is not None and type_compatible(d, a)) else "false"
        rows.append(", ".join([_sql_text(dataset), _sql_text(name), _sql_text(d),
                               _sql_text(a.simpleString() if a is not None else None), ok, value]))
    agg = df.agg(*counts) if counts else df.agg(F.count(F.lit(1)).alias("_n"))
    stack = (f"stack({len(rows)}, {', '.join(rows)}) AS "
             "(dataset, column_name, declared_type, actual_type, type_ok, nonconforming_rows)")
    return agg.select(F.expr(stack))


def _is_zero(declared: str, actual: T.DataType) -> bool:
    """Whether ``_misfit`` is the constant 0 for this pair (no data check)."""
    if declared in (_INT, _BIG) and isinstance(actual, _NUMERIC):
        return False
    return type_compatible(declared, actual) or declared == _TEXT
