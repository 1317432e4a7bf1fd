"""Independent SQL statements of every registered query, for DuckDB.

Each statement rebuilds the bronze inputs from the driver's tables with the
same derivation as ``terrace.sources.fixtures`` and then applies the model in
plain SQL, so the Spark implementation can be compared row by row.  Result
types are pinned where the engines' defaults differ (integer widths, decimal
sum precision, averages as DOUBLE, rounding of doubles through DECIMAL).
"""

from __future__ import annotations

from terrace import schemas
from terrace.sources import fixtures as fx

# What the codes stand for.
PROPERTY_TYPES = {"D": "Detached", "S": "Semi-Detached", "T": "Terraced", "F": "Flats/Maisonettes", "O": "Other"}
TENURES = {"F": "Freehold", "L": "Leasehold"}
CATEGORIES = {"A": "Standard Price Paid", "B": "Additional Price Paid"}

RUN_TS = "2026-02-01 06:00:00"
RUN_TS_2 = "2026-03-01 06:00:00"
INGESTED_AT = fx.FIXTURE_INGESTED_AT.strftime("%Y-%m-%d %H:%M:%S")


def _case(col: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} ELSE 'Unknown' END"


def _md5(cols: list[str]) -> str:
    parts = " || '|' || ".join(f"coalesce(cast({c} AS VARCHAR), 'NULL')" for c in cols)
    return f"md5({parts})"


def _date_key(col: str) -> str:
    return f"cast(strftime({col}, '%Y%m%d') AS INTEGER)"


def _mean(col: str) -> str:
    return f"(cast(sum({col}) AS DOUBLE) / count({col}))"


def round_dbl(expr: str, digits: int) -> str:
    """Half-up rounding of a double on its decimal digits (as Spark/Postgres)."""
    return f"cast(round(cast({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _area(prefix: str, expr: str) -> str:
    return f"concat('{prefix}', lpad(cast({expr} AS VARCHAR), 6, '0'))"


def raw_ppd_sql(where: str = "TRUE", ingested_at: str = INGESTED_AT, mode: str = "full") -> str:
    return f"""
SELECT cast(o.o_orderkey AS VARCHAR) AS transaction_id,
       cast(o.o_totalprice AS DECIMAL(12,2)) AS price,
       cast(o.o_orderdate AS DATE) AS transfer_date,
       CASE WHEN o.o_orderkey % 500 = 0 THEN NULL WHEN o.o_orderkey % 500 = 1 THEN ''
            ELSE concat('ab', cast(o.o_custkey AS VARCHAR), ' 1xy') END AS postcode,
       substring('DSTFO', cast(o.o_orderkey % 5 AS INTEGER) + 1, 1) AS property_type,
       o.o_orderkey % 7 = 0 AS new_build,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL WHEN o.o_orderkey % 2 = 0 THEN 'F' ELSE 'L' END AS tenure,
       cast(o.o_custkey % 90 AS VARCHAR) AS paon,
       CASE WHEN o.o_orderkey % 4 = 0 THEN concat('FLAT ', cast(o.o_orderkey % 9 AS VARCHAR)) END AS saon,
       concat('STREET ', cast(o.o_custkey % 50 AS VARCHAR)) AS street,
       cast(NULL AS VARCHAR) AS locality,
       n.n_name AS town, c.c_mktsegment AS district, r.r_name AS county,
       CASE WHEN o.o_orderpriority = '5-LOW' THEN 'B' ELSE 'A' END AS category_type,
       CASE o.o_orderstatus WHEN 'O' THEN 'A' WHEN 'F' THEN 'C' WHEN 'P' THEN 'D' END AS record_status,
       TIMESTAMP '{ingested_at}' AS _ingested_at,
       '{mode}' AS _source_mode
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
WHERE {where}"""


def _onspd_common() -> str:
    return f"""concat(CASE WHEN c_custkey % 20 = 0 THEN 'QQ' ELSE 'AB' END, cast(c_custkey AS VARCHAR), ' 1XY') AS pcds,
       {{dointr}} AS dointr, {{doterm}} AS doterm,
       {_area('E01', f'c_custkey // {fx.PER_AREA_2021}')} AS lsoa21cd,
       {_area('E11', f'c_custkey // {fx.PER_AREA_2011}')} AS lsoa11cd,
       {_area('E02', f'c_custkey // {fx.PER_AREA_MIDDLE}')} AS msoa21cd,
       concat('L', cast(c_nationkey AS VARCHAR)) AS lad25cd,
       50.0e0 + (c_custkey % 100) / 10.0e0 AS lat,
       -1.0e0 * (c_custkey % 50) / 10.0e0 AS "long\""""


def raw_onspd_sql() -> str:
    first = _onspd_common().format(
        dointr="CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN NULL "
               "ELSE concat('1996', lpad(cast(c_custkey % 12 + 1 AS VARCHAR), 2, '0')) END",
        doterm="CASE WHEN c_custkey % 4 = 0 THEN '199806' END")
    second = _onspd_common().format(
        dointr="CASE WHEN c_custkey % 40 = 8 THEN '199801' ELSE '199807' END", doterm="''")
    return f"""
SELECT {first} FROM customer
UNION ALL
SELECT {second} FROM customer WHERE c_custkey % 8 = 0
UNION ALL
SELECT '', NULL, NULL, NULL, NULL, NULL, NULL, cast(NULL AS DOUBLE), cast(NULL AS DOUBLE)"""


def raw_ruc_sql() -> str:
    return f"""
SELECT CASE WHEN a % 10 = 9 THEN {_area('X01', 'a')} ELSE {_area('E01', 'a')} END AS "LSOA21CD",
       concat(c_name, ' ') AS "LSOA21NM",
       cast(NULL AS VARCHAR) AS "LSOA21NMW",
       concat(CASE WHEN a % 4 = 0 THEN 'R' ELSE 'U' END, cast(a % 3 AS VARCHAR), ' ') AS "RUC21CD",
       CASE WHEN a % 4 = 0 THEN ' Rural town' ELSE ' Urban city' END AS "RUC21NM",
       CASE WHEN a % 4 = 0 THEN 'Rural ' ELSE 'Urban ' END AS "Urban_rural_flag",
       cast(a AS INTEGER) AS "ObjectId"
FROM (SELECT c_custkey // {fx.PER_AREA_2021} AS a, min(c_name) AS c_name FROM customer GROUP BY 1) t"""


def raw_imd_sql() -> str:
    cols = [f"CASE WHEN a % 7 = 3 THEN {_area('X11', 'a')} ELSE {_area('E11', 'a')} END AS lsoa_code_2011",
            "c_name AS lsoa_name_2011",
            "c_mktsegment AS local_authority_district_name_2019"]
    for i, (_, _, _, score, decile) in enumerate(schemas.IMD_DOMAINS):
        cols.append(f"cast(cast((a * {i + 3} % 1000) / 7.0e0 AS DECIMAL(12,5)) AS VARCHAR) AS {score}")
        cols.append(f"cast(a * {i + 1} % 10 + 1 AS VARCHAR) AS {decile}")
    return (f"SELECT {', '.join(cols)} FROM (SELECT c_custkey // {fx.PER_AREA_2011} AS a, min(c_name) AS c_name, "
            f"min(c_mktsegment) AS c_mktsegment FROM customer GROUP BY 1) t")


def dirty_ppd_sql() -> str:
    """The faulty sales that the checks are run on."""
    k = "cast(transaction_id AS BIGINT)"
    rows = f"""SELECT * REPLACE (
    cast(CASE {k} % 97 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN -price ELSE price END AS DECIMAL(12,2)) AS price,
    CASE {k} % 89 WHEN 0 THEN 'X' WHEN 1 THEN '?' WHEN 2 THEN NULL ELSE property_type END AS property_type,
    CASE {k} % 83 WHEN 0 THEN NULL WHEN 1 THEN DATE '2035-06-01' ELSE transfer_date END AS transfer_date)
FROM ({raw_ppd_sql()}) c"""
    return f"SELECT * FROM ({rows}) a UNION ALL SELECT * FROM ({rows}) b WHERE {k} % 79 = 0"


def silver_ppd_sql(src: str = "raw_ppd", run_ts: str = RUN_TS) -> str:
    return f"""
SELECT transaction_id, price, transfer_date, postcode AS raw_postcode,
       replace(upper(coalesce(postcode, '')), ' ', '') AS normalized_postcode,
       property_type, new_build, tenure, paon, saon, street, locality, town, district, county,
       category_type, record_status, TIMESTAMP '{run_ts}' AS dbt_updated_at
FROM {src}"""


def _month(cell: str, otherwise: str, whole: bool) -> str:
    """A YYYYMM cell as its first day (``whole``: last day); ``otherwise`` if blank."""
    first = f"cast(try_strptime(nullif({cell}, ''), '%Y%m') AS DATE)"
    return f"if(nullif({cell}, '') IS NULL, DATE '{otherwise}', {f'last_day({first})' if whole else first})"


SILVER_ONSPD = f"""
WITH present AS (SELECT *, replace(upper(pcds), ' ', '') AS plain FROM raw_onspd WHERE length(pcds) > 0)
SELECT md5(concat(plain, dointr)) AS onspd_key, plain AS normalized_postcode, pcds AS raw_postcode,
       {_month('dointr', '1900-01-01', False)} AS valid_from, {_month('doterm', '2099-12-31', True)} AS valid_to,
       lat AS latitude, "long" AS longitude, lad25cd AS lad_code, msoa21cd, lsoa11cd, lsoa21cd
FROM present"""

SILVER_RUC = """
SELECT "LSOA21CD" AS lsoa21cd, trim("LSOA21NM") AS lsoa21nm, trim("RUC21CD") AS ruc21cd,
       trim("RUC21NM") AS ruc21nm, trim("Urban_rural_flag") AS urban_rural_flag
FROM raw_ruc"""


def _silver_imd() -> str:
    cols = ["lsoa_code_2011 AS lsoa11cd", "lsoa_name_2011 AS lsoa11nm",
            "local_authority_district_name_2019 AS local_authority_name"]
    for prefix, _, _, score, decile in schemas.IMD_DOMAINS:
        cols.append(f"cast({score} AS DECIMAL(10,3)) AS {prefix}_score")
        cols.append(f"cast({decile} AS INTEGER) AS {prefix}_decile")
    return f"SELECT {', '.join(cols)} FROM raw_imd"


def _dim_geography() -> str:
    measures = ", ".join(f"i.{p}_{kind}" for p, *_ in schemas.IMD_DOMAINS for kind in ("score", "decile"))
    return f"""
SELECT o.onspd_key AS geography_key, o.* EXCLUDE (onspd_key), r.ruc21cd, r.ruc21nm, r.urban_rural_flag, {measures}
FROM silver_onspd o
LEFT JOIN silver_ruc r ON o.lsoa21cd = r.lsoa21cd
LEFT JOIN silver_imd i ON o.lsoa11cd = i.lsoa11cd"""


def dim_property_sql(src: str = "silver_ppd") -> str:
    return f"""
SELECT {_md5(schemas.PROPERTY_COLUMNS)} AS property_key,
       property_type, {_case('property_type', PROPERTY_TYPES)} AS property_type_desc,
       new_build,
       tenure, {_case('tenure', TENURES)} AS tenure_desc,
       category_type, {_case('category_type', CATEGORIES)} AS category_type_desc
FROM (SELECT DISTINCT property_type, new_build, tenure, category_type FROM {src}) u"""


def dim_location_sql(src: str = "silver_ppd") -> str:
    cols = ", ".join(schemas.ADDRESS_COLUMNS)
    return f"SELECT {_md5(schemas.ADDRESS_COLUMNS)} AS location_key, {cols} FROM (SELECT DISTINCT {cols} FROM {src}) u"


DIM_DATE = """
SELECT cast(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       cast(year(d) AS INTEGER) AS year, cast(quarter(d) AS INTEGER) AS quarter,
       cast(month(d) AS INTEGER) AS month, strftime(d, '%B') AS month_name,
       cast(day(d) AS INTEGER) AS day_of_month, cast(isodow(d) AS INTEGER) AS day_of_week,
       strftime(d, '%A') AS day_name, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT cast(unnest(generate_series(TIMESTAMP '1990-01-01', TIMESTAMP '2030-12-31', INTERVAL 1 DAY)) AS DATE) AS d) s"""


def fact_sales_sql(src: str = "silver_ppd", run_ts: str = RUN_TS) -> str:
    return f"""
SELECT transaction_id, price, {_date_key('transfer_date')} AS date_key, normalized_postcode,
       {_md5(schemas.PROPERTY_COLUMNS)} AS property_key,
       {_md5(schemas.ADDRESS_COLUMNS)} AS location_key,
       dbt_updated_at AS silver_updated_at, TIMESTAMP '{run_ts}' AS gold_updated_at
FROM {src}"""


# Every sale with what the reports group by: first its day and its kind, then
# the postcode version that holds on the day (NULLs where there is none).
SALES = """
WITH dated AS (SELECT s.*, (SELECT struct_pack(y := c.year, d := c.full_date) FROM dim_date c WHERE c.date_key = s.date_key) AS day
               FROM fact_sales s),
     kinds AS (SELECT property_key, any_value(property_type_desc) AS kind, any_value(tenure_desc) AS held,
                      any_value(new_build) AS fresh FROM dim_property GROUP BY property_key)
SELECT dated.*, day.y AS sold_in, day.d AS sold_on, kind, held, fresh, place
FROM dated LEFT JOIN kinds USING (property_key)
LEFT JOIN (SELECT normalized_postcode AS code, geo AS place FROM dim_geography geo) v
       ON code = dated.normalized_postcode AND day.d BETWEEN place.valid_from AND place.valid_to"""

# The mart's measures, in the declared order.
MEASURES = {
    "total_transactions": "count(*)",
    "total_sales_volume": "cast(sum(price) AS DECIMAL(22,2))",
    "average_price": _mean("price"),
    "min_price": "min(price)",
    "max_price": "max(price)",
    "avg_imd_score": _mean("place.imd_score"),
    "avg_crime_score": _mean("place.crime_score"),
    "avg_education_score": _mean("place.education_score"),
}

MART = f"""
SELECT sold_in AS sale_year, place.urban_rural_flag AS urban_rural_flag, kind AS property_type, fresh AS new_build,
       {", ".join(f"{sql} AS {name}" for name, sql in MEASURES.items())}
FROM sales GROUP BY ALL"""


def base_ctes(dirty: bool = False) -> list[tuple[str, str]]:
    """Bronze -> silver -> gold -> mart, in dependency order."""
    return [
        ("raw_ppd", dirty_ppd_sql() if dirty else raw_ppd_sql()),
        ("raw_onspd", raw_onspd_sql()),
        ("raw_ruc", raw_ruc_sql()),
        ("raw_imd", raw_imd_sql()),
        ("silver_ppd", silver_ppd_sql()),
        ("silver_onspd", SILVER_ONSPD),
        ("silver_ruc", SILVER_RUC),
        ("silver_imd", _silver_imd()),
        ("dim_geography", _dim_geography()),
        ("dim_property", dim_property_sql()),
        ("dim_location", dim_location_sql()),
        ("dim_date", DIM_DATE),
        ("fact_sales", fact_sales_sql()),
        ("sales", SALES),
        ("mart", MART),
    ]


def with_ctes(select: str, extra: list[tuple[str, str]] | None = None, dirty: bool = False) -> str:
    ctes = base_ctes(dirty) + (extra or [])
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes)
    return f"WITH {body}\n{select}"
