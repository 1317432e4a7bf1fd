"""Declared schemas for every layer (bronze, silver, gold, messages).

Column names and types are fixed values of the data model: they have to be
identical to the warehouse contract so that downstream readers keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# The 16 columns of the headerless price-paid transaction file,
# in file order, and the two metadata columns added on ingestion.
# ---------------------------------------------------------------------------
PPD_COLUMNS = [
    "transaction_id", "price", "transfer_date", "postcode", "property_type",
    "new_build", "tenure", "paon", "saon", "street", "locality", "town",
    "district", "county", "category_type", "record_status",
]
METADATA_COLUMNS = ["_ingested_at", "_source_mode"]
RAW_PPD_COLUMNS = PPD_COLUMNS + METADATA_COLUMNS

# Columns a keyed upsert overwrites when the key already exists; every other
# column keeps the value it had when the key was first inserted.
UPSERT_UPDATE_COLUMNS = [
    "price", "transfer_date", "postcode", "property_type", "new_build",
    "tenure", "_ingested_at", "_source_mode",
]

ADDRESS_COLUMNS = ["paon", "saon", "street", "locality", "town", "district", "county"]
PROPERTY_COLUMNS = ["property_type", "new_build", "tenure", "category_type"]

# Text as it sits in the file: every cell is read as a string first so a bad
# cell can become NULL in the typed projection instead of failing the scan.
PPD_TEXT = T.StructType([T.StructField(c, T.StringType()) for c in PPD_COLUMNS])

RAW_PPD = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("transfer_date", T.DateType()),
    T.StructField("postcode", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("new_build", T.BooleanType()),
    T.StructField("tenure", T.StringType()),
    T.StructField("paon", T.StringType()),
    T.StructField("saon", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("locality", T.StringType()),
    T.StructField("town", T.StringType()),
    T.StructField("district", T.StringType()),
    T.StructField("county", T.StringType()),
    T.StructField("category_type", T.StringType()),
    T.StructField("record_status", T.StringType()),
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source_mode", T.StringType()),
])

# A message on the transaction topic: every field arrives as JSON text and may
# be absent; from_json with this schema yields NULL for absent fields.
MESSAGE = T.StructType([T.StructField(c, T.StringType()) for c in RAW_PPD_COLUMNS])

# ---------------------------------------------------------------------------
# Postcode directory columns, in file order (53 columns).
# ---------------------------------------------------------------------------
ONSPD_COLUMNS = [
    "pcd7", "pcd8", "pcds", "dointr", "doterm",
    "cty25cd", "ced25cd", "lad25cd", "wd25cd", "parncp25cd",
    "usrtypind", "east1m", "north1m", "gridind", "hlth19cd",
    "nhser24cd", "ctry25cd", "rgn25cd", "ssr95cd", "pcon24cd",
    "eer20cd", "educ23cd", "ttwa15cd", "pco19cd", "itl25cd",
    "wdstl05cd", "oa01cd", "wdcas03cd", "npark16cd", "lsoa01cd",
    "msoa01cd", "ruc01ind", "oac01ind", "oa11cd", "lsoa11cd",
    "msoa11cd", "wz11cd", "sicbl24cd", "bua24cd", "ruc11ind",
    "oac11ind", "lat", "long", "lep21cd1",
    "lep21cd2", "pfa23cd", "imd20ind", "cal24cd", "icb23cd",
    "oa21cd", "lsoa21cd", "msoa21cd", "ruc21ind",
]
# All text except the coordinates: an inferred numeric YYYYMM would break the
# comparisons with '' that the silver model performs.
RAW_ONSPD = T.StructType([
    T.StructField(c, T.DoubleType() if c in ("lat", "long") else T.StringType())
    for c in ONSPD_COLUMNS
])

# rural/urban classification columns (snake form, file order).
RUC_COLUMNS = ["lsoa21cd", "lsoa21nm", "lsoa21nmw", "ruc21cd", "ruc21nm",
               "urban_rural_flag", "objectid"]
RAW_RUC = T.StructType([
    T.StructField(c, T.IntegerType() if c == "objectid" else T.StringType())
    for c in RUC_COLUMNS
])

# ---------------------------------------------------------------------------
# Deprivation-index domains.  Each entry is
# (silver prefix, original file header of the score, original header of the
# decile truncated to 63 characters, snake header of the score, snake header
# of the decile).  The silver model accepts either header form.
# ---------------------------------------------------------------------------
IMD_DOMAINS = [
    ("imd",
     "Index of Multiple Deprivation (IMD) Score",
     "Index of Multiple Deprivation (IMD) Decile (where 1 is most dep",
     "index_of_multiple_deprivation_imd_score",
     "index_of_multiple_deprivation_imd_decile_where_1_is_most_dep"),
    ("income",
     "Income Score (rate)",
     "Income Decile (where 1 is most deprived 10% of LSOAs)",
     "income_score_rate",
     "income_decile_where_1_is_most_deprived_10_of_lsoas"),
    ("employment",
     "Employment Score (rate)",
     "Employment Decile (where 1 is most deprived 10% of LSOAs)",
     "employment_score_rate",
     "employment_decile_where_1_is_most_deprived_10_of_lsoas"),
    ("education",
     "Education, Skills and Training Score",
     "Education, Skills and Training Decile (where 1 is most deprived",
     "education_skills_and_training_score",
     "education_skills_and_training_decile_where_1_is_most_deprive"),
    ("health",
     "Health Deprivation and Disability Score",
     "Health Deprivation and Disability Decile (where 1 is most depri",
     "health_deprivation_and_disability_score",
     "health_deprivation_and_disability_decile_where_1_is_most_dep"),
    ("crime",
     "Crime Score",
     "Crime Decile (where 1 is most deprived 10% of LSOAs)",
     "crime_score",
     "crime_decile_where_1_is_most_deprived_10_of_lsoas"),
    ("housing_barriers",
     "Barriers to Housing and Services Score",
     "Barriers to Housing and Services Decile (where 1 is most depriv",
     "barriers_to_housing_and_services_score",
     "barriers_to_housing_and_services_decile_where_1_is_most_depr"),
    ("living_environment",
     "Living Environment Score",
     "Living Environment Decile (where 1 is most deprived 10% of LSOA",
     "living_environment_score",
     "living_environment_decile_where_1_is_most_deprived_10_of_lso"),
]
# Identifying columns of the deprivation file,
# (silver name, original header, snake header).
IMD_ID_COLUMNS = [
    ("lsoa11cd", "LSOA code (2011)", "lsoa_code_2011"),
    ("lsoa11nm", "LSOA name (2011)", "lsoa_name_2011"),
    ("local_authority_name", "Local Authority District name (2019)",
     "local_authority_district_name_2019"),
]

# ---------------------------------------------------------------------------
# Expected output schemas (used by the conformance check).
# ---------------------------------------------------------------------------
SILVER_PPD = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("transfer_date", T.DateType()),
    T.StructField("raw_postcode", T.StringType()),
    T.StructField("normalized_postcode", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("new_build", T.BooleanType()),
    T.StructField("tenure", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in ADDRESS_COLUMNS],
    T.StructField("category_type", T.StringType()),
    T.StructField("record_status", T.StringType()),
    T.StructField("dbt_updated_at", T.TimestampType()),
])

FACT_SALES = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("price", T.DecimalType(12, 2)),
    T.StructField("date_key", T.IntegerType()),
    T.StructField("normalized_postcode", T.StringType()),
    T.StructField("property_key", T.StringType()),
    T.StructField("location_key", T.StringType()),
    T.StructField("silver_updated_at", T.TimestampType()),
    T.StructField("gold_updated_at", T.TimestampType()),
])

DIM_DATE = T.StructType([
    T.StructField("date_key", T.IntegerType()),
    T.StructField("full_date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("quarter", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("month_name", T.StringType()),
    T.StructField("day_of_month", T.IntegerType()),
    T.StructField("day_of_week", T.IntegerType()),
    T.StructField("day_name", T.StringType()),
    T.StructField("is_weekend", T.BooleanType()),
])

MART = T.StructType([
    T.StructField("sale_year", T.IntegerType()),
    T.StructField("urban_rural_flag", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("new_build", T.BooleanType()),
    T.StructField("total_transactions", T.LongType()),
    T.StructField("total_sales_volume", T.DecimalType(22, 2)),
    T.StructField("average_price", T.DoubleType()),
    T.StructField("min_price", T.DecimalType(12, 2)),
    T.StructField("max_price", T.DecimalType(12, 2)),
    T.StructField("avg_imd_score", T.DoubleType()),
    T.StructField("avg_crime_score", T.DoubleType()),
    T.StructField("avg_education_score", T.DoubleType()),
])

# All 57 deprivation-file columns in file order (snake form).
IMD_COLUMNS = [
    "lsoa_code_2011",
    "lsoa_name_2011",
    "local_authority_district_code_2019",
    "local_authority_district_name_2019",
    "index_of_multiple_deprivation_imd_score",
    "index_of_multiple_deprivation_imd_rank_where_1_is_most_depri",
    "index_of_multiple_deprivation_imd_decile_where_1_is_most_dep",
    "income_score_rate",
    "income_rank_where_1_is_most_deprived",
    "income_decile_where_1_is_most_deprived_10_of_lsoas",
    "employment_score_rate",
    "employment_rank_where_1_is_most_deprived",
    "employment_decile_where_1_is_most_deprived_10_of_lsoas",
    "education_skills_and_training_score",
    "education_skills_and_training_rank_where_1_is_most_deprived",
    "education_skills_and_training_decile_where_1_is_most_deprive",
    "health_deprivation_and_disability_score",
    "health_deprivation_and_disability_rank_where_1_is_most_depri",
    "health_deprivation_and_disability_decile_where_1_is_most_dep",
    "crime_score",
    "crime_rank_where_1_is_most_deprived",
    "crime_decile_where_1_is_most_deprived_10_of_lsoas",
    "barriers_to_housing_and_services_score",
    "barriers_to_housing_and_services_rank_where_1_is_most_depriv",
    "barriers_to_housing_and_services_decile_where_1_is_most_depr",
    "living_environment_score",
    "living_environment_rank_where_1_is_most_deprived",
    "living_environment_decile_where_1_is_most_deprived_10_of_lso",
    "income_deprivation_affecting_children_index_idaci_score_rate",
    "income_deprivation_affecting_children_index_idaci_rank_where",
    "income_deprivation_affecting_children_index_idaci_decile_whe",
    "income_deprivation_affecting_older_people_idaopi_score_rate",
    "income_deprivation_affecting_older_people_idaopi_rank_where_",
    "income_deprivation_affecting_older_people_idaopi_decile_wher",
    "children_and_young_people_sub_domain_score",
    "children_and_young_people_sub_domain_rank_where_1_is_most_de",
    "children_and_young_people_sub_domain_decile_where_1_is_most_",
    "adult_skills_sub_domain_score",
    "adult_skills_sub_domain_rank_where_1_is_most_deprived",
    "adult_skills_sub_domain_decile_where_1_is_most_deprived_10_o",
    "geographical_barriers_sub_domain_score",
    "geographical_barriers_sub_domain_rank_where_1_is_most_depriv",
    "geographical_barriers_sub_domain_decile_where_1_is_most_depr",
    "wider_barriers_sub_domain_score",
    "wider_barriers_sub_domain_rank_where_1_is_most_deprived",
    "wider_barriers_sub_domain_decile_where_1_is_most_deprived_10",
    "indoors_sub_domain_score",
    "indoors_sub_domain_rank_where_1_is_most_deprived",
    "indoors_sub_domain_decile_where_1_is_most_deprived_10_of_lso",
    "outdoors_sub_domain_score",
    "outdoors_sub_domain_rank_where_1_is_most_deprived",
    "outdoors_sub_domain_decile_where_1_is_most_deprived_10_of_ls",
    "total_population_mid_2015_excluding_prisoners",
    "dependent_children_aged_0_15_mid_2015_excluding_prisoners",
    "population_aged_16_59_mid_2015_excluding_prisoners",
    "older_population_aged_60_and_over_mid_2015_excluding_prisone",
    "working_age_population_18_59_64_for_use_with_employment_depr",
]
RAW_IMD = T.StructType([T.StructField(c, T.StringType()) for c in IMD_COLUMNS])

DIM_PROPERTY = T.StructType([
    T.StructField("property_key", T.StringType()),
    T.StructField("property_type", T.StringType()),
    T.StructField("property_type_desc", T.StringType()),
    T.StructField("new_build", T.BooleanType()),
    T.StructField("tenure", T.StringType()),
    T.StructField("tenure_desc", T.StringType()),
    T.StructField("category_type", T.StringType()),
    T.StructField("category_type_desc", T.StringType()),
])

DIM_LOCATION = T.StructType([T.StructField("location_key", T.StringType())]
                            + [T.StructField(c, T.StringType()) for c in ADDRESS_COLUMNS])

DIM_GEOGRAPHY = T.StructType(
    [T.StructField(c, T.StringType()) for c in ("geography_key", "normalized_postcode", "raw_postcode")]
    + [T.StructField("valid_from", T.DateType()), T.StructField("valid_to", T.DateType())]
    + [T.StructField(c, T.StringType()) for c in ("lsoa21cd", "lsoa11cd", "msoa21cd", "lad_code",
                                                 "ruc21cd", "ruc21nm", "urban_rural_flag")]
    + [f for p, *_ in IMD_DOMAINS for f in (T.StructField(f"{p}_score", T.DecimalType(10, 3)),
                                             T.StructField(f"{p}_decile", T.IntegerType()))]
    + [T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType())])
