import datetime as dt
import hashlib

from pyspark.sql import functions as F

from terrace import functions as T
from terrace.plans import gold


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_normalize_postcode(spark):
    assert one(spark, T.normalize_postcode, "ab1 2cd") == "AB12CD"
    assert one(spark, T.normalize_postcode, None) == ""
    assert one(spark, lambda c: T.normalize_postcode(c, empty_for_null=False), None) is None
    assert one(spark, T.normalize_postcode, " ") == ""
    assert one(spark, T.normalize_postcode, "\tab 1") == "\tAB1"  # only spaces removed


def test_md5_key_matches_python(spark):
    df = spark.createDataFrame([("D", True, None, "A")], "a string, b boolean, c string, d string")
    got = df.select(T.md5_key("a", "b", "c", "d")).first()[0]
    assert got == hashlib.md5(b"D|true|NULL|A").hexdigest()


def test_version_key(spark):
    df = spark.createDataFrame([("ab1 2cd", None), ("ab1 2cd", "199601")], "p string, d string")
    got = [r[0] for r in df.select(T.version_key("p", "d")).collect()]
    assert got == [hashlib.md5(b"AB12CD").hexdigest(), hashlib.md5(b"AB12CD199601").hexdigest()]


def test_month_bounds(spark):
    assert one(spark, T.month_start, "") == dt.date(1900, 1, 1)
    assert one(spark, T.month_start, None) == dt.date(1900, 1, 1)
    assert one(spark, T.month_start, "199602") == dt.date(1996, 2, 1)
    assert one(spark, T.month_end, "199602") == dt.date(1996, 2, 29)
    assert one(spark, T.month_end, "") == dt.date(2099, 12, 31)


def test_parse_dates(spark):
    assert one(spark, T.parse_transfer_date, "2023-05-04 00:00") == dt.date(2023, 5, 4)
    assert one(spark, T.parse_transfer_date, "garbage") is None
    assert one(spark, T.parse_iso_timestamp, "2026-01-02T03:04:05.123456") == dt.datetime(2026, 1, 2, 3, 4, 5, 123456)
    assert one(spark, T.parse_iso_timestamp, "2026-01-02T03:04:05") == dt.datetime(2026, 1, 2, 3, 4, 5)
    assert one(spark, T.parse_iso_timestamp, "nope") is None


def test_flags(spark):
    assert one(spark, T.yes_flag, "Y") is True
    assert one(spark, T.yes_flag, "N") is False
    assert one(spark, T.yes_flag, None) is None
    assert one(spark, T.yes_flag_text, "Y") == "true"
    assert one(spark, T.yes_flag_text, "x") == "false"
    assert one(spark, T.yes_flag_text, None) is None
    assert one(spark, T.text_bool, "TRUE") is True
    assert one(spark, T.text_bool, "no") is False


def test_describe_codes(spark):
    f = lambda c: T.describe(c, T.PROPERTY_TYPE_DESC)
    assert one(spark, f, "F") == "Flats/Maisonettes"
    assert one(spark, f, "X") == "Unknown"
    assert one(spark, f, None) == "Unknown"


def test_dim_date_spine(spark):
    d = gold.dim_date(spark)
    assert d.count() == gold.DATE_SPINE_ROWS == 14975
    r = d.where(F.col("date_key") == 20240106).first()
    assert (r.full_date, r.year, r.quarter, r.month, r.day_of_week, r.is_weekend) == \
        (dt.date(2024, 1, 6), 2024, 1, 1, 6, True)
    assert (r.month_name, r.day_name) == ("January", "Saturday")
    padded = gold.dim_date(spark, pad_names=True).where(F.col("date_key") == 20240501).first()
    assert (padded.month_name, padded.day_name) == ("May      ", "Wednesday")


def test_dim_date_against_duckdb(spark):
    import duckdb
    from terrace import oracles
    want = sorted(duckdb.sql(oracles.DIM_DATE).fetchall())
    got = sorted(tuple(r) for r in gold.dim_date(spark).collect())
    assert got == want


def test_days_since(spark):
    assert one(spark, lambda c: T.days_since(c, dt.date(2026, 2, 1)), dt.date(2026, 1, 1), "date") == 31
    today = one(spark, T.days_since, dt.date.today(), "date")
    assert today in (0, 1)  # current_date in the session time zone
