"""File sources and sinks on hand-written edge rows."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from terrace.sinks import tables
from terrace.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_headerless_ppd_lenient(spark, tmpdir_run):
    _write(f"{tmpdir_run}/ppd/pp.csv",
           '"{A1}","250000","2023-05-04 00:00","AB1 2CD","D","Y","F","1","","HIGH ST","","TOWN","DIST","CTY","A","A"\n'
           '"{A2}","oops","not a date","","S","N","L","2","FLAT 1","LOW RD","","TOWN","DIST","CTY","B","C"\n'
           '"{A3}","99.5","2024-01-31 00:00"\n')
    rows = {r.transaction_id: r for r in
            files.read_ppd(spark, f"{tmpdir_run}/ppd", "full", dt.datetime(2026, 1, 1)).collect()}
    assert str(rows["{A1}"].price) == "250000.00" and rows["{A1}"].new_build is True
    assert rows["{A1}"].transfer_date == dt.date(2023, 5, 4)
    assert rows["{A2}"].price is None and rows["{A2}"].transfer_date is None and rows["{A2}"].new_build is False
    assert rows["{A3}"].transfer_date == dt.date(2024, 1, 31) and rows["{A3}"].postcode is None  # short row
    assert rows["{A3}"]._source_mode == "full"


def test_bootstrap_leaves_metadata_null(spark, tmpdir_run):
    _write(f"{tmpdir_run}/b/pp.csv", '"{B1}","1","2020-01-01 00:00","X","D","N","F","","","","","","","","A","A"\n')
    r = files.bootstrap_ppd(spark, f"{tmpdir_run}/b").first()
    assert r._ingested_at is None and r._source_mode is None and r.transaction_id == "{B1}"


def test_csv_by_the_standard(spark, tmpdir_run):
    """Doubled quotes, plain backslashes, empty and missing cells."""
    tail = ',"TOWN","DIST","CTY","A","A"\n'
    _write(f"{tmpdir_run}/q/pp.csv",
           '"{Q1}","1","2020-01-01 00:00","X","D","N","F","HIGH ""A"" ST","FLAT \\","S, T",""' + tail
           + '"{Q2}","2","2020-01-01 00:00","","D","N","F",,"x","y",' + tail)
    rows = {r.transaction_id: r for r in files.read_ppd_text(spark, f"{tmpdir_run}/q").collect()}
    q1, q2 = rows["{Q1}"], rows["{Q2}"]
    assert (q1.paon, q1.saon, q1.street, q1.locality, q1.town) == ('HIGH "A" ST', "FLAT \\", "S, T", "", "TOWN")
    assert (q2.postcode, q2.paon, q2.locality, q2.record_status) == ("", None, None, "A")


def test_csv_round_trip(spark, tmpdir_run):
    rows = [('a "b" c', "\\", "", None), ("x,y", "\\\"", None, "")]
    cells = spark.createDataFrame([(f"t{i}", *r) for i, r in enumerate(rows)], "transaction_id string, price string, "
                                  "transfer_date string, postcode string, property_type string")
    cells.write.options(header=False, **files.CSV_WRITE_OPTIONS).csv(f"{tmpdir_run}/rt")
    got = {r.transaction_id: tuple(r)[1:5] for r in files.read_ppd_text(spark, f"{tmpdir_run}/rt").collect()}
    assert got == {f"t{i}": r for i, r in enumerate(rows)}


def _names(paths):
    return [p.rsplit("/", 1)[1] for p in paths]


def test_landing_routing_newest_delivery(spark, tmpdir_run):
    d = f"{tmpdir_run}/landing"
    parts = ["File_7_new_part-0.csv", "File_7_new_part-1.csv", "File_7_new_part_00002.csv"]
    for name in ("IoD2019_old.csv", *parts, "ONSPD_X.csv", "unknown.csv"):
        _write(f"{d}/{name}", "a\n1\n")
    os.utime(f"{d}/IoD2019_old.csv", (1_000_000, 1_000_000))
    routed = files.landing_files(spark, d)
    assert set(routed) == {"imd", "onspd"}
    assert _names(routed["imd"].files) == parts
    assert _names(routed["imd"].superseded) == ["IoD2019_old.csv"]
    for name in (*parts, "IoD2019_old.csv"):
        os.utime(f"{d}/{name}", (2_000_000, 2_000_000))
    with pytest.raises(ValueError, match="equally new"):
        files.landing_files(spark, d)


@pytest.mark.parametrize("older, newer", [("ONSPD_2024-04", "ONSPD_2024-05"), ("ONSPD_MAY_23", "ONSPD_MAY_24"),
                                          ("ONSPD_1", "ONSPD_2"), ("ONSPD.part", "ONSPD.parts-3")])
def test_two_months_are_two_deliveries(spark, tmpdir_run, older, newer):
    d = f"{tmpdir_run}/landing"
    for name in (older, newer):
        _write(f"{d}/{name}.csv", "a\n1\n")
    os.utime(f"{d}/{older}.csv", (1_000_000, 1_000_000))
    found = files.landing_files(spark, d)["onspd"]
    assert (_names(found.files), _names(found.superseded)) == ([f"{newer}.csv"], [f"{older}.csv"])


@pytest.mark.parametrize("digits", [1, 5, 9])
def test_a_delivery_of_very_many_parts_is_whole(spark, tmpdir_run, digits):
    d = f"{tmpdir_run}/landing"
    for i in range(1200):
        _write(f"{d}/Rural_Urban_2021_part-{i:0{digits}d}.csv", f"LSOA21CD\nE{i}\n")
    found = files.landing_files(spark, d)["ruc_lsoa_2021"]
    assert len(found.files) == 1200 and not found.superseded
    rows = files.read_reference(spark, found.files, "ruc_lsoa_2021")
    assert rows.count() == rows.distinct().count() == 1200


def test_a_delivery_that_is_not_whole_is_refused(spark, tmpdir_run):
    d = f"{tmpdir_run}/landing"
    for i in (1, 2, 4):
        _write(f"{d}/ONSPD_May_part-{i}-of-4.csv", "a\n1\n")
    with pytest.raises(ValueError, match="3 of 4"):
        files.landing_files(spark, d)
    _write(f"{d}/ONSPD_May_part-3-of-4.csv", "a\n1\n")
    assert len(files.landing_files(spark, d)["onspd"].files) == 4
    _write(f"{d}/ONSPD_May_part-03.csv", "a\n1\n")
    with pytest.raises(ValueError, match="twice"):
        files.landing_files(spark, d)


def test_folders_as_spark_writes_them(spark, tmpdir_run):
    d = f"{tmpdir_run}/landing"
    for month, n in (("2024-04", 3), ("2024-05", 7)):
        (spark.range(n).selectExpr("concat('E', id) AS LSOA21CD").repartition(n)
         .write.options(header=True).csv(f"{d}/Rural_Urban_{month}"))
        for f in glob.glob(f"{d}/Rural_Urban_2024-04/*.csv"):
            os.utime(f, (1_000_000, 1_000_000))
    found = files.landing_files(spark, d)["ruc_lsoa_2021"]
    assert len(found.superseded) and _names(found.entries) == ["Rural_Urban_2024-04", "Rural_Urban_2024-05"]
    assert files.read_reference(spark, found.files, "ruc_lsoa_2021").count() == 7


def test_reference_columns_are_found_by_name(spark, tmpdir_run):
    from terrace import schemas
    names = [f.name for f in schemas.RAW_ONSPD.fields]
    row = {n: "1.5" if n in ("lat", "long") else n.upper() for n in names}
    turned = names[::-1]
    _write(f"{tmpdir_run}/o/a.csv", ",".join(turned) + "\n" + ",".join(row[n] for n in turned) + "\n")
    got = files.read_reference(spark, f"{tmpdir_run}/o/a.csv", "onspd")
    assert got.columns == names and got.first().lsoa21cd == "LSOA21CD" and got.first().lat == 1.5
    _write(f"{tmpdir_run}/o/b.csv", ",".join(names) + "\n" + ",".join(row[n] for n in names) + "\n")
    with pytest.raises(Exception, match="(?i)header"):  # parts of one delivery must agree
        files.read_reference(spark, [f"{tmpdir_run}/o/a.csv", f"{tmpdir_run}/o/b.csv"], "onspd").collect()
    _write(f"{tmpdir_run}/o/c.csv", ",".join(names[1:]) + "\n")
    with pytest.raises(ValueError, match=names[0]):
        files.read_reference(spark, f"{tmpdir_run}/o/c.csv", "onspd")


def test_reference_reader_keeps_headers(spark, tmpdir_run):
    _write(f"{tmpdir_run}/ruc/r.csv", "LSOA21CD,LSOA21NM,RUC21CD\nE1, name ,U1 \n")
    df = files.read_reference(spark, f"{tmpdir_run}/ruc/r.csv", "ruc_lsoa_2021")
    assert df.columns == ["LSOA21CD", "LSOA21NM", "RUC21CD"] and df.first().LSOA21NM == " name "


def test_export_and_report(spark, tmpdir_run):
    df = spark.range(20).select(F.col("id").alias("n"))
    tables.export_csv(df, f"{tmpdir_run}/out")
    parts = glob.glob(f"{tmpdir_run}/out/part-*.csv")
    assert len(parts) == 1 and open(parts[0]).readline().strip() == "n"
    tables.VersionedTable(spark, f"{tmpdir_run}/mart").overwrite(df)
    assert len(tables.report_to_pandas(spark, f"{tmpdir_run}/mart")) == 20
    assert sorted(tables.report_to_pandas(spark, f"{tmpdir_run}/mart", "n >= 18")["n"]) == [18, 19]


def test_write_bronze_modes(spark, tmpdir_run):
    df = spark.range(3)
    tables.write_bronze(df, f"{tmpdir_run}/t", "full")
    tables.write_bronze(df, f"{tmpdir_run}/t", "incremental")
    assert spark.read.parquet(f"{tmpdir_run}/t").count() == 6
    tables.write_bronze(df, f"{tmpdir_run}/t", "full")
    assert spark.read.parquet(f"{tmpdir_run}/t").count() == 3
