"""End to end: landing CSVs and a transaction file -> warehouse -> gate."""

import datetime as dt
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from terrace import schemas
from terrace.catalog import RUN_TS
from terrace.plans import gold, pipeline
from terrace.plans.star import build_star
from terrace.sinks.tables import CommitConflict, VersionedTable
from terrace.sources import files
from terrace.sources import fixtures as fx
from terrace.streaming import ingest, messages

MONTH = dt.timedelta(days=30)


def _landing(spark, d, parts=1):
    """The fixture's reference tables as landing files (the directory in parts)."""
    b = fx.bronze(spark, SF_SMALL)
    filled = lambda df, schema: df.select(*[
        F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    landing = f"{d}/landing"
    os.makedirs(landing)
    for name, df, n in (("ONSPD_FEB", filled(b["onspd"], schemas.RAW_ONSPD), parts), ("Rural_Urban_2021", b["ruc_lsoa_2021"], 1),
                        ("File_7_scores", filled(b["imd"], schemas.RAW_IMD), 1)):
        df.repartition(n).write.options(header=True, **files.CSV_WRITE_OPTIONS).csv(f"{d}/tmp_{name}")
        found = sorted(glob.glob(f"{d}/tmp_{name}/part-*.csv"))
        assert len(found) == n
        for i, path in enumerate(found):
            shutil.copy(path, f"{landing}/{name}_part-{i:05d}.csv" if n > 1 else f"{landing}/{name}.csv")
    with open(f"{landing}/notes.csv", "w") as fh:  # unknown prefix: skipped
        fh.write("a,b\n1,2\n")
    return b, landing


def _sales(spark, raw, path, where="true"):
    messages.to_file_text(raw.where(where)).write.options(header=False, **files.CSV_WRITE_OPTIONS).csv(path)
    return path


def _same(got, want):
    return got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _consistent(spark, root):
    """Dimensions equal a rebuild; every fact finds its location and property."""
    rows = pipeline.read(spark, root, "silver", "silver_ppd")
    fact = pipeline.read(spark, root, "gold", "fact_sales")
    assert fact.count() == rows.count()
    for name, full, key in (("dim_property", gold.dim_property(rows), "property_key"),
                            ("dim_location", gold.dim_location(rows), "location_key")):
        got = pipeline.read(spark, root, "gold", name)
        assert _same(got, full), name
        assert fact.join(got, key, "left_anti").count() == 0


def test_full_then_incremental_run(spark, tmpdir_run):
    b, landing = _landing(spark, tmpdir_run, parts=3)
    raw = b["ppd"]
    root = f"{tmpdir_run}/wh"
    r1 = pipeline.run_pipeline(spark, root, "full", RUN_TS, landing_dir=landing,
                               ppd_path=_sales(spark, raw, f"{tmpdir_run}/full", "transfer_date < '1998-01-01'"),
                               as_of=dt.date(1998, 1, 20), min_rows=10, enforce_gate=True)
    assert {c["test"] for c in r1.checks} >= {"unique", "not_null", "accepted_values", "price_positive"}
    # all parts of the delivery are loaded, and archived by the run that read them
    assert r1.loaded["onspd"] == b["onspd"].count() == pipeline.read(spark, root, "raw", "onspd").count()
    assert os.listdir(landing) == ["notes.csv"]
    archived = sorted(os.path.basename(p) for p in glob.glob(f"{tmpdir_run}/processed/*/*.csv"))
    assert archived == ["File_7_scores.csv", *[f"ONSPD_FEB_part-0000{i}.csv" for i in range(3)], "Rural_Urban_2021.csv"]
    run2 = RUN_TS + MONTH
    r2 = pipeline.run_pipeline(spark, root, "incremental", run2, ppd_path=_sales(spark, raw, f"{tmpdir_run}/month"),
                               as_of=dt.date(2001, 8, 20), min_rows=10)
    assert r2.late_rows == 0
    # the warehouse mart equals the mart computed directly from all rows
    star = build_star(spark, {**b, "ppd": raw}, RUN_TS)
    key = ["sale_year", "urban_rural_flag", "property_type", "new_build", "total_transactions",
           "total_sales_volume", "min_price", "max_price"]
    mart = pipeline.read(spark, root, "gold", "mart_rural_urban_stats")
    assert _same(mart.select(*key), star.mart().select(*key))
    assert mart.where("urban_rural_flag is not null").count() > 0
    fact = pipeline.read(spark, root, "gold", "fact_sales")
    assert fact.count() == raw.count()
    assert fact.where(F.col("gold_updated_at") == F.lit(run2)).count() > 0
    _consistent(spark, root)


def test_late_sales_are_counted(spark, tmpdir_run):
    b, landing = _landing(spark, tmpdir_run)
    root = f"{tmpdir_run}/wh"
    some = "transfer_date < '1998-01-01' AND cast(transaction_id AS int) % 3 != 0"
    run = lambda mode, ts, path: pipeline.run_pipeline(
        spark, root, mode, ts, landing_dir=landing, ppd_path=path, min_rows=1, enforce_gate=False)
    run("full", RUN_TS, _sales(spark, b["ppd"], f"{tmpdir_run}/full", some))
    mark = b["ppd"].where(some).agg(F.max("transfer_date")).first()[0]
    late = b["ppd"].where((F.col("transfer_date") <= F.lit(mark)) & (F.col("transaction_id").cast("int") % 3 == 0)).count()
    assert late > 0 and run("incremental", RUN_TS + MONTH, _sales(spark, b["ppd"], f"{tmpdir_run}/month")).late_rows == late


def test_late_sales_are_judged_within_the_years_that_changed(spark, tmpdir_run):
    """Late, moved and repeated keys; no file of an untouched year is read."""
    b, landing = _landing(spark, tmpdir_run)
    root = f"{tmpdir_run}/wh"
    first = "transfer_date < '2000-01-01' AND cast(transaction_id AS int) % 3 != 0"
    pipeline.run_pipeline(spark, root, "full", RUN_TS, landing_dir=landing, min_rows=1, enforce_gate=False,
                          ppd_path=_sales(spark, b["ppd"], f"{tmpdir_run}/full", first))
    bronze, sales = (pipeline.table(spark, root, *n) for n in (("raw", "ppd"), ("silver", "silver_ppd")))
    mark = b["ppd"].where(first).agg(F.max("transfer_date")).first()[0]
    number = F.col("transaction_id").cast("int")
    arriving = b["ppd"].where("year(transfer_date) = 1997").where(number % 3 == 0)
    # A known sale moves from 1998 to 1997: it is in silver, so not late.
    moved = b["ppd"].where(first).where("year(transfer_date) = 1998").orderBy("transaction_id").limit(1)
    moved = moved.withColumn("transfer_date", F.lit(dt.date(1997, 5, 5)))
    for run, rows in enumerate([arriving.unionByName(moved), arriving], 1):  # the second repeats rows of the first
        pipeline.ingest_ppd_file(spark, _sales(spark, rows, f"{tmpdir_run}/month{run}"), root, "incremental", RUN_TS + run * MONTH)
        late = pipeline.late_sales(bronze, sales, sales.manifest(), mark)
        assert late.count() == arriving.count()
        years = {f.rsplit("_part=", 1)[1].split("/")[0] for f in late.inputFiles()}
        assert years == {"1997", "1998"}, years
    versions, counted = pipeline.build_silver(spark, root, "incremental", RUN_TS + 3 * MONTH)
    assert counted == arriving.count() > 0
    # What was counted is not counted again, whether it comes again or not.
    pipeline.ingest_ppd_file(spark, _sales(spark, arriving, f"{tmpdir_run}/again"), root, "incremental", RUN_TS + 4 * MONTH)
    assert pipeline.build_silver(spark, root, "incremental", RUN_TS + 5 * MONTH)[1] == 0


@pytest.mark.parametrize("stop", ["build_gold", "dim_location", "fact_sales", "build_mart"])
def test_a_stopped_run_can_be_repeated(spark, tmpdir_run, monkeypatch, stop):
    """Stop the incremental run at a step, run it again: nothing is lost."""
    b, landing = _landing(spark, tmpdir_run)
    root = f"{tmpdir_run}/wh"
    options = dict(as_of=dt.date(2001, 8, 20), min_rows=1, enforce_gate=False)
    pipeline.run_pipeline(spark, root, "full", RUN_TS, landing_dir=landing,
                          ppd_path=_sales(spark, b["ppd"], f"{tmpdir_run}/full", "transfer_date < '1998-01-01'"), **options)
    month = _sales(spark, b["ppd"], f"{tmpdir_run}/month")
    with monkeypatch.context() as m:
        if stop.startswith("build"):
            m.setattr(pipeline, stop, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
        else:
            commit = VersionedTable._commit

            def failing(self, *args):
                if self.path.endswith(stop):
                    raise RuntimeError("stopped")
                return commit(self, *args)

            m.setattr(VersionedTable, "_commit", failing)
        with pytest.raises(RuntimeError, match="stopped"):
            pipeline.run_pipeline(spark, root, "incremental", RUN_TS + MONTH, ppd_path=month, **options)
    pipeline.run_pipeline(spark, root, "incremental", RUN_TS + MONTH, ppd_path=month, **options)
    assert pipeline.read(spark, root, "silver", "silver_ppd").count() == b["ppd"].count()
    _consistent(spark, root)


def test_a_repeated_run_time_with_new_rows_is_refused(spark, tmpdir_run):
    b, landing = _landing(spark, tmpdir_run)
    root = f"{tmpdir_run}/wh"
    run = lambda mode, path: pipeline.run_pipeline(
        spark, root, mode, RUN_TS, landing_dir=landing, ppd_path=path, min_rows=1, enforce_gate=False)
    run("full", _sales(spark, b["ppd"], f"{tmpdir_run}/full", "transfer_date < '1998-01-01'"))
    with pytest.raises(ValueError, match="later"):
        run("incremental", _sales(spark, b["ppd"], f"{tmpdir_run}/month"))


def test_a_redelivered_file_is_loaded_again(spark, tmpdir_run):
    landing, root = f"{tmpdir_run}/landing", f"{tmpdir_run}/wh"
    os.makedirs(landing)
    for turn, code in enumerate(("OLD", "NEW")):
        with open(f"{landing}/Rural_Urban_x.csv", "w") as fh:
            fh.write(f"lsoa21cd,ruc21cd\n{code},R1\n")
        pipeline.ingest_reference(spark, landing, root, RUN_TS + turn * MONTH)
        assert [r.lsoa21cd for r in pipeline.read(spark, root, "raw", "ruc_lsoa_2021").collect()] == [code]
    assert len(glob.glob(f"{tmpdir_run}/processed/*/Rural_Urban_x.csv")) == 2


def test_produce_then_consume(spark, tmpdir_run):
    b, landing = _landing(spark, tmpdir_run)
    raw, root, msgs = b["ppd"], f"{tmpdir_run}/wh", f"{tmpdir_run}/msgs"
    os.makedirs(msgs)
    run = lambda mode, ts, **more: pipeline.run_pipeline(
        spark, root, mode, ts, landing_dir=landing, messages_folder=msgs, as_of=dt.date(2001, 8, 20), min_rows=10, **more)
    r = run("full", RUN_TS, ppd_path=_sales(spark, raw, f"{tmpdir_run}/pp"))
    assert all(c["failures"] == 0 for c in r.checks if c["severity"] == "error")
    bronze = pipeline.read(spark, root, "raw", "ppd")
    want = raw.withColumn("_ingested_at", F.lit(RUN_TS)).select(*bronze.columns)
    assert _same(bronze, want)
    # no new message: neither bronze nor the position moves
    again = run("incremental", RUN_TS + MONTH)
    assert again.versions["raw_ppd"] == r.versions["raw_ppd"]
    assert pipeline.read(spark, root, "gold", "fact_sales").count() == raw.count()


def test_newest_landing_file_wins_across_prefixes(spark, tmpdir_run):
    landing = f"{tmpdir_run}/landing"
    os.makedirs(landing)
    header = ",".join(schemas.IMD_COLUMNS)

    def imd_file(name, code, mtime):
        row = [code, "name", "lad"] + ["1.0"] * (len(schemas.IMD_COLUMNS) - 3)
        with open(f"{landing}/{name}", "w") as fh:
            fh.write(header + "\n" + ",".join(row) + "\n")
        os.utime(f"{landing}/{name}", (mtime, mtime))

    imd_file("File_7_old.csv", "OLD", 1_000_000)
    imd_file("IoD2019_new.csv", "NEW", 2_000_000)
    root = f"{tmpdir_run}/wh"
    result = pipeline.ingest_reference(spark, landing, root, RUN_TS)
    codes = [r[0] for r in pipeline.read(spark, root, "raw", "imd").select("lsoa_code_2011").collect()]
    assert codes == ["NEW"] and [p.rsplit("/", 1)[1] for p in result.superseded] == ["File_7_old.csv"]
    assert os.listdir(landing) == []


def test_of_two_writers_the_second_fails(spark, tmpdir_run):
    rows = lambda *names: spark.createDataFrame([(n,) for n in names], "k string")
    one, two = VersionedTable(spark, f"{tmpdir_run}/t"), VersionedTable(spark, f"{tmpdir_run}/t")
    one.overwrite(rows("a"))
    started = two.manifest()
    one.upsert(rows("b"), "k", lambda cur, new: cur.unionByName(new))
    two.manifest = lambda version=None: started  # it began before the other's commit
    with pytest.raises(CommitConflict):
        two.upsert(rows("c"), "k", lambda cur, new: cur.unionByName(new))
    assert sorted(r.k for r in one.read().collect()) == ["a", "b"]
