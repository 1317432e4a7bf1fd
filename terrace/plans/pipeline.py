"""The monthly warehouse run: landing files -> bronze -> silver -> gold -> mart
-> quality gate, all as Spark jobs over tables under one root.

Every table is a ``VersionedTable`` (``<root>/<layer>/<table>``): a reader sees
one committed version or the next, never half of one.  Sales tables (bronze,
silver, fact) are partitioned by sale year, so an incremental run rewrites only
the years it touches; reference and dimension models are rebuilt in full.

A run that stops anywhere can be repeated: what a step has taken in of the
table before it is recorded with the step's own table, not in the process.
"""

from __future__ import annotations

import datetime as _dt
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace import schemas
from terrace.operators import incremental as inc
from terrace.operators import quality, refcount
from terrace.plans import gold, marts, silver
from terrace.sinks.tables import Manifest, VersionedTable
from terrace.sources import files
from terrace.streaming import ingest

# Names under which a table records the version of its source it has taken in.
SILVER_VERSION = "silver_ppd version"
BRONZE_VERSION = "raw_ppd version"


@dataclass
class RunResult:
    mode: str
    versions: dict[str, int] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    superseded: list[str] = field(default_factory=list)
    late_rows: int = 0
    rejected_messages: int = 0
    checks: list[dict] = field(default_factory=list)


def table(spark: SparkSession, root: str, layer: str, name: str) -> VersionedTable:
    """A warehouse table with its partitioning and recorded maxima."""
    options = {
        "raw/ppd": (lambda: F.year("transfer_date"), ["transaction_id"], ["transfer_date"]),
        "silver/silver_ppd": (lambda: F.year("transfer_date"), ["transaction_id"], ["transfer_date", "dbt_updated_at"]),
        "gold/fact_sales": (lambda: (F.col("date_key") / 10000).cast("int"), ["date_key", "transaction_id"],
                            ["silver_updated_at"]),
    }.get(f"{layer}/{name}", ())
    return VersionedTable(spark, f"{root}/{layer}/{name}", *options)


def read(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame:
    return table(spark, root, layer, name).read()


def _archive(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Move landing files and folders into ``folder`` (a new one per run, so
    what is delivered again under its old name finds its place free)."""
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    target = Path(folder)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target)
    for path in paths:
        if not fs.rename(Path(path), Path(target, path.rsplit("/", 1)[-1])):
            raise OSError(f"cannot archive {path} to {folder}")


def ingest_reference(spark: SparkSession, landing_dir: str, root: str, run_ts: _dt.datetime,
                     archive_dir: str | None = None) -> RunResult:
    """Load the newest delivery of every reference table (truncate and load),
    then archive the files read and those superseded by newer ones.

    The archive is ``processed/<run>`` next to the landing folder by default.
    A run that stops between load and archive loads the same files again.
    """
    result = RunResult("reference")
    archive = archive_dir or os.path.join(os.path.dirname(landing_dir.rstrip("/")), "processed")
    for name, found in files.landing_files(spark, landing_dir).items():
        rows = (files.read_reference(spark, found.files, name)
                .withColumn("_ingested_at", F.lit(run_ts).cast("timestamp"))
                .withColumn("_source_mode", F.lit("full")))
        bronze = table(spark, root, "raw", name)
        result.versions[f"raw_{name}"] = bronze.overwrite(rows)
        result.loaded[name] = bronze.read().count()
        result.superseded += found.superseded
        _archive(spark, found.entries, f"{archive}/{run_ts:%Y%m%dT%H%M%S%f}")
    return result


def ingest_ppd_file(spark: SparkSession, path: str, root: str, mode: str, run_ts: _dt.datetime) -> int:
    """Bronze sales from the transaction file: full replaces, incremental
    replaces rows of the same key."""
    rows = files.read_ppd(spark, path, mode, run_ts)
    bronze = table(spark, root, "raw", "ppd")
    if mode == "full":
        return bronze.overwrite(rows)
    return bronze.upsert(rows, "transaction_id", lambda cur, new: inc.replace_by_key(cur, new, "transaction_id"))


def build_silver(spark: SparkSession, root: str, mode: str, run_ts: _dt.datetime) -> tuple[dict[str, int], int]:
    """Silver models; returns their versions and the number of sales that
    arrived late (at or before the mark: the strict mark never loads them).

    Late sales are judged as they arrive: among the bronze years changed since
    the version silver has taken in, those whose key these years did not hold
    before.  No other year is read.  Where that version is gone, or nothing
    recorded it, all of bronze is compared with silver.
    """
    bronze = table(spark, root, "raw", "ppd")
    sales = table(spark, root, "silver", "silver_ppd")
    out: dict[str, int] = {}
    late = 0
    current, arrived = sales.manifest(), bronze.manifest()
    if mode == "full" or not current.parts:
        out["silver_ppd"] = sales.overwrite(silver.silver_ppd(bronze.read(), run_ts), arrived.version, BRONZE_VERSION)
    else:
        # High-water mark from the manifest's per-partition maxima: no scan;
        # bronze partitions that cannot hold a newer date are not read.
        mark = sales.mark("transfer_date", inc.DEFAULT_DATE_MARK, current)
        raw = bronze.read_newer("transfer_date", mark)
        if raw is None:
            raw = spark.createDataFrame([], schemas.RAW_PPD)
        new = silver.silver_ppd(inc.newer_than(raw, "transfer_date", mark), run_ts)
        stamp = sales.mark("dbt_updated_at", inc.DEFAULT_TS_MARK, current)
        # Later layers take rows stamped after their mark, so a stamp that is
        # already there would hide the new rows from them.
        if run_ts <= stamp and not new.isEmpty():
            raise ValueError(f"run_ts {run_ts} must be later than the last load's {stamp}")
        late = late_sales(bronze, sales, current, mark).count()
        if run_ts > stamp:
            out["silver_ppd"] = sales.upsert(
                new, "transaction_id", lambda cur, n: inc.replace_by_key(cur, n, "transaction_id"),
                arrived.version, BRONZE_VERSION)
    for name, model, source in (("silver_onspd", silver.silver_onspd, "onspd"),
                                ("silver_ruc", silver.silver_ruc, "ruc_lsoa_2021"),
                                ("silver_imd", silver.silver_imd, "imd")):
        out[name] = table(spark, root, "silver", name).overwrite(model(read(spark, root, "raw", source)))
    return out, late


def late_sales(bronze: VersionedTable, sales: VersionedTable, current: Manifest, mark: _dt.date) -> DataFrame:
    """Bronze rows at or before ``mark`` that arrived since silver version ``current``.

    A key that bronze held before has been loaded or counted then; an upsert
    rewrites both years of a key that moves, so its old row is among the
    changed years as they were.
    """
    delta = _changed(bronze, current.streams.get(BRONZE_VERSION), schemas.RAW_PPD)
    now, known = delta or (bronze.read(), sales.read(manifest=current))
    return inc.late_rows(now, known, "transfer_date", mark, "transaction_id")


def _changed(source: VersionedTable, taken: int | None, schema) -> tuple[DataFrame, DataFrame] | None:
    """Rows of the partitions that changed since version ``taken``: as they are
    now and as they were.  None if that version is gone."""
    spark = source.spark
    now = source.manifest()
    before = None if taken is None else source.manifest(taken)
    if before is None:
        return None

    def part(m: Manifest, other: Manifest) -> DataFrame:
        found = {p: v for p, v in m.parts.items() if other.parts.get(p, (None,))[0] != v[0]}
        rows = source.read(manifest=Manifest(m.version, found)) if found else None
        return spark.createDataFrame([], schema) if rows is None else rows

    return part(now, before), part(before, now)


def _distinct_dimension(spark: SparkSession, root: str, mode: str, name: str, cols: list[str], rows) -> int:
    """A distinct dimension from the counts of silver rows behind each member.

    The counts know the silver version they hold; the partitions changed since
    then are counted anew (added) and as they were (removed), whichever run
    changed them.  Without that version the counts are built from all of silver.
    """
    sales = table(spark, root, "silver", "silver_ppd")
    counts = table(spark, root, "gold", f"_counts_{name}")
    seen = counts.manifest()
    version = sales.version()
    known = mode != "full" and seen.parts
    delta = _changed(sales, seen.streams.get(SILVER_VERSION), schemas.SILVER_PPD) if known else None
    if delta is None:
        counts.overwrite(refcount.counts(sales.read(), cols), version, SILVER_VERSION)
    elif seen.streams[SILVER_VERSION] != version:
        counts.overwrite(refcount.apply_delta(counts.read(manifest=seen), *delta, cols), version, SILVER_VERSION)
    return table(spark, root, "gold", name).overwrite(rows(counts.read().select(*cols)))


def build_gold(spark: SparkSession, root: str, mode: str, run_ts: _dt.datetime) -> dict[str, int]:
    sales = table(spark, root, "silver", "silver_ppd")
    out = {
        "dim_geography": table(spark, root, "gold", "dim_geography").overwrite(gold.dim_geography(
            *[read(spark, root, "silver", n) for n in ("silver_onspd", "silver_ruc", "silver_imd")])),
        "dim_property": _distinct_dimension(spark, root, mode, "dim_property", schemas.PROPERTY_COLUMNS, gold.property_rows),
        "dim_location": _distinct_dimension(spark, root, mode, "dim_location", schemas.ADDRESS_COLUMNS, gold.location_rows),
        "dim_date": table(spark, root, "gold", "dim_date").overwrite(gold.dim_date(spark)),
    }
    fact = table(spark, root, "gold", "fact_sales")
    current = fact.manifest()
    if mode == "full" or not current.parts:
        out["fact_sales"] = fact.overwrite(gold.fact_sales(sales.read(), run_ts))
    else:
        mark = fact.mark("silver_updated_at", inc.DEFAULT_TS_MARK, current)
        # Only silver partitions updated after the mark are read.
        changed = sales.read_newer("dbt_updated_at", mark)
        if changed is None:
            changed = spark.createDataFrame([], schemas.SILVER_PPD)
        new = gold.fact_sales(inc.newer_than(changed, "dbt_updated_at", mark), run_ts)
        out["fact_sales"] = fact.upsert(new, "transaction_id",
                                        lambda cur, n: inc.replace_by_key(cur, n, "transaction_id"))
    return out


def build_mart(spark: SparkSession, root: str) -> DataFrame:
    fact, dates, geography, properties = (
        read(spark, root, "gold", n) for n in ("fact_sales", "dim_date", "dim_geography", "dim_property"))
    table(spark, root, "gold", "mart_rural_urban_stats").overwrite(
        marts.mart_rural_urban(fact, dates, geography, properties))
    return read(spark, root, "gold", "mart_rural_urban_stats")


def run_checks(spark: SparkSession, root: str, as_of: _dt.date, min_rows: int = quality.MIN_FACT_ROWS,
               enforce: bool = True) -> list[dict]:
    report = quality.quality_report(
        read(spark, root, "silver", "silver_ppd"), read(spark, root, "gold", "fact_sales"),
        read(spark, root, "gold", "dim_date"), read(spark, root, "gold", "mart_rural_urban_stats"), as_of, min_rows)
    if enforce:
        return quality.gate(report)
    return [r.asDict() for r in report.collect()]


def run_pipeline(spark: SparkSession, root: str, mode: str, run_ts: _dt.datetime, *,
                 landing_dir: str | None = None, ppd_path: str | None = None,
                 messages_folder: str | None = None, bootstrap_servers: str | None = None,
                 as_of: _dt.date | None = None, min_rows: int = quality.MIN_FACT_ROWS,
                 enforce_gate: bool = True) -> RunResult:
    """One monthly run in dependency order; ``mode`` is ``full`` or ``incremental``.

    With a transaction file and a topic (or message folder) the file's rows are
    produced to the topic first and bronze consumes them; with a file alone
    bronze reads it; with a topic alone bronze consumes what waits there.
    """
    res = RunResult(mode)
    if landing_dir:
        loaded = ingest_reference(spark, landing_dir, root, run_ts)
        res.versions.update(loaded.versions)
        res.loaded.update(loaded.loaded)
        res.superseded = loaded.superseded
    if messages_folder or bootstrap_servers:
        where = {"folder": messages_folder, "bootstrap_servers": bootstrap_servers}
        if ppd_path:
            ingest.publish(files.read_ppd_text(spark, ppd_path), run_ts, mode, **where)
        res.versions["raw_ppd"] = ingest.consume(spark, f"{root}/raw/ppd", mode, run_id=run_ts, **where)
        res.rejected_messages = ingest.rejected(spark, f"{root}/raw/ppd")
    elif ppd_path:
        res.versions["raw_ppd"] = ingest_ppd_file(spark, ppd_path, root, mode, run_ts)
    versions, res.late_rows = build_silver(spark, root, mode, run_ts)
    res.versions.update(versions)
    res.versions.update(build_gold(spark, root, mode, run_ts))
    build_mart(spark, root)
    res.checks = run_checks(spark, root, as_of or run_ts.date(), min_rows, enforce_gate)
    return res
