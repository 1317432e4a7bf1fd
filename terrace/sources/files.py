"""File sources: the headerless transaction CSV, headered reference CSVs,
landing-zone routing, and named warehouse tables."""

from __future__ import annotations

import datetime as _dt
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrace import schemas
from terrace.functions import parse_transfer_date, yes_flag

# Landing-file name prefix -> bronze table (two prefixes feed
# the deprivation table).
REFERENCE_MAP = {
    "ONSPD": "onspd",
    "Rural_Urban": "ruc_lsoa_2021",
    "IoD2019": "imd",
    "File_7": "imd",
}
# Columns a reference table must hold (its declared columns; for the other two
# tables silver picks the original or the snake form of a header).
REFERENCE_SCHEMAS: dict[str, T.StructType | None] = {
    "onspd": schemas.RAW_ONSPD,
    "ruc_lsoa_2021": None,
    "imd": None,
}

# CSV by the standard: a quote inside a quoted cell is doubled, a backslash is
# an ordinary character.  A quoted empty cell is an empty string, an unquoted
# one is missing (no cell of these files is the single control character).
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "nullValue": "\x01", "emptyValue": ""}
# Blanks around a cell are part of it (Spark's writer would cut them off).
CSV_WRITE_OPTIONS = {"quote": '"', "escape": '"', "nullValue": "", "emptyValue": '""',
                     "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_ppd_text(spark: SparkSession, path: str) -> DataFrame:
    """Headerless transaction file as 16 text columns.

    PERMISSIVE: a short row yields NULLs for its missing tail; nothing fails.
    """
    return spark.read.schema(schemas.PPD_TEXT).options(header=False, **CSV_OPTIONS).csv(path)


def type_ppd(text: DataFrame, ingested_at: _dt.datetime, source_mode: str) -> DataFrame:
    """Text cells -> typed ``raw.ppd`` rows plus load metadata.

    A cell that does not parse becomes NULL (lenient, like the file loader).
    """
    cols = []
    for c in schemas.PPD_COLUMNS:
        col = F.col(c)
        if c == "price":
            col = col.try_cast("decimal(12,2)")
        elif c == "transfer_date":
            col = parse_transfer_date(col)
        elif c == "new_build":
            col = yes_flag(col)
        cols.append(col.alias(c))
    return text.select(*cols, F.lit(ingested_at).cast("timestamp").alias("_ingested_at"),
                       F.lit(source_mode).alias("_source_mode"))


def read_ppd(spark: SparkSession, path: str, mode: str, ingested_at: _dt.datetime) -> DataFrame:
    return type_ppd(read_ppd_text(spark, path), ingested_at, mode)


def bootstrap_ppd(spark: SparkSession, path: str) -> DataFrame:
    """Bulk load of the 16 file columns; metadata columns stay NULL."""
    typed = type_ppd(read_ppd_text(spark, path), _dt.datetime(1970, 1, 1), "full")
    return typed.withColumn("_ingested_at", F.lit(None).cast("timestamp")) \
                .withColumn("_source_mode", F.lit(None).cast("string"))


def read_reference(spark: SparkSession, paths: str | list[str], table: str) -> DataFrame:
    """Headered reference CSV files of one delivery, columns found by name.

    Cells are read as text; the header of the first file names them, and a
    file whose header differs fails the read.  Declared columns are cast (a
    cell that does not parse becomes NULL) and must all be there.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    header = spark.read.options(header=True, **CSV_OPTIONS).csv(paths[0]).columns
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    rows = (spark.read.schema(text).options(header=True, enforceSchema=False, **CSV_OPTIONS).csv(paths))
    declared = REFERENCE_SCHEMAS.get(table)
    if declared is None:
        return rows
    by_name = {c.strip().lower(): c for c in header}
    missing = [f.name for f in declared.fields if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"{paths[0]}: no column {', '.join(missing)} for {table}")
    return rows.select(*[F.col(f"`{by_name[f.name.lower()]}`").try_cast(f.dataType).alias(f.name)
                         for f in declared.fields])


# A part of a delivery says so: ``..._part-7.csv``, ``..._part_00012.csv``, or
# ``..._part-7-of-120.csv``.  A bare trailing number is a date or a version.
_PART = re.compile(r"[._-]part[._-]?(\d+)(?:[._-]?of[._-]?(\d+))?$", re.IGNORECASE)


def _delivery(below: str) -> tuple[str, int | None, int | None]:
    """(delivery, part, parts) of a file given by its path below the landing
    folder.  A folder is one delivery with whatever files it holds (as Spark
    writes them); a single file, or files that differ only in their part."""
    if "/" in below:
        return below.split("/", 1)[0], None, None
    name = below.removesuffix(".csv")
    part = _PART.search(name)
    if not part:
        return name, None, None
    return name[:part.start()], int(part[1]), int(part[2]) if part[2] else None


@dataclass
class Landing:
    """Files of a table's newest delivery, files of older ones, and what is to
    be moved away once they are loaded (a delivery's folder, or its files)."""
    files: list[str]
    superseded: list[str]
    entries: list[str] = field(default_factory=list)


def _check_parts(table: str, name: str, found: list[tuple]) -> None:
    """A delivery whose files say how many there are must be whole, and no
    part may come twice."""
    numbers = [part for _, _, part, _ in found if part is not None]
    if len(numbers) != len(set(numbers)):
        raise ValueError(f"delivery {name} for {table} holds a part twice")
    stated = {parts for _, _, _, parts in found if parts is not None}
    if stated and stated != {len(found)}:
        raise ValueError(f"delivery {name} for {table} has {len(found)} of {max(stated)} parts")


def landing_files(spark: SparkSession, landing_dir: str) -> dict[str, Landing]:
    """Route landing ``*.csv`` files to bronze tables by the prefix of their
    delivery's name.

    Only names and times are listed; unknown deliveries are skipped.  Of several
    deliveries for one table the newest counts, with all its files; two that
    are equally new cannot be told apart and raise, as does one that is not whole.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
               .load(landing_dir).select("path", "modificationTime"))
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing_dir.rstrip("/")).toUri().getPath()
    routed: dict[str, dict[str, list]] = {}
    entries: dict[tuple[str, str], set[str]] = {}
    for row in listing.collect():  # one row per file, not per record
        base, below = row["path"].split(f"{root}/", 1)
        delivery, part, parts = _delivery(below)
        for prefix, table in REFERENCE_MAP.items():
            if delivery.startswith(prefix):
                routed.setdefault(table, {}).setdefault(delivery, []).append(
                    (row["modificationTime"], row["path"], part, parts))
                entries.setdefault((table, delivery), set()).add(f"{base}{root}/{below.split('/', 1)[0]}")
                break
    out = {}
    for table, deliveries in routed.items():
        times = {name: max(f[0] for f in found) for name, found in deliveries.items()}
        newest = [name for name, t in times.items() if t == max(times.values())]
        if len(newest) > 1:
            raise ValueError(f"deliveries {sorted(newest)} for {table} are equally new")
        _check_parts(table, newest[0], deliveries[newest[0]])
        out[table] = Landing(sorted(f[1] for f in deliveries[newest[0]]),
                             sorted(f[1] for n, found in deliveries.items() if n != newest[0] for f in found),
                             sorted(e for n in deliveries for e in entries[table, n]))
    return out
