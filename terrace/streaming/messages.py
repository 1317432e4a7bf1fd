"""Sale rows <-> JSON messages on the transaction topic."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace import schemas
from terrace.functions import parse_iso_timestamp, parse_transfer_date, text_bool, yes_flag_text

# Timestamps are written with microseconds; the default JSON format drops them.
JSON_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def encode(ppd_text: DataFrame, ingested_at: _dt.datetime | str, mode: str) -> DataFrame:
    """File rows (text cells) -> ``key``/``value`` JSON messages.

    ``new_build`` Y/N becomes the text ``true``/``false``; the load time is
    ISO text so the message stays portable.  The key is the transaction id.
    """
    stamp = ingested_at if isinstance(ingested_at, str) else ingested_at.isoformat(timespec="microseconds")
    row = ppd_text.select(
        *[yes_flag_text(c).alias(c) if c == "new_build" else F.col(c).cast("string").alias(c)
          for c in schemas.PPD_COLUMNS],
        F.lit(stamp).alias("_ingested_at"),
        F.lit(mode).alias("_source_mode"),
    )
    return row.select(F.col("transaction_id").alias("key"),
                      F.to_json(F.struct(*schemas.RAW_PPD_COLUMNS), JSON_OPTIONS).alias("value"))


def decode(messages: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """JSON messages -> typed ``raw.ppd`` rows.

    Absent fields become NULL (declared schema); price is cast to
    DECIMAL(12,2) (a malformed price fails the batch, as the table would), the transfer date parsed from ``yyyy-MM-dd HH:mm`` and the
    load time from ISO text (unparsable -> NULL), ``new_build`` from
    case-insensitive ``true``.  ``keep`` carries extra columns (offsets).
    """
    m = F.from_json(F.col(value_col).cast("string"), schemas.MESSAGE)
    parsed = messages.select(*(keep or []), m.alias("m")).select(*(keep or []), "m.*")
    typed = []
    for c in schemas.RAW_PPD_COLUMNS:
        col = F.col(c)
        if c == "price":
            col = col.cast("decimal(12,2)")
        elif c == "transfer_date":
            col = parse_transfer_date(col)
        elif c == "new_build":
            col = text_bool(col)
        elif c == "_ingested_at":
            col = parse_iso_timestamp(col)
        typed.append(col.alias(c))
    return parsed.select(*(keep or []), *typed)


def to_file_text(raw: DataFrame) -> DataFrame:
    """Typed ``raw.ppd`` rows back to the text cells of the transaction file
    (date as ``yyyy-MM-dd HH:mm``, flag as Y/N)."""
    cells = []
    for c in schemas.PPD_COLUMNS:
        col = F.col(c)
        if c == "transfer_date":
            col = F.date_format(col, "yyyy-MM-dd HH:mm")
        elif c == "new_build":
            col = F.when(col.isNull(), F.lit(None).cast("string")).when(col, F.lit("Y")).otherwise(F.lit("N"))
        cells.append(col.cast("string").alias(c))
    return raw.select(*cells)
