"""Scalar column expressions used by the models.

Everything here returns a ``Column`` built from built-in Spark functions, so
the expressions stay inside whole-stage code generation; nothing here is a
Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- postcode -------------------------------------------------------------

def normalize_postcode(col: ColumnOrName, empty_for_null: bool = True) -> Column:
    """Upper-case and strip every space.

    With ``empty_for_null`` a NULL postcode becomes ``''`` (sales side);
    without it NULL stays NULL (postcode-directory side).
    """
    c = _c(col)
    if empty_for_null:
        c = F.coalesce(c, F.lit(""))
    return F.replace(F.upper(c), F.lit(" "), F.lit(""))


def is_present(col: ColumnOrName) -> Column:
    """Not NULL and not the empty string."""
    c = _c(col)
    return c.isNotNull() & (c != F.lit(""))


# --- surrogate keys -------------------------------------------------------

def md5_key(*cols: ColumnOrName) -> Column:
    """MD5 (lower-case hex) of the pipe-joined attributes, NULL spelled 'NULL'.

    Booleans are rendered as ``true``/``false`` before joining.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit("NULL")) for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def version_key(postcode: ColumnOrName, introduced: ColumnOrName) -> Column:
    """MD5 of normalised postcode directly followed by the introduction month."""
    return F.md5(F.concat(normalize_postcode(postcode, empty_for_null=False),
                          F.coalesce(_c(introduced), F.lit(""))))


# --- code descriptions ----------------------------------------------------

# Code -> description, with 'Unknown' for anything else.
PROPERTY_TYPE_DESC = {
    "D": "Detached",
    "S": "Semi-Detached",
    "T": "Terraced",
    "F": "Flats/Maisonettes",
    "O": "Other",
}
TENURE_DESC = {"F": "Freehold", "L": "Leasehold"}
CATEGORY_TYPE_DESC = {"A": "Standard Price Paid", "B": "Additional Price Paid"}
ACCEPTED_PROPERTY_TYPES = ["D", "S", "T", "F", "O"]


def describe(col: ColumnOrName, mapping: dict[str, str], default: str = "Unknown") -> Column:
    """``CASE col WHEN k THEN v ... ELSE default END`` as a when-chain."""
    c = _c(col)
    out = None
    for code, text in mapping.items():
        out = F.when(c == F.lit(code), F.lit(text)) if out is None else out.when(c == F.lit(code), F.lit(text))
    return out.otherwise(F.lit(default))


# --- dates ----------------------------------------------------------------

def date_key(col: ColumnOrName) -> Column:
    """Integer ``YYYYMMDD`` of a date (arithmetic, no string formatting)."""
    d = _c(col)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def iso_day_of_week(col: ColumnOrName) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return (F.weekday(_c(col)) + 1).cast("int")


def month_name(col: ColumnOrName, pad: bool = False) -> Column:
    """Full English month name; ``pad`` blank-pads to 9 characters."""
    out = F.date_format(_c(col), "MMMM")
    return F.rpad(out, 9, " ") if pad else out


def day_name(col: ColumnOrName, pad: bool = False) -> Column:
    """Full English day name; ``pad`` blank-pads to 9 characters."""
    out = F.date_format(_c(col), "EEEE")
    return F.rpad(out, 9, " ") if pad else out


def is_weekend(col: ColumnOrName) -> Column:
    return iso_day_of_week(col).isin(6, 7)


def month_start(col: ColumnOrName, default: str = "1900-01-01") -> Column:
    """``YYYYMM`` text -> first day of that month; NULL or '' -> ``default``.

    The empty case is guarded before parsing, so ANSI mode never sees ''.
    """
    c = _c(col)
    return (F.when(c.isNull() | (c == F.lit("")), F.lit(default).cast("date"))
            .otherwise(F.to_date(c, "yyyyMM")))


def month_end(col: ColumnOrName, default: str = "2099-12-31") -> Column:
    """``YYYYMM`` text -> last day of that month; NULL or '' -> ``default``."""
    c = _c(col)
    return (F.when(c.isNull() | (c == F.lit("")), F.lit(default).cast("date"))
            .otherwise(F.last_day(F.to_date(c, "yyyyMM"))))


def parse_transfer_date(col: ColumnOrName, fmt: str = "yyyy-MM-dd HH:mm") -> Column:
    """Text ``yyyy-MM-dd HH:mm`` -> date; anything unparsable -> NULL."""
    return F.to_date(F.try_to_timestamp(_c(col), F.lit(fmt)))


def parse_iso_timestamp(col: ColumnOrName) -> Column:
    """ISO-8601 text with optional fraction -> timestamp; failure -> NULL."""
    return F.try_to_timestamp(_c(col), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"))


def days_since(col: ColumnOrName, as_of: _dt.date | str | None = None) -> Column:
    ref = F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")
    return F.datediff(ref, _c(col))


# --- flags ----------------------------------------------------------------

def yes_flag(col: ColumnOrName) -> Column:
    """``'Y'`` -> true, any other text -> false, NULL stays NULL."""
    return _c(col) == F.lit("Y")


def yes_flag_text(col: ColumnOrName) -> Column:
    """``'Y'`` -> ``'true'``, other text -> ``'false'``, NULL stays NULL."""
    c = _c(col)
    return F.when(c.isNull(), F.lit(None).cast("string")).when(c == F.lit("Y"), F.lit("true")).otherwise(F.lit("false"))


def text_bool(col: ColumnOrName) -> Column:
    """Case-insensitive ``'true'`` -> true, other text -> false, NULL stays NULL."""
    return F.lower(_c(col)) == F.lit("true")


# --- numbers --------------------------------------------------------------

def mean(col: ColumnOrName) -> Column:
    """Average as DOUBLE: exact decimal sum divided by the non-null count.

    Used for every average in the marts so results are the same whichever
    engine reads the tables back (decimal AVG precision differs by engine).
    """
    c = _c(col)
    return F.sum(c).cast("double") / F.count(c)


def round_half_up(col: ColumnOrName, digits: int) -> Column:
    """``ROUND(x::NUMERIC, n)``: half away from zero on the decimal text of x."""
    return F.round(_c(col), digits)


def pct(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator * 100`` as DOUBLE (NULL on an empty table)."""
    return numerator.cast("double") / F.nullif(denominator, F.lit(0)).cast("double") * F.lit(100.0)
