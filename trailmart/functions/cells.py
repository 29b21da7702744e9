"""Strict reading of text cells: a cell that is not exactly of its type is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings, written so that Java's and RE2's engines agree.
INTEGER = r"^[+-]?[0-9]+$"
DECIMAL = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])$"
TIMESTAMP = r"^[0-9]{4}-(0[1-9]|1[0-2])-(0[1-9]|[12][0-9]|3[01])[ T]([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](\.0+)?$"
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def stripped(cell: Column) -> Column:
    """The cell without spaces around it; an empty one is null."""
    return F.nullif(F.trim(cell), F.lit(""))


def read_cell(cell: Column, kind: str) -> Column:
    """The cell as ``kind`` (tinyint..bigint, float, double, date, timestamp_ntz, string) or null.

    Spaces around it are dropped. Integers carry an optional sign and must fit the type,
    decimals may have fraction and exponent, dates and times must exist in the calendar.
    """
    text = F.trim(cell)
    # of these characters alone the casts read just what the patterns above allow, and a translation costs less than a match
    if kind in INTEGERS:
        return F.when(F.translate(text, "0123456789+-", "") == "", text.try_cast(kind))
    if kind in ("float", "double"):
        return F.when(F.translate(text, "0123456789+-.eE", "") == "", text.try_cast(kind))
    if kind == "date":
        return F.when(text.rlike(DATE), text.try_cast("date"))
    if kind == "timestamp_ntz":
        return F.when(text.rlike(TIMESTAMP), text.try_cast("timestamp_ntz"))
    return stripped(cell)
