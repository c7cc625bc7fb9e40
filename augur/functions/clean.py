"""Cleaning helpers, Column -> Column (F1-F10, P4, F6). All JVM-side."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnOrName) -> Column:
    """NULLIF(TRIM(s), ''): blank or space-only text becomes NULL."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def normalize_tag(c: ColumnOrName) -> Column:
    """LOWER(TRIM(s)) (F1, F2)."""
    return F.lower(F.trim(_c(c)))


def normalize_vocab(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Trim, then map listed variants onto their controlled value.

    The mapping is a handful of literals folded into one CASE expression; a
    large vocabulary belongs in a table joined on the trimmed value.
    """
    trimmed = F.trim(_c(c))
    if not mapping:
        return trimmed
    expr = None
    for variant, canonical in mapping.items():
        cond = trimmed == F.lit(variant)
        expr = F.when(cond, F.lit(canonical)) if expr is None else expr.when(cond, F.lit(canonical))
    return expr.otherwise(trimmed)


def is_blank_or_null(c: ColumnOrName, data_type: T.DataType | None = None) -> Column:
    """``c IS NULL OR c = ''`` (P4); NULL-safe, never returns NULL."""
    col = _c(c)
    if data_type is not None and not isinstance(data_type, T.StringType):
        return col.isNull()
    return col.isNull() | F.coalesce(col.cast("string") == F.lit(""), F.lit(False))


def is_complete(*cols: ColumnOrName) -> Column:
    """Profile flag (F6): TRUE when none of the columns is NULL or ''."""
    flag = F.lit(True)
    for c in cols:
        flag = flag & ~is_blank_or_null(c)
    return flag


def typed_int(c: ColumnOrName, bits: int = 32) -> Column:
    """Strict cast of text to an integer (F7): bad text fails under ANSI."""
    return _c(c).cast("int" if bits == 32 else "bigint")


def typed_timestamp(c: ColumnOrName) -> Column:
    """Strict cast of text to a zone-free timestamp (F8)."""
    return _c(c).cast("timestamp_ntz")


def typed_date(c: ColumnOrName) -> Column:
    """Strict cast of text to a date (F8)."""
    return _c(c).cast("date")


# An ISO date is four, two and two digits (a time may follow);
# the layouts besides it are the prose one of the demographics extract, e.g.
# "March 15, 2023" (full English month name, 1- or 2-digit day), and slashes.
ISO_DATE = r"^\s*\d{4}-\d{1,2}-\d{1,2}(?:[ T].*)?\s*$"
PROSE_DATE_FORMAT = "MMMM d, yyyy"
SLASH_DATE_FORMAT = "yyyy/M/d"


def iso_date(c: ColumnOrName) -> Column:
    """Text in full ISO shape as a date, else NULL: Spark's cast alone also
    takes a bare year or year and month."""
    col = _c(c)
    return F.when(col.rlike(ISO_DATE), col.try_cast("date"))


def parse_mixed_dates(
    c: ColumnOrName, formats: Sequence[str] = (SLASH_DATE_FORMAT, PROSE_DATE_FORMAT)
) -> Column:
    """COALESCE(TRY_CAST(s AS DATE), TRY_TO_DATE(s, fmt), ...)."""
    col = _c(c)
    return F.coalesce(iso_date(col), *[F.try_to_date(col, f) for f in formats])


def unparsable_iso_date(c: ColumnOrName) -> Column:
    """TRUE when text is present but is not a date in ISO or slash shape (Q3 detector)."""
    col = _c(c)
    return col.isNotNull() & F.coalesce(iso_date(col), F.try_to_date(col, SLASH_DATE_FORMAT)).isNull()
