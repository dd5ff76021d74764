"""Column expressions: dates from names, casts, keys, ratios.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage code generation; none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Snapshot names start with the date as ``YYYY_MM_DD``
# (e.g. ``2020_01_02_<source>.json`` or a directory ``2020_01_02_<source>``).
SNAPSHOT_DATE_PATTERN = r"^(\d{4}_\d{2}_\d{2})"
SNAPSHOT_DATE_FORMAT = "yyyy_MM_dd"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_from_name(
    name: str | Column,
    pattern: str = SNAPSHOT_DATE_PATTERN,
    fmt: str = SNAPSHOT_DATE_FORMAT,
    strict: bool = False,
) -> Column:
    """Calendar date encoded at the start of a file or directory name.

    A name that does not match, or matches but is no calendar date, gives
    null, or fails the query when ``strict`` (the reference raises).  For
    the default ``YYYY_MM_DD`` prefix the date is parsed straight from the
    first ten characters (what the anchored pattern captures), which avoids
    a regular expression per row.
    """
    if pattern == SNAPSHOT_DATE_PATTERN and fmt == SNAPSHOT_DATE_FORMAT:
        parsed = F.try_to_date(F.substring(_col(name), 1, 10), fmt)
    else:
        token = F.regexp_extract(_col(name), pattern, 1)
        parsed = F.when(token != "", F.try_to_date(token, fmt))
    if strict:
        return F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("no date in name: "), _col(name)))).otherwise(parsed)
    return parsed


def parent_name(path: str | Column) -> Column:
    """Name of the directory that holds a file (a Parquet snapshot directory)."""
    return F.regexp_extract(_col(path), r"([^/]+)/[^/]+$", 1)


def file_name_date(strict: bool = False) -> Column:
    """P1 for file sources: snapshot date from ``_metadata.file_name``."""
    return date_from_name(F.col("_metadata.file_name"), strict=strict)


def directory_date(strict: bool = False) -> Column:
    """P1 for directory-per-date sources: date from the parent directory."""
    return date_from_name(parent_name(F.col("_metadata.file_path")), strict=strict)


# What a text must look like for a cast to succeed, and more: white space and
# control characters around it, a sign, digits; other numbers than whole ones may
# have any letter of an exponent, a hexadecimal number, infinity or not-a-number.
_WHOLE = r"^[\x00-\x20\x7F]*+[+-]?[0-9.]++[\x00-\x20\x7F]*+$"
_REAL = r"^[\x00-\x20\x7F]*+[+-]?(?:[0-9.]|(?i:nan|inf))[0-9a-fA-FxXpPiInNtTyY.+-]*+[\x00-\x20\x7F]*+$"
_WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint", "byte", "short", "integer", "long")


def numeric(c: str | Column, to: str = "double", text: bool = True) -> Column:
    """Cast *text* to a number; bad text becomes null instead of failing
    (Spark 4 is ANSI, where a plain cast of ``''`` raises).

    A bad text costs ``try_cast`` an exception, many times a good one's cast,
    so a pattern that every whole or floating point number meets turns most
    bad ones away first.  ``text=False`` is for columns that are no texts."""
    col = _col(c)
    pattern = _WHOLE if to.lower() in _WHOLE_TYPES else _REAL if to.lower() in ("double", "float") else None
    if not text or pattern is None:
        return col.try_cast(to)
    return F.when(col.rlike(pattern), col.try_cast(to))


def as_text(c: str | Column, kind: T.DataType | None = None) -> Column:
    """P4 option: stringify a value as the wide-row store did.

    With the value's type, floating point numbers from 0.0001 up to 1e16 are
    written without an exponent and truth values as ``True`` and ``False``.
    """
    col = _col(c)
    text = col.cast("string")
    if isinstance(kind, T.BooleanType):
        return F.when(col, F.lit("True")).when(~col, F.lit("False"))
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        size = F.abs(col)
        plain = F.regexp_replace(text.cast("double").try_cast("decimal(38,21)").cast("string"), "0+$", "")
        plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
        return F.when((size >= 1e-4) & (size < 1e16) & text.contains("E"), plain).otherwise(text)
    return text


def iso_date_text(c: str | Column) -> Column:
    """Date rendered as ``YYYY-MM-DD`` text (the stored date cell)."""
    return F.date_format(_col(c), "yyyy-MM-dd")


def parse_date_prefix(c: str | Column) -> Column:
    """``%Y-%m-%d`` prefix match of an ISO date or timestamp text."""
    return F.to_date(F.substring(_col(c), 1, 10), "yyyy-MM-dd")


def dash_free(c: str | Column, sep: str = "-") -> Column:
    """Replace the key separator inside a key part by a space."""
    return F.replace(_col(c), F.lit(sep), F.lit(" "))


def composite_key(*parts: str | Column, sep: str = "-", escape: bool = True) -> Column:
    """``a-b[-year]`` display key.  With ``escape`` the separator
    inside each part is replaced (P9) so that P10 can split it back.
    ``concat_ws`` skips null parts; joins use the separate columns."""
    cols = [dash_free(p, sep) if escape else _col(p) for p in parts]
    return F.concat_ws(sep, *[c.cast("string") for c in cols])


def split_key(c: str | Column, index: int, sep: str = "-") -> Column:
    """P10: 1-based part of a composite key; null when the key has fewer parts."""
    return F.try_element_at(F.split(_col(c), F.lit(sep)), F.lit(index))


def safe_ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Ratio that is null for a zero divisor instead of raising."""
    return F.try_divide(_col(numerator), _col(denominator))


def natural_log(c: str | Column) -> Column:
    """P12."""
    return F.ln(_col(c))


def strip_quotes_commas(c: str | Column) -> Column:
    """Clean-up of reconciled names: the lookups wrap names containing a
    comma in literal quotes; removing ``"`` and ``,`` gives the plain name."""
    return F.regexp_replace(_col(c), r'[",]', "")


def calendar_date(c: str | Column) -> Column:
    """Timestamp (with or without zone) to its calendar date."""
    return F.to_date(_col(c))


def year_of(c: str | Column) -> Column:
    return F.year(_col(c))
