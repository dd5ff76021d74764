"""Row filters and projections of the listing clean-up.

Everything here is a narrow transformation: no shuffle, and filters on
plain columns are pushed into the Parquet/JSON scan by Catalyst.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonekit.functions.scalar import as_text, composite_key, numeric

# The listing attributes kept by the store and their column
# families (row key = propertyCode).
LISTING_FAMILIES: dict[str, list[str]] = {
    "cf1": ["district", "neighborhood", "price"],
    "cf2": ["date"],
    "cf3": ["latitude", "longitude"],
    "cf4": [
        "propertyType",
        "status",
        "size",
        "rooms",
        "bathrooms",
        "distance",
        "newDevelopment",
        "priceByArea",
    ],
}

# Attributes a listing must have, and the default place filter.
REQUIRED_LISTING_COLUMNS = ["propertyCode", "district", "neighborhood"]
DEFAULT_MUNICIPALITY = "Barcelona"


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """F1 (and F3 on a fixed schema): drop rows where any column is null
    (``IsNotNull`` filters, which reach the scan)."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in columns]))


def where_equals(df: DataFrame, column: str, value) -> DataFrame:
    """Equality filter; pushed to the scan."""
    return df.filter(F.col(column) == F.lit(value))


def with_constant(df: DataFrame, name: str, value) -> DataFrame:
    """Attach one constant column (e.g. the snapshot date)."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def cast_numeric(df: DataFrame, columns: Sequence[str], to: str = "double") -> DataFrame:
    """P3 on whole columns: bad text becomes null."""
    return df.withColumns({c: numeric(c, to, isinstance(df.schema[c].dataType, T.StringType)) for c in columns})


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Select and rename.  Source names with spaces or brackets are
    quoted, so ``Ocupacio_mitjana_(persones_ per_domicili)`` works."""
    cols = []
    for out, src in mapping.items():
        c = F.col(f"`{src}`") if isinstance(src, str) else src
        cols.append(c.alias(out))
    return df.select(*cols)


def clean_listings(
    df: DataFrame,
    municipality: str | None = DEFAULT_MUNICIPALITY,
    required: Sequence[str] = REQUIRED_LISTING_COLUMNS,
    numeric_columns: Sequence[str] = ("distance",),
) -> DataFrame:
    """F1 + F2 + P3: the listing clean-up of both generations."""
    out = require(df, required)
    if municipality is not None:
        out = where_equals(out, "municipality", municipality)
    present = [c for c in numeric_columns if c in out.columns]
    return cast_numeric(out, present)


def family_table(
    df: DataFrame,
    key: str = "propertyCode",
    families: Mapping[str, Sequence[str]] = LISTING_FAMILIES,
    as_strings: bool = False,
) -> DataFrame:
    """One key column plus one struct per column family.

    Stored as Parquet, reading ``cf2.date`` prunes the scan to that nested
    field -- the access pattern the families were designed for.
    """
    def cell(c: str) -> Column:
        if c not in df.columns:
            v = F.lit(None).cast("string")
        elif as_strings and c == "date":
            v = F.date_format(F.col(c), "yyyy-MM-dd")
        else:
            v = as_text(c, df.schema[c].dataType) if as_strings else F.col(c)
        return v.alias(c)

    return df.select(
        F.col(key).alias("key"),
        *[F.struct(*[cell(c) for c in cols]).alias(fam) for fam, cols in families.items()],
    )


def measure_table(df: DataFrame, parts: Sequence[str], values: Mapping[str, str], as_strings: bool = False) -> DataFrame:
    """K3: composite key, its parts and a struct ``cf1`` of measures (name -> source column).

    The separate key columns stay next to the display key, so joins never
    split it."""
    cells = [as_text(f"`{src}`", df.schema[src].dataType) if as_strings else F.col(f"`{src}`") for src in values.values()]
    keys = [F.col(f"`{p}`") for p in parts]
    return df.select(
        composite_key(*keys, escape=False).alias("key"),
        *keys,
        F.struct(*[c.alias(n) for c, n in zip(cells, values)]).alias("cf1"),
    )


def lookup_table(linked: DataFrame, origin: Sequence[str], dest: Sequence[str]) -> DataFrame:
    """K4: composite key of the origin and a struct ``cf1`` of the destination pair."""
    return linked.select(
        composite_key(*origin, escape=False).alias("key"),
        F.struct(*[F.col(d).alias(n) for d, n in zip(dest, ("district", "neighborhood"))]).alias("cf1"),
    )
