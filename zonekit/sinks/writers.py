"""Sinks (K1-K9, A13 report, S10).

Writes are distributed (one file per task).  ``single_file`` funnels a
result through one task and is meant only for small aggregated results
such as a KPI table.  Overwrites only ever target our own output paths.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonekit.operators.clean import family_table, lookup_table, measure_table


def write(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] | None = None,
    cluster_by: Sequence[str] | None = None,
    single_file: bool = False,
    **options: str,
) -> None:
    """K1 (json), K5 (overwrite = full refresh), K6 (append), K7 (csv).

    ``cluster_by`` (K8, the compound index): range-partition on all the
    clustering columns (ranges come from a sample, so a hot leading value is
    split by the following columns instead of landing in one task) and sort
    within partitions; each file then covers a contiguous key range and zone
    lookups skip most row groups by their min/max statistics.
    """
    out = df
    if cluster_by:
        out = out.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    if single_file:
        out = out.coalesce(1)
    writer = out.write.mode(mode).format(fmt).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_single_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K7: one CSV part file with a header (aggregated results only)."""
    write(df, path, fmt="csv", mode=mode, single_file=True, header="true")


def write_family_table(df: DataFrame, path: str, key: str = "propertyCode", as_strings: bool = False) -> None:
    """K2: listing table with column families as structs."""
    write(family_table(df, key=key, as_strings=as_strings), path)


def write_measure_table(
    df: DataFrame,
    path: str,
    parts: Sequence[str] = ("Nom_Districte", "Nom_Barri", "Any"),
    values: dict[str, str] | None = None,
    as_strings: bool = True,
) -> None:
    """K3: composite-key measure table ``district-neighborhood-year``."""
    values = values or {"rfd": "Índex RFD Barcelona = 100", "population": "Població"}
    write(measure_table(df, parts, values, as_strings), path)


def write_lookup_table(linked: DataFrame, path: str, origin: Sequence[str], dest: Sequence[str]) -> None:
    """K4: origin ``district-neighborhood`` -> destination pair."""
    write(lookup_table(linked, origin, dest), path)


def save_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """K9 create/replace a catalog table (``saveAsTable``)."""
    df.write.mode(mode).format(fmt).saveAsTable(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """K9 drop (own tables only)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
