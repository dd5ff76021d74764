"""ETL flows (ETL1, ETL2): read, clean, dedupe, link, store, count."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.operators.aggregate import table_counts
from zonekit.operators.dedup import upsert_in_load_order
from zonekit.operators.reconcile import link_lookups, unlinked
from zonekit.plans.kpi import latest_listings
from zonekit.sinks.tables import append_batch, create_keyed, put_rows
from zonekit.sinks.writers import write, write_family_table, write_lookup_table, write_measure_table
from zonekit.sources import readers


def _ids(lookup: DataFrame) -> DataFrame:
    return lookup.select("district", "neighborhood", "district_id", "neighborhood_id")


def _readable(inputs: dict[str, DataFrame], out_dir: str, on_bad: str) -> dict[str, DataFrame]:
    """The inputs without records that cannot be read; these are written to ``out_dir``/rejected."""
    if on_bad != "keep":
        return inputs
    split = {name: readers.split_bad(df) for name, df in inputs.items()}
    reports = [bad.select(F.lit(name).alias("input"), "*") for name, (_, bad) in split.items()]
    write(readers.union_snapshots(reports), os.path.join(out_dir, "rejected"))
    return {name: good for name, (good, _) in split.items()}


def link_pair_lookups(listing_lookup: DataFrame, income_lookup: DataFrame) -> tuple[DataFrame, DataFrame]:
    """J1 both directions on (district_id, neighborhood_id).

    Result columns: origin ``district, neighborhood`` and destination
    ``income_district, income_neighborhood`` (or the reverse names)."""
    ids = ["district_id", "neighborhood_id"]
    a = upsert_in_load_order(_ids(listing_lookup), ["district", "neighborhood"])
    b = upsert_in_load_order(_ids(income_lookup), ["district", "neighborhood"])
    b_named = b.select(F.col("district").alias("income_district"), F.col("neighborhood").alias("income_neighborhood"), *ids)
    a_named = a.select(F.col("district").alias("listing_district"), F.col("neighborhood").alias("listing_neighborhood"), *ids)
    to_income = link_lookups(a, b_named, ids, ["income_district", "income_neighborhood"])
    to_listing = link_lookups(b, a_named, ids, ["listing_district", "listing_neighborhood"])
    return to_income, to_listing


def etl1(
    spark: SparkSession,
    listings_dir: str,
    income_dir: str,
    listing_lookup_csv: str,
    income_lookup_csv: str,
    out_dir: str,
    as_strings: bool = True,
    on_bad: str = "fail",
) -> DataFrame:
    """ETL1: snapshots -> clean -> latest per key -> family table (K2);
    income CSVs -> last write wins per (district, neighborhood, year) ->
    measure table (K3); both lookups linked both ways (J1) -> two lookup
    tables (K4).  Returns the row count report (A13) of the stored tables
    and writes the unlinked-entry report (J2).

    Input that cannot be read fails the run, or with ``on_bad="keep"`` is left
    out and listed in the table ``rejected`` (input, file, block_start, record)."""
    inputs = _readable(
        {
            "listings": readers.read_json_snapshots(spark, listings_dir, on_bad=on_bad),
            "income": readers.read_income_csv(spark, income_dir, on_bad=on_bad),
            "listing lookup": readers.read_pair_lookup(spark, listing_lookup_csv, on_bad=on_bad),
            "income lookup": readers.read_pair_lookup(spark, income_lookup_csv, on_bad=on_bad),
        },
        out_dir,
        on_bad,
    )
    listings = latest_listings(inputs["listings"])
    write_family_table(listings, os.path.join(out_dir, "housing"), as_strings=as_strings)

    income = upsert_in_load_order(inputs["income"], ["Nom_Districte", "Nom_Barri", "Any"])
    write_measure_table(income, os.path.join(out_dir, "income"), as_strings=as_strings)

    ll, il = inputs["listing lookup"], inputs["income lookup"]
    to_income, to_listing = link_pair_lookups(ll, il)
    write_lookup_table(to_income, os.path.join(out_dir, "listing-to-income"), ["district", "neighborhood"], ["income_district", "income_neighborhood"])
    write_lookup_table(to_listing, os.path.join(out_dir, "income-to-listing"), ["district", "neighborhood"], ["listing_district", "listing_neighborhood"])
    ids = ["district_id", "neighborhood_id"]
    # the report is on the entries that are linked: last write wins, as in link_pair_lookups
    ll, il = (upsert_in_load_order(_ids(x), ["district", "neighborhood"]) for x in (ll, il))
    missing = unlinked(_ids(ll), _ids(il), ids).withColumn("side", F.lit("listing")).unionByName(
        unlinked(_ids(il), _ids(ll), ids).withColumn("side", F.lit("income"))
    )
    write(missing, os.path.join(out_dir, "unlinked"))

    names = ["housing", "income", "listing-to-income", "income-to-listing"]
    return table_counts({n: spark.read.parquet(os.path.join(out_dir, n)) for n in names}, "table", "rows")


def etl2(
    spark: SparkSession,
    income_docs_path: str,
    occupancy_csv: str,
    lookup_dir: str,
    out_dir: str,
    mode: str = "overwrite",
    on_bad: str = "fail",
) -> DataFrame:
    """ETL2: import income documents, the occupancy CSV and every JSON
    lookup file (one table per file stem) into ``out_dir`` (K5 full
    refresh or K6 append); returns the row count per table (A13).
    Documents are stored whole, with every field they have.  ``on_bad`` as in ``etl1``."""
    tables: dict[str, DataFrame] = {
        "income": readers.read_json_lines(spark, income_docs_path, on_bad=on_bad),
        "inhabitants": readers.read_occupancy_csv(spark, occupancy_csv, on_bad=on_bad),
    }
    for row in readers.list_files(spark, lookup_dir, "*.json").collect():
        stem = row.path.rstrip("/").rsplit("/", 1)[-1][: -len(".json")]
        tables[stem] = readers.read_json_lines(spark, row.path, on_bad=on_bad)
    tables = _readable(tables, out_dir, on_bad)
    for name, df in tables.items():
        write(df, os.path.join(out_dir, name), mode=mode)
    stored = {n: spark.read.parquet(os.path.join(out_dir, n)) for n in sorted(tables)}
    return table_counts(stored, "table", "rows")


def take_in_snapshots(
    spark: SparkSession,
    listings_dir: str,
    name: str,
    buckets: int = 64,
    on_bad: str = "fail",
    **clean: object,
) -> list[str]:
    """S12 + A1, incremental: merge the snapshot files not taken in before into the keyed table ``name``.

    The table holds the latest row per listing, as ``latest_listings`` over all files
    would give it, and ``name``_files the files it holds.  Only new files are read, and
    only the buckets they touch rewritten.  A run that fails is repeated as a whole:
    rows merge by date, so taking in a file twice changes nothing.  Returns the new files.
    """
    listed = readers.list_files(spark, listings_dir, "*.json")
    taken = f"{name}_files"
    if spark.catalog.tableExists(taken):
        listed = listed.join(spark.table(taken).select("path"), "path", "left_anti")
    new = sorted(r.path for r in listed.collect())  # names of files, never rows
    if not new:
        return []
    rows = readers.read_json_snapshots(spark, new, on_bad=on_bad)
    rows = readers.split_bad(rows)[0] if on_bad == "keep" else rows
    latest = latest_listings(rows, **clean)
    if spark.catalog.tableExists(name):
        put_rows(latest, name, ["date", "price"])
    else:
        create_keyed(latest, name, "propertyCode", buckets)
    batch = hashlib.sha256("\n".join(new).encode()).hexdigest()
    append_batch(spark.createDataFrame([(p,) for p in new], "path string"), taken, batch)
    return new
