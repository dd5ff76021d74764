"""KPI compositions (KPI1, KPI1b, KPI2, KPI2b, KPI3) on the listing model.

Each KPI is one DataFrame plan: clean -> latest per key -> aggregate ->
reconcile -> join.  Nothing is collected; scalar results are one-row
DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonekit.functions.nested import latest_from_array
from zonekit.functions.scalar import dash_free, safe_ratio, strip_quotes_commas
from zonekit.operators.aggregate import daily_counts, mean_by, mean_of, partial_mean, per_calendar_day
from zonekit.operators.clean import REQUIRED_LISTING_COLUMNS, clean_listings, project, require
from zonekit.operators.dedup import latest_by_key, upsert_in_load_order
from zonekit.operators.reconcile import apply_lookup, join_on_reconciled, strict_join

# Occupancy column of the household table.
OCCUPANCY_COLUMN = "Ocupacio_mitjana_(persones_ per_domicili)"


#: Columns that the KPIs read of a listing, besides those of the clean-up.
KPI_COLUMNS = ("propertyCode", "date", "price", "district", "neighborhood")


def latest_listings(
    listings: DataFrame,
    key: str = "propertyCode",
    date_col: str = "date",
    tie_break: Sequence[str] = ("price",),
    municipality: str | None = "Barcelona",
    columns: Sequence[str] | None = None,
    attributes: DataFrame | None = None,
) -> DataFrame:
    """Clean (F1, F2, P3) and keep the latest snapshot of each listing (A1/A2).

    Ties on the date are broken by ``tie_break`` and then by all other
    columns, descending, so the winner never depends on the order of rows.
    ``columns`` names the columns wanted; the others are neither read nor
    shuffled (they then break no tie either).

    ``attributes`` (``key`` and further columns, one row per key) holds what
    depends on the listing alone, such as its zone.  Listings are then reduced
    before they are joined: a key with a third of all rows reaches the join
    as one row, after a partial aggregation in every task that read it.
    """
    if attributes is not None:
        later = [c for c in attributes.columns if c != key]
        own = [c for c in REQUIRED_LISTING_COLUMNS if c not in later]
        clean = clean_listings(listings, municipality=municipality, required=own)
        wanted = [c for c in columns or clean.columns if c not in later]
        clean = clean.select(*dict.fromkeys([key, date_col, *tie_break, *wanted]))
        order = list(dict.fromkeys([date_col, *tie_break, *[c for c in clean.columns if c != key]]))
        joined = latest_by_key(clean, [key], order).join(attributes, key)
        return require(joined, [c for c in REQUIRED_LISTING_COLUMNS if c in later]).select(*(columns or joined.columns))
    clean = clean_listings(listings, municipality=municipality)
    if columns is not None:
        clean = clean.select(*dict.fromkeys([key, date_col, *tie_break, *columns]))
    order = list(dict.fromkeys([date_col, *tie_break, *[c for c in clean.columns if c != key]]))
    latest = latest_by_key(clean, [key], order)
    return latest if columns is None else latest.select(*columns)


def kpi1(latest: DataFrame, date_col: str = "date") -> DataFrame:
    """KPI1: listings per snapshot date (``date, listings_count``), ascending."""
    return daily_counts(latest, date_col, "date", "listings_count")


def kpi1_average(latest: DataFrame, date_col: str = "date") -> DataFrame:
    """KPI1 scalar (A5): mean listings per sampled date."""
    return mean_of(daily_counts(latest, date_col, sort=False), "listings_count", "avg_per_sampled_day")


def kpi1_summary(latest: DataFrame, date_col: str = "date") -> DataFrame:
    """KPI1 and KPI1b in one pass over the daily counts: mean listings per
    sampled date and listings per calendar day of the period (null for a
    single date).  The daily counts are tiny, so this adds one small stage."""
    counts = daily_counts(latest, date_col, "date", "listings_count", sort=False)
    return counts.agg(
        F.avg("listings_count").alias("avg_per_sampled_day"),
        safe_ratio(F.sum("listings_count"), F.datediff(F.max("date"), F.min("date"))).alias("avg_per_calendar_day"),
    )


def kpi1b(latest: DataFrame, date_col: str = "date") -> DataFrame:
    """KPI1b (A6): listings per calendar day of the period."""
    return per_calendar_day(latest, date_col, "avg_per_calendar_day")


def latest_income(docs: DataFrame, name_col: str = "neigh_name", info_col: str = "info") -> DataFrame:
    """A18 per document: the income index of the latest year."""
    return docs.select(F.col(name_col), latest_from_array(info_col, "year", "RFD").alias("rfd"))


def kpi2(
    latest: DataFrame,
    rent_lookup: DataFrame,
    income_docs: DataFrame,
    income_lookup: DataFrame,
    clean_names: bool = True,
    zone_keys: Sequence[str] = ("neighborhood",),
    rent_raw: Sequence[str] = ("ne",),
) -> DataFrame:
    """KPI2: ``neighborhood, mean_price, rfd``.

    Mean price per raw listing zone (A7, partial + final aggregation) ->
    listing-name lookup (J4, P6); latest income per document (A18) ->
    income-name lookup (J5, P6); inner join on the reconciled name (J6).
    The zone key is the name alone by default; names can repeat across
    districts, so ``zone_keys=("district", "neighborhood")`` with a lookup
    keyed on both (``rent_raw``) keys on the pair instead.
    """
    price = mean_by(latest, list(zone_keys), "price", "mean_price")
    price = apply_lookup(price, rent_lookup, list(zone_keys), "ne_re", "neighborhood", lookup_raw=list(rent_raw))
    income = income_reconciled(income_docs, income_lookup)
    out = join_on_reconciled(price, income, "neighborhood").select("neighborhood", "mean_price", "rfd")
    return _clean(out, clean_names)


def income_reconciled(income_docs: DataFrame, income_lookup: DataFrame) -> DataFrame:
    """Latest income per reconciled neighbourhood name (J5 + P6)."""
    return apply_lookup(
        latest_income(income_docs),
        income_lookup,
        "neigh_name",
        "neighborhood_reconciled",
        "neighborhood",
        lookup_raw="neighborhood",
    )


def kpi3(
    occupancy: DataFrame,
    income_docs: DataFrame,
    income_lookup: DataFrame,
    clean_names: bool = True,
) -> DataFrame:
    """KPI3: ``neighborhood, inhabitants_family, rfd``."""
    occ = project(occupancy, {"neighborhood": "Nom_Barri", "inhabitants_family": OCCUPANCY_COLUMN})
    occ = apply_lookup(occ, income_lookup, "neighborhood", "neighborhood_reconciled", "neighborhood", lookup_raw="neighborhood")
    income = income_reconciled(income_docs, income_lookup)
    out = join_on_reconciled(occ, income, "neighborhood").select("neighborhood", "inhabitants_family", "rfd")
    return _clean(out, clean_names)


def _clean(df: DataFrame, clean_names: bool) -> DataFrame:
    if not clean_names:
        return df
    return df.withColumn("neighborhood", strip_quotes_commas("neighborhood"))


def kpi2b(
    latest: DataFrame,
    listing_to_income: DataFrame,
    income: DataFrame,
    years: Sequence[int] = (2014, 2015, 2016),
    strict: bool = False,
) -> DataFrame:
    """KPI2b (A9, J3, F5): mean listing price / income index per zone and year.

    ``listing_to_income``: (district, neighborhood) -> (income_district,
    income_neighborhood), e.g. the J1 link.  ``income``: the yearly CSV
    rows.  Listings are reduced to one (sum, count) state per zone before
    any join, and one plan covers all years (the reference rescans per
    year).  With ``strict`` a zone without lookup entry fails the query.
    """
    states = partial_mean(latest, ["district", "neighborhood"], "price")
    link = listing_to_income.select("district", "neighborhood", "income_district", "income_neighborhood")
    states = strict_join(states, link, ["district", "neighborhood"]) if strict else states.join(
        link, ["district", "neighborhood"], "inner"
    )
    # the year is part of the key, so the filter may come first
    income = upsert_in_load_order(income.filter(F.col("Any").isin(list(years))), ["Nom_Districte", "Nom_Barri", "Any"])
    yearly = income.select(
        F.col("Nom_Districte").alias("income_district"),
        F.col("Nom_Barri").alias("income_neighborhood"),
        F.col("Any").alias("year"),
        F.col("`Índex RFD Barcelona = 100`").alias("rfd"),
    )
    joined = states.join(yearly, ["income_district", "income_neighborhood"], "inner")
    return joined.groupBy(
        "year",
        dash_free("district").alias("district"),
        dash_free("neighborhood").alias("neighborhood"),
    ).agg(safe_ratio(safe_ratio(F.sum("__zk_sum").cast("double"), F.sum("__zk_n")), F.max("rfd")).alias("ratio"))


def report(
    listings: DataFrame,
    rent_lookup: DataFrame,
    income_docs: DataFrame,
    income_lookup: DataFrame,
    occupancy: DataFrame,
    out_dir: str | None = None,
    cut_lineage: bool = False,
    single_file: bool = False,
) -> dict[str, DataFrame]:
    """The analysis run: KPI1, KPI2, KPI3 and their summary figures.

    The latest listings feed several KPIs, so they are kept (S12:
    persisted, or checkpointed into ``spark.checkpoint.dir`` with
    ``cut_lineage``); the income documents and lookups are small and are
    simply read again.  With ``out_dir`` each KPI table is written as CSV
    with a header (K7), as one file if ``single_file`` (one task then writes
    it, and runs what is not behind a shuffle).  The caller may ``unpersist`` the ``latest``
    frame afterwards.
    """
    from zonekit.session import reuse
    from zonekit.sinks.writers import write, write_single_csv

    latest = reuse(latest_listings(listings, columns=KPI_COLUMNS), cut_lineage)
    k1 = kpi1(latest)
    k2 = kpi2(latest, rent_lookup, income_docs, income_lookup)
    k3 = kpi3(occupancy, income_docs, income_lookup)
    k1s = kpi1_summary(latest)
    parts = [
        k1s.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in k1s.columns]))),
        price_income_correlation(k2).select(F.lit("corr_price_income").alias("metric"), F.col("r").alias("value")),
        price_income_correlation(k3, "inhabitants_family").select(
            F.lit("corr_occupancy_income").alias("metric"), F.col("r").alias("value")
        ),
    ]
    summary = parts[0]
    for p in parts[1:]:
        summary = summary.unionByName(p)
    if out_dir is not None:
        for name, df in (("kpi1", k1), ("kpi2", k2), ("kpi3", k3)):
            path = f"{out_dir.rstrip('/')}/{name}"
            if single_file:
                write_single_csv(df, path)
            else:
                write(df, path, fmt="csv", header="true")
    return {"latest": latest, "kpi1": k1, "kpi2": k2, "kpi3": k3, "summary": summary}


def price_income_correlation(kpi: DataFrame, value: str = "mean_price", income: str = "rfd") -> DataFrame:
    """A16 over a KPI table."""
    from zonekit.operators.stats import pearson

    return kpi.agg(pearson(value, income).alias("r"))


__all__ = [
    "latest_listings",
    "kpi1",
    "kpi1_average",
    "kpi1b",
    "kpi1_summary",
    "kpi2",
    "kpi2b",
    "kpi3",
    "latest_income",
    "income_reconciled",
    "price_income_correlation",
    "report",
]
