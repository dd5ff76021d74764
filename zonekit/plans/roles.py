"""The operators run on the driver's synthetic tables.

Roles (SURVEY §7.4): a listing is an ``orders`` row (key ``o_custkey``,
snapshot date ``o_orderdate``, price ``o_totalprice``, tie-break
``o_orderkey``); the neighbourhood is ``nation.n_name`` and the district
``region.r_name``; income is the mean ``c_acctbal`` (or the yearly mean
``o_totalprice``) per nation; occupancy the mean ``s_acctbal`` per nation;
the year -> value object is ``events.props``.  Lookups reconcile
``n_name`` to ``lower(n_name)`` and hold only the nations with at least
the mean number of suppliers, so that inner joins drop zones, as the real
lookups do; lookups by customer hold the customers that have orders.

Every query reads whole tables.  Where a fact table meets a mapping
table, facts are first reduced to one partial state per join key, so the
large join moves one row per key instead of one per fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonekit.functions import nested, scalar
from zonekit.operators import aggregate, clean, dedup, keyed, reconcile, stats
from zonekit.sources import readers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables, with the file's own schema (one footer read)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def geo(spark: SparkSession, d: str) -> DataFrame:
    """nation + region: (n_nationkey, zone, district, n_regionkey)."""
    n = table(spark, d, "nation")
    r = table(spark, d, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("zone"), F.col("r_name").alias("district"), "n_regionkey"
    )


def customer_zone(spark: SparkSession, d: str) -> DataFrame:
    """customer -> (c_custkey, zone, district): the mapping a listing's key
    goes through.  Grows with the customer table; it is never broadcast."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    g = geo(spark, d)
    return c.join(g, c.c_nationkey == g.n_nationkey).select("c_custkey", "zone", "district")


def _busy_nations(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the nations with at least the mean number of suppliers."""
    counts = table(spark, d, "supplier").groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= counts.agg(F.avg("n")).scalar()).select("s_nationkey")


def _held(lookup: DataFrame, busy: DataFrame, key: str) -> DataFrame:
    return lookup.join(busy, lookup[key] == busy["s_nationkey"], "left_semi")


def zone_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Name lookup raw -> reconciled, with gaps."""
    n = _held(table(spark, d, "nation"), _busy_nations(spark, d), "n_nationkey")
    return n.select("n_name", F.lower("n_name").alias("re"))


def cents(name: str) -> Column:
    """An amount as a decimal: sums of cents are exact, whatever their order."""
    return F.col(name).cast("decimal(18,2)").alias(name)


def listings(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders")


# --------------------------------------------------------------- sources


def snapshot_union(spark: SparkSession, d: str) -> DataFrame:
    """All events as two "snapshots" with different columns, union by name
    (the second lacks ``value``, which reads as null)."""
    ev = table(spark, d, "events")
    bought = F.col("event_type").eqNullSafe("purchase")
    a = ev.filter(bought).select("event_id", "event_type", "value")
    b = ev.filter(~bought).select("event_id", "event_type")
    return readers.union_snapshots([a, b])


def required_filter(spark: SparkSession, d: str) -> DataFrame:
    """F1 + F2 + X3: equality filter, JSON attribute and key must be present."""
    ev = table(spark, d, "events")
    ev = clean.where_equals(ev, "event_type", "purchase").withColumn("__k", nested.json_field("props", "$.k"))
    return clean.require(ev, ["__k", "user_id"]).select("event_id", "user_id")


def snapshot_date(spark: SparkSession, d: str) -> DataFrame:
    """Date parsed back from a ``YYYY_MM_DD_<name>.json`` name."""
    o = listings(spark, d)
    name = F.concat(F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit("_orders.json"))
    return o.select("o_orderkey", scalar.date_from_name(name).alias("snap_date"))


def numeric_cast(spark: SparkSession, d: str) -> DataFrame:
    """Text -> double; bad text -> null."""
    o = listings(spark, d)
    return o.select(
        "o_orderkey",
        scalar.numeric(scalar.as_text("o_totalprice"), "double").alias("price"),
        scalar.numeric("o_orderpriority", "int").alias("bad"),
    )


# ----------------------------------------------------------------- dedup


def latest_by_key(spark: SparkSession, d: str) -> DataFrame:
    """A1 / A2: latest listing per key, ties by the order key."""
    o = listings(spark, d).select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return dedup.latest_by_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select(
        "o_custkey", "o_orderkey", "o_totalprice"
    )


def upsert_by_key(spark: SparkSession, d: str) -> DataFrame:
    """A3: last write (greatest order key) per (key, year)."""
    yr = scalar.year_of("o_orderdate").cast("bigint").alias("yr")  # SQL year() is a bigint
    o = listings(spark, d).select("o_custkey", yr, "o_orderkey", "o_totalprice")
    # o_orderkey is the order's primary key: unique and non-null within a key
    latest = dedup.latest_by_key(o, ["o_custkey", "yr"], ["o_orderkey"], unique_order=True)
    return latest.select("o_custkey", "yr", "o_totalprice")


# ------------------------------------------------------------- reconcile


def lookup_link(spark: SparkSession, d: str) -> DataFrame:
    """Link two lookups through the shared id pair."""
    g = geo(spark, d)
    a = g.select(F.col("district").alias("d"), F.col("zone").alias("z"), F.col("n_regionkey").alias("di"), F.col("n_nationkey").alias("zi"))
    b = _held(a, _busy_nations(spark, d), "zi").select(F.lower("d").alias("d2"), F.lower("z").alias("z2"), "di", "zi")
    return reconcile.link_lookups(a, b, ["di", "zi"], ["d2", "z2"]).select("d", "z", "d2", "z2")


def lookup_missing(spark: SparkSession, d: str) -> DataFrame:
    """Entries without a partner."""
    n = table(spark, d, "nation").select(F.col("n_name").alias("z"), F.col("n_regionkey").alias("di"), F.col("n_nationkey").alias("zi"))
    b = _held(n, _busy_nations(spark, d), "zi").select("di", "zi")
    return reconcile.unlinked(n, b, ["di", "zi"]).select("z")


def _customer_lookups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Two lookups that grow with the data: customers by (nation, key) with
    their name, and a reconciled copy (lower-case names) of those that have orders."""
    a = table(spark, d, "customer").select(
        F.col("c_name").alias("z"), F.col("c_nationkey").alias("di"), F.col("c_custkey").alias("zi")
    )
    ordered = listings(spark, d).select("o_custkey").distinct()
    b = a.join(ordered, a["zi"] == ordered["o_custkey"], "left_semi").select(F.lower("z").alias("z2"), "di", "zi")
    return a, b


def lookup_link_customers(spark: SparkSession, d: str) -> DataFrame:
    """J1 on lookups as large as the customer table (shuffle join at scale)."""
    a, b = _customer_lookups(spark, d)
    return reconcile.link_lookups(a, b, ["di", "zi"], ["z2"]).select("z", "z2")


def lookup_missing_customers(spark: SparkSession, d: str) -> DataFrame:
    """J2 on lookups as large as the customer table."""
    a, b = _customer_lookups(spark, d)
    return reconcile.unlinked(a, b.select("di", "zi"), ["di", "zi"]).select("z")


def _urgent_customers(spark: SparkSession, d: str) -> DataFrame:
    return listings(spark, d).filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")


def get_rows_by_table(spark: SparkSession, d: str) -> DataFrame:
    """F8 with a key table derived from the facts (left-semi join)."""
    return keyed.get_rows(table(spark, d, "customer"), "c_custkey", _urgent_customers(spark, d), ["c_custkey", "c_name"])


def delete_keys_by_table(spark: SparkSession, d: str) -> DataFrame:
    """F10 with a key table derived from the facts (left-anti join)."""
    out = keyed.delete_keys(table(spark, d, "customer"), "c_custkey", _urgent_customers(spark, d))
    return out.select("c_custkey", "c_name")


def composite_key(spark: SparkSession, d: str) -> DataFrame:
    """P8 + P9: distinct ``district-zone-year`` keys of listings.

    (key, year) pairs are made distinct before the join with customers; the
    partial distinct collapses a hot key in each map task.  Measured on 1.5M
    rows this beats a per-key ``collect_set`` of years (which would save one
    exchange) in both the broadcast and the sort-merge regime."""
    o = listings(spark, d).select("o_custkey", scalar.year_of("o_orderdate").alias("yr")).distinct()
    cz = customer_zone(spark, d)
    j = o.join(cz, o.o_custkey == cz.c_custkey)
    return j.select(scalar.composite_key("district", "zone", "yr").alias("k")).distinct()


def reconcile_names(spark: SparkSession, d: str) -> DataFrame:
    """J4/J5/J7 + P6: mean income per reconciled zone name."""
    c = table(spark, d, "customer").select("c_nationkey", cents("c_acctbal"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    # the mean is taken per raw name, then the names are reconciled
    income = aggregate.mean_by(c, ["c_nationkey"], "c_acctbal", "m")
    named = income.join(n, income.c_nationkey == n.n_nationkey).select("n_name", "m")
    re = reconcile.apply_lookup(named, zone_lookup(spark, d), "n_name", "re", "re")
    return re.select("re", F.round("m", 4).alias("m"))


# ------------------------------------------------------------ aggregates


def count_by(spark: SparkSession, d: str) -> DataFrame:
    """A10: rows per district."""
    c = table(spark, d, "customer").select("c_nationkey")
    g = geo(spark, d)
    j = c.join(g, c.c_nationkey == g.n_nationkey)
    return aggregate.count_by(j, [F.col("district").alias("r_name")], "n")


def daily_counts(spark: SparkSession, d: str) -> DataFrame:
    """A4 + O1."""
    return aggregate.daily_counts(table(spark, d, "events"), "ts", "d", "n")


def avg_per_sampled_day(spark: SparkSession, d: str) -> DataFrame:
    """A5."""
    counts = aggregate.daily_counts(listings(spark, d), "o_orderdate", "d", "n", sort=False)
    return aggregate.mean_of(counts, "n", "a").select(F.round("a", 4).alias("a"))


def avg_per_calendar_day(spark: SparkSession, d: str) -> DataFrame:
    """A6 + A14 + P13 (KPI1b)."""
    out = aggregate.per_calendar_day(listings(spark, d), "o_orderdate", "a")
    return out.select(F.round("a", 4).alias("a"))


def peak_day(spark: SparkSession, d: str) -> DataFrame:
    """O4."""
    counts = aggregate.daily_counts(table(spark, d, "events"), "ts", "d", "n", sort=False)
    return aggregate.peak(counts, "n", "d", 1)


def log_daily(spark: SparkSession, d: str) -> DataFrame:
    """P12 + A15."""
    counts = aggregate.daily_counts(table(spark, d, "events"), "ts", "d", "n", sort=False)
    return aggregate.log_series(counts, "d", "n", "l").select("d", F.round("l", 6).alias("l"))


def mean_by(spark: SparkSession, d: str) -> DataFrame:
    """A7 + A8: mean listing price per zone."""
    m = zone_mean_price(spark, d)
    return m.select("zone", F.round("m", 4).alias("m"))


def zone_mean_price(spark: SparkSession, d: str, name: str = "m") -> DataFrame:
    o = listings(spark, d).select("o_custkey", cents("o_totalprice"))
    return aggregate.mean_through(o, "o_custkey", "o_totalprice", customer_zone(spark, d), "c_custkey", ["zone"], name)


def latest_from_array(spark: SparkSession, d: str) -> DataFrame:
    """A18 + O2 + X4: per zone an array of (year, mean price) structs, then
    the value of the latest year.  The array has one element per year, so
    its length is bounded by the calendar, not by the data."""
    o = listings(spark, d).select("o_custkey", cents("o_totalprice"), scalar.year_of("o_orderdate").alias("yr"))
    yearly = aggregate.mean_through(
        o, "o_custkey", "o_totalprice", customer_zone(spark, d), "c_custkey", ["zone"], "v", fact_group=["yr"]
    )
    arr = yearly.groupBy("zone").agg(F.collect_list(F.struct(F.col("yr").alias("year"), F.col("v").alias("RFD"))).alias("info"))
    return arr.select("zone", F.round(nested.latest_from_array("info", "year", "RFD"), 4).alias("v"))


def zone_ratio_by_year(spark: SparkSession, d: str, years: tuple[int, ...] = (1996, 1997, 1998)) -> DataFrame:
    """F5 + P13: mean zone price / yearly zone income for
    the listed years (1996-1998).

    One conditional aggregation per customer key yields the all-years state
    and one state per listed year (a pivot with fixed years), so the facts
    are scanned and shuffled once; the aggregate is hash-partitioned on the
    key, which the customer join reuses.  The per-zone result is unpivoted
    into (zone, year) rows; a year without listings in a zone gives no row
    (inner-join semantics)."""
    o = listings(spark, d)
    yr = scalar.year_of("o_orderdate")
    price = cents("o_totalprice")
    aggs = [F.sum(price).alias("s"), F.count(price).alias("n")]
    for y in years:
        aggs += [F.sum(F.when(yr == y, price)).alias(f"s{y}"), F.count(F.when(yr == y, price)).alias(f"n{y}")]
    states = o.groupBy("o_custkey").agg(*aggs)
    cz = customer_zone(spark, d)
    zoned = states.join(cz, states.o_custkey == cz.c_custkey)
    state_cols = ["s", "n"] + [f"{k}{y}" for y in years for k in ("s", "n")]
    z = zoned.groupBy("zone").agg(*[F.sum(c).alias(c) for c in state_cols])
    per_year = F.array(
        *[
            F.struct(F.lit(y).cast("bigint").alias("yr"), scalar.safe_ratio(F.col(f"s{y}").cast("double"), f"n{y}").alias("b"), F.col(f"n{y}").alias("nb"))
            for y in years
        ]
    )
    rows = z.select("zone", scalar.safe_ratio(F.col("s").cast("double"), "n").alias("p"), F.inline(per_year)).filter(F.col("nb") > 0)
    return rows.select("zone", "yr", F.round(scalar.safe_ratio("p", "b"), 6).alias("ratio"))


def price_income(spark: SparkSession, d: str) -> DataFrame:
    """KPI2 shape, unrounded: latest listing per key (A2) -> mean price per
    zone (A7) -> name lookup (J4, P6) -> join zone income (J6)."""
    o = listings(spark, d).select("o_custkey", "o_orderkey", "o_orderdate", cents("o_totalprice"))
    latest = dedup.latest_by_key(o, ["o_custkey"], ["o_orderdate", "o_orderkey"])
    price = aggregate.mean_through(latest, "o_custkey", "o_totalprice", customer_zone(spark, d), "c_custkey", ["zone"], "mean_price")
    income = zone_income(spark, d)
    p = reconcile.apply_lookup(price, zone_lookup(spark, d), "zone", "re", "re", lookup_raw="n_name", keep_raw=True)
    return p.join(income, "zone").select(F.col("re").alias("zone"), "mean_price", F.col("inc").alias("income"))


def kpi_price_income(spark: SparkSession, d: str) -> DataFrame:
    """KPI2 table with named, rounded columns."""
    return price_income(spark, d).select("zone", F.round("mean_price", 4).alias("mean_price"), F.round("income", 4).alias("income"))


def zone_income(spark: SparkSession, d: str) -> DataFrame:
    """Income per zone: mean c_acctbal per nation (broadcast join with the
    nation table is map-side, so the aggregate is partial before the shuffle)."""
    c = table(spark, d, "customer").select("c_nationkey", cents("c_acctbal"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c.c_nationkey == n.n_nationkey)
    return aggregate.mean_by(j, ["n_name"], "c_acctbal", "inc").withColumnRenamed("n_name", "zone")


def listing_model(spark: SparkSession, d: str) -> DataFrame:
    """Orders in the columns of a listing table, without what depends on the customer."""
    return listings(spark, d).select(
        F.col("o_custkey").alias("propertyCode"), scalar.calendar_date("o_orderdate").alias("date"), cents("o_totalprice").alias("price"), "o_orderkey"
    )


def latest_listings(spark: SparkSession, d: str, columns: tuple[str, ...]) -> DataFrame:
    """A2 through ``plans.kpi.latest_listings``: ties by price, then order key;
    district and zone come through the customer, after the reduction."""
    from zonekit.plans import kpi

    zones = customer_zone(spark, d).select(F.col("c_custkey").alias("propertyCode"), "district", F.col("zone").alias("neighborhood"))
    return kpi.latest_listings(
        listing_model(spark, d), tie_break=("price", "o_orderkey"), municipality=None, columns=columns, attributes=zones
    )


def kpi1_daily(spark: SparkSession, d: str) -> DataFrame:
    """KPI1: latest listing per key (A2) -> listings per date (A4, O1)."""
    from zonekit.plans import kpi

    return kpi.kpi1(latest_listings(spark, d, ("date",)))


def kpi1_summary(spark: SparkSession, d: str) -> DataFrame:
    """KPI1 + KPI1b scalars (A5, A6) on the deduplicated listings."""
    from zonekit.plans import kpi

    s = kpi.kpi1_summary(latest_listings(spark, d, ("date",)))
    return s.select(*[F.round(c, 4).alias(c) for c in s.columns])


def occupancy_income(spark: SparkSession, d: str) -> DataFrame:
    """KPI3 shape, unrounded (J7, J8): occupancy and income per zone."""
    s = table(spark, d, "supplier").select("s_nationkey", cents("s_acctbal"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    occ = aggregate.mean_by(
        s.join(n, s.s_nationkey == n.n_nationkey), ["n_name"], "s_acctbal", "occ"
    ).withColumnRenamed("n_name", "zone")
    j = reconcile.join_on_reconciled(occ, zone_income(spark, d), "zone")
    return j.select(F.lower("zone").alias("zone"), "occ", F.col("inc").alias("income"))


def _name_lookups(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Listing-side (ne -> ne_re) and income-side (neighborhood ->
    neighborhood_reconciled) name lookups, with the same gaps as above."""
    n = _held(table(spark, d, "nation"), _busy_nations(spark, d), "n_nationkey")
    rent = n.select(F.col("n_name").alias("ne"), F.lower("n_name").alias("ne_re"))
    income = n.select(F.col("n_name").alias("neighborhood"), F.lower("n_name").alias("neighborhood_reconciled"))
    return rent, income


def _income_documents(spark: SparkSession, d: str) -> DataFrame:
    """Nested income documents derived from the facts: per zone an array of
    (year, RFD) with RFD = the year's highest price; one element per year,
    so the array is bounded by the calendar."""
    o = listings(spark, d).select("o_custkey", scalar.year_of("o_orderdate").alias("year"), "o_totalprice")
    per_key = o.groupBy("o_custkey", "year").agg(F.max("o_totalprice").alias("m"))
    cz = customer_zone(spark, d)
    yearly = per_key.join(cz, per_key.o_custkey == cz.c_custkey).groupBy("zone", "year").agg(F.max("m").alias("RFD"))
    return yearly.groupBy("zone").agg(F.collect_list(F.struct("year", "RFD")).alias("info")).select(
        F.col("zone").alias("neigh_name"), "info"
    )


def _kpi2(spark: SparkSession, d: str) -> DataFrame:
    from zonekit.plans import kpi

    rent, income_lk = _name_lookups(spark, d)
    return kpi.kpi2(latest_listings(spark, d, ("neighborhood", "price")), rent, _income_documents(spark, d), income_lk)


def kpi2_listing_model(spark: SparkSession, d: str) -> DataFrame:
    """KPI2 through ``plans.kpi.kpi2``: latest listing per key, name lookups
    on both sides, latest yearly income from nested documents."""
    out = _kpi2(spark, d)
    return out.select("neighborhood", F.round("mean_price", 4).alias("mean_price"), F.round("rfd", 4).alias("rfd"))


def kpi2_correlation(spark: SparkSession, d: str) -> DataFrame:
    """A16 over the reconciled KPI2 table: the price / income correlation."""
    return stats.corr_pair(_kpi2(spark, d), "mean_price", "rfd", "r").select(F.round("r", 6).alias("r"))


def kpi2b_listing_model(spark: SparkSession, d: str) -> DataFrame:
    """KPI2b through ``plans.kpi.kpi2b``: pair lookups linked by id (J1, J3),
    yearly income rows, ratio per zone and year (A9, F5)."""
    from zonekit.plans import etl, kpi

    g = geo(spark, d).select("district", F.col("zone").alias("neighborhood"), F.col("n_regionkey").alias("district_id"), F.col("n_nationkey").alias("neighborhood_id"))
    other = _held(g, _busy_nations(spark, d), "neighborhood_id")
    other = other.withColumns({c: F.lower(c) for c in ("district", "neighborhood")})
    to_income, _ = etl.link_pair_lookups(g, other)
    o = listings(spark, d).select("o_custkey", scalar.year_of("o_orderdate").alias("year"), "o_totalprice")
    cz = customer_zone(spark, d)
    top = o.groupBy("o_custkey", "year").agg(F.max("o_totalprice").alias("m"))
    income = top.join(cz, top.o_custkey == cz.c_custkey).groupBy("district", "zone", "year").agg(F.max("m").alias("m"))
    income = income.select(
        F.lower("district").alias("Nom_Districte"),
        F.lower("zone").alias("Nom_Barri"),
        F.col("year").alias("Any"),
        F.col("m").alias("Índex RFD Barcelona = 100"),
    )
    latest = latest_listings(spark, d, ("district", "neighborhood", "price"))
    out = kpi.kpi2b(latest, to_income, income, years=(1996, 1997, 1998))
    return out.select(F.col("year").cast("bigint").alias("year"), "district", "neighborhood", F.round("ratio", 6).alias("ratio"))


def _kpi3(spark: SparkSession, d: str) -> DataFrame:
    from zonekit.plans import kpi

    s = table(spark, d, "supplier").select("s_nationkey", cents("s_acctbal"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    occ = aggregate.mean_by(
        s.join(n, s.s_nationkey == n.n_nationkey), ["n_name"], "s_acctbal", "o"
    ).select(F.col("n_name").alias("Nom_Barri"), F.col("o").alias(kpi.OCCUPANCY_COLUMN))
    _, income_lk = _name_lookups(spark, d)
    return kpi.kpi3(occ, _income_documents(spark, d), income_lk)


def kpi3_listing_model(spark: SparkSession, d: str) -> DataFrame:
    """KPI3 through ``plans.kpi.kpi3``: an occupancy table per zone (mean
    supplier balance) reconciled by name and joined to the latest income."""
    return _kpi3(spark, d).select(
        "neighborhood", F.round("inhabitants_family", 4).alias("inhabitants_family"), F.round("rfd", 4).alias("rfd")
    )


def kpi_occupancy_income(spark: SparkSession, d: str) -> DataFrame:
    """KPI3 table with rounded columns."""
    return occupancy_income(spark, d).select("zone", F.round("occ", 4).alias("occ"), F.round("income", 4).alias("income"))


def kpi3_correlation(spark: SparkSession, d: str) -> DataFrame:
    """A16 over the reconciled KPI3 table: the occupancy / income correlation."""
    return stats.corr_pair(_kpi3(spark, d), "inhabitants_family", "rfd", "r").select(F.round("r", 6).alias("r"))


# ------------------------------------------------------------------ stats


def corr_pair(spark: SparkSession, d: str) -> DataFrame:
    """A16."""
    li = table(spark, d, "lineitem")
    return stats.corr_pair(li, "l_quantity", "l_extendedprice", "r").select(F.round("r", 6).alias("r"))


def corr_matrix(spark: SparkSession, d: str) -> DataFrame:
    """One aggregation pass, long form."""
    li = table(spark, d, "lineitem")
    m = stats.corr_matrix(li, ["l_quantity", "l_extendedprice", "l_discount"])
    return m.select("a", "b", F.round("r", 6).alias("r"))


def corr_matrix_lineitem(spark: SparkSession, d: str) -> DataFrame:
    """A17 over every numeric column of a table, as one vector-valued aggregate."""
    return stats.corr_matrix(table(spark, d, "lineitem")).select("a", "b", F.round("r", 6).alias("r"))


# ----------------------------------------------------------------- nested


def map_unwind_avg(spark: SparkSession, d: str) -> DataFrame:
    """X1 + X2 + A11 + P14: JSON object -> map -> entries -> explode -> avg."""
    ev = table(spark, d, "events").select("event_type", "user_id", nested.json_map("props").alias("m"))
    out = aggregate.avg_map_values(ev, ["event_type", "user_id"], "m", "v")
    return out.select("event_type", "user_id", F.round("v", 4).alias("v"))


def avg_nested(spark: SparkSession, d: str) -> DataFrame:
    """A12 + X4: average of a nested field per group."""
    ev = table(spark, d, "events").select("event_type", F.from_json("props", "k double").alias("p"))
    out = aggregate.avg_nested(ev, ["event_type"], nested.field("p", "k"), "v")
    return out.select("event_type", F.round("v", 4).alias("v"))


# ------------------------------------------------------------------ keyed


def get_rows(spark: SparkSession, d: str) -> DataFrame:
    """F7 + F8: multi-get; absent keys give no row."""
    return keyed.get_rows(table(spark, d, "customer"), "c_custkey", [1, 7, 999999], ["c_custkey", "c_name"])


def prefix_scan(spark: SparkSession, d: str) -> DataFrame:
    """F9 + S8."""
    return keyed.prefix_scan(table(spark, d, "customer"), "c_name", "Customer#0000000", ["c_custkey", "c_name"])


def delete_keys(spark: SparkSession, d: str) -> DataFrame:
    """F10."""
    return keyed.delete_keys(table(spark, d, "nation"), "n_nationkey", [1, 7]).select("n_nationkey", "n_name")


def zone_equals(spark: SparkSession, d: str) -> DataFrame:
    """F6."""
    return keyed.zone_equals(table(spark, d, "customer"), "c_mktsegment", "MACHINERY").select("c_custkey")


def table_counts(spark: SparkSession, d: str) -> DataFrame:
    """A13."""
    return aggregate.table_counts(
        {n: table(spark, d, n) for n in ("orders", "customer", "events")}, "t", "n"
    )


def head_rows(spark: SparkSession, d: str) -> DataFrame:
    """O3: first rows in key order (a top-k)."""
    return aggregate.head(table(spark, d, "customer").select("c_custkey", "c_name"), ["c_custkey"], 5)


def family_table(spark: SparkSession, d: str) -> DataFrame:
    """K2 + P4: one struct per column family, values as stored text (prices
    in whole cents, well above 1e7, have no exponent)."""
    rows = listings(spark, d).select(
        "o_orderkey", "o_orderpriority", (F.floor("o_totalprice") * 100).cast("double").alias("price"),
        scalar.calendar_date("o_orderdate").alias("date"),
    )
    out = clean.family_table(rows, "o_orderkey", {"cf1": ["o_orderpriority", "price"], "cf2": ["date"]}, as_strings=True)
    return out.select("key", "cf1.o_orderpriority", "cf1.price", F.col("cf2.date").alias("d"))


def measure_table(spark: SparkSession, d: str) -> DataFrame:
    """K3: the composite key with its parts and measures, one row per nation."""
    g = geo(spark, d).withColumn("measure", F.col("n_nationkey") * 2)
    out = clean.measure_table(g, ["district", "zone", "n_nationkey"], {"measure": "measure"}, as_strings=True)
    return out.select("key", "district", "zone", "n_nationkey", "cf1.measure")


def lookup_table(spark: SparkSession, d: str) -> DataFrame:
    """K4: the composite key of the origin and the names of the destination."""
    out = clean.lookup_table(lookup_link(spark, d), ["d", "z"], ["d2", "z2"])
    return out.select("key", "cf1.district", "cf1.neighborhood")


def split_key(spark: SparkSession, d: str) -> DataFrame:
    """P10: the parts of a composite key (P8, P9); a fourth part gives null."""
    keys = geo(spark, d).select("n_nationkey", scalar.composite_key("district", "zone", "n_nationkey").alias("k"))
    parts = [scalar.split_key("k", i + 1).alias(f"p{i + 1}") for i in range(4)]
    return keys.select("n_nationkey", *parts)


def parse_date(spark: SparkSession, d: str) -> DataFrame:
    """Calendar date from the text of a timestamp."""
    o = listings(spark, d)
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return o.select("o_orderkey", scalar.parse_date_prefix(text).alias("day"))


def constant_column(spark: SparkSession, d: str) -> DataFrame:
    """A snapshot's date on every row of it."""
    c = table(spark, d, "customer").select("c_custkey")
    return clean.with_constant(c, "snapshot", F.to_date(F.lit("2020-01-02")))


def snapshot_drift(spark: SparkSession, d: str) -> DataFrame:
    """a snapshot without the key column gives no row after the union."""
    ev = table(spark, d, "events")
    bought = F.col("event_type").eqNullSafe("purchase")
    a = ev.filter(bought).select("event_id", "user_id")
    b = ev.filter(~bought).select("event_id")
    return clean.require(readers.union_snapshots([a, b]), ["event_id", "user_id"])


def audited_lookup(spark: SparkSession, d: str) -> DataFrame:
    """J3 + J2 + A13 in one pass: customers with the name of their nation, where the lookup has it."""
    c = table(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    lookup = _held(table(spark, d, "nation").select("n_nationkey", "n_name"), _busy_nations(spark, d), "n_nationkey")
    joined, _ = reconcile.audited_join(c, lookup, ["n_nationkey"])
    return joined.select("c_custkey", "n_name")


def ratio_by(spark: SparkSession, d: str) -> DataFrame:
    """Mean balance per nation over a per-nation constant."""
    c = table(spark, d, "customer").select("c_nationkey", cents("c_acctbal"))
    n = table(spark, d, "nation").select("n_nationkey", "n_name", (F.col("n_regionkey") + 1).alias("base"))
    rows = c.join(n, c.c_nationkey == n.n_nationkey)
    return aggregate.ratio_by(rows, ["n_name"], "c_acctbal", "base").select("n_name", F.round(F.col("ratio").cast("double"), 4).alias("ratio"))


def delete_keys_with_null(spark: SparkSession, d: str) -> DataFrame:
    """F10 where keys and rows have nulls: only the named, non-null keys go."""
    c = table(spark, d, "customer").select("c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("seg"))
    return keyed.delete_keys(c, "seg", ["MACHINERY", None])


QUERIES = {
    "snapshot_union": snapshot_union,
    "required_filter": required_filter,
    "snapshot_date": snapshot_date,
    "numeric_cast": numeric_cast,
    "latest_by_key": latest_by_key,
    "upsert_by_key": upsert_by_key,
    "lookup_link": lookup_link,
    "lookup_missing": lookup_missing,
    "composite_key": composite_key,
    "lookup_link_customers": lookup_link_customers,
    "lookup_missing_customers": lookup_missing_customers,
    "get_rows_by_table": get_rows_by_table,
    "delete_keys_by_table": delete_keys_by_table,
    "count_by": count_by,
    "daily_counts": daily_counts,
    "avg_per_sampled_day": avg_per_sampled_day,
    "avg_per_calendar_day": avg_per_calendar_day,
    "peak_day": peak_day,
    "log_daily": log_daily,
    "mean_by": mean_by,
    "latest_from_array": latest_from_array,
    "reconcile": reconcile_names,
    "zone_ratio_by_year": zone_ratio_by_year,
    "kpi_price_income": kpi_price_income,
    "kpi_occupancy_income": kpi_occupancy_income,
    "kpi2_correlation": kpi2_correlation,
    "kpi3_correlation": kpi3_correlation,
    "kpi2_listing_model": kpi2_listing_model,
    "kpi3_listing_model": kpi3_listing_model,
    "kpi1_daily": kpi1_daily,
    "kpi1_summary": kpi1_summary,
    "corr_pair": corr_pair,
    "corr_matrix": corr_matrix,
    "corr_matrix_lineitem": corr_matrix_lineitem,
    "audited_lookup": audited_lookup,
    "map_unwind_avg": map_unwind_avg,
    "avg_nested": avg_nested,
    "get_rows": get_rows,
    "prefix_scan": prefix_scan,
    "delete_keys": delete_keys,
    "zone_equals": zone_equals,
    "table_counts": table_counts,
    "head_rows": head_rows,
    "family_table": family_table,
    "measure_table": measure_table,
    "lookup_table": lookup_table,
    "split_key": split_key,
    "parse_date": parse_date,
    "constant_column": constant_column,
    "snapshot_drift": snapshot_drift,
    "ratio_by": ratio_by,
    "delete_keys_with_null": delete_keys_with_null,
    "kpi2b_listing_model": kpi2b_listing_model,
}
