"""Every operator accepts empty input: row operators give no row, global
aggregates give one row of nulls (or zero counts)."""

import pytest

from zonekit.functions import nested
from zonekit.operators import aggregate, clean, dedup, keyed, reconcile, stats
from zonekit.plans import kpi

LISTINGS = (
    "propertyCode string, municipality string, district string, neighborhood string, "
    "price double, distance string, date date"
)


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], LISTINGS)


def test_row_operators_on_empty(spark, empty):
    lk = spark.createDataFrame([("a", "A")], "ne string, ne_re string")
    frames = [
        clean.clean_listings(empty),
        clean.family_table(empty),
        dedup.latest_by_key(empty, ["propertyCode"], ["date"]),
        dedup.first_by_key(empty, ["propertyCode"], ["date"]),
        dedup.upsert(empty, empty, ["propertyCode"], ["date"]),
        reconcile.apply_lookup(empty, lk, "neighborhood", "ne_re", "neighborhood", lookup_raw="ne"),
        reconcile.unlinked(empty, empty, ["district", "neighborhood"]),
        keyed.get_rows(empty, "propertyCode", ["x"]),
        keyed.delete_keys(empty, "propertyCode", empty.select("propertyCode")),
        keyed.prefix_scan(empty, "propertyCode", "p"),
        aggregate.daily_counts(empty),
        aggregate.mean_by(empty, ["neighborhood"], "price"),
        aggregate.count_by(empty, ["district"]),
        aggregate.head(empty, ["propertyCode"], 5),
        aggregate.peak(aggregate.daily_counts(empty), "listings_count", "date"),
        kpi.kpi1(empty),
        nested.unwind(spark.createDataFrame([], "k string, a array<int>"), "a", "x"),
    ]
    for df in frames:
        assert df.count() == 0


def test_global_aggregates_on_empty(spark, empty):
    assert aggregate.per_calendar_day(empty).first().per_day is None
    assert aggregate.mean_of(empty, "price", "m").first().m is None
    assert kpi.kpi1_summary(empty).first().avg_per_sampled_day is None
    assert stats.corr_pair(empty, "price", "price").first().r is None
    assert [r.r for r in stats.corr_matrix(empty, ["price", "price"]).collect()] == [None]
    assert aggregate.table_counts({"e": empty}).first().n == 0
