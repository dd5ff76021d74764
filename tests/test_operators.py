import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zonekit.operators import aggregate, clean, dedup, keyed, reconcile, stats

D = dt.date


# ------------------------------------------------------------------ dedup


def test_latest_by_key_with_ties(spark):
    rows = [
        ("p1", D(2020, 1, 2), 100.0),
        ("p1", D(2020, 6, 1), 120.0),
        ("p2", D(2020, 6, 1), 90.0),
        ("p2", D(2020, 6, 1), 95.0),  # tie on date -> larger price (tie-break column)
        ("p3", None, 50.0),  # null date sorts last
        ("p3", D(2020, 1, 1), 55.0),
    ]
    df = spark.createDataFrame(rows, "k string, date date, price double")
    got = {r.k: (r.date, r.price) for r in dedup.latest_by_key(df, ["k"], ["date", "price"]).collect()}
    assert got == {"p1": (D(2020, 6, 1), 120.0), "p2": (D(2020, 6, 1), 95.0), "p3": (D(2020, 1, 1), 55.0)}


def test_latest_by_key_empty(spark):
    df = spark.createDataFrame([], "k string, date date")
    assert dedup.latest_by_key(df, ["k"], ["date"]).count() == 0


def test_upsert_last_write_wins(spark):
    old = spark.createDataFrame([("a", 1, 10.0), ("b", 1, 20.0)], "k string, v int, x double")
    new = spark.createDataFrame([("a", 2), ("c", 2)], "k string, v int")  # lacks x -> null
    got = {r.k: (r.v, r.x) for r in dedup.upsert(old, new, ["k"], ["v"]).collect()}
    assert got == {"a": (2, None), "b": (1, 20.0), "c": (2, None)}


def test_upsert_in_load_order(spark):
    df = spark.createDataFrame([("a", "b", 1.0), ("a", "b", 2.0), ("c", "d", 3.0)], "x string, y string, v double").coalesce(1)
    got = sorted((r.x, r.v) for r in dedup.upsert_in_load_order(df, ["x", "y"]).collect())
    assert got == [("a", 2.0), ("c", 3.0)]


# ------------------------------------------------------------------ clean


def test_clean_listings(spark):
    rows = [
        ("1", "Barcelona", "Quadrat", "Pont Gris", "415"),
        ("2", "Badalona", "X", "Y", "10"),  # other municipality
        ("3", "Barcelona", None, "Y", "10"),  # no district
        (None, "Barcelona", "A", "B", "1"),  # no key
        ("4", "Barcelona", "Marina", "Vila de Marga", "bad"),  # bad distance -> null
    ]
    df = spark.createDataFrame(rows, "propertyCode string, municipality string, district string, neighborhood string, distance string")
    got = {r.propertyCode: r.distance for r in clean.clean_listings(df).collect()}
    assert got == {"1": 415.0, "4": None}


def test_project_odd_names(spark):
    df = spark.createDataFrame([("el Rocar", 2.78)], "`Nom_Barri` string, `Ocupacio_mitjana_(persones_ per_domicili)` double")
    out = clean.project(df, {"n": "Nom_Barri", "o": "Ocupacio_mitjana_(persones_ per_domicili)"})
    assert out.columns == ["n", "o"] and out.first().o == 2.78


def test_family_table_strings(spark):
    df = spark.createDataFrame(
        [("k1", "D", "N", 100.0, D(2020, 1, 2), 41.3, 2.1, "flat", "good", 90.0, 3, 1, 415.0, False, 3660.0)],
        "propertyCode string, district string, neighborhood string, price double, date date, latitude double, "
        "longitude double, propertyType string, status string, size double, rooms long, bathrooms long, "
        "distance double, newDevelopment boolean, priceByArea double",
    )
    r = clean.family_table(df, as_strings=True).first()
    assert r.key == "k1"
    assert r.cf1.price == "100.0" and r.cf2.date == "2020-01-02" and r.cf4.newDevelopment == "False"
    typed = clean.family_table(df).first()
    assert typed.cf1.price == 100.0 and typed.cf2.date == D(2020, 1, 2)


# -------------------------------------------------------------- reconcile


def test_apply_lookup_inner_and_fanout(spark):
    price = spark.createDataFrame([("Serra", 10.0), ("Sants", 20.0), ("Nowhere", 5.0), (None, 1.0)], "n string, p double")
    lk = spark.createDataFrame(
        [("Serra", '"Serra, Barcelona"'), ("Sants", "Sants"), ("Sants", "Sants Bis")], "ne string, ne_re string"
    )
    out = reconcile.apply_lookup(price, lk, "n", "ne_re", "neighborhood", lookup_raw="ne")
    got = sorted((r.neighborhood, r.p) for r in out.collect())
    assert got == [('"Serra, Barcelona"', 10.0), ("Sants", 20.0), ("Sants Bis", 20.0)]
    assert out.columns == ["neighborhood", "p"]
    keep = reconcile.apply_lookup(price, lk, "n", "ne_re", "re", lookup_raw="ne", keep_raw=True)
    assert set(keep.columns) == {"re", "n", "p"}


def test_link_and_unlinked(spark):
    a = spark.createDataFrame([("D1", "N1", "d1", "n1"), ("D1", "N2", "d1", "n2"), ("D2", "N3", "d2", "n3")],
                              "district string, neighborhood string, di string, ni string")
    b = spark.createDataFrame([("d1", "n1", "X", "Y"), ("d1", "n1", "A", "B"), ("d2", "n3", "Q", "R")],
                              "di string, ni string, od string, on string")
    linked = reconcile.link_lookups(a, b, ["di", "ni"], ["od", "on"])
    got = sorted((r.neighborhood, r.od, r.on) for r in linked.collect())
    assert got == [("N1", "A", "B"), ("N3", "Q", "R")]  # first by name wins
    miss = [r.neighborhood for r in reconcile.unlinked(a, b, ["di", "ni"]).collect()]
    assert miss == ["N2"]


def test_strict_join(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    lk = spark.createDataFrame([("a", "A")], "k string, name string")
    with pytest.raises(Exception):
        reconcile.strict_join(df, lk, ["k"]).collect()
    ok = reconcile.strict_join(df.filter("k = 'a'"), lk, ["k"]).collect()
    assert [(r.k, r.name) for r in ok] == [("a", "A")]


# -------------------------------------------------------------- aggregate


def test_daily_counts_sorted_and_mean(spark):
    df = spark.createDataFrame([(D(2020, 1, 8),), (D(2020, 1, 2),), (D(2020, 1, 8),)], "date date")
    counts = aggregate.daily_counts(df)
    assert [(r.date, r.listings_count) for r in counts.collect()] == [(D(2020, 1, 2), 1), (D(2020, 1, 8), 2)]
    assert aggregate.mean_of(counts, "listings_count", "a").first().a == 1.5


def test_per_calendar_day(spark):
    df = spark.createDataFrame([(D(2020, 1, 2),), (D(2020, 1, 12),), (D(2020, 1, 12),)], "date date")
    assert aggregate.per_calendar_day(df).first().per_day == pytest.approx(0.3)
    one = spark.createDataFrame([(D(2020, 1, 2),), (D(2020, 1, 2),)], "date date")
    assert aggregate.per_calendar_day(one).first().per_day is None  # zero divisor


def test_mean_through_equals_direct(spark):
    facts = spark.createDataFrame([(1, 10.0), (1, 20.0), (2, 30.0), (3, 40.0), (9, 99.0)], "k long, v double")
    mapping = spark.createDataFrame([(1, "z1"), (2, "z1"), (3, "z2")], "mk long, zone string")
    got = {r.zone: r.mean for r in aggregate.mean_through(facts, "k", "v", mapping, "mk", ["zone"]).collect()}
    assert got == {"z1": 20.0, "z2": 40.0}


def test_count_by_keeps_null_group(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",)], "d string")
    got = {r.d: r["count"] for r in aggregate.count_by(df, ["d"]).collect()}
    assert got == {"a": 2, None: 1}


def test_peak_and_head(spark):
    df = spark.createDataFrame([(D(2020, 1, 2), 5), (D(2020, 1, 1), 5), (D(2020, 1, 3), 1)], "d date, n long")
    assert aggregate.peak(df, "n", "d").first().d == D(2020, 1, 1)
    assert [r.d for r in aggregate.head(df, ["d"], 2).collect()] == [D(2020, 1, 1), D(2020, 1, 2)]


def test_ratio_and_log(spark):
    df = spark.createDataFrame([("z", 2016, 281000.0, 71.5), ("z", 2016, 281000.0, 71.5), ("y", 2016, 1.0, 0.0)],
                               "zone string, year int, price double, rfd double")
    got = {r.zone: r.ratio for r in aggregate.ratio_by(df, ["zone", "year"], "price", "rfd").collect()}
    assert got["z"] == pytest.approx(281000.0 / 71.5) and got["y"] is None
    counts = spark.createDataFrame([(D(2020, 1, 2), 1), (D(2020, 1, 3), 2100)], "date date, listings_count long")
    logs = {r.date: r.listings_count_log for r in aggregate.log_series(counts).collect()}
    assert logs[D(2020, 1, 2)] == 0.0 and logs[D(2020, 1, 3)] == pytest.approx(math.log(2100))


def test_avg_nested_ignores_non_numbers(spark):
    df = spark.createDataFrame([("A", "1.5"), ("A", "x"), ("A", "2.5"), ("B", None)], "district string, v string")
    got = {r.district: r.rfd for r in aggregate.avg_nested(df, ["district"], "v", "rfd").collect()}
    assert got == {"A": 2.0, "B": None}


def test_table_counts(spark):
    out = aggregate.table_counts({"a": spark.range(3), "b": spark.range(0)})
    assert sorted((r.t, r.n) for r in out.collect()) == [("a", 3), ("b", 0)]


# ------------------------------------------------------------------ stats


def test_corr_pair_and_matrix(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=200)
    y = 2 * x + rng.normal(size=200)
    z = rng.normal(size=200)
    df = spark.createDataFrame([(float(a), float(b), float(c), "t") for a, b, c in zip(x, y, z)], "x double, y double, z double, s string")
    r = stats.corr_pair(df, "x", "y").first().r
    assert r == pytest.approx(np.corrcoef(x, y)[0, 1], rel=1e-9)
    m = {(row.a, row.b): row.r for row in stats.corr_matrix(df).collect()}
    assert set(m) == {("x", "y"), ("x", "z"), ("y", "z")}  # text column left out
    assert m[("x", "z")] == pytest.approx(np.corrcoef(x, z)[0, 1], rel=1e-9)
    full = stats.corr_matrix(df, ["x", "y"], full=True).collect()
    assert len(full) == 4


def test_corr_golden_shape(spark):
    # correlation is symmetric and 1 on a perfect linear relation
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0)], "a double, b double")
    assert stats.corr_pair(df, "a", "b").first().r == pytest.approx(1.0)


# ------------------------------------------------------------------ keyed


def test_keyed_access(spark):
    df = spark.createDataFrame([("row1", 1), ("row2", 2), ("other", 3), (None, 4)], "key string, v int")
    assert sorted(r.key for r in keyed.get_rows(df, "key", ["row1", "nope"]).collect()) == ["row1"]
    keys = spark.createDataFrame([("row2",), ("other",)], "k string")
    assert sorted(r.v for r in keyed.get_rows(df, "key", keys, ["v"]).collect()) == [2, 3]
    assert sorted(r.key for r in keyed.prefix_scan(df, "key", "row").collect()) == ["row1", "row2"]
    # only named keys go; a null key stays, and a null among the keys deletes nothing
    assert sorted(r.v for r in keyed.delete_keys(df, "key", ["row1"]).collect()) == [2, 3, 4]
    for named in (["row1", None], spark.createDataFrame([("row1",), (None,)], "k string"), ["row1", None, *map(str, range(2000))]):
        assert sorted(r.v for r in keyed.delete_keys(df, "key", named).collect()) == [2, 3, 4]
        assert [r.v for r in keyed.get_rows(df, "key", named).collect()] == [1]
    assert sorted(r.v for r in keyed.delete_keys(df, "key", keys).collect()) == [1, 4]
    assert keyed.zone_equals(df, "v", 3).count() == 1
    assert keyed.scan(df, ["v"]).columns == ["v"]


def test_avg_map_values(spark):
    df = spark.createDataFrame(
        [("D", "N", {"2015": 70.0, "2016": 80.0}), ("D", "N", {"2017": 90.0}), ("D", "M", {}), ("E", "X", None)],
        "district string, neighborhood string, rfd map<string,double>",
    )
    got = {(r.district, r.neighborhood): r.rfd for r in aggregate.avg_map_values(df, ["district", "neighborhood"], "rfd", "rfd").collect()}
    assert got == {("D", "N"): 80.0}  # empty and null maps are dropped by the unwind


def test_latest_by_key_forms_agree(spark):
    import random

    rnd = random.Random(7)
    rows = [
        (rnd.randint(0, 30), rnd.choice([None, D(2020, 1, rnd.randint(1, 5))]), rnd.randint(0, 3), float(i))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k int, date date, t int, v double")
    a = dedup.latest_by_key(df, ["k"], ["date", "t", "v"])
    b = dedup.latest_by_key_window(df, ["k"], ["date", "t", "v"])
    assert a.columns == df.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    keys_only = dedup.latest_by_key(df.select("k", "v"), ["k", "v"], ["v"])
    assert keys_only.count() == df.select("k", "v").distinct().count()


def test_with_constant_and_date_range(spark):
    df = spark.createDataFrame([(D(2020, 1, 2),), (D(2021, 3, 9),)], "date date")
    assert [r.src for r in clean.with_constant(df, "src", "x").collect()] == ["x", "x"]
    r = aggregate.date_range(df).first()
    assert (r.min_date, r.max_date) == (D(2020, 1, 2), D(2021, 3, 9))
    empty = aggregate.per_calendar_day(spark.createDataFrame([], "date date")).first()
    assert empty.per_day is None


def test_first_by_key_matches_window(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(3)
    rows = [(rnd.randint(0, 20), rnd.choice([None, "a", "b", "c"]), rnd.choice([None, 1, 2]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k int, name string, n int, pos int")
    order = ["name", "n", "pos"]
    a = dedup.first_by_key(df, ["k"], order)
    b = dedup.latest_by_key_window(df, ["k"], [F.col(o).asc_nulls_last() for o in order])
    assert a.columns == df.columns
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)


def test_latest_and_first_by_key_odd_column_names(spark):
    df = spark.createDataFrame(
        [("a", 1, 10.0), ("a", 2, 20.0), ("b", 5, 1.0)], "`k.ey` string, `Índex RFD = 100` int, `v.x` double"
    )
    got = sorted(tuple(r) for r in dedup.latest_by_key(df, ["k.ey"], ["Índex RFD = 100"]).collect())
    assert got == [("a", 2, 20.0), ("b", 5, 1.0)]
    first = sorted(tuple(r) for r in dedup.first_by_key(df, ["k.ey"], ["Índex RFD = 100"]).collect())
    assert first == [("a", 1, 10.0), ("b", 5, 1.0)]
    assert dedup.latest_by_key(df, ["k.ey"], ["v.x"]).columns == df.columns


def test_lookup_with_dotted_names(spark):
    df = spark.createDataFrame([("x", 1)], "`raw.name` string, v int")
    lk = spark.createDataFrame([("x", "X")], "`lk.raw` string, `lk.re` string")
    out = reconcile.apply_lookup(df, lk, "raw.name", "lk.re", "re", lookup_raw="lk.raw")
    assert [tuple(r) for r in out.collect()] == [("X", 1)]


def test_corr_on_text_columns_is_ansi_safe(spark):
    df = spark.createDataFrame([("1", "2"), ("2", "4"), ("x", "5"), ("3", "6")], "a string, b string")
    assert stats.corr_pair(df, "a", "b").first().r == pytest.approx(1.0)  # 'x' is skipped, not an error


def test_upsert_in_load_order_with_explicit_order(spark):
    df = spark.createDataFrame([("a", 2, 1.0), ("a", 1, 2.0)], "k string, file_no int, v double").coalesce(1)
    # read order alone: the later row wins; with an explicit order the larger file_no wins
    assert dedup.upsert_in_load_order(df, ["k"]).first().v == 2.0
    assert dedup.upsert_in_load_order(df, ["k"], order_by=["file_no"]).first().v == 1.0


def test_corr_zero_variance_is_null_not_an_error(spark):
    # Spark's corr raises DIVIDE_BY_ZERO here under ANSI mode; ours gives null
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "x double, y double")
    assert stats.corr_pair(df, "x", "y").first().r is None
    assert [r.r for r in stats.corr_matrix(df).collect()] == [None]


def test_correlation_leaves_out_nan_and_constant_columns(spark):
    rows = [(1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, float("nan"), 5.0), (4.0, 8.0, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert stats.corr_pair(df, "a", "b").first().r == pytest.approx(1.0)
    full = {(r.a, r.b): r.r for r in stats.corr_matrix(df, full=True).collect()}
    assert full[("a", "a")] == 1.0 and full[("c", "c")] is None and full[("a", "c")] is None


def test_many_columns_in_one_vector_aggregate(spark):
    """More columns than expressions are made for: equal to the pairwise results, nulls and NaN included."""
    rng = np.random.default_rng(7)
    k, rows = 14, 600
    x = rng.normal(size=(rows, k)) * 10.0 ** rng.integers(-2, 7, k) + 10.0 ** rng.integers(0, 4, k)
    x[:, 1] = 0.1  # constant
    x[rng.random((rows, k)) < 0.2] = np.nan
    x[:, 2] = np.where(np.isnan(x[:, 3]), 5.0 + x[:, 3], 0.3)  # constant wherever column 3 is there
    x[:, 4] = np.nan  # never there
    x[:300, 5] = np.nan
    x[300:, 6] = np.nan  # never together with column 5
    names = [f"c.{i}" for i in range(k)]
    cells = [[None if np.isnan(v) and i % 2 else float(v) for v in row] for i, row in enumerate(x)]
    df = spark.createDataFrame(cells, ", ".join(f"`{n}` double" for n in names)).repartition(7)
    got = {(r.a, r.b): r.r for r in stats.corr_matrix(df, names).collect()}
    assert len(got) == k * (k - 1) // 2
    for i, a in enumerate(names):
        for j in range(i + 1, k):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            u, v = x[both, i], x[both, j]
            if len(u) < 2 or u.min() == u.max() or v.min() == v.max():
                assert got[a, names[j]] is None
            else:
                assert got[a, names[j]] == pytest.approx(np.corrcoef(u, v)[0, 1], abs=1e-7), (a, names[j], len(u))
    full = {(r.a, r.b): r.r for r in stats.corr_matrix(df, names, full=True).collect()}
    assert len(full) == k * k and full["c.0", "c.0"] == 1.0 and full["c.1", "c.1"] is None
    assert full["c.7", "c.0"] == pytest.approx(got["c.0", "c.7"])
    assert [r.r for r in stats.corr_matrix(df.limit(0), names).collect()] == [None] * len(got)


def test_two_hundred_columns(spark):
    import time

    df = spark.range(5000, numPartitions=4).select(*[F.sin(F.col("id") * (i + 1)).alias(f"c{i}") for i in range(200)])
    began = time.time()
    rows = stats.corr_matrix(df).count()
    assert rows == 200 * 199 // 2 and time.time() - began < 60
