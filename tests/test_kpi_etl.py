import datetime as dt
import os

import pytest

from tests import fixtures as fx
from zonekit.plans import etl, kpi
from zonekit.sources import readers, schemas

D = dt.date


@pytest.fixture()
def inputs(tmp_dir):
    lk = fx.write_name_lookups(tmp_dir)
    a, b = fx.write_pair_lookups(tmp_dir)
    return {
        "root": tmp_dir,
        "snapshots": fx.write_snapshots(tmp_dir),
        "income_csv": fx.write_income_csv(tmp_dir),
        "occupancy": fx.write_occupancy_csv(tmp_dir),
        "pair_listing": a,
        "pair_income": b,
        "lookups": lk,
        "income_docs": fx.write_income_docs(tmp_dir),
    }


def _latest(spark, inputs):
    return kpi.latest_listings(readers.read_json_snapshots(spark, inputs["snapshots"]))


def test_latest_listings(spark, inputs):
    got = {r.propertyCode: (r.date, r.price, r.distance) for r in _latest(spark, inputs).collect()}
    assert got == {
        "p1": (D(2020, 6, 1), 290000.0, 415.0),
        "p2": (D(2020, 1, 2), 300000.0, 415.0),
        "p5": (D(2020, 1, 2), 200000.0, 415.0),
        "p6": (D(2020, 6, 1), 100000.0, None),
    }


def test_kpi1(spark, inputs):
    latest = _latest(spark, inputs)
    assert [(r.date, r.listings_count) for r in kpi.kpi1(latest).collect()] == [(D(2020, 1, 2), 2), (D(2020, 6, 1), 2)]
    assert kpi.kpi1_average(latest).first().avg_per_sampled_day == 2.0
    assert kpi.kpi1b(latest).first().avg_per_calendar_day == pytest.approx(4 / 151)


def test_kpi2(spark, inputs):
    latest = _latest(spark, inputs)
    rent = readers.read_json_lines(spark, inputs["lookups"]["rent"], schemas.RENT_NAME_LOOKUP_SCHEMA)
    inc_lk = readers.read_json_lines(spark, inputs["lookups"]["income"], schemas.INCOME_NAME_LOOKUP_SCHEMA)
    docs = readers.read_json_lines(spark, inputs["income_docs"], schemas.INCOME_DOC_SCHEMA)
    out = kpi.kpi2(latest, rent, docs, inc_lk)
    assert out.columns == ["neighborhood", "mean_price", "rfd"]
    got = sorted(tuple(r) for r in out.collect())
    assert got == [("Pont Gris", 200000.0, 106.5), ("Serra Barcelona", 200000.0, 95.0), ("el Camp Gran", 290000.0, 78.0)]
    raw = sorted(r.neighborhood for r in kpi.kpi2(latest, rent, docs, inc_lk, clean_names=False).collect())
    assert raw == ['"Serra, Barcelona"', "Pont Gris", "el Camp Gran"]
    r = kpi.price_income_correlation(out).first().r
    assert -1.0 <= r <= 1.0


def test_kpi3(spark, inputs):
    occ = readers.read_occupancy_csv(spark, inputs["occupancy"])
    assert occ.first()["Any"] == 2020  # the byte-order mark does not hide the first column
    inc_lk = readers.read_json_lines(spark, inputs["lookups"]["income"], schemas.INCOME_NAME_LOOKUP_SCHEMA)
    docs = readers.read_json_lines(spark, inputs["income_docs"], schemas.INCOME_DOC_SCHEMA)
    got = sorted(tuple(r) for r in kpi.kpi3(occ, docs, inc_lk).collect())
    # the quoted raw name never matches: 3 occupancy rows -> 2 KPI rows
    assert got == [("Pont Gris", 2.75, 106.5), ("el Camp Gran", 2.16, 78.0)]


def test_kpi2b(spark, inputs):
    latest = _latest(spark, inputs)
    ll = readers.read_pair_lookup(spark, inputs["pair_listing"])
    il = readers.read_pair_lookup(spark, inputs["pair_income"])
    to_income, _ = etl.link_pair_lookups(ll, il)
    income = readers.read_income_csv(spark, inputs["income_csv"])
    got = {(r.year, r.district, r.neighborhood): r.ratio for r in kpi.kpi2b(latest, to_income, income).collect()}
    assert set(got) == {
        (2015, "Alta Marçà", "El Camp Gran"),
        (2016, "Alta Marçà", "El Camp Gran"),
        (2015, "Quadrat", "Pont Gris"),
        (2016, "Quadrat", "Pont Gris"),
    }
    assert got[(2016, "Alta Marçà", "El Camp Gran")] == pytest.approx(290000.0 / 71.5)
    assert got[(2015, "Quadrat", "Pont Gris")] == pytest.approx(2000.0)
    assert got[(2016, "Quadrat", "Pont Gris")] == pytest.approx(200000.0 / 107.0)  # last write wins
    with pytest.raises(Exception):  # Serra has no lookup entry
        kpi.kpi2b(latest, to_income, income, strict=True).collect()


def test_etl1(spark, inputs):
    out = os.path.join(inputs["root"], "store")
    counts = etl.etl1(
        spark, inputs["snapshots"], inputs["income_csv"], inputs["pair_listing"], inputs["pair_income"], out
    )
    got = {r.table: r.rows for r in counts.collect()}
    assert got == {"housing": 4, "income": 5, "listing-to-income": 2, "income-to-listing": 2}
    housing = spark.read.parquet(os.path.join(out, "housing"))
    r = housing.filter("key = 'p1'").select("cf1.price", "cf2.date").first()
    assert (r.price, r.date) == ("290000.0", "2020-06-01")
    inc = spark.read.parquet(os.path.join(out, "income"))
    fp = inc.filter("key = 'Quadrat-Pont Gris-2016'").first()
    assert fp.cf1.rfd == "107.0"
    lk = spark.read.parquet(os.path.join(out, "listing-to-income"))
    assert lk.filter("key = 'Alta-Marçà-El Camp Gran'").first().cf1.neighborhood == "el Camp-gran"
    missing = sorted((r.side, r.neighborhood) for r in spark.read.parquet(os.path.join(out, "unlinked")).collect())
    assert missing == [("income", "Santa Font, Santa Pedra i la Llera"), ("listing", "Serra")]


def test_etl2(spark, inputs):
    out = os.path.join(inputs["root"], "collections")
    counts = etl.etl2(spark, inputs["income_docs"], inputs["occupancy"], inputs["lookups"]["dir"], out)
    got = {r.table: r.rows for r in counts.collect()}
    assert got == {
        "income": 5,
        "inhabitants": 3,
        "income_lookup_district": 1,
        "income_lookup_neighborhood": 4,
        "rent_lookup_neighborhood": 3,
    }
    # append mode adds the rows again (K6)
    counts2 = etl.etl2(spark, inputs["income_docs"], inputs["occupancy"], inputs["lookups"]["dir"], out, mode="append")
    assert {r.table: r.rows for r in counts2.collect()}["inhabitants"] == 6


def test_report(spark, inputs):
    rent = readers.read_json_lines(spark, inputs["lookups"]["rent"], schemas.RENT_NAME_LOOKUP_SCHEMA)
    inc_lk = readers.read_json_lines(spark, inputs["lookups"]["income"], schemas.INCOME_NAME_LOOKUP_SCHEMA)
    docs = readers.read_json_lines(spark, inputs["income_docs"], schemas.INCOME_DOC_SCHEMA)
    occ = readers.read_occupancy_csv(spark, inputs["occupancy"])
    listings = readers.read_json_snapshots(spark, inputs["snapshots"])
    out = os.path.join(inputs["root"], "kpis")
    res = kpi.report(listings, rent, docs, inc_lk, occ, out)
    summary = {r.metric: r.value for r in res["summary"].collect()}
    assert summary["avg_per_sampled_day"] == 2.0
    assert summary["avg_per_calendar_day"] == pytest.approx(4 / 151)
    assert summary["corr_occupancy_income"] == pytest.approx(1.0)  # two points, both rising
    back = readers.read_result_csv(spark, os.path.join(out, "kpi2"), schemas.KPI2_SCHEMA)
    assert back.count() == 3
    res["latest"].unpersist()
    # lineage cut into spark.checkpoint.dir instead of a cache
    res2 = kpi.report(listings, rent, docs, inc_lk, occ, cut_lineage=True)
    assert res2["kpi1"].count() == 2


def test_command_line(spark, inputs):
    from zonekit.__main__ import main

    out = os.path.join(inputs["root"], "cli")
    main([
        "report",
        "--listings", inputs["snapshots"],
        "--rent-lookup", inputs["lookups"]["rent"],
        "--income-docs", inputs["income_docs"],
        "--income-lookup", inputs["lookups"]["income"],
        "--occupancy", inputs["occupancy"],
        "--out", out,
    ])
    assert readers.read_result_csv(spark, os.path.join(out, "kpi1"), schemas.KPI1_SCHEMA).count() == 2
    main([
        "etl1",
        "--listings", inputs["snapshots"],
        "--income", inputs["income_csv"],
        "--listing-lookup", inputs["pair_listing"],
        "--income-lookup", inputs["pair_income"],
        "--out", os.path.join(inputs["root"], "cli_store"),
    ])
    assert spark.read.parquet(os.path.join(inputs["root"], "cli_store", "housing")).count() == 4


def test_latest_income_null_and_empty(spark, inputs):
    docs = readers.read_json_lines(spark, inputs["income_docs"], schemas.INCOME_DOC_SCHEMA)
    got = {r.neigh_name: r.rfd for r in kpi.latest_income(docs).collect()}
    assert got == {"el Camp-gran": 78.0, "Pont Gris": 106.5, "Serra": 95.0, "Vallombra": None, "Les Eres": None}


def test_same_key_twice_on_one_date(spark, tmp_dir):
    d = os.path.join(tmp_dir, "tie")
    os.makedirs(d)
    rows = [
        fx.listing("t1", "Barcelona", "Quadrat", "Pont Gris", 100.0),
        fx.listing("t1", "Barcelona", "Quadrat", "Pont Gris", 150.0),
    ]
    with open(os.path.join(d, "2020_05_05_listings.json"), "w") as fp:
        import json

        json.dump(rows, fp)
    latest = kpi.latest_listings(readers.read_json_snapshots(spark, d))
    # stated tie rule: equal dates -> the larger price (tie_break) wins
    assert [(r.propertyCode, r.price) for r in latest.collect()] == [("t1", 150.0)]


def test_kpi2_fan_out_of_reconciled_names(spark):
    latest = spark.createDataFrame(
        [("Poble Nord", 100.0), ("El Camp Gran", 300.0)], "neighborhood string, price double"
    )
    rent = spark.createDataFrame(
        [("Poble Nord", "el Camp Gran"), ("El Camp Gran", "el Camp Gran")], "ne string, ne_re string"
    )
    docs = spark.createDataFrame([("el Camp-gran", [(2017, 78.0)])], "neigh_name string, info array<struct<year:int, RFD:double>>")
    inc_lk = spark.createDataFrame(
        [("el Camp-gran", "el Camp Gran")], "neighborhood string, neighborhood_reconciled string"
    )
    got = sorted(tuple(r) for r in kpi.kpi2(latest, rent, docs, inc_lk).collect())
    # two raw names, one reconciled name: one row per raw mean, not re-combined
    assert got == [("el Camp Gran", 100.0, 78.0), ("el Camp Gran", 300.0, 78.0)]


def test_kpi2_pair_zone_keys(spark):
    # the same name in two districts: keyed on the pair, the prices stay apart
    latest = spark.createDataFrame(
        [("D1", "Centre", 100.0), ("D2", "Centre", 300.0)], "district string, neighborhood string, price double"
    )
    rent = spark.createDataFrame(
        [("D1", "Centre", "Centre One"), ("D2", "Centre", "Centre Two")], "di string, ne string, ne_re string"
    )
    docs = spark.createDataFrame(
        [("c1", [(2017, 50.0)]), ("c2", [(2017, 90.0)])], "neigh_name string, info array<struct<year:int, RFD:double>>"
    )
    inc_lk = spark.createDataFrame(
        [("c1", "Centre One"), ("c2", "Centre Two")], "neighborhood string, neighborhood_reconciled string"
    )
    got = sorted(
        tuple(r)
        for r in kpi.kpi2(latest, rent, docs, inc_lk, zone_keys=("district", "neighborhood"), rent_raw=("di", "ne")).collect()
    )
    assert got == [("Centre One", 100.0, 50.0), ("Centre Two", 300.0, 90.0)]
    # keyed on the name alone the two districts would merge into one mean
    merged = kpi.kpi2(latest.drop("district"), rent.drop("di").dropDuplicates(["ne"]).filter("ne_re = 'Centre One'"), docs, inc_lk)
    assert [tuple(r) for r in merged.collect()] == [("Centre One", 200.0, 50.0)]


def test_command_line_report_from_parquet_snapshots(spark, inputs):
    from zonekit.__main__ import main

    # the JSON snapshots rewritten as one Parquet directory per date
    pq_root = os.path.join(inputs["root"], "pq_snapshots")
    for name, rows in fx.SNAPSHOTS.items():
        if not rows:
            continue
        stem = name[: -len(".json")]
        spark.createDataFrame(rows, schemas.LISTING_SCHEMA).write.parquet(os.path.join(pq_root, stem))
    out = os.path.join(inputs["root"], "cli_pq")
    main([
        "report", "--parquet",
        "--listings", pq_root,
        "--rent-lookup", inputs["lookups"]["rent"],
        "--income-docs", inputs["income_docs"],
        "--income-lookup", inputs["lookups"]["income"],
        "--occupancy", inputs["occupancy"],
        "--out", out,
    ])
    k1 = readers.read_result_csv(spark, os.path.join(out, "kpi1"), schemas.KPI1_SCHEMA)
    assert sorted((r.date, r.listings_count) for r in k1.collect()) == [("2020-01-02", 2), ("2020-06-01", 2)]


def test_reuse_cut_lineage_writes_to_checkpoint_dir(spark, tmp_dir):
    from zonekit.session import checkpoint_dir, reuse

    folder = checkpoint_dir(spark)
    before = sum(len(files) for _, _, files in os.walk(folder))
    df = spark.range(100).selectExpr("id", "id * 2 as v").filter("v > 10")
    cut = reuse(df, cut_lineage=True)
    after = sum(len(files) for _, _, files in os.walk(folder))
    assert cut.count() == 94 and after > before  # data written under spark.checkpoint.dir
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan  # the lineage above the checkpoint is gone


def _scan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def _stored(spark, tmp_dir, name, rows, schema):
    path = os.path.join(tmp_dir, name)
    spark.createDataFrame(rows, schema).write.parquet(path)
    return spark.read.parquet(path)


LISTING = "propertyCode string, date date, price double, district string, neighborhood string, municipality string, distance string, url string"


def test_plans_read_only_what_they_need(spark, tmp_dir):
    rows = [("p", dt.date(2020, 1, 2), 1.0, "D", "N", "Barcelona", "1", "u")]
    listings = _stored(spark, tmp_dir, "listings", rows, LISTING)
    plan = _scan(kpi.kpi1(kpi.latest_listings(listings, columns=("date",))))
    assert "url" not in plan and "distance" not in plan
    assert "IsNotNull(propertyCode)" in plan and "IsNotNull(neighborhood)" in plan and "EqualTo(municipality,Barcelona)" in plan
    latest = kpi.latest_listings(listings, columns=("neighborhood", "price"))
    assert latest.columns == ["neighborhood", "price"] and "url" not in _scan(latest)
    income = _stored(
        spark, tmp_dir, "income", [("D", "N", 2015, 70.0)],
        "Nom_Districte string, Nom_Barri string, Any int, `Índex RFD Barcelona = 100` double",
    )
    link = spark.createDataFrame([("D", "N", "D", "N")], "district string, neighborhood string, income_district string, income_neighborhood string")
    out = kpi.kpi2b(kpi.latest_listings(listings, columns=("district", "neighborhood", "price")), link, income)
    assert "In(Any, [2014,2015,2016])" in _scan(out)


def test_ties_never_depend_on_row_order(spark):
    day = dt.date(2020, 1, 2)
    rows = [("p", day, 5.0, "D", n, "Barcelona", "1", "u") for n in ("A", "C", "B")]
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        df = spark.createDataFrame(order, LISTING).repartition(3)
        assert [r.neighborhood for r in kpi.latest_listings(df).collect()] == ["C"]


def test_swapped_csv_columns_fail(spark, tmp_dir):
    path = os.path.join(tmp_dir, "swapped")
    os.makedirs(path)
    with open(os.path.join(path, "a.csv"), "w") as fp:
        fp.write('"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Índex RFD Barcelona = 100","Població"\n')
        fp.write('2015,3,"D",11,"N","70.0",40000\n')
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_income_csv(spark, path).collect()


def test_undated_snapshot_fails(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "listings.json"), "w") as fp:
        fp.write('[{"propertyCode": "p"}]')
    with pytest.raises(Exception, match="no date in name"):
        readers.read_json_snapshots(spark, tmp_dir).collect()
    assert readers.read_json_snapshots(spark, tmp_dir, strict_dates=False).first().date is None


def test_documents_are_stored_whole(spark, inputs, tmp_dir):
    docs = os.path.join(tmp_dir, "docs.json")
    with open(docs, "w") as fp:
        fp.write('{"_id": "Q1", "neigh_name": "N", "district": "D", "info": [{"year": 2016, "RFD": 70.0, "rest": 1}]}\n')
    out = os.path.join(tmp_dir, "etl2")
    etl.etl2(spark, docs, inputs["occupancy"], inputs["lookups"]["dir"], out)
    row = spark.read.parquet(os.path.join(out, "income")).first()
    assert (row["_id"], row["district"], row.info[0].rest) == ("Q1", "D", 1)


def test_an_entry_is_linked_or_reported(spark, tmp_dir):
    """A repeated (district, neighborhood) keeps its last ids, in the link and in the report."""
    schema = "district string, neighborhood string, district_id string, neighborhood_id string"
    ll = spark.createDataFrame([("D", "N", "1", "10"), ("D", "N", "1", "11")], schema).coalesce(1)
    il = spark.createDataFrame([("d", "n", "1", "10")], schema)
    linked, _ = etl.link_pair_lookups(ll, il)
    kept = etl.upsert_in_load_order(ll, ["district", "neighborhood"])
    lost = etl.unlinked(kept, il, ["district_id", "neighborhood_id"])
    assert linked.count() == 0 and [r.neighborhood_id for r in lost.collect()] == ["11"]
