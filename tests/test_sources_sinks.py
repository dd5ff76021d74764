import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import fixtures as fx
from zonekit.operators.clean import clean_listings
from zonekit.sinks import writers
from zonekit.sources import readers, schemas

D = dt.date


def test_json_array_snapshots(spark, tmp_dir):
    d = fx.write_snapshots(tmp_dir)
    df = readers.read_json_snapshots(spark, d)
    counts = {r.date: r["count"] for r in df.groupBy("date").count().collect()}
    # notes.txt is skipped by the glob; the empty array gives no row
    assert counts == {D(2020, 1, 2): 3, D(2020, 6, 1): 4, D(2021, 1, 1): 1}
    r = df.filter("propertyCode = 'p1' and date = '2020-01-02'").first()
    assert r.detailedType.typology == "flat" and r.distance == "415"


def test_parquet_snapshots_with_drift(spark, tmp_dir):
    root = os.path.join(tmp_dir, "pq")
    a = spark.createDataFrame(
        [("k1", 10.0, "D", "N", "Barcelona")], "propertyCode string, price double, district string, neighborhood string, municipality string"
    )
    b = spark.createDataFrame([("k2", 20.0, "N", "Barcelona")], "propertyCode string, price double, neighborhood string, municipality string")
    a.write.parquet(os.path.join(root, "2020_01_02_listings"))
    b.write.parquet(os.path.join(root, "2020_02_01_listings"))  # lacks district
    with open(os.path.join(root, "README.org"), "w") as fp:  # loose file: not a snapshot
        fp.write("* notes")
    df = readers.read_parquet_snapshots(spark, root)
    got = sorted((r.propertyCode, r.date, r.district) for r in df.collect())
    assert got == [("k1", D(2020, 1, 2), "D"), ("k2", D(2020, 2, 1), None)]
    # the snapshot without the column drops out after the required-column filter
    assert [r.propertyCode for r in clean_listings(df).collect()] == ["k1"]
    # U1 by name on per-snapshot frames gives the same rows
    u = readers.union_snapshots([a, b])
    assert sorted((r.propertyCode, r.district) for r in u.collect()) == [("k1", "D"), ("k2", None)]


def test_income_csv_and_pair_lookup(spark, tmp_dir):
    inc = readers.read_income_csv(spark, fx.write_income_csv(tmp_dir))
    assert inc.count() == 6
    r = inc.filter(F.col("Codi_Barri") == 4).first()
    assert r.Nom_Barri == "Santa Font, Santa Pedra i la Llera" and r["Índex RFD Barcelona = 100"] == 61.25
    a, _ = fx.write_pair_lookups(tmp_dir)
    lk = readers.read_pair_lookup(spark, a)
    assert lk.count() == 3 and lk.filter("neighborhood = 'Serra'").first().neighborhood_id == "Q30"


def test_json_lines_views_and_catalog(spark, tmp_dir):
    lk = fx.write_name_lookups(tmp_dir)
    views = readers.register_json_tables(spark, lk["dir"])
    assert views == ["income_lookup_district", "income_lookup_neighborhood", "rent_lookup_neighborhood"]
    assert spark.table("rent_lookup_neighborhood").count() == 3
    names = {r.name for r in readers.list_tables(spark).collect()}
    assert set(views) <= names
    dist = readers.read_json_lines(spark, lk["district"], schemas.INCOME_DISTRICT_LOOKUP_SCHEMA).first()
    assert dist.neighborhood_id == ["Q20"]
    generic = readers.read_source(spark, "json", lk["rent"], schemas.RENT_NAME_LOOKUP_SCHEMA)
    assert generic.filter("ne = 'Serra'").first().ne_re == '"Serra, Barcelona"'


def test_write_read_back(spark, tmp_dir):
    df = spark.createDataFrame([(D(2020, 1, 2), 2), (D(2020, 6, 1), 2)], "date date, listings_count long")
    csv_path = os.path.join(tmp_dir, "kpi1")
    writers.write_single_csv(df, csv_path)
    parts = [p for p in os.listdir(csv_path) if p.endswith(".csv")]
    assert len(parts) == 1
    back = readers.read_result_csv(spark, csv_path, schemas.KPI1_SCHEMA)
    assert sorted((r.date, r.listings_count) for r in back.collect()) == [("2020-01-02", 2), ("2020-06-01", 2)]
    jpath = os.path.join(tmp_dir, "json")
    writers.write(df, jpath, fmt="json")
    lines = [
        json.loads(line)
        for p in os.listdir(jpath)
        if p.endswith(".json")
        for line in open(os.path.join(jpath, p))
        if line.strip()
    ]
    assert len(lines) == 2 and set(lines[0]) == {"date", "listings_count"}
    ppath = os.path.join(tmp_dir, "pq")
    writers.write(df, ppath)
    writers.write(df, ppath, mode="append")  # K6
    assert spark.read.parquet(ppath).count() == 4
    writers.write(df, ppath)  # K5 full refresh
    assert spark.read.parquet(ppath).count() == 2
    cpath = os.path.join(tmp_dir, "clustered")
    writers.write(df.withColumn("district", F.lit("Quadrat")), cpath, cluster_by=["district", "date"], partition_by=["district"])
    assert spark.read.parquet(cpath).filter("district = 'Quadrat'").count() == 2


def test_family_table_nested_pruning(spark, tmp_dir):
    df = spark.createDataFrame(
        [("k1", "D", "N", 100.0, D(2020, 1, 2))], "propertyCode string, district string, neighborhood string, price double, date date"
    )
    path = os.path.join(tmp_dir, "housing")
    writers.write_family_table(df, path)
    read = spark.read.parquet(path).select("key", "cf2.date")
    assert read.first().date == D(2020, 1, 2)
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<key:string,cf2:struct<date:date>>" in plan


def test_save_and_drop_table(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    writers.save_table(df, "zk_test_table")
    assert spark.table("zk_test_table").count() == 1
    writers.drop_table(spark, "zk_test_table")
    assert "zk_test_table" not in {t.name for t in spark.catalog.listTables()}


def test_file_and_directory_date_columns(spark, tmp_dir):
    from zonekit.functions import scalar

    d = fx.write_snapshots(tmp_dir)
    df = spark.read.schema(schemas.LISTING_SCHEMA).option("multiLine", True).option("pathGlobFilter", "*.json").json(d)
    dates = sorted({r.d for r in df.select(scalar.file_name_date().alias("d")).collect()})
    assert dates == [D(2020, 1, 2), D(2020, 6, 1), D(2021, 1, 1)]
    root = os.path.join(tmp_dir, "pq2")
    spark.createDataFrame([("k",)], "propertyCode string").write.parquet(os.path.join(root, "2020_03_04_x"))
    got = spark.read.parquet(os.path.join(root, "*")).select(scalar.directory_date().alias("d")).first().d
    assert got == D(2020, 3, 4)
    files = [r.path for r in readers.list_files(spark, d, "*.json").collect()]
    assert len(files) == 4


def test_cluster_by_splits_a_hot_leading_key(spark, tmp_dir):
    # one district holds most rows; range partitioning on (district, n) still spreads it
    df = spark.range(4000).selectExpr("case when id % 4 = 0 then 'B' else 'A' end as district", "id as n")
    path = os.path.join(tmp_dir, "clustered_hot")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # tiny input: keep the range partitions apart
    try:
        writers.write(df.repartition(4), path, cluster_by=["district", "n"])
    finally:
        spark.conf.set(key, "true")
    back = spark.read.parquet(path)
    per_file = back.groupBy(F.col("_metadata.file_name")).count().collect()
    assert back.count() == 4000
    assert len(per_file) > 1 and max(r["count"] for r in per_file) < 3000


def test_snapshot_date_filter_prunes_files(spark, tmp_dir):
    d = fx.write_snapshots(tmp_dir)
    df = readers.read_json_snapshots(spark, d).filter(F.col("date") >= F.lit("2020-06-01").cast("date"))
    assert df.count() == 5

    def scanned_files(frame):
        frame.collect()  # run this frame's own plan so its scan metrics fill in
        found = []

        def walk(p):
            m = p.metrics()
            if m.contains("numFiles"):
                found.append(m.apply("numFiles").value())
            it = p.children().iterator()
            while it.hasNext():
                walk(it.next())

        plan = frame._jdf.queryExecution().executedPlan()
        walk(plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan)
        return sum(found)

    assert scanned_files(readers.read_json_snapshots(spark, d)) == 4
    assert scanned_files(df) == 3  # the 2020-01-02 file is never opened


def _write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as fp:
        fp.write(text)
    return path


SMALL = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])


def _bad_inputs(tmp_dir):
    """A cut and a partly bad JSON array, a bad CSV number, bad JSON lines."""
    snaps = os.path.join(tmp_dir, "snaps")
    _write(snaps, "2020_01_02_x.json", '[{"a":1,"b":"x"},{"a":2,"b":"y"}]')
    _write(snaps, "2020_01_03_x.json", '[{"a":5,"b":"x"},{"a":6,')
    _write(snaps, "2020_01_04_x.json", '[{"a":7},{"a":"no number","b":"y"}]')
    csv = _write(os.path.join(tmp_dir, "csv"), "t.csv", "a,b\n1,x\nzz,y\n3,z\n4,w,too many\n")
    lines = _write(os.path.join(tmp_dir, "lines"), "t.json", '{"a":1,"b":"x"}\n{"a":"q","b":"y"}\n{"a":3,\n{"a":4,"b":"w"}\n')
    return {
        "snapshots": (lambda s, **k: readers.read_json_snapshots(s, snaps, SMALL, **k), [1, 2], ["2020_01_03_x.json", "2020_01_04_x.json"]),
        "csv": (lambda s, **k: readers.read_csv_dir(s, csv, SMALL, **k), [1, 3], ["zz,y", "4,w,too many"]),
        "lines": (lambda s, **k: readers.read_json_lines(s, lines, SMALL, **k), [1, 4], ['{"a":"q","b":"y"}', '{"a":3,']),
    }


@pytest.mark.parametrize("kind", ["snapshots", "csv", "lines"])
def test_unreadable_input_fails_or_is_reported(spark, tmp_dir, kind):
    read, good_values, bad_records = _bad_inputs(tmp_dir)[kind]
    with pytest.raises(Exception, match="(?i)malformed|FAILED_READ_FILE"):
        read(spark).collect()
    good, bad = readers.split_bad(read(spark, on_bad="keep"))
    assert sorted(r.a for r in good.collect()) == good_values and good.count() == len(good_values)
    found = {(r.file.rsplit("/", 1)[-1], r.record, r.block_start) for r in bad.collect()}
    assert sorted(f if kind == "snapshots" else r for f, r, _ in found) == sorted(bad_records)
    assert all(start == 0 for *_, start in found) and readers.BAD not in good.columns
    # a pruned read finds the same records bad
    assert sorted(r.b for r in good.select("b").collect() if r.b) == sorted(r.b for r in good.collect() if r.b)
    assert read(spark, on_bad="null").count() >= len(good_values)


def test_kept_lines_without_a_schema(spark, tmp_dir):
    path = _write(tmp_dir, "open.json", '{"a":1,"b":"x"}\nnothing\n{"c":[1]}\n')
    good, bad = readers.split_bad(readers.read_json_lines(spark, path, on_bad="keep"))
    assert good.columns == ["a", "b", "c"] and good.count() == 2 and [r.record for r in bad.collect()] == ["nothing"]
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|PARSE"):
        readers.read_json_lines(spark, path).collect()
