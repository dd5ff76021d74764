import os
import shutil

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests import fixtures as fx
from zonekit.operators import reconcile
from zonekit.plans import etl, kpi
from zonekit.sinks import tables
from zonekit.sources import readers


def files(spark, name):
    """bucket -> names of its files."""
    rows = spark.table(name).select(tables.BUCKET, F.input_file_name().alias("f")).distinct().collect()
    return {r[0]: r.f for r in rows}


@pytest.fixture()
def stored(spark):
    name = "zk_keyed"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_keyed(spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"), F.lit("a").alias("t")), name, "k", buckets=16)
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_put_rewrites_only_the_buckets_it_touches(spark, stored):
    before = files(spark, stored)
    updates = spark.createDataFrame([(5, 1), (5, 0), (1000, 7)], "k long, v long")
    n = tables.put_rows(updates, stored, ["v"])
    assert n <= 2
    rows = {r.k: (r.v, r.t) for r in tables.read_keyed(spark, stored).collect()}
    assert rows[5] == (50, "a") and rows[1000] == (7, None) and len(rows) == 201  # the greatest by v stays
    assert tables.put_rows(updates.filter("v = 1"), stored) == 1  # by default the new row stays
    rows = {r.k: (r.v, r.t) for r in tables.read_keyed(spark, stored).collect()}
    assert rows[5] == (1, None) and rows[6] == (60, "a")
    after = files(spark, stored)
    assert len(before) == 16 and 14 <= sum(before[b] == after[b] for b in before) < 16
    tables.put_rows(updates.filter("v = 1"), stored)  # again: the same rows
    assert {r.k: (r.v, r.t) for r in tables.read_keyed(spark, stored).collect()} == rows
    assert tables.put_rows(updates.limit(0), stored) == 0


def test_put_equals_a_full_upsert(spark, stored):
    updates = spark.range(150, 260, 3).select(F.col("id").alias("k"), F.lit(-1).cast("long").alias("v"), F.lit("b").alias("t"))
    want = {r.k: (r.v, r.t) for r in tables.read_keyed(spark, stored).collect()} | {r.k: (r.v, r.t) for r in updates.collect()}
    tables.put_rows(updates, stored)
    assert {r.k: (r.v, r.t) for r in tables.read_keyed(spark, stored).collect()} == want


@pytest.mark.parametrize("as_frame", [False, True])
def test_delete_rewrites_only_the_buckets_it_touches(spark, stored, as_frame):
    before = files(spark, stored)
    keys = [3, None, 9999]
    n = tables.delete_rows(spark, stored, spark.createDataFrame([(k,) for k in keys], "x long") if as_frame else keys)
    after = files(spark, stored)
    assert n == 1 and sum(before[b] == after[b] for b in before) == 15
    assert sorted(r.k for r in tables.read_keyed(spark, stored).collect()) == [i for i in range(200) if i != 3]
    # a bucket that loses its last row
    bucket = spark.table(stored).filter("k = 7").first()[tables.BUCKET]
    gone = [r.k for r in spark.table(stored).filter(F.col(tables.BUCKET) == bucket).collect()]
    assert tables.delete_rows(spark, stored, gone) == 1 and bucket not in files(spark, stored)
    assert tables.read_keyed(spark, stored).count() == 199 - len(gone)
    assert tables.delete_rows(spark, stored, gone) == 0


def test_get_reads_the_buckets_of_its_keys(spark, stored):
    got = tables.get_keyed(spark, stored, [7, 123, 5000, None], ["k", "v"])
    assert sorted(map(tuple, got.collect())) == [(7, 70), (123, 1230)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert tables.BUCKET in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert tables.get_keyed(spark, stored, []).count() == 0


def test_a_failed_put_leaves_the_table(spark, stored):
    want = sorted(map(tuple, tables.read_keyed(spark, stored).collect()))
    broken = spark.createDataFrame([(5, 1)], "k long, v long").withColumn("t", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        tables.put_rows(broken, stored)
    assert sorted(map(tuple, tables.read_keyed(spark, stored).collect())) == want


def test_batches_can_run_again(spark):
    name = "zk_batches"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    frame = spark.range(10).select("id")
    tables.append_batch(frame, name, "2020-01-02")
    tables.append_batch(frame.limit(4), name, "2020-01-03")
    tables.append_batch(frame.limit(3), name, "2020-01-03")  # again, with other rows
    assert {r[0]: r[1] for r in spark.table(name).groupBy(tables.BATCH).count().collect()} == {"2020-01-02": 10, "2020-01-03": 3}
    with pytest.raises(Exception, match="stop"):
        tables.append_batch(frame.select(F.raise_error(F.lit("stop")).cast("long").alias("id")), name, "2020-01-02")
    tables.append_batch(frame.limit(0), name, "2020-01-03")
    assert spark.table(name).count() == 10
    spark.sql(f"DROP TABLE {name}")


def test_a_refresh_is_published_in_one_step(spark, tmp_dir):
    name = "zk_published"
    tables.replace_all(spark.range(5), name, tmp_dir, "v1")
    with pytest.raises(Exception, match="stop"):
        tables.replace_all(spark.range(9).select(F.raise_error(F.lit("stop")).cast("long").alias("id")), name, tmp_dir, "v2")
    assert spark.table(name).count() == 5
    tables.replace_all(spark.range(9), name, tmp_dir, "v2")
    tables.replace_all(spark.range(9), name, tmp_dir, "v2")
    assert spark.table(name).count() == 9
    with pytest.raises(ValueError):
        tables.replace_all(spark.range(9), name, tmp_dir, "../v3")
    spark.sql(f"DROP VIEW {name}")


def test_bucketed_tables_join_without_an_exchange(spark):
    rows = spark.range(500).select(F.col("id").alias("zone"), F.rand(1).alias("v"))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    try:
        for name in ("zk_left", "zk_right"):
            tables.save_bucketed(rows, name, ["zone"], 8)
        spark.conf.set(setting, "-1")
        joined = spark.table("zk_left").join(spark.table("zk_right"), "zone")
        assert joined.count() == 500
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        per_zone = spark.table("zk_left").groupBy("zone").agg(F.avg("v").alias("m"))
        assert "Exchange" not in per_zone._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
        for name in ("zk_left", "zk_right"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_incremental_run_equals_the_full_one(spark, tmp_dir, monkeypatch):
    folder = fx.write_snapshots(tmp_dir)
    whole = kpi.latest_listings(readers.read_json_snapshots(spark, folder))
    want = sorted(map(str, whole.collect()))
    part, name = os.path.join(tmp_dir, "arriving"), "zk_listings"
    os.makedirs(part)
    read: list = []
    plain = readers.read_json_snapshots
    monkeypatch.setattr(readers, "read_json_snapshots", lambda s, paths, **k: read.append(list(paths)) or plain(s, paths, **k))
    for table in (name, f"{name}_files"):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    names = sorted(n for n in os.listdir(folder) if n.endswith(".json"))
    for n in reversed(names):  # later snapshots first: the date decides, not the order of runs
        shutil.copy(os.path.join(folder, n), part)
        assert [p.rsplit("/", 1)[-1] for p in etl.take_in_snapshots(spark, part, name, buckets=4)] == [n]
        assert etl.take_in_snapshots(spark, part, name) == []
    assert [[p.rsplit("/", 1)[-1] for p in paths] for paths in read] == [[n] for n in reversed(names)]
    assert sorted(map(str, tables.read_keyed(spark, name).select(*whole.columns).collect())) == want
    # a run that failed before it noted its files is repeated
    spark.sql(f"DROP TABLE {name}_files")
    assert len(etl.take_in_snapshots(spark, part, name)) == len(names)
    assert sorted(map(str, tables.read_keyed(spark, name).select(*whole.columns).collect())) == want
    for table in (name, f"{name}_files"):
        spark.sql(f"DROP TABLE {table}")


def test_snapshots_with_drifting_types(spark, tmp_dir):
    for date, ddl, value in (("2020_01_02", "rooms long", 3), ("2020_02_01", "rooms int", 2), ("2020_03_01", "rooms string", "4"), ("2020_04_01", "rooms string", "many"), ("2020_05_01", "size double", 7.5)):
        spark.createDataFrame([(date, value)], f"propertyCode string, {ddl}").write.parquet(f"{tmp_dir}/{date}_x")
    schema = T.StructType([T.StructField("propertyCode", T.StringType()), T.StructField("rooms", T.IntegerType()), T.StructField("size", T.DoubleType())])
    got = readers.read_drifting_snapshots(spark, tmp_dir, schema)
    assert got.schema["rooms"].dataType == T.IntegerType()
    rows = {str(r.date): (r.rooms, r["size"]) for r in got.collect()}
    assert rows == {"2020-01-02": (3, None), "2020-02-01": (2, None), "2020-03-01": (4, None), "2020-04-01": (None, None), "2020-05-01": (None, 7.5)}


def test_audited_join_counts_in_the_same_pass(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("z"), "id")
    lookup = spark.createDataFrame([(i, f"n{i}") for i in range(7)], "z long, name string")
    joined, found = reconcile.audited_join(df, lookup, ["z"])
    assert joined.filter("name = 'n3'").count() == 10  # a later filter changes no count
    assert found.get == {"rows": 100, "unmatched": 30, "matched": 70}
