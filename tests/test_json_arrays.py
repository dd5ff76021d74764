import json
import os
import random

import pytest
from pyspark.sql import types as T

from tests import fixtures as fx
from zonekit.sources import json_arrays, readers

SCHEMA = T.StructType(
    [
        T.StructField("a", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("o", T.StructType([T.StructField("x", T.ArrayType(T.StructType([T.StructField("y", T.StringType())])))])),
    ]
)


def _folder(tmp_dir):
    rng = random.Random(1)
    odd = ['"', "\\", "\\\\", "{", "}", "},{", "[", "]", '"}', "é🙂", ",", "\n", "x" * 30, '\\"', ""]
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    for day, indent in (("2020_01_02", None), ("2020_01_03", 2), ("2020_01_04", None)):
        rows = [{"a": i, "s": "".join(rng.choices(odd, k=rng.randint(0, 5))), "o": {"x": [{"y": rng.choice(odd)}] * rng.randint(0, 2)}} for i in range(60)]
        with open(f"{tmp_dir}/in/{day}_x.json", "w", encoding="utf-8") as fp:
            json.dump(rows if day != "2020_01_04" else [], fp, indent=indent, ensure_ascii=False)
    return f"{tmp_dir}/in"


@pytest.mark.parametrize("range_bytes", [7, 64, 1000, 1 << 20])
def test_rows_equal_the_plain_reader_however_files_are_cut(spark, tmp_dir, range_bytes):
    folder = _folder(tmp_dir)
    want = sorted(map(repr, readers.read_json_snapshots(spark, folder, SCHEMA).collect()))
    got = json_arrays.read_large_json_arrays(spark, folder, SCHEMA, range_bytes=range_bytes)
    assert sorted(map(repr, got.collect())) == want and len(want) == 120


def test_one_file_is_read_by_several_tasks(spark, tmp_dir):
    folder = _folder(tmp_dir)
    found = json_arrays.array_elements(spark, f"{folder}/2020_01_02_x.json", range_bytes=500)
    read = found.withColumn("task", json_arrays.F.spark_partition_id())
    assert read.count() == 60 and read.select("task").distinct().count() > 1


def test_listing_snapshots_and_cut_files(spark, tmp_dir):
    folder = fx.write_snapshots(tmp_dir)
    got = json_arrays.read_large_json_arrays(spark, folder, range_bytes=100)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, readers.read_json_snapshots(spark, folder).collect()))
    os.makedirs(f"{tmp_dir}/cut")
    with open(f"{tmp_dir}/cut/2020_01_02_x.json", "w") as fp:
        fp.write('[{"a":1},{"a":2,"s":"he')
    with pytest.raises(Exception, match="(?i)malformed"):
        json_arrays.read_large_json_arrays(spark, f"{tmp_dir}/cut", SCHEMA, range_bytes=8).collect()
