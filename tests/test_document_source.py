import json
import re

import pytest

from zonekit.sources import documents, readers

SCHEMA = "name string, year int, info array<struct<year: int, RFD: double>>"


@pytest.fixture()
def folder(spark, tmp_dir):
    import os

    documents.register(spark)
    for collection, n in (("income", 1000), ("other", 3)):
        os.makedirs(f"{tmp_dir}/{collection}")
        with open(f"{tmp_dir}/{collection}/part.json", "w", encoding="utf-8") as fp:
            for i in range(n):
                row = {"_id": i, "name": f"zone é {i % 10}" if i % 7 else None, "year": 2000 + i % 5, "info": [{"year": 2000, "RFD": i / 2}]}
                fp.write(json.dumps(row, ensure_ascii=False) + "\n" + "\n" * (i % 50 == 0))
    return tmp_dir


def read(spark, folder, **options):
    return spark.read.format(documents.FORMAT).schema(SCHEMA).options(path=folder, **options).load()


@pytest.mark.parametrize("range_bytes", [97, 4096, 1 << 20])
def test_every_document_once_however_files_are_cut(spark, folder, range_bytes):
    got = read(spark, folder, collection="income", rangeBytes=range_bytes)
    plain = readers.read_json_lines(spark, f"{folder}/income", got.schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert (got.rdd.getNumPartitions() > 1) == (range_bytes < 1 << 20)
    assert read(spark, folder).count() == 1003


def test_the_reader_sees_filters(spark, folder):
    df = read(spark, folder, collection="income")
    for where in ("name = 'zone é 3' and year = 2001", "year in (2001, 2004)", "name is not null and year > 2002", "info[0].RFD = 4.5"):
        plain = readers.read_json_lines(spark, f"{folder}/income", df.schema).filter(where)
        assert sorted(map(str, df.filter(where).collect())) == sorted(map(str, plain.collect())), where
    reader = documents.DocumentReader(df.schema, {"path": folder})
    kept = documents.IsNotNull(("info", "x"))
    assert list(reader.pushFilters([documents.EqualTo(("year",), 2001), kept])) == [kept]
    rows = sum(b.num_rows for part in reader.partitions() for b in reader.read(part))
    assert rows == df.filter("year = 2001").count() + 1
    plan = df.filter("year = 2001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)  # nothing is left for Spark to filter


def test_a_bad_document_fails(spark, folder):
    with open(f"{folder}/other/part.json", "a") as fp:
        fp.write('{"name": \n')
    with pytest.raises(Exception, match="JSONDecodeError"):
        read(spark, folder, collection="other").collect()
    with pytest.raises(Exception):
        spark.read.format(documents.FORMAT).option("path", folder).load()
