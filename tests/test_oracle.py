"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E
from zonekit.plans import roles

SF = os.environ.get("ZONEKIT_ORACLE_SF", "/root/testdata/sf0.001")  # e.g. .../sf0.1 for a larger check
TABLES = "region nation customer supplier part orders lineitem events".split()

duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return "nan" if math.isnan(v) else round(v, 9)
        return v

    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(roles.QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["zone", "mean_price", "income"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(roles.QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    a, b = _canon(df.columns, srows), _canon(dcols, drows)
    assert a == b


def test_building_a_query_reads_no_rows(spark):
    """Planning may read file footers (jobs without stages that scan), never rows."""
    tracker = spark.sparkContext.statusTracker()
    for name, query in roles.QUERIES.items():
        spark.sparkContext.setJobGroup(f"plan-{name}", name)
        spark.read.parquet(f"{SF}/nation.parquet").schema
        one = len(tracker.getJobIdsForGroup(f"plan-{name}"))
        query(spark, SF)
        jobs = len(tracker.getJobIdsForGroup(f"plan-{name}")) - one
        tables = 14  # at most one footer read for each time a table is opened
        assert jobs <= tables * one, name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_appended_files_are_read(spark, tmp_dir):
    """Nothing about a table is kept between two calls."""
    d = os.path.join(tmp_dir, "grown")
    for t in ("customer", "nation", "region"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
    before = roles.customer_zone(spark, d).count()
    more = spark.read.parquet(f"{SF}/customer.parquet")
    more.write.mode("append").parquet(f"{d}/customer.parquet")
    assert roles.customer_zone(spark, d).count() == 2 * before
