"""Hot-key check: do the key-based queries stay balanced when one key holds
a third of all rows?

Usage: python tools/scale_check.py [src_sf_dir] [copies] [--sort-merge]

``--sort-merge`` switches off Spark's automatic broadcast joins (static and
adaptive), so the customer mapping is joined by sort-merge as it would be at
scale.

Builds, in a fresh scratch folder, two copies of the source tables with
``orders`` repeated ``copies`` times (new order keys): one as is, one where
every third order belongs to customer 1.  Runs the key-based queries on
both with Spark's event log in the scratch folder, and prints per query the
time on each copy and, for the hot-key copy, the largest and the median
number of shuffle records read by one task of each post-shuffle stage.
"""

from __future__ import annotations

import glob
import io
import json
import os
import statistics
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from zonekit.plans import roles  # noqa: E402
from zonekit.session import get_session  # noqa: E402

QUERIES = ["latest_by_key", "upsert_by_key", "mean_by", "composite_key", "latest_from_array",
           "zone_ratio_by_year", "kpi_price_income", "kpi1_daily", "kpi1_summary", "kpi2_listing_model", "kpi2_correlation",
           "kpi2b_listing_model"]
TABLES = ["customer", "nation", "region", "supplier", "events", "lineitem"]


def build(spark, src: str, dst: str, copies: int, hot: bool) -> None:
    o = roles.table(spark, src, "orders")
    key = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey")) if hot else F.col("o_custkey")
    big = o.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)).cast("array<long>"))).select(
        (F.col("o_orderkey") * copies + F.col("rep")).alias("o_orderkey"),
        key.cast("long").alias("o_custkey"),
        "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority",
    )
    big.repartition(32).write.mode("overwrite").parquet(f"{dst}/orders.parquet")
    for t in TABLES:
        roles.table(spark, src, t).write.mode("overwrite").parquet(f"{dst}/{t}.parquet")


def stage_balance(log_dir: str) -> dict[str, list[tuple[int, float]]]:
    import zstandard

    out: dict[str, list[tuple[int, float]]] = defaultdict(list)
    group_of: dict[int, str] = {}
    reads: dict[int, list[int]] = defaultdict(list)
    for f in glob.glob(f"{log_dir}/*/events*") + glob.glob(f"{log_dir}/events*"):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8").splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                for s in e["Stage IDs"]:
                    group_of[s] = g
            elif e.get("Event") == "SparkListenerTaskEnd":
                m = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                reads[e["Stage ID"]].append(m.get("Total Records Read", 0))
    for s, rs in reads.items():
        if len(rs) > 1 and max(rs) > 0 and group_of.get(s):
            out[group_of[s]].append((max(rs), statistics.median(rs)))
    return out


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sort_merge = "--sort-merge" in sys.argv
    src = args[0] if args else "/root/testdata/sf0.1"
    copies = int(args[1]) if len(args) > 1 else 10
    scratch = tempfile.mkdtemp(prefix="zonekit-scale-")
    log_dir = os.path.join(scratch, "events")
    os.makedirs(log_dir)
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir}
    if sort_merge:
        conf.update({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark = get_session("local[8]", shuffle_partitions=16, conf=conf)
    dirs = {"uniform": os.path.join(scratch, "uniform"), "hot": os.path.join(scratch, "hot")}
    for name, d in dirs.items():
        build(spark, src, d, copies, hot=(name == "hot"))
    times: dict[str, dict[str, float]] = defaultdict(dict)
    for name, d in dirs.items():
        for q in QUERIES:
            spark.sparkContext.setJobGroup(f"{name}:{q}", q)
            roles.QUERIES[q](spark, d).write.format("noop").mode("overwrite").save()  # warm
            t0 = time.perf_counter()
            roles.QUERIES[q](spark, d).write.format("noop").mode("overwrite").save()
            times[q][name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    balance = stage_balance(log_dir)
    print(f"scratch: {scratch}")
    print(f"{'query':22s} {'uniform s':>10s} {'hot s':>8s}  hot-key stages: max/median shuffle records per task")
    for q in QUERIES:
        stages = ", ".join(f"{mx}/{md:.0f}" for mx, md in balance.get(f"hot:{q}", []))
        print(f"{q:22s} {times[q]['uniform']:10.3f} {times[q]['hot']:8.3f}  {stages}")


if __name__ == "__main__":
    main()
