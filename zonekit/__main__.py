"""Command line: ``python -m zonekit <command> ...``.

Commands
  etl1    snapshots + income CSVs + pair lookups -> stored tables, row counts
  etl2    income documents + occupancy CSV + JSON lookups -> one table per file
  report  KPI1/KPI2/KPI3 as CSV files and a summary (means, correlations)

The session comes from the launcher (``spark-submit``); ``--master`` is only
for local runs.
"""

from __future__ import annotations

import argparse

from zonekit.session import get_session


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="zonekit")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)

    e1 = sub.add_parser("etl1")
    e1.add_argument("--listings", required=True, help="folder of YYYY_MM_DD_*.json snapshot files")
    e1.add_argument("--income", required=True, help="folder of yearly income CSV files")
    e1.add_argument("--listing-lookup", required=True)
    e1.add_argument("--income-lookup", required=True)
    e1.add_argument("--out", required=True)

    e2 = sub.add_parser("etl2")
    e2.add_argument("--income-docs", required=True)
    e2.add_argument("--occupancy", required=True)
    e2.add_argument("--lookups", required=True, help="folder of JSON-lines lookup files")
    e2.add_argument("--out", required=True)
    e2.add_argument("--mode", default="overwrite", choices=["overwrite", "append"])

    r = sub.add_parser("report")
    r.add_argument("--listings", required=True, help="snapshot folder (JSON arrays) or Parquet root with --parquet")
    r.add_argument("--parquet", action="store_true", help="listings are one Parquet directory per date")
    r.add_argument("--rent-lookup", required=True)
    r.add_argument("--income-docs", required=True)
    r.add_argument("--income-lookup", required=True)
    r.add_argument("--occupancy", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--cut-lineage", action="store_true", help="checkpoint reused frames into spark.checkpoint.dir")

    a = p.parse_args(argv)
    spark = get_session(a.master)

    if a.cmd == "etl1":
        from zonekit.plans.etl import etl1

        etl1(spark, a.listings, a.income, a.listing_lookup, a.income_lookup, a.out).show(truncate=False)
    elif a.cmd == "etl2":
        from zonekit.plans.etl import etl2

        etl2(spark, a.income_docs, a.occupancy, a.lookups, a.out, a.mode).show(truncate=False)
    else:
        from zonekit.plans.kpi import report
        from zonekit.sources import readers, schemas

        listings = (
            readers.read_parquet_snapshots(spark, a.listings)
            if a.parquet
            else readers.read_json_snapshots(spark, a.listings)
        )
        res = report(
            listings,
            readers.read_json_lines(spark, a.rent_lookup, schemas.RENT_NAME_LOOKUP_SCHEMA),
            readers.read_json_lines(spark, a.income_docs, schemas.INCOME_DOC_SCHEMA),
            readers.read_json_lines(spark, a.income_lookup, schemas.INCOME_NAME_LOOKUP_SCHEMA),
            readers.read_occupancy_csv(spark, a.occupancy),
            out_dir=a.out,
            cut_lineage=a.cut_lineage,
        )
        res["summary"].show(truncate=False)


if __name__ == "__main__":
    main()
