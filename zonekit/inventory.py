"""Where each operator ID of SURVEY §2 lives (``module:function`` paths).

``tests/test_inventory.py`` resolves every entry, so a renamed or removed
operator fails the build instead of silently dropping coverage.
"""

from __future__ import annotations

import importlib

INVENTORY: dict[str, list[str]] = {
    # 2.1 scans / sources / session
    "S1": ["zonekit.sources.readers:read_json_snapshots", "zonekit.sources.json_arrays:read_large_json_arrays"],
    "S2": ["zonekit.sources.readers:read_csv_dir", "zonekit.sources.readers:read_income_csv"],
    "S3": ["zonekit.sources.readers:read_pair_lookup", "zonekit.operators.dedup:upsert_in_load_order"],
    "S4": ["zonekit.sources.readers:read_parquet_snapshots", "zonekit.sources.readers:read_drifting_snapshots"],
    "S5": ["zonekit.sources.readers:read_json_lines", "zonekit.sources.readers:register_json_tables"],
    "S6": ["zonekit.sources.readers:read_occupancy_csv"],
    "S7": ["zonekit.sources.readers:read_source", "zonekit.sources.documents:register"],
    "S8": ["zonekit.operators.keyed:scan"],
    "S9": ["zonekit.sources.readers:read_result_csv"],
    "S10": ["zonekit.sources.readers:list_tables"],
    "S11": ["zonekit.session:get_session"],
    "S12": ["zonekit.session:reuse", "zonekit.plans.etl:take_in_snapshots"],
    # 2.2 sinks
    "K1": ["zonekit.sinks.writers:write"],
    "K2": ["zonekit.operators.clean:family_table", "zonekit.sinks.writers:write_family_table"],
    "K3": ["zonekit.operators.clean:measure_table", "zonekit.sinks.writers:write_measure_table"],
    "K4": ["zonekit.plans.etl:link_pair_lookups", "zonekit.operators.clean:lookup_table", "zonekit.sinks.writers:write_lookup_table"],
    "K5": ["zonekit.sinks.writers:write", "zonekit.sinks.tables:replace_all"],
    "K6": ["zonekit.sinks.writers:write", "zonekit.sinks.tables:append_batch"],
    "K7": ["zonekit.sinks.writers:write_single_csv"],
    "K8": ["zonekit.sinks.writers:write", "zonekit.sinks.tables:save_bucketed", "zonekit.sinks.tables:get_keyed"],
    "K9": ["zonekit.sinks.writers:save_table", "zonekit.operators.dedup:upsert", "zonekit.sinks.writers:drop_table",
           "zonekit.sinks.tables:create_keyed", "zonekit.sinks.tables:put_rows", "zonekit.sinks.tables:delete_rows"],
    # 2.3 projections and scalar functions
    "P1": ["zonekit.functions.scalar:date_from_name", "zonekit.functions.scalar:file_name_date",
           "zonekit.functions.scalar:directory_date"],
    "P2": ["zonekit.operators.clean:with_constant"],
    "P3": ["zonekit.functions.scalar:numeric", "zonekit.operators.clean:cast_numeric"],
    "P4": ["zonekit.operators.clean:family_table"],
    "P5": ["zonekit.operators.clean:project"],
    "P6": ["zonekit.operators.reconcile:apply_lookup"],
    "P7": ["zonekit.operators.clean:project"],
    "P8": ["zonekit.functions.scalar:composite_key"],
    "P9": ["zonekit.functions.scalar:dash_free"],
    "P10": ["zonekit.functions.scalar:split_key"],
    "P11": ["zonekit.functions.scalar:parse_date_prefix"],
    "P12": ["zonekit.functions.scalar:natural_log"],
    "P13": ["zonekit.functions.scalar:safe_ratio"],
    "P14": ["zonekit.operators.clean:project", "zonekit.functions.nested:object_to_array"],
    # 2.4 filters
    "F1": ["zonekit.operators.clean:require"],
    "F2": ["zonekit.operators.clean:where_equals"],
    "F3": ["zonekit.sources.readers:read_parquet_snapshots", "zonekit.operators.clean:require"],
    "F4": ["zonekit.sources.readers:read_json_snapshots", "zonekit.sources.readers:read_csv_dir"],
    "F5": ["zonekit.plans.kpi:kpi2b", "zonekit.plans.roles:zone_ratio_by_year"],
    "F6": ["zonekit.operators.keyed:zone_equals"],
    "F7": ["zonekit.operators.keyed:get_rows", "zonekit.sinks.tables:get_keyed"],
    "F8": ["zonekit.operators.keyed:get_rows", "zonekit.sinks.tables:get_keyed"],
    "F9": ["zonekit.operators.keyed:prefix_scan"],
    "F10": ["zonekit.operators.keyed:delete_keys", "zonekit.sinks.tables:delete_rows"],
    # 2.5 joins
    "J1": ["zonekit.operators.reconcile:link_lookups"],
    "J2": ["zonekit.operators.reconcile:unlinked", "zonekit.operators.reconcile:audited_join"],
    "J3": ["zonekit.operators.reconcile:strict_join", "zonekit.operators.reconcile:audited_join", "zonekit.plans.kpi:kpi2b"],
    "J4": ["zonekit.operators.reconcile:apply_lookup"],
    "J5": ["zonekit.operators.reconcile:apply_lookup", "zonekit.plans.kpi:income_reconciled"],
    "J6": ["zonekit.operators.reconcile:join_on_reconciled"],
    "J7": ["zonekit.operators.reconcile:apply_lookup"],
    "J8": ["zonekit.operators.reconcile:join_on_reconciled"],
    # 2.6 aggregations
    "A1": ["zonekit.operators.dedup:latest_by_key"],
    "A2": ["zonekit.operators.dedup:latest_by_key", "zonekit.plans.kpi:latest_listings"],
    "A3": ["zonekit.operators.dedup:upsert", "zonekit.operators.dedup:upsert_in_load_order"],
    "A4": ["zonekit.operators.aggregate:count_by", "zonekit.operators.aggregate:daily_counts"],
    "A5": ["zonekit.operators.aggregate:mean_of"],
    "A6": ["zonekit.operators.aggregate:per_calendar_day"],
    "A7": ["zonekit.operators.aggregate:mean_by", "zonekit.operators.aggregate:mean_through"],
    "A8": ["zonekit.operators.aggregate:mean_by"],
    "A9": ["zonekit.operators.aggregate:ratio_by", "zonekit.plans.kpi:kpi2b"],
    "A10": ["zonekit.operators.aggregate:count_by"],
    "A11": ["zonekit.operators.aggregate:avg_map_values"],
    "A12": ["zonekit.operators.aggregate:avg_nested"],
    "A13": ["zonekit.operators.aggregate:table_counts"],
    "A14": ["zonekit.operators.aggregate:date_range"],
    "A15": ["zonekit.operators.aggregate:log_series"],
    "A16": ["zonekit.operators.stats:corr_pair"],
    "A17": ["zonekit.operators.stats:corr_matrix", "zonekit.operators.comoments:pair_correlations"],
    "A18": ["zonekit.functions.nested:latest_from_array"],
    # 2.7 sort / limit / top-k
    "O1": ["zonekit.operators.aggregate:daily_counts"],
    "O2": ["zonekit.functions.nested:latest_from_array", "zonekit.functions.nested:sorted_desc_first"],
    "O3": ["zonekit.operators.aggregate:head"],
    "O4": ["zonekit.operators.aggregate:peak"],
    # 2.8 set operations
    "U1": ["zonekit.sources.readers:union_snapshots"],
    # 2.9 array / map / JSON
    "X1": ["zonekit.functions.nested:object_to_array"],
    "X2": ["zonekit.functions.nested:unwind", "zonekit.functions.nested:unwind_map"],
    "X3": ["zonekit.functions.nested:json_map", "zonekit.functions.nested:json_field",
           "zonekit.sources.readers:read_json_lines"],
    "X4": ["zonekit.functions.nested:field"],
    # 2.10 KPI compositions
    "KPI1": ["zonekit.plans.kpi:kpi1", "zonekit.plans.kpi:kpi1_average", "zonekit.plans.kpi:kpi1_summary"],
    "KPI1b": ["zonekit.plans.kpi:kpi1b"],
    "KPI2": ["zonekit.plans.kpi:kpi2"],
    "KPI2b": ["zonekit.plans.kpi:kpi2b"],
    "KPI3": ["zonekit.plans.kpi:kpi3"],
    "ETL1": ["zonekit.plans.etl:etl1"],
    "ETL2": ["zonekit.plans.etl:etl2"],
}


def resolve(path: str):
    """The callable behind a ``module:function`` path."""
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)
