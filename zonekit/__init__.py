"""zonekit: zone-level listing, income and occupancy KPIs as PySpark DataFrame plans.

Subpackages: ``sources`` (scans with explicit schemas), ``functions``
(column expressions), ``operators`` (clean-up, latest-per-key, lookups,
aggregates, statistics, keyed access), ``sinks`` (writers), ``plans``
(KPI and ETL compositions, the registered queries) and ``llm``
(operators for training data, which nothing else imports).
"""

__version__ = "0.1.0"
