"""marketlens: campaign and CRM analytics expressed as Spark DataFrame plans.

Layers
------
sources    typed source-table schemas, readers, driver-table role adapters
functions  Column-level helpers: guarded KPI ratios, boundary date diffs, rule ladders
operators  DataFrame -> DataFrame primitives: latest record, dimension attach,
           windows, scalable global ranks, shares, period compare, calendar
plans      named marts, dashboard queries, measures and report queries
streaming  incremental refresh of the append-only sources
"""

__all__ = ["session"]
