"""vaultmart: a Spark-native batch warehouse.

Raw lake files -> typed, year-partitioned ODS -> Data Vault (hash-keyed hubs,
links and change-tracking satellites) -> star-schema payment report and a
traffic mart.  Every operator is a function from DataFrames to a DataFrame
built from Spark built-ins only; Catalyst plans and runs the work.

Layout
  sources/    schemas, raw-table fixtures, scans and sinks
  functions/  column-level helpers (hash keys, lenient casts, year filters,
              size-checked broadcast, distributed sequence ids)
  plans/      yearly runs, backfill, the query registry
"""

from vaultmart.session import configure, get_or_create_session  # noqa: F401

__all__ = ["configure", "get_or_create_session"]
