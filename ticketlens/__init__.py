"""ticketlens — ticket-sale and journey analytics as Spark DataFrame plans.

Layers:
  sources/    scans of the driver tables, the derived ``rides`` binding, CSV/Parquet sinks
  functions/  column expressions (time of day, calendar, money, keys)
  operators/  reusable DataFrame operators (cleaning, contiguous ids, grouping, profiling, filters)
  plans/      star-schema build, notebook reports, SQL-script reports, dashboard panels, query catalog
  streaming/  incremental panel aggregates over arriving ride files
"""

from ticketlens.session import checkpoint_dir, drop_materialised, get_spark, materialise

__all__ = ["get_spark", "checkpoint_dir", "materialise", "drop_materialised"]
