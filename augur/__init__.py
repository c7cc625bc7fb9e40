"""augur: forecast-survey analytics on Spark.

Layers:
  sources/    readers (CSV, Parquet, driver tables) and sinks
  functions/  Column -> Column helpers (cleaning, dates, labels)
  operators/  reusable DataFrame operators (keys, sequences, latest, dedup, reshape)
  plans/      model build, marts, derived KPIs, data-quality detectors, query catalog
  streaming/  incremental (append) loading of new forecast extracts
"""

__version__ = "0.1.0"
