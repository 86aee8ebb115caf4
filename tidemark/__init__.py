"""tidemark: Spark-native analytics for panels of economic-style time series.

Subpackages:
  functions  Column builders (series windows, rule tables, calendar) - no UDFs
  operators  DataFrame operators (panel windows, alignment joins, quality checks)
  sources    table readers, observation panels, load/upsert/parse operators
  streaming  incremental load with Structured Streaming
  plans      the twenty models, reports, pipeline runner and registered queries
"""

__version__ = "0.1.0"
