"""nestrel: nested JSON documents -> relational tables -> analytics, on Spark.

Sub-packages:
  functions/  Column expressions (JSON navigation, arrays, text, search normalisers)
  operators/  DataFrame -> DataFrame operators (entries, joins/aggregates, trees,
              integrity, capacity guards, full-text index)
  sources/    table and document scans, landing, request manifests, writes
  plans/      composite pipelines and the driver-table query catalogue
  streaming/  incremental landing of documents with Structured Streaming
"""

__version__ = "0.1.0"
