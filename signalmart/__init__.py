"""signalmart: explainable daily demand signals from overlapping feeds, on Spark.

Layout
  sources/    readers and writers (raw CSV, seeds, payload JSON, test tables)
  functions/  column expressions (cleaning, local time, flags)
  operators/  DataFrame -> DataFrame building blocks (dedupe, rollups,
              trailing baseline, calendar joins, rules, alerts, quality)
  plans/      the marts composed from operators, plus the query registry
  streaming/  incremental ingest, freshest-wins upsert, tumbling counts
"""

__version__ = "0.1.0"
