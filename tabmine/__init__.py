"""tabmine: DataFrame -> DataFrame operators for mining one large flat table on Spark.

Operators take column names as parameters; nothing here assumes a fixed schema.
Sub-packages:
  sources    readers and writers (CSV with explicit missing tokens, lookup files, JSON reports)
  functions  per-row Column expressions (no Python row functions)
  operators  cleaning, audit, profiling, encoding, splitting, selection, evaluation,
             association rules, models, clustering
  plans      bindings to the driver tables, registered queries and their SQL oracles
  streaming  the stateless derivations applied to a Structured Streaming source
"""

__version__ = "0.1.0"
