"""sylvan: Spark-native data preparation, profiling and readable-model learning.

Sub-packages:
  sources    - table, CSV and HTML readers/writers
  functions  - column expressions (parsers, bins, regex helpers)
  operators  - DataFrame operators (impurity, trees, metrics, sampling, EDA, ...)
  streaming  - Structured Streaming ingest / enrichment / scoring
  plans      - the registered queries and their SQL oracles
"""

from sylvan.session import checkpoint_root, get_spark, scratch_path

__all__ = ["get_spark", "checkpoint_root", "scratch_path"]
