"""newsloom: a PySpark-native article collection, enrichment and search engine.

Every public function takes and returns DataFrames or Columns. Job-level values
such as ``now`` and ``ref_date`` are arguments; nothing reads the clock per row.
"""

__version__ = "0.1.0"
