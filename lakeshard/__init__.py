"""lakeshard: text indexing and table maintenance on Spark DataFrames.

Sub-packages:
  sources    - readers for the test tables, whole-file text and file listings
  functions  - Column-expression helpers (tokenising, hashing, provenance)
  operators  - the data operators (index, copy, compaction, layouts, row rewrites)
  plans      - named conformance queries (Spark plan + DuckDB oracle SQL)
  streaming  - foreachBatch sinks that keep streamed tables compact
"""

from lakeshard.session import get_session, scratch_dir  # noqa: F401

__all__ = ["get_session", "scratch_dir"]
