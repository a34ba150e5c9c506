"""cmdeval: instruction-to-command corpus preparation and evaluation on Spark.

Sub-packages:
  functions  - Column expressions (text cleaning, tokens, per-pair metrics)
  operators  - DataFrame -> DataFrame operators (prep, scoring, summaries, reports,
               telemetry, Python-worker surfaces)
  sources    - readers / writers with fixed schemas and fixtures derived from tables
  streaming  - Structured Streaming jobs (log tail, running evaluation, telemetry windows)
  plans      - the named query catalogue and the matching DuckDB SQL
"""

__version__ = "0.1.0"
