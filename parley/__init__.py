"""parley — conversation and text analytics expressed as Spark DataFrame jobs.

Layout:
  functions/  Column -> Column expressions (regex dialect, text, PII, arrays)
  operators/  DataFrame -> DataFrame operators (segments, rules, spans, BIO, corpus, metrics, models)
  sources/    readers and writers (tables, JSON calls, corpora, binary files, lexicons, sinks)
  plans/      the registered end-to-end queries and their DuckDB oracle SQL
  streaming/  Structured Streaming jobs built from the same expressions
"""

__version__ = "0.1.0"
