"""boxstar: box-score warehouse and player benchmarking on Spark DataFrames.

Layers:
  sources    reading raw box-score inputs (CSV, Parquet landing, driver-table bindings)
  functions  column expressions (parsers, decoders, date parts, ratios, ladders)
  operators  distributed building blocks (dense keys, ranks, exact quantiles, reshaping)
  plans      recipes: warehouse build, audits, team analyses, player benchmarks and tiers
  streaming  incremental landing of new box-score files with Structured Streaming
"""

__all__ = ["config", "session"]
