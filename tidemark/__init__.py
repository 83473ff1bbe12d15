"""tidemark: event, cost and reliability analytics on Spark DataFrames.

Sub-packages:
  sources    readers for the base tables and the analysis views
  functions  column expressions (scalar rules as built-in Spark expressions)
  operators  DataFrame -> DataFrame operators (joins, aggregates, windows)
  plans      plan inspection and guards (partition filters, scan bytes)
  streaming  Structured Streaming sources, sinks and stateful operators
  suite      registered analyses bound to the test tables
"""
