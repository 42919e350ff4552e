"""Customer-event quality and remediation operators for Spark.

Every operator takes DataFrames and returns DataFrames; clocks, thresholds and
mappings are arguments.  The same functions serve batch and streaming.
"""
