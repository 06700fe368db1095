"""Metric-stream analytics on Spark: parse, join, window, store, query, forecast, decide."""
