"""Mention analytics on Spark: identify symbols in posts, count and rank
mentions per time bucket, join them with price bars, publish the results.

Modules: ``functions`` (Column expressions), ``sources`` (readers and
stand-in inputs), ``operators`` (DataFrame operators), ``sinks`` (tables),
``streaming`` (Structured Streaming jobs), ``plans`` (registered queries).
"""
