"""statlayer: layered statistical data products on Spark DataFrames.

Packages: ``sources`` (scans), ``functions`` (column expressions), ``operators`` (reshape, conform,
aggregate, window, join, dedup), ``plans`` (data products, published queries, query catalogue,
pipeline), ``quality`` (checks, rules, contracts), ``publish`` (upsert, audit, atomic switch),
``profile`` (column and distribution profiles), ``streaming`` (incremental snapshot refresh).
"""
__version__ = "0.1.0"
