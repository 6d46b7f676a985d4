"""ingot: a PySpark medallion pipeline for shop clickstream events.

Layers: bronze (typed CSV ingest with rejects), silver (split and filled),
gold (product dimension, keyed event fact), with data-quality checks that
return DataFrames.  Entry points: `ingot.plans.medallion.run_medallion`,
`ingot.streaming.incremental.ingest_new_files`, and `python -m ingot`.
"""

__version__ = "0.1.0"
