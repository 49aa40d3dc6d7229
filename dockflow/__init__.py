"""dockflow: Spark-native time-series feature engineering and evaluation engine.

Irregular station readings -> cleaned facts -> leak-free features (as-of lags,
historical profiles, temporal splits) -> pyspark.ml models -> evaluation tables,
with Structured Streaming ingestion of nested JSON snapshots.
"""

__version__ = "0.1.0"
