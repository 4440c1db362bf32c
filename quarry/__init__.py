"""quarry: Spark-native analytics for the data of an online photo service.

Subpackages: ``sources`` (scans, sinks, derived views of the driver tables),
``functions`` (column expressions), ``operators`` (DataFrame operators),
``streaming`` (Structured Streaming jobs), ``plans`` (queries bound to the
driver tables, with DuckDB oracle SQL).
"""

__version__ = "0.1.0"
