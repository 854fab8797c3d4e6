"""panelforge: a Spark-native engine for operational and clinical tables.

Loading with schema checks, profiling reports, leakage-safe panel features,
reproducible splits, Spark ML training and batch/stream scoring. Every
operator takes and returns DataFrames and stays in built-in expressions.
"""

__version__ = "0.1.0"
