"""A Spark-native engine for market and time-series analytics over lazy DataFrames."""
