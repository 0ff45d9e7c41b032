"""Continuous activity analytics on Spark: typed JSON topics, landed Parquet, windowed
counts, incremental rankings and keyed serving tables."""
