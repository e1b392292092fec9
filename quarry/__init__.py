"""A Spark-native engine for table profiling, join discovery and corpus preparation."""
