"""A Spark-first engine for text corpora: DataFrame operators, sources and queries."""
