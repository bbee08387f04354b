"""A Spark-native engine for semi-structured records and training corpora."""
