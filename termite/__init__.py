"""termite: Spark-native text retrieval and topic analytics."""
