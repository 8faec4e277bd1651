"""A Spark-native catalogue engine."""
