"""wakeline: Spark-native vessel-track analytics."""
