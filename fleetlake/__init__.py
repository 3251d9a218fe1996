"""fleetlake: Spark-native analytics for fleet and rental businesses."""
