"""Spark-native analytics toolkit: text, relational, series, graph, streaming and ML jobs."""
