"""Spark-native automatic coding and record matching."""
