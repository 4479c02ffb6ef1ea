"""Meseta: a Spark-native medallion engine for weather and electricity series."""
