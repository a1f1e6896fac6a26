"""Spark-native analytics for swath-sonar bathymetry."""
