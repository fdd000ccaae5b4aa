"""Spark-native terrain analytics: raster cells, features, labelled points, statistics and models as DataFrames."""
