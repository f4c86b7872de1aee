"""Spark-native raster tiling and spatial analytics."""
