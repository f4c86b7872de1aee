"""Readers of configuration, rasters and web pages."""
