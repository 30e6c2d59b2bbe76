"""Raster-stack analytics and data-pipeline operators on PySpark."""
