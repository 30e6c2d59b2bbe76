"""Readers and writers of rasters, vector regions and reports."""
