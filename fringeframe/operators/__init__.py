"""Operators on pixel tables, image pairs and networks of dates."""
