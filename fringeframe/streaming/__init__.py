"""Streams of new images and new observations."""
