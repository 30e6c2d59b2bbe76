"""Views, registered queries and the stages of the raster pipeline."""
