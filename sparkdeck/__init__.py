"""Data jobs as DataFrame operators: relational, text, raster, series, spatial, models and streams."""
