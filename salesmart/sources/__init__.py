"""Readers for CSV, GeoJSON, COPY dumps and raw tables."""
