"""Compositions: silver, star schema, views, data quality, profiling, materialised lake."""
