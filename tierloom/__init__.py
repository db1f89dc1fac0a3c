"""Layered analytics on Spark: typed landing, cleansing, star schema, quality checks and reports."""
