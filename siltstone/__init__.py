"""Layered, incremental warehousing on Spark: extract, ingest, check, version, publish."""
