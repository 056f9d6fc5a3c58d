"""Ingest, reporting and run control for broadcast schedule files, on Spark DataFrames."""
