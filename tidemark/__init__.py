"""Slot-ordered event ingestion and query engine on Spark DataFrames."""
