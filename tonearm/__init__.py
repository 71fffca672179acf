"""Listening warehouse on Spark: event ingest, Data Vault, marts, catalogue queries."""
