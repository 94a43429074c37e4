"""Micro-batch ingestion of readings and the daily aggregates kept current by it."""
