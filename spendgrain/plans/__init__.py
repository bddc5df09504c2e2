"""Whole runs: ingestion and feature refresh."""
