"""Whole jobs: ingestion, rollups, reports."""
