"""Structured Streaming versions of intake, merge and rollup."""
