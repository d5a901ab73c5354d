"""Readers and writers: text logs, telemetry landing data, CSV, and the fact table."""
