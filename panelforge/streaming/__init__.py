"""Structured Streaming jobs: request scoring (ST1) and capture aggregates (ST2)."""
