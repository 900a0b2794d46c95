"""Structured Streaming jobs: tick ingestion and clock-driven snapshot publishing."""
