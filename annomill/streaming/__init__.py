"""Structured Streaming jobs: job status, landing outputs, running summaries."""
