"""Structured Streaming jobs: landing, latest state, real-time views."""
